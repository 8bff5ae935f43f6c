"""Near duplicates by SuperMinHash, banding, exact verification and union-find.

Each shingle draws one random permutation of the signature's components and a random
fraction per step; a component keeps the least ``step + fraction`` that falls on it.
The ranks of one shingle are thus correlated, without repetition, which lowers the
variance against independent hashes; and once every component is below the current
step no later step can change anything, so long texts stop after a step or two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm import words
from keyfold.llm.components import components
from keyfold.llm.placed import placed
from keyfold.session import materialize

#: A pair with a similarity of 0.8 shares no band with a chance below 1e-7.
BANDS, ROWS = 54, 6
_BLOCK = 2048
_STEP = 0x9E3779B97F4A7C15


def signature(elements: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash of distinct 64-bit hashes: per component ``step << 32 | fraction``."""
    least = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(elements), _BLOCK):
        block = elements[at:at + _BLOCK]
        rows, order, step = np.arange(len(block)), None, 0
        # values of a step are at least the step: done when every component lies below
        while step < size and step <= int(least.max() >> np.uint64(32)):
            drawn = words.mix(block + np.uint64(_STEP * (step + 1) % (1 << 64)))
            slot = step + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(size - step)) >> np.uint64(32)).astype(np.int64)
            if step == 0:
                place = slot
            else:
                if order is None:  # what the first step left of each permutation
                    order = np.tile(np.arange(size, dtype=np.int32), (len(block), 1))
                    order[rows, first] = 0
                place = order[rows, slot]
                order[rows, slot] = order[:, step]
            if step == 0:
                first = slot
            np.minimum.at(least, place, (np.uint64(step) << np.uint64(32)) | (drawn >> np.uint64(32)))
            step += 1
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature; keys of different bands do not meet."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(words.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = words.pair(key, parts[:, :, i])
    return key


def shingles(w: words.Words, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``width`` consecutive words per text; fewer words are one shingle."""
    out, first = [], w.first
    for i in range(len(first) - 1):
        own = w.hash[first[i]:first[i + 1]]
        n = max(1, len(own) - width + 1) if len(own) else 0
        made = own[:n]
        for k in range(1, min(width, len(own))):
            made = words.pair(made, own[k:k + n])
        if 0 < len(own) < width:
            made = words.mix(made + np.uint64(len(own)))
        out.append(np.unique(made))
    return out


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """Per document: size and 128-bit digest of its set, and its band keys."""

    def run(batches):
        for batch in batches:
            for at, to, w in words.of_column(batch.column(1)):
                sets = shingles(w, width)
                with np.errstate(over="ignore"):
                    d1 = np.array([words.mix(s).sum(dtype=np.uint64) for s in sets]).astype(np.uint64).view(np.int64)
                    d2 = np.array([words.mix(s ^ np.uint64(_STEP)).sum(dtype=np.uint64) for s in sets]).astype(np.uint64).view(np.int64)
                keys = band_keys(np.stack([signature(s) for s in sets])).view(np.int64).ravel()
                filled = np.array([len(s) > 0 for s in sets])
                first = np.concatenate([[0], np.cumsum(filled * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(first), pa.array(keys[np.repeat(filled, BANDS)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1), pa.array(d2), bands],
                    names=["id", "n_shingles", "d1", "d2", "bands"])

    return docs.mapInArrow(run, "id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at, to, w in words.of_column(batch.column(1)):
                blobs = [s.tobytes() for s in shingles(w, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(blobs, pa.binary())], names=["id", "items"])

    return docs.mapInArrow(run, "id bigint, items binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with ``share``, the hundredths of their full sets' union that both have, rounded down."""

    def run(batches):
        for batch in batches:
            share = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                share.append(100 * shared // (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share, pa.int64())], names=["a", "b", "share"])

    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a")
    return both.select("a", "b", "items_a", "items_b").mapInArrow(run, "a bigint, b bigint, share bigint")


def _compared(table: pa.Table, percent: int) -> pa.Table:
    """Links between the sets of one block that belong to different components so far.

    Every pair of which one is outside the largest component is compared, one set with
    all others at once, unless links found before already connect it.
    """
    ids, component = table["rep"].to_numpy(), table["component"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"].combine_chunks()]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    distinct, number = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(size)])
    names, label = np.unique(component, return_inverse=True)
    label = label.copy()
    main = np.bincount(label).argmax()
    mark, a, b = np.zeros(len(distinct), dtype=bool), [], []
    for i in np.argsort(ids, kind="stable"):
        if label[i] == main:
            continue
        own = number[first[i]:first[i + 1]]
        mark[own] = True
        shared = np.bincount(owner[mark[number]], minlength=len(sets))
        mark[own] = False
        for j in np.flatnonzero(100 * shared >= percent * (size + size[i] - shared)):
            if label[j] != label[i]:
                a.append(ids[i]), b.append(ids[j])
                old, new = (label[i], label[j]) if label[i] != main else (label[j], label[i])
                label[label == old] = new
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


#: Sets that one task compares with each other, twice at most of these.
BLOCK_SETS = 512


def _within(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside groups (rep, grouped, component), compared block by block of their members."""
    sizes = (groups.groupBy("grouped").agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
             .where(F.col("x") != F.col("y")).select("grouped", F.ceil(F.col("size") / BLOCK_SETS).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (groups.join(sizes, "grouped").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("rep", "component", "grouped", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    full = dealt.join(sets.withColumnRenamed("id", "rep"), "rep")
    return full.groupBy("grouped", "i", "j").applyInArrow(lambda t: _compared(t, percent), "a bigint, b bigint")


#: Share of two sets from which they are put in one group to be compared as a whole.
GROUP_PERCENT = 40


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id and kept.

    Two documents are linked when 100 * shared shingles >= percent * all their shingles;
    a component is what links connect, named after its smallest id, which alone is kept.
    A document without words, or without text, has no shingles and no links. Ids are
    integers; rows with equal ids are one node. A row without id joins no other by
    itself, takes the component of equal sets if there are any, and is kept if not.

    Equal sets are put together before banding, so copies never meet in pairs. In each
    band bucket the first member is compared with all others. Sets connected by shares
    of ``GROUP_PERCENT`` form groups, and a group that holds several components is
    compared as a whole, a block of it against a block. What a bucket still holds of
    different groups and components is compared one, two, four ... members with
    all others at a time, until every pair of its members is connected or was compared.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("body"))
    scanned = materialize(_scan(rows, width))
    sets_of = scanned.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    sets_of = materialize(sets_of)
    banded = sets_of.where(F.col("rep").isNotNull()).select(F.explode("bands").alias("bucket"), "rep")
    shared = (banded.groupBy("bucket").agg(F.min("rep").alias("lead"), F.max("rep").alias("last"), F.count("*").alias("size"),
                                           F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"))
              .where(F.col("lead") != F.col("last"))
              # buckets of the same members count once
              .groupBy("lead", "last", "size", "who").agg(F.min("bucket").alias("bucket")).select("bucket", "lead", "size"))
    members = materialize(banded.join(shared, "bucket"))
    wanted = members.select(F.col("rep").alias("id")).distinct()
    sets = _sets(rows.join(wanted, "id", "left_semi"), width).distinct()
    # kept in the partitioning by id that all joins below ask for
    sets = placed(sets, "id")

    pairs = members.where("rep != lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    tested = materialize(_verified(pairs, sets, percent))
    links = tested.where(F.col("share") >= percent).select("a", "b")
    found = materialize(components(links))
    groups = materialize(components(tested.where(F.col("share") >= min(percent, GROUP_PERCENT)).select("a", "b"))
                         .select(F.col("node").alias("rep"), F.col("component").alias("grouped")))

    def labelled(frame):
        return frame.join(found, frame["rep"] == found["node"], "left").select(
            *(frame[c] for c in frame.columns), F.coalesce("component", "rep").alias("component"))

    more = materialize(_within(labelled(groups), sets, percent))
    links = links.union(more)
    found = materialize(components(links))

    def split(frame):
        """Members of buckets that hold several components and several groups."""
        mixed = (labelled(frame).groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                                       F.min("grouped").alias("p"), F.max("grouped").alias("q"))
                 .where((F.col("x") != F.col("y")) & (F.col("p") != F.col("q"))).select("bucket"))
        return frame.join(mixed, "bucket", "left_semi")

    left = members.where("size > 2").select("bucket", "rep")
    left = left.join(groups, "rep", "left").select("bucket", "rep", F.coalesce("grouped", "rep").alias("grouped"))
    left = split(left)
    left = materialize(left.withColumn("rank", F.row_number().over(W.partitionBy("bucket").orderBy("rep"))))
    done, step, tested = 1, 1, tested.select("a", "b")
    while not left.where(F.col("rank") > done + 1).isEmpty():
        now = labelled(left)
        leads = now.where((F.col("rank") > done) & (F.col("rank") <= done + step)).select(
            "bucket", F.col("rep").alias("a"), F.col("rank").alias("at"), F.col("component").alias("of"), F.col("grouped").alias("in"))
        pairs = (now.join(leads, "bucket").where((F.col("rank") > F.col("at")) & (F.col("component") != F.col("of"))
                                                 & (F.col("grouped") != F.col("in")))
                 .select("a", F.col("rep").alias("b")).distinct().join(tested, ["a", "b"], "left_anti"))
        pairs = materialize(pairs)
        more = materialize(_verified(pairs, sets, percent).where(F.col("share") >= percent).select("a", "b"))
        tested, done, step = tested.union(pairs), done + step, step * 2
        if not more.isEmpty():
            links = links.union(more)
            found = materialize(components(links))
            left = materialize(split(left))
    sets_of = sets_of.join(found, sets_of["rep"] == found["node"], "left").select(
        "d1", "d2", F.col("n_shingles").alias("n"), F.coalesce("component", "rep").alias("component"))
    out = scanned.drop("bands").join(sets_of, (scanned["d1"] == sets_of["d1"]) & (scanned["d2"] == sets_of["d2"])
                                     & (scanned["n_shingles"] == sets_of["n"]), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(doc_id), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))
