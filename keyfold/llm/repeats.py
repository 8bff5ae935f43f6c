"""Long repeated byte strings, from enhanced suffix arrays of the places that may repeat.

A suffix array of everything would not fit the disks of any cluster, and need not be
built: every window of ``WIDTH`` bytes has an anchor, the least hash of its ``GRAM``-byte
substrings, and equal windows have equal anchors at equal offsets. So

1. all texts are scanned for anchors; a bounded map notes hash slots met twice;
2. stretches of windows around anchors in such slots are grouped by content: of equal
   stretches all but the earliest are repeats as a whole;
3. stretches with equal anchors but unequal content are sorted into suffix arrays, one
   per bucket of anchors. A stack scan over their common prefixes gives the intervals
   of at least ``WIDTH`` bytes; those whose occurrences differ in the byte before are
   maximal repeats, with all their occurrences. All but the earliest are removed.

Every pair of equal windows lies in equal stretches or in one suffix array, so no
repeat is missed and none is invented (hashes have 64 bits).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm import words
from keyfold.llm.placed import stored
from keyfold.session import materialize

WIDTH, GRAM = 100, 40
_SPAN = WIDTH - GRAM + 1        # grams in a window

#: The map of slots has this many bits, whatever the input. When it fills up it lets
#: more through, which costs time and changes no result.
SLOT_BITS = 27
#: Distinct stretches of one anchor that are sorted in one task; anchors with more are
#: compared window by window, with a minimum taken before the shuffle.
BUCKET_ROWS = 4096


def stretches(data: np.ndarray, bounds: np.ndarray):
    """Per anchor: its hash, hash of its stretch, text number, first and last window start."""
    none = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(words._BYTES[data] * words.powers(words._BASE, len(data)), out=total[1:])
    inverse = words.powers(words._INVERSE, len(data))
    gram = words.mix((total[GRAM:] - total[:-GRAM]) * inverse[:len(data) - GRAM + 1])
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while size * 2 <= _SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:len(gram) - _SPAN + 1], least[_SPAN - size:])
    start = np.flatnonzero(np.repeat(bounds[1:], np.diff(bounds))[:len(least)] >= np.arange(len(least)) + WIDTH)
    if not len(start):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(start)]]) - 1
    lo, hi = start[first], start[last]
    whole = words.mix((total[hi + WIDTH] - total[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))
    return gram[anchor[first]], whole, np.searchsorted(bounds, lo, side="right") - 1, lo, hi


def _slot(hashed: np.ndarray) -> np.ndarray:
    # Anchors are least hashes: mixed again, they spread over all slots.
    return (words.mix(hashed) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slots_met(rows: DataFrame, slots_of, times: int) -> np.ndarray:
    """Bit map of the slots that ``slots_of(batch)`` gives at least ``times`` times over all rows."""
    spark = rows.sparkSession
    parts = min(1 << 12, max(8, 1 << int(np.ceil(np.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))))))
    width = (1 << SLOT_BITS) // parts

    def emit(batches):
        def packed(slots):
            slots = np.sort(slots)
            if times > 1:  # twice is enough
                slots = slots[np.concatenate([[True] * 2, slots[2:] != slots[:-2]])[:len(slots)]]
            else:
                slots = np.unique(slots)
            cut = np.searchsorted(slots, np.arange(parts + 1) * width)
            filled = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(filled, pa.int64()), pa.array([(slots[cut[p]:cut[p + 1]] - p * width).astype(np.uint32).tobytes() for p in filled], pa.binary())],
                names=["part", "slots"])

        held, size = [], 0
        for batch in batches:
            for slots in slots_of(batch):
                held.append(slots)
                size += len(slots)
                if size > 1 << 20:
                    yield packed(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield packed(np.concatenate(held))

    def count(batches):
        once, twice = {}, {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                slots = np.frombuffer(blob.as_buffer(), np.uint32)
                a, b = once.setdefault(part, np.zeros(width, bool)), twice.setdefault(part, np.zeros(width, bool))
                b[slots[a[slots]]] = True
                if times > 1 and len(slots) > 1:
                    b[slots[1:][slots[1:] == slots[:-1]]] = True
                a[slots] = True
        for part in once:
            bits = np.packbits((once if times == 1 else twice)[part])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["part", "bits"])

    schema = "part bigint, {} binary"
    met = rows.mapInArrow(emit, schema.format("slots")).repartition(parts, "part").mapInArrow(count, schema.format("bits"))
    out = np.zeros((1 << SLOT_BITS) // 8, dtype=np.uint8)
    for row in met.toLocalIterator():  # 2 ** SLOT_BITS / 8 bytes in all
        out[row.part * width // 8:(row.part + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def _is_set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 > 0


def _place(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    return words.pair(doc.astype(np.int64).view(np.uint64), at.astype(np.int64).view(np.uint64))


def maximal_repeats(texts: list[bytes], width: int = WIDTH):
    """(length, [(text, start)]) of each maximal repeat of at least ``width`` bytes with all its occurrences.

    The beginning of a text differs from every byte and every other beginning.
    """
    count = [max(0, len(t) - width + 1) for t in texts]
    if sum(count) < 2:
        return
    owner = np.repeat(np.arange(len(texts)), count)
    place = np.concatenate([np.arange(n) for n in count])
    size = np.array([len(t) for t in texts])
    longest = int(size.max())
    body = np.frombuffer(b"".join(t + bytes(longest) for t in texts), dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum(size + longest)])[:-1]
    suffix = np.ascontiguousarray(sliding_window_view(body, longest)[first[owner] + place])
    length = size[owner] - place
    order = np.argsort(suffix.view(np.dtype((np.void, longest))).ravel(), kind="stable")
    suffix, owner, place, length = suffix[order], owner[order], place[order], length[order]
    differs = suffix[1:] != suffix[:-1]
    common = np.where(differs.any(1), differs.argmax(1), longest)
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    left = np.where(place > 0, body[first[owner] + place - 1], -1 - owner)
    # Prefix intervals by a stack of (common length, first suffix); -1 closes the last.
    stack: list[tuple[int, int]] = []
    long = np.flatnonzero(common >= width)
    for run in np.split(long, np.flatnonzero(np.diff(long) > 1) + 1):
        if not len(run):
            continue
        for i in [*run.tolist(), -1]:
            value = int(common[i]) if i >= 0 else -1
            begin = i if i >= 0 else run[-1] + 1
            while stack and stack[-1][0] > value:
                held, begin = stack.pop()
                end = i if i >= 0 else int(run[-1]) + 1
                if (left[begin:end + 1] != left[begin]).any():
                    yield held, list(zip(owner[begin:end + 1].tolist(), place[begin:end + 1].tolist()))
            if i >= 0 and (not stack or stack[-1][0] < value):
                stack.append((value, begin))


def _bucket(table: pa.Table) -> pa.Table:
    """Removed spans (doc, start, size) of the stretches of one bucket of anchors."""
    doc, lo = table["doc"].to_numpy(), table["lo"].to_numpy()
    spans: dict[int, list[tuple[int, int]]] = {}
    # What stands before a stretch has an anchor of its own, so each stretch counts as beginning there.
    for length, found in maximal_repeats(table["body"].to_pylist()):
        at = sorted({(int(doc[i]), int(lo[i]) + p) for i, p in found})
        for d, p in at[1:]:
            spans.setdefault(d, []).append((p, length))
    runs = [(d, a, b - a) for d, own in spans.items() for a, b in merged(own)]
    return pa.table({c: pa.array([r[i] for r in runs], pa.int64()) for i, c in enumerate(("doc", "start", "size"))})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of spans (start, size)."""
    out: list[list[int]] = []
    for start, size in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + size)
        else:
            out.append([start, start + size])
    return [tuple(r) for r in out]


def _numbered(docs: DataFrame) -> DataFrame:
    """Documents with ``_doc``, a number that orders them by id; rows equal in id and text share it."""
    ids = docs.groupBy("id").agg(F.count("*").alias("n"))
    if ids.where((F.col("n") > 1) | F.col("id").isNull()).isEmpty():
        return docs.withColumn("_doc", F.col("id"))
    keyed = docs.withColumn("_text", F.xxhash64("body"))
    keys = keyed.select("id", "_text").distinct().orderBy(F.col("id").asc_nulls_first(), "_text")
    keys = materialize(keys.withColumn("_doc", F.monotonically_increasing_id()).withColumnRenamed("id", "_id").withColumnRenamed("_text", "_hash"))
    return keyed.join(keys, keyed["id"].eqNullSafe(keys["_id"]) & (keyed["_text"] == keys["_hash"])).select("id", "body", "_doc")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, start, size) of removed spans, overlapping ones too, for documents (``_doc``, body)."""
    spark = docs.sparkSession
    rows = docs.select("_doc", "body")

    def slots_of(batch):
        for _, _, data, bounds in words.chunks(batch.column(1)):
            yield _slot(stretches(data, bounds)[0])

    met = spark.sparkContext.broadcast(_slots_met(rows, slots_of, 2))

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, _, data, bounds in words.chunks(batch.column(1)):
                anchor, whole, doc, lo, hi = stretches(data, bounds)
                keep = _is_set(met.value, _slot(anchor))
                own = (lo - bounds[doc]) << 8 | (hi - lo + 1)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (anchor.view(np.int64), whole.view(np.int64), ids[at + doc], own)],
                                                 names=["anchor", "whole", "doc", "at"])

    found = stored(rows.mapInArrow(scan, "anchor bigint, whole bigint, doc bigint, at bigint"))
    groups = stored(found.groupBy("anchor", "whole").agg(F.min(F.struct("doc", "at")).alias("first"), F.max(F.struct("doc", "at")).alias("last"))
                    .select("anchor", "whole", "first.doc", "first.at", (F.col("first") != F.col("last")).alias("again")))
    start, size = F.shiftright("at", 8), F.col("at").bitwiseAND(255) + WIDTH - 1
    copies = (found.join(groups.where("again").select("anchor", "whole", F.struct("doc", "at").alias("first")), ["anchor", "whole"])
              .where(F.struct("doc", "at") != F.col("first")).select("doc", start.alias("start"), size.alias("size")))

    # Anchors with several contents: the earliest stretch of each, with its bytes.
    several = groups.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1")
    places = stored(groups.join(several, "anchor").select("anchor", "contents", "doc", "at"))

    def places_of(batch):
        yield _slot(_place(batch.column(0).to_numpy(), batch.column(1).to_numpy() >> 8))

    wanted = spark.sparkContext.broadcast(_slots_met(places.select("doc", "at"), places_of, 1))

    def fetch(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, _, data, bounds in words.chunks(batch.column(1)):
                _, _, doc, lo, hi = stretches(data, bounds)
                start = lo - bounds[doc]
                keep = np.flatnonzero(_is_set(wanted.value, _slot(_place(ids[at + doc], start))))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at + doc[keep]]), pa.array(start[keep] << 8 | (hi - lo + 1)[keep]),
                     pa.array([raw[a:b + WIDTH] for a, b in zip(lo[keep].tolist(), hi[keep].tolist())], pa.binary())],
                    names=["doc", "at", "body"])

    bodies = rows.mapInArrow(fetch, "doc bigint, at bigint, body binary")
    full = stored(places.join(bodies, ["doc", "at"]).select("anchor", "contents", "doc", F.shiftright("at", 8).alias("lo"), "body"))
    normal = full.where(F.col("contents") <= BUCKET_ROWS)
    buckets = -(-normal.count() // BUCKET_ROWS) or 1
    sorted_out = (normal.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket")
                  .applyInArrow(_bucket, "doc bigint, start bigint, size bigint"))

    def windows(batches):
        for batch in batches:
            for one in batch.to_pylist():
                digests = [hashlib.blake2b(one["body"][i:i + WIDTH], digest_size=16).digest() for i in range(len(one["body"]) - WIDTH + 1)]
                n = len(digests)
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([one["doc"]] * n, pa.int64()),
                                                  pa.array(range(one["lo"], one["lo"] + n), pa.int64())], names=["window", "doc", "start"])

    crowded = full.where(F.col("contents") > BUCKET_ROWS).select("doc", "lo", "body").mapInArrow(windows, "window binary, doc bigint, start bigint")
    earliest = crowded.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"), F.max(F.struct("doc", "start")).alias("last")).where("first != last")
    later = crowded.join(earliest.drop("last"), "window").where(F.struct("doc", "start") != F.col("first")).select("doc", "start", F.lit(WIDTH).cast("long").alias("size"))
    return copies.union(sorted_out).union(later)


def dedup_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, n_bytes, ``removed`` (start, end in bytes of the text given) and ``kept``, the remaining bytes.

    A byte goes if a string of ``WIDTH`` bytes that covers it also starts earlier: in a
    document of smaller id, or earlier in its own. Matches never cross documents and are
    judged on the input. A null text is empty. Ids are integers; rows with equal ids and
    equal texts are one document and get equal results; rows with equal ids and unequal
    texts follow each other by a hash of the text, a null id comes first.
    """
    rows = _numbered(docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")))
    spans = repeated_spans(rows).groupBy("doc").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    joined = rows.join(spans, rows["_doc"] == spans["doc"], "left").select("id", "body", "spans")

    def cut(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at, to, data, bounds in words.chunks(batch.column(1)):
                raw, runs, kept = data.tobytes(), [], []
                for i, spans in enumerate(batch.column(2).slice(at, to - at).to_pylist()):
                    own, done, parts = raw[bounds[i]:bounds[i + 1]], 0, []
                    runs.append([{"start": a, "end": b} for a, b in merged([(s["start"], s["size"]) for s in spans or []])])
                    for run in runs[-1]:
                        parts.append(own[done:run["start"]])
                        done = run["end"]
                    kept.append(b"".join([*parts, own[done:]]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(np.diff(bounds), pa.int64()),
                                                  pa.array(runs, kind), pa.array(kept, pa.binary())], names=["id", "n_bytes", "removed", "kept"])

    out = joined.mapInArrow(cut, "id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")
    return out.withColumnRenamed("id", doc_id)
