"""How far the sources of a language differ in their words, in exact integers.

Documents become sparse count vectors; the vocabulary of a language is every term in
at least ``min_docs`` of its documents, of any number (a count vectorizer with a least
document frequency and the largest possible vocabulary). Vectors are summed per (lang,
source), and sums are compared pair by pair over the words both have. What only one
has, or none, enters by counts of counts, so nothing is as long as the vocabulary
times the sources.

Terms stand for themselves: no vocabulary is numbered, collected or sent to tasks.
Vectors are summed inside each task before they are shuffled, with the number of their
documents, so one pass over the texts gives counts and document frequencies alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm import words
from keyfold.llm.placed import stored

#: Bytes of text whose vectors are summed at once inside a task.
CHUNK_BYTES = 2 << 20
SCALE = 1_000_000_000
#: Bytes of terms: ASCII letters, and all above ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def vectors(data: np.ndarray, bounds: np.ndarray):
    """Sparse vectors of consecutive texts: text number, term (number of a word) and count of each entry, and the words.

    Equal words of a text are found by 64-bit hashes.
    """
    found = words.words(data, bounds, LETTERS)
    order = np.lexsort((found.hash, found.doc))
    doc, term = found.doc[order], found.hash[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(first)
    return doc[at], order[at], np.diff(np.append(at, len(order))), found


def spelled(found: words.Words, which: np.ndarray) -> pa.Array:
    """Some of the words as strings, A-Z in lower case."""
    start, size = found.start[which], found.end[which] - found.start[which]
    offsets = np.zeros(len(which) + 1, dtype=np.int32)
    np.cumsum(size, out=offsets[1:])
    body = words.LOWER[found.data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)]]
    return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body)))


def _partial_sums(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): vectors summed over a chunk of rows; several rows a term."""

    def run(batches):
        for batch in batches:
            for at, to, data, bounds in words.chunks(batch.column(2), CHUNK_BYTES):
                part = batch.slice(at, to - at)
                tag = part.column(3).to_numpy()
                _, group = np.unique(tag, return_inverse=True)
                doc, which, count, found = vectors(data, bounds)
                if not len(doc):
                    continue
                of, term = group[doc], found.hash[which]
                order = np.lexsort((term, of))
                of, term = of[order], term[order]
                first = np.ones(len(order), dtype=bool)
                first[1:] = (of[1:] != of[:-1]) | (term[1:] != term[:-1])
                cut = np.flatnonzero(first)
                rows = pa.array(doc[order[cut]])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), spelled(found, which[order[cut]]),
                     pa.array(np.add.reduceat(count[order], cut)), pa.array(np.diff(np.append(cut, len(order))))],
                    names=["lang", "source", "term", "n", "docs"])

    tagged = docs.select("lang", "source", "text", F.xxhash64("lang", "source"))
    return tagged.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def group_sums(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10) -> DataFrame:
    """Occurrences (lang, source, term, n) of every term in at least ``min_docs`` documents of its language."""
    sums = (_partial_sums(_rows(docs, lang, source, text)).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    # a term has as many entries as its language has sources, at most
    by_term = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return by_term.where(F.col("docs") >= min_docs).select("lang", "term", F.inline("cells"))


def _rows(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), in wider integers where a count needs them."""
    below = f"({total} + 2 * {kept})"
    wide = f"(cast({n} + 2 as decimal(28,0)) * cast({SCALE} as decimal(10,0))) div cast({below} as decimal(20,0))"
    return F.expr(f"1 + case when {n} < 9000000000 then ({SCALE} * ({n} + 2L)) div {below} else {wide} end")


def _apart(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q}))"


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10,
          top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources of the language, and telling terms.

    Shares ``p`` of terms are smoothed by 2 and scaled to 10**9; two shares differ by
    ``floor((p - q)**2 / (p + q))``. Part ``pair`` sums that over all kept terms for each
    other source; part ``term`` ranks the ``top`` terms that a group uses more than its
    language does. Values descend, ties go by item in UTF-8.

    A null text, language or source is an empty one. Groups whose documents hold no
    kept term are compared all the same; without kept terms distances are 0. A repeated
    row is a document of its own. An empty table gives no rows. Other columns are not
    used, whatever their names.
    """
    sums = stored(group_sums(docs, lang, source, text, min_docs))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    lang_totals = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    kept = sums.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("kept"))
    # One row per group: small beside the documents, and read several times.
    stats = stored(_rows(docs, lang, source, text).select("lang", "source").distinct()
                   .join(totals, ["lang", "source"], "left").join(lang_totals, "lang", "left").join(kept, "lang", "left")
                   .na.fill(0, ["total", "own", "kept", "lang_total"]).withColumn("none", F.lit(0).cast("long"))
                   .withColumn("p0", F.when(F.col("kept") > 0, _share("none", "total", "kept")))
                   .withColumn("group", F.monotonically_increasing_id()).drop("none"))
    # Terms with their groups side by side: as many entries as the language has sources, at most.
    shares = (sums.join(stats, ["lang", "source"])
              .select("lang", "term", "group", "n", _share("n", "total", "kept").alias("p"), "p0", "lang_total", "kept"))
    by_term = stored(shares.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.first("lang_total").alias("lang_total"), F.first("kept").alias("kept"),
        F.array_sort(F.collect_list(F.struct("group", "p", "p0"))).alias("cells")))

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    used_more = by_term.select("term", _share("lang_n", "lang_total", "kept").alias("q"), F.inline("cells")).where("p > q")
    telling = (used_more.select("group", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
               .join(stats.select("lang", "source", "group"), "group")
               .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
               .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

    # What only one group has meets the share of an absent term; groups hold few distinct counts.
    cells = by_term.select("cells", F.posexplode("cells").alias("at", "a"))
    own = cells.groupBy(F.col("a.group").alias("group"), F.col("a.p").alias("p")).agg(F.count("*").alias("times"))
    named = stats.select("lang", "group", "own", "p0", "kept")
    other = stats.select("lang", F.col("group").alias("other"), F.col("source").alias("item"), F.col("own").alias("other_own"), F.col("p0").alias("q0"))
    one_sided = (own.join(stats.select("group", "lang"), "group").join(other, "lang").where("group <> other")
                 .groupBy("group", "other").agg(F.sum(F.col("times") * F.expr(_apart("p", "q0"))).alias("one_sided")))
    pair = cells.select("a", F.explode(F.slice("cells", F.col("at") + 2, F.size("cells"))).alias("b"))
    gain = f"{_apart('a.p', 'b.p')} - {_apart('a.p', 'b.p0')} - {_apart('a.p0', 'b.p')} + {_apart('a.p0', 'b.p0')}"
    both = (pair.groupBy(F.col("a.group").alias("near"), F.col("b.group").alias("far"))
            .agg(F.sum(F.expr(gain)).alias("both")))
    absent = F.when(F.col("kept") > 0, (F.col("kept") - F.col("own") - F.col("other_own")) * F.expr(_apart("p0", "q0"))).otherwise(0)
    reverse = one_sided.select(F.col("group").alias("other"), F.col("other").alias("group"), F.col("one_sided").alias("reverse"))
    distance = (named.join(other, "lang").where("group <> other")
                .withColumns({"near": F.least("group", "other"), "far": F.greatest("group", "other"), "absent": absent})
                .join(both, ["near", "far"], "left").join(one_sided, ["group", "other"], "left").join(reverse, ["group", "other"], "left")
                .na.fill(0, ["both", "one_sided", "reverse"])
                .join(stats.select("group", "source"), "group")
                .select("lang", "source", F.lit("pair").alias("part"), "item",
                        (F.col("absent") + F.col("both") + F.col("one_sided") + F.col("reverse")).cast("long").alias("value"))
                .withColumn("rank", F.row_number().over(ranked)))
    return distance.unionByName(telling)
