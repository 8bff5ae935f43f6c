"""Benchmark passages in documents: one Aho-Corasick automaton, one scan of each text.

A window is ``width`` consecutive words of a benchmark item; an item with fewer
words, but not none, is one window. All windows go into one automaton over
normalised text, so a document is read once however many items there are.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm import words
from keyfold.session import materialize

#: Bytes of benchmark text in one automaton. A larger benchmark is scanned in several
#: rounds, each with a block of items of at most this size (or one longer item).
BLOCK_BYTES = 8 << 20

_KEEP = bytes(c + 32 if 0x41 <= c <= 0x5A else c if words.ALNUM[c] else 0x20 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal(text: str | None) -> bytes:
    """Words of a text, lower-cased, each between single spaces; no words: empty."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()
    return b" " + b" ".join(found) + b" " if found else b""


def windows(text: str | None, width: int) -> set[bytes]:
    found = normal(text).split()
    return {b" " + b" ".join(found[i:i + width]) + b" " for i in range(max(1, len(found) - width + 1))} if found else set()


@lru_cache(maxsize=1)
def _automaton(items: tuple[tuple[str | None, str], ...], width: int):
    """Automaton whose values are (words of the window, items that have it)."""
    owners: dict[bytes, set] = {}
    for item, text in items:
        for window in windows(text, width):
            owners.setdefault(window, set()).add(item)
    made = ahocorasick.Automaton()
    for window, ids in owners.items():
        made.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(ids)))
    made.make_automaton()
    return made


def scan(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, runs of hit words (first, last + 1) and items that occur."""
    line = normal(text)
    if not line:
        return 0, [], set()
    found, items = [], set()
    if len(automaton):
        for at, (n, ids) in automaton.iter(line.decode("latin-1")):
            found.append((at, n))
            items.update(ids)
    if not found:
        return line.count(b" ") - 1, [], items
    spaces = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20)
    last = np.searchsorted(spaces, [at for at, _ in found])
    runs: list[list[int]] = []
    for first, end in sorted(zip((last - [n for _, n in found]).tolist(), last.tolist())):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([first, end])
    return len(spaces) - 1, [tuple(r) for r in runs], items


def _joined(old: list[tuple[int, int]], new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for first, end in sorted([*old, *new]):
        if runs and first <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], end)
        else:
            runs.append((first, end))
    return runs


def _spans(text: str | None, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code point offsets of the text as given."""
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text or "")]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in runs]


_RUNS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_OWN = {"n_words": T.LongType(), "hit_runs": _RUNS, "hit_items": T.ArrayType(T.StringType()), "hit_spans": _SPANS}


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns n_words, hit_runs (of word numbers), hit_items and hit_spans (code points) beside those of ``docs``.

    A null or empty text, or one without words, has no words and no hits. An item
    without words has no windows; repeated items count once; windows of an item whose
    id is null hit words but list no item. An empty benchmark hits nothing. Rows of
    ``docs`` stay one to one; its columns of the four names are replaced.
    """
    docs = docs.drop(*_OWN)
    spark, schema = docs.sparkSession, docs.schema
    for name, kind in _OWN.items():
        schema = T.StructType([*schema.fields, T.StructField(name, kind)])
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("body")).where(F.col("body").isNotNull())
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # Blocks of about half the bound, so that hashing items to them stays below it.
    blocks = max(1, -(-size * 2 // block_bytes)) if size > block_bytes else 1
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)))

    def scanned(frame: DataFrame, block: int, again: bool) -> DataFrame:
        own = tuple(sorted({(r.item, r.body) for r in items.where(F.col("block") == block).collect()}, key=repr))
        shared = spark.sparkContext.broadcast(own)

        def run(batches):
            automaton = _automaton(shared.value, width)
            for batch in batches:
                column = batch.schema.get_field_index(text)
                for at, to, _, _ in words.chunks(batch.column(column)):
                    part = batch.slice(at, to - at)
                    texts = part.column(column).to_pylist()
                    found = [scan(x, automaton) for x in texts]
                    rows = {"n_words": [n for n, _, _ in found],
                            "hit_runs": [r for _, r, _ in found],
                            "hit_items": [{x for x in i if x is not None} for _, _, i in found]}
                    if again:
                        before = part.select(list(_OWN)).to_pylist()
                        for i, row in enumerate(before):
                            rows["hit_runs"][i] = _joined([(r["first"], r["end"]) for r in row["hit_runs"]], rows["hit_runs"][i])
                            rows["hit_items"][i] |= set(row["hit_items"])
                        part = part.drop_columns(list(_OWN))
                    rows["hit_spans"] = [_spans(x, r) for x, r in zip(texts, rows["hit_runs"])]
                    rows["hit_runs"] = [[{"first": a, "end": b} for a, b in r] for r in rows["hit_runs"]]
                    rows["hit_items"] = [sorted(i) for i in rows["hit_items"]]
                    kinds = [pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()),
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(rows[k], t) for k, t in zip(_OWN, kinds))],
                                                     names=[*part.schema.names, *_OWN])

        return frame.mapInArrow(run, schema)

    found = scanned(docs, 0, False)
    for block in range(1, blocks):
        found = scanned(materialize(found), block, True)
    return found


def summary(found: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated from the columns of ``find_leaks``."""
    hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"])
    return found.withColumns({
        "n_hit": hit,
        "n_items": F.size("hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join("hit_items", ",").cast("binary"), 256),
        "contaminated": hit > 0,
    })


def written(spans: str):
    """Spans as text: start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
