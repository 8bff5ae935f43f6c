"""Repeated lines: every unit of text is hashed, one occurrence of each is kept.

Lines are cut after each sentence end inside them: a mark with a blank after it, or a
full-width mark, with what closes a quotation, where scripts need no blank. A piece of five
words or more is a unit. Shorter pieces of a line that follow each other are joined until
they have five words; what is left over is prose that texts share by chance and stays. With
``headings`` a short line that does not end like a sentence (an entry of a menu) is a unit
as it is. In scripts without blanks each character counts as a word. Units are compared after
lower-casing and joining their words with single spaces. Of equal units the one of
the smallest document, then the earliest in it, stays; the others are removed.
Digests have 128 bits: equal digests are taken as equal units.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm import words

_CLOSE = "」』）】”’"
_CUT = re.compile(
    rf"\n|(?<=[.!?؟۔।॥။።])[ \t\u3000]+|(?:(?<=[。！？｡])|(?<=．)(?!\d)|(?<=[。！？｡．][{_CLOSE}]))(?![。！？｡．{_CLOSE}])[ \t\u3000]*")


def units(text: str | None):
    """(start, end, normalised) of each unit with words; ends leave separators out."""
    text, at = text or "", 0
    for m in _CUT.finditer(text):
        if m.start() > at:
            yield at, m.start(), text[at:m.start()]
        at = m.end()
    if at < len(text):
        yield at, len(text), text[at:]


#: Characters that are words of their own: scripts written without blanks.
_DENSE = re.compile("[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")
_SENTENCE_END = re.compile(rf"[.!?؟۔।॥။።。！？｡．][{_CLOSE}\"')\]]*\s*$")


def size(piece: str) -> int:
    """Words of a piece, characters of dense scripts counted each."""
    return len(piece.split()) + (0 if piece.isascii() else len(_DENSE.findall(piece)))


def judged(text: str | None, min_words: int, headings: bool = True):
    """(start, end, words or not enough) of each piece, short neighbours in a line joined."""
    text = text or ""
    short: list[int] | None = None  # start, end, words of a run of short pieces
    before = -1
    for start, end, piece in units(text):
        opens = before < 0 or "\n" in text[before:start]
        if opens and short:
            yield short[0], short[1], False
            short = None
        n = size(piece)
        closes = end == len(text) or text[end] == "\n"
        if n >= min_words:
            if short:
                yield short[0], short[1], False
                short = None
            yield start, end, True
        elif headings and opens and closes and not _SENTENCE_END.search(piece):
            yield start, end, bool(piece.split())
        else:
            short = [short[0], end, short[2] + n] if short else [start, end, n]
            if short[2] >= min_words:
                yield short[0], short[1], True
                short = None
        before = end
    if short:
        yield short[0], short[1], False


def digest(unit: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(" ".join(unit.lower().split()).encode("utf-8", "surrogatepass"))
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def cut(text: str | None, spans) -> str:
    """The text without the spans, and without a line break left alone by a removed line."""
    text, out, at = text or "", [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
        # what separated a removed unit from its successor goes with it
        while at < len(text) and text[at] in " \t\u3000":
            at += 1
        if at < len(text) and text[at] == "\n" and (start == 0 or text[start - 1] == "\n"):
            at += 1
    return "".join(out) + text[at:]


def dedup_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 5, headings: bool = False) -> DataFrame:
    """``docs`` with n_units, removed (start, end in code points of the text as given) and kept_text.

    Pieces that are no units (above) are kept. ``n_units`` counts pieces, however short. Rows with equal id and text are
    one document and get the same result, so a repeated row removes nothing from
    itself. A null id ranks first; a null or empty text has no units and stays
    as it is. Columns of ``docs`` with the three names are replaced.

    A unit that very many documents share is one row per map task after the partial
    minimum; the join that tells its occurrences is split where it is skewed.
    """
    docs = docs.drop("n_units", "removed", "kept_text")
    keyed = docs.withColumn("_key", F.xxhash64(F.col(text)))

    def split(batches):
        for batch in batches:
            for at, to, _, _ in words.chunks(batch.column(2)):
                part = batch.slice(at, to - at)
                rows, h1, h2, start, end = [], [], [], [], []
                for i, body in enumerate(part.column(2).to_pylist()):
                    for a, b, counts in judged(body, min_words, headings):
                        if counts:
                            d = digest(body[a:b])
                            rows.append(i), h1.append(d[0]), h2.append(d[1]), start.append(a), end.append(b)
                rows = pa.array(np.array(rows, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), *(pa.array(np.array(c, dtype=np.int64)) for c in (h1, h2, start, end))],
                    names=["id", "_key", "h1", "h2", "start", "end"])

    kind = docs.schema[doc_id].dataType
    source = keyed.select(F.col(doc_id).alias("id"), "_key", F.col(text).alias("body"))
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(c, T.LongType()) for c in ("_key", "h1", "h2", "start", "end"))])
    found = source.mapInArrow(split, schema)
    firsts = (found.groupBy("h1", "h2")
              .agg(F.min(F.struct("id", "_key", "start")).alias("first"), F.max(F.struct("id", "_key", "start")).alias("latest"))
              .where(F.col("first") != F.col("latest")).drop("latest"))
    again = (found.join(firsts, ["h1", "h2"])
             .where(~F.struct("id", "_key", "start").eqNullSafe(F.col("first")))
             .groupBy("id", "_key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed")))
    # Keys: a null id joins its own rows too.
    joined = keyed.join(again, keyed[doc_id].eqNullSafe(again["id"]) & (keyed["_key"] == again["_key"]), "left").select(
        *(keyed[c] for c in docs.columns), F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"))

    def drop(batches):
        for batch in batches:
            for at, to, _, _ in words.chunks(batch.column(batch.schema.get_field_index(text))):
                part = batch.slice(at, to - at)
                bodies, spans = part.column(part.schema.get_field_index(text)).to_pylist(), part.column(part.schema.get_field_index("removed")).to_pylist()
                kept = [None if b is None else cut(b, [(s["start"], s["end"]) for s in r]) for b, r in zip(bodies, spans)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([sum(1 for _ in units(b)) for b in bodies], pa.int64()), pa.array(kept, pa.string())],
                    names=[*part.schema.names, "n_units", "kept_text"])

    out = T.StructType([*joined.schema.fields, T.StructField("n_units", T.LongType()), T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(drop, out)
