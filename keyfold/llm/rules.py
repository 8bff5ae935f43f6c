"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Each document is measured in whole numbers. A sketch is a count per cell of a scale whose
cells are single numbers up to 31 and then 16 to each doubling, so a quantile is right to a
sixteenth; sketches merge by adding counts, in any order, with the same result. Groups
with few documents borrow the merged sketch of their language, or that of all.
A document fails a rule when its measure lies beyond the upper (or lower) quartile
by ``REACH`` times the distance of the quartiles, or by the rule's least distance if
that is more, so that measures which hardly vary do not reject every small difference.

Everything is built from DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.placed import stored
from keyfold.operators.joins import join_on

#: Documents a group needs for thresholds of its own.
MIN_DOCS = 50
REACH = 3
#: Least distance from the quartile, and whether low values fail too. Shares are in
#: thousandths, the length of words in hundredths of a character.
RULES = {
    "symbols": (50, False),
    "capitals": (100, False),
    "dup_lines": (300, False),
    "repeats": (150, False),
    "word_length": (100, True),
}
WINDOW = 8
_BLANKS = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _next(values: Column) -> Column:
    """The values moved up by one place."""
    return F.slice(values, F.lit(2), F.greatest(F.size(values), F.lit(1)))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight found twice or more; windows are compared by 64-bit hashes."""

    def covered(at: Column) -> Column:
        gaps = F.zip_with(at, _next(at), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda n, g: n + g)

    def places(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def both(rows: Column) -> Column:
            same = F.zip_with(rows, _next(rows), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
            flagged = _let(same, lambda s: F.zip_with(s, F.concat(F.array(F.lit(False)), s), lambda a, b: a | b))
            found = F.zip_with(rows, flagged, lambda r, f: F.when(f & r.isNotNull(), r["i"]))
            return F.array_sort(F.filter(found, lambda i: i.isNotNull()))

        return _let(ordered, both)

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _let(places(windows), covered)).otherwise(0)

    def windows(hashes: Column) -> Column:
        eight = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, WINDOW))))
        return F.slice(eight, F.lit(1), F.size(hashes) - (WINDOW - 1))

    several = F.size(words) > WINDOW
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(several, _let(_let(hashes, windows), counted)).otherwise(0)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts of each text, and the measures of ``RULES`` from them; a null text has no words."""
    body = F.coalesce(F.col(text), F.lit(""))

    def among(kind: str) -> Column:
        return F.length(F.regexp_replace("_text", f"[^{kind}]+", "")).cast("long")

    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    split = docs.withColumn("_text", body).withColumns({"_words": F.array_remove(F.split("_text", _BLANKS), ""), "_lines": lines})
    counted = split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": among("#*$%&|<>"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")).cast("long"),
        "n_capitals": among("A-Z"),
        "n_lines": F.size("_lines").cast("long"),
    }).drop("_text", "_words", "_lines")

    def rate(part: str, whole: str, scale: int) -> Column:
        return F.expr(f"({part} * {scale}) div greatest({whole}, 1)")

    return counted.withColumns({
        "symbols": rate("n_symbols", "word_chars", 1000),
        "capitals": rate("n_capitals", "word_chars", 1000),
        "dup_lines": rate("n_dup_lines", "n_lines", 1000),
        "repeats": rate("n_repeat_words", "n_words", 1000),
        "word_length": rate("word_chars", "n_words", 100),
        "base_failed": F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"),
    })


def cell(value: str) -> Column:
    """The least number of the value's cell: its first five binary digits, then zeros."""
    return F.expr(f"case when {value} < 32 then {value} else shiftleft(shiftright({value}, length(bin({value})) - 5), length(bin({value})) - 5) end")


def sketches(measured: DataFrame, by: list[str]) -> DataFrame:
    """Counts (by, rule, cell, docs) of documents that pass the base rules, combined before the shuffle."""
    named = F.array(*(F.struct(F.lit(r).alias("rule"), cell(r).alias("cell")) for r in RULES))
    rows = measured.where(~F.col("base_failed")).select(*by, F.inline(named))
    return rows.groupBy(*by, "rule", "cell").agg(F.count("*").alias("docs"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "rule", "cell").agg(F.sum("docs").alias("docs"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, docs, fences): for each rule what lies outside low to high fails."""

    def quartile(cells: Column, docs: Column, quarters: int) -> Column:
        # the first cell that brings the count up to the quartile
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("at"))

        def step(a: Column, c: Column) -> Column:
            n = a["n"] + c["docs"]
            return F.struct(n.alias("n"), F.coalesce(a["at"], F.when(n * 4 >= docs * quarters, c["cell"])).alias("at"))

        return F.aggregate(cells, start, step, lambda a: a["at"])

    # a sketch has under a thousand cells, however many documents it counts
    each = sketch.groupBy(*by, "rule").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("cell", "docs"))).alias("cells"))
    found = each.select(*by, "rule", "docs", quartile(F.col("cells"), F.col("docs"), 1).alias("q1"), quartile(F.col("cells"), F.col("docs"), 3).alias("q3"))
    least = F.create_map(*(F.lit(x) for r, (d, _) in RULES.items() for x in (r, d)))
    two_sided = F.col("rule").isin([r for r, (_, both) in RULES.items() if both])
    reach = F.greatest(REACH * (F.col("q3") - F.col("q1")), least[F.col("rule")].cast("long"))
    fence = F.struct(F.when(two_sided, F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    return found.groupBy(*by).agg(F.max("docs").alias("docs"), *(F.max(F.when(F.col("rule") == r, fence)).alias(r) for r in RULES))


def thresholds(measured: DataFrame, by: list[str], min_docs: int = MIN_DOCS) -> DataFrame:
    """(by, fences): a struct of all rules' fences, from the group's own sketch, that of its first column, or that of all."""
    every = F.struct(*RULES).alias("fences")
    own = stored(sketches(measured, by))
    wide = merged(own, by[:1])
    lang = fences(wide, by[:1]).where(F.col("docs") >= min_docs).select(*by[:1], every).withColumnRenamed("fences", "_of_lang")
    groups = fences(own, by).select(*by, F.when(F.col("docs") >= min_docs, every).alias("_own"))
    # one row: two numbers a rule
    found = fences(merged(wide, []), []).first()
    whole = F.lit(None)
    if found["docs"] is not None:
        bound = lambda f, c: F.lit(f[c]).cast("long").alias(c)
        whole = F.struct(*(F.struct(bound(found[r], "low"), bound(found[r], "high")).alias(r) for r in RULES))
    return join_on(groups, lang, by[:1], "left").select(*by, F.coalesce("_own", "_of_lang", whole).alias("fences"))


def judge(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without its text, with the counts and measures, base_failed, failed_rules (empty after the base) and kept.

    A document fails at a fixed base rule (under 20 words, or 30 % of its words in
    repeated windows), or at a threshold of its language and source. A null or empty text
    fails at the base. A null language or source is a group of its own. Repeated
    rows are judged alike and count each; an empty table stays empty. Columns of ``docs``
    named as the results are replaced.
    """
    own = [*RULES, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines",
           "base_failed", "failed_rules", "kept"]
    # The text is read once: its measures are a narrow table that sketches and filter share.
    measured = stored(measures(docs.drop(*own), text).drop(text))
    by = [lang, source]
    joined = join_on(measured, thresholds(measured, by, min_docs).withColumnRenamed("fences", "_fences"), by, "left")

    def fails(rule: str) -> Column:
        fence = F.col("_fences")[rule]
        outside = (F.col(rule) > fence["high"]) | F.coalesce(F.col(rule) < fence["low"], F.lit(False))
        return F.when(~F.col("base_failed") & outside, F.lit(rule))

    failed = F.array_compact(F.array(*map(fails, RULES)))
    return (joined.withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_fences"))
