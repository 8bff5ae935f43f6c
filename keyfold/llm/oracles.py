"""The same results in plain SQL, where SQL can express them."""

from __future__ import annotations

_UP = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_DOWN = "'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"

_DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, {_UP}, {_DOWN}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 2)) // (coalesce(t.total, 0)::HUGEINT + 2 * l.v) AS p,
    1 + (1000000000 * (k.n::HUGEINT + 2)) // (l.total::HUGEINT + 2 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10"""

#: rule: numerator, denominator, scale, least distance, low side too
_RULES = {
    "symbols": ("n_symbols", "word_chars", 1000, 50, False),
    "capitals": ("n_capitals", "word_chars", 1000, 100, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 300, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 150, False),
    "word_length": ("word_chars", "n_words", 100, 100, True),
}
_LONG = " UNION ALL ".join(
    f"SELECT lang, source, '{rule}' AS rule, {distance} AS least, {both} AS both_sides, x, "
    "CASE WHEN x < 32 THEN x ELSE (x >> (length(bin(x)) - 5)) << (length(bin(x)) - 5) END AS cell "
    f"FROM (SELECT lang, source, CAST({top} * {scale} // greatest({below}, 1) AS BIGINT) AS x FROM m WHERE NOT base_failed)"
    for rule, (top, below, scale, distance, both) in _RULES.items())


def _fence(keys: str) -> str:
    """Quartiles by counting cells, for each value of the keys."""
    named = keys + ", " if keys else ""
    return f"""SELECT {named}rule, any_value(n) AS n, CASE WHEN any_value(both_sides) THEN min(q1) - any_value(reach) END AS low,
      min(q3) + any_value(reach) AS high FROM (
      SELECT *, greatest(3 * (min(q3) OVER k - min(q1) OVER k), least) AS reach FROM (
        SELECT *, CASE WHEN 4 * r >= n THEN cell END AS q1, CASE WHEN 4 * r >= 3 * n THEN cell END AS q3 FROM (
          SELECT *, row_number() OVER (PARTITION BY {named}rule ORDER BY cell) AS r, count(*) OVER (PARTITION BY {named}rule) AS n FROM cells))
      WINDOW k AS (PARTITION BY {named}rule)) GROUP BY {named}rule"""


_ADAPTIVE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_WORD}) AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
eight AS (SELECT rid, i, words[i:i + 7] AS grams FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, grams) AS c FROM eight) WHERE c > 1),
covered AS (SELECT rid, CAST(sum(least(8, nxt - i)) AS BIGINT) AS n FROM (
    SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 8) AS nxt FROM twice) GROUP BY rid),
c AS (SELECT rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
    FROM w LEFT JOIN covered USING (rid)),
m AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
cells AS ({_LONG}),
f2 AS ({_fence('lang, source')}), f1 AS ({_fence('lang')}), f0 AS ({_fence('')}),
chosen AS (SELECT g.lang, g.source, r.rule,
    CASE WHEN f2.n >= 50 THEN f2.low WHEN f1.n >= 50 THEN f1.low ELSE f0.low END AS low,
    CASE WHEN f2.n >= 50 THEN f2.high WHEN f1.n >= 50 THEN f1.high ELSE f0.high END AS high
  FROM (SELECT DISTINCT lang, source FROM m) g CROSS JOIN (SELECT unnest([{", ".join(f"'{r}'" for r in _RULES)}]) AS rule) r
  LEFT JOIN f2 ON f2.lang IS NOT DISTINCT FROM g.lang AND f2.source IS NOT DISTINCT FROM g.source AND f2.rule = r.rule
  LEFT JOIN f1 ON f1.lang IS NOT DISTINCT FROM g.lang AND f1.rule = r.rule LEFT JOIN f0 ON f0.rule = r.rule),
judged AS (SELECT m.*, r.rule, r.low, r.high, CASE r.rule {" ".join(f"WHEN '{r}' THEN {t} * {s} // greatest({b}, 1)" for r, (t, b, s, _, _) in _RULES.items())} END AS x
  FROM m JOIN chosen r ON r.lang IS NOT DISTINCT FROM m.lang AND r.source IS NOT DISTINCT FROM m.source),
failed AS (SELECT rid, list(rule) AS rules FROM judged WHERE NOT base_failed AND (x > high OR x < low) GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rules IS NULL AS kept,
  coalesce(array_to_string([x FOR x IN [{", ".join(f"'{r}'" for r in _RULES)}] IF list_contains(rules, x)], ','), '') AS failed_rules
FROM m LEFT JOIN failed USING (rid)"""

_INFILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
n AS (SELECT *, CAST(len(units) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS pre, coalesce(array_to_string(units[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(units[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""

_LEAKS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), {_UP}, {_DOWN}) AS text FROM documents),
pieces AS (SELECT rid, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS piece,
    generate_subscripts(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), 1) AS nr FROM d),
placed AS (SELECT rid, piece, nr, sum(length(piece)) OVER (PARTITION BY rid ORDER BY nr) AS stop FROM pieces),
w AS (SELECT rid, piece AS word, row_number() OVER (PARTITION BY rid ORDER BY nr) AS pos, CAST(stop - length(piece) AS BIGINT) AS start,
    CAST(stop AS BIGINT) AS stop FROM placed WHERE regexp_matches(piece, '^[^\x00-\x2F\x3A-\x60\x7B-\x7F]')),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, {_UP}, {_DOWN}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS body
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
lists AS (SELECT rid, list(word ORDER BY pos) AS words FROM w GROUP BY rid),
hits AS (SELECT rid, pos, n, item FROM (
    SELECT rid, n, i AS pos, array_to_string(words[i:i + n - 1], ' ') AS body
    FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM lists, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)) x
  JOIN windows USING (n, body)),
covered AS (SELECT DISTINCT rid, unnest(range(pos, pos + n)) AS pos FROM hits),
runs AS (SELECT rid, min(start) || ':' || max(stop) AS span, min(pos) AS pos, count(*) AS n FROM (
    SELECT rid, pos, start, stop, pos - row_number() OVER (PARTITION BY rid ORDER BY pos) AS run FROM covered JOIN w USING (rid, pos)) GROUP BY rid, run),
spans AS (SELECT rid, sum(n) AS n_hit, string_agg(span, ',' ORDER BY pos) AS hit_spans FROM runs GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(hit_spans, '') AS hit_spans
FROM d LEFT JOIN lists USING (rid) LEFT JOIN spans USING (rid) LEFT JOIN items USING (rid)"""

_NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_DOWN}), {_WORD}) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct([array_to_string(w[i:i + 1], ' ') FOR i IN range(1, greatest(len(w), 2))])) END AS shingles FROM d),
reps AS (SELECT min(doc_id) AS rep, shingles, len(shingles) AS n FROM s WHERE len(shingles) > 0 GROUP BY shingles),
g AS (SELECT rep, n, unnest(shingles) AS shingle FROM reps),
shared AS (SELECT a.rep AS a, b.rep AS b, count(*) AS n, any_value(a.n) AS x, any_value(b.n) AS y
  FROM g a JOIN g b ON a.shingle = b.shingle AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 100 * n >= 80 * (x + y - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reached.a, l.b FROM reached JOIN both_ways l ON reached.b = l.a),
named AS (SELECT a AS rep, least(a, min(b)) AS component FROM reached GROUP BY a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(component, rep, s.doc_id) AS component_id,
  s.doc_id = coalesce(component, rep, s.doc_id) AS kept
FROM s LEFT JOIN reps ON len(s.shingles) > 0 AND s.shingles = reps.shingles LEFT JOIN named USING (rep)"""

ORACLES = {
    "op4_minhash": _NEAR,
    "op5_decontaminate": _LEAKS,
    "op11_source_divergence": _DIVERGENCE,
    "op12_adaptive_rules": _ADAPTIVE,
    "op13_fill_in_middle": _INFILL,
}
