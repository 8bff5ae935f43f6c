"""Source divergence, adaptive rules and fill-in-the-middle against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.llm import divergence, infill, rules

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcÉé漢😀xYz") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    rows = []
    for i in range(240):
        lang = rng.choice(["en", "en", "de", None, "x\0y"])
        text = "".join(rng.choice(vocab) + rng.choice([" ", "1", "\n", "  ", "&", "_"]) for _ in range(rng.randrange(0, 120)))
        rows.append((i, text, lang, rng.choice(["a", "b", "c", None])))
    rows += [(240, None, "en", "only"), (241, "", "fr", "a"), (242, "rare words", "fr", "b"), rows[0], rows[0], (None, "x " * 60000, "de", "a"),
             (244, "a\n" * 30 + "b c <S> d", "en", "a"), (245, "漢" * 9 + "😀ab", "en", "é")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n string, terms string, kept string, index int, value double"
    return spark.createDataFrame([(*r, "x", "y", "z", 1, 2.0) for r in rows], schema).repartition(3)


def brute_audit(rows, min_docs, top):
    rows = [(t or "", g or "", s or "") for _, t, g, s in rows]
    found = [(g, s, Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)))) for t, g, s in rows]
    out = []
    for lang in {g for g, _, _ in found}:
        docs = Counter(t for g, _, c in found if g == lang for t in c)
        kept = [t for t, n in docs.items() if n >= min_docs]
        counts = {s: Counter() for g, s, _ in found if g == lang}
        for g, s, c in found:
            if g == lang:
                counts[s].update({t: c[t] for t in kept if t in c})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, last in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (v, i) in enumerate(items[:last])]
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 7])
def test_audit_is_exact(docs, rows, partitions):
    got = sorted(tuple(r) for r in divergence.audit(docs.repartition(partitions), min_docs=5).collect())
    assert got == brute_audit(rows, 5, 10)


def test_audit_without_kept_terms_or_rows(docs, rows):
    got = sorted(tuple(r) for r in divergence.audit(docs, min_docs=10_000).collect())
    assert got == brute_audit(rows, 10_000, 10) and {r[4] for r in got} == {0}
    assert divergence.audit(docs.limit(0)).count() == 0


def test_vectors_of_documents():
    texts = ["Aé1b_C b", "", "dd DD d", "1 2"]
    data, bounds = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t.encode()) for t in texts])
    doc, which, count, found = divergence.vectors(data, bounds)
    got = sorted(zip(doc.tolist(), divergence.spelled(found, which).to_pylist(), count.tolist()))
    assert got == [(0, "aé", 1), (0, "b", 2), (0, "c", 1), (2, "d", 1), (2, "dd", 2)]


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a " * 7, "a " * 8, "a " * 9, "é b\x0bc\n\n", "a b\na b \na b", "<x> #&|" * 5,
             *("".join(rng.choice(["a ", "b ", "c\n", "# "]) for _ in range(rng.randrange(300))) for _ in range(80)),
             " ".join(str(i) for i in range(40_000)), "ab " * 50_000]
    got = rules.measures(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.i])


def brute_fences(values):
    cells = sorted(v if v < 32 else v >> v.bit_length() - 5 << v.bit_length() - 5 for v in values)
    return [cells[-(-len(cells) * k // 4) - 1] for k in (1, 3)]


def test_thresholds_follow_each_group(spark):
    rng = random.Random(2)
    rows = []
    for lang, source, n, rate in (("en", "code", 60, 0.3), ("en", "news", 70, 0.0), ("en", "few", 5, 0.0), (None, None, 55, 0.1), ("fr", "tiny", 3, 0.0)):
        for _ in range(n):
            found = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(3, 9))) + ("#" if rng.random() < rate else "") for _ in range(60)]
            rows.append((len(rows), lang, source, " ".join(found)))
    rows += [(len(rows) + i, lang, s, " ".join("w%d$$$" % j for j in range(60))) for i, (lang, s) in enumerate([("en", "news"), ("en", "few"), ("fr", "tiny"), (None, None)])]
    rows += [(900, "en", "news", None), (901, "en", "news", "short"), (902, "zz", None, "same words again " * 30), rows[0], rows[0]]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, lang string, source string, text string, kept string").repartition(3)
    got = rules.judge(frame).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        if not r.base_failed:
            for key in ((r.lang, r.source), (r.lang, "*all"), ("*all", "*all")):
                groups.setdefault(key, []).append(r)
    for r in got:
        failed = []
        level = next(k for k in ((r.lang, r.source), (r.lang, "*all"), ("*all", "*all")) if len(groups.get(k, ())) >= 50 or k[0] == "*all")
        for rule, (least, both) in rules.RULES.items():
            q1, q3 = brute_fences([x[rule] for x in groups[level]])
            reach = max(3 * (q3 - q1), least)
            if not r.base_failed and (r[rule] > q3 + reach or both and r[rule] < q1 - reach):
                failed.append(rule)
        assert r.failed_rules == failed and r.kept == (not r.base_failed and not failed)
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[i] for i in (193, 194, 195, 196, 900, 901, 902)) and sum(kept.values()) > 180
    assert rules.judge(frame.limit(0)).count() == 0


def test_sketches_merge_in_any_order(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = rules.measures(frame)
    whole = rules.merged(rules.sketches(measured, ["lang", "source"]), ["lang"])
    parts = [rules.sketches(measured.where(F.coalesce("doc_id", F.lit(0)) % 3 == k), ["lang"]) for k in range(3)]
    again = rules.merged(parts[2].unionAll(parts[0]).unionAll(parts[1]), ["lang"])
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, again.select(whole.columns).collect()))


def brute_cut(doc_id, text):
    text = text or ""
    units = re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle_equals_brute_force(spark, docs, rows):
    rng = random.Random(9)
    more = [(1000 + i, "".join(rng.choice(["a", "Zz", "é", "漢", "😀", " ", "<", "<S", "P>", "\n", "\x7f", "9"]) for _ in range(rng.randrange(40))), None, None)
            for i in range(300)]
    more += [(2000, "abc " * 60_000, None, None), (2001, "😀" * 30_000, None, None)]
    frame = docs.select("doc_id", "text", "n", "kept").unionByName(
        spark.createDataFrame([(i, t, "q", "w") for i, t, _, _ in more], "doc_id long, text string, n string, kept string"))
    got = infill.fill_in_middle(frame).withColumn("back", infill.restored()).collect()
    want = Counter((i, *brute_cut(i, t)) for i, t, _, _ in rows + more)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert all(r.back == (r.text or "") for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(frame.limit(0)).count() == 0


def test_marks_rank_and_select():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 8, 9, 64, 1000):
        text = "".join(rng.choice(list("aZ é漢😀.")) for _ in range(size))
        data = np.frombuffer(text.encode(), np.uint8)
        ends, chars = infill.marks(data, np.array([0, len(data)]))
        at = [m.end() - 1 for m in re.finditer(rb"(?s)[A-Za-z]+|[^A-Za-z](?:[\x80-\xbf])*", data.tobytes())]
        places = np.arange(len(data) + 1)
        assert ends.rank(places).tolist() == [sum(a < p for a in at) for p in places]
        assert ends.select(np.arange(1, len(at) + 1)).tolist() == at
        assert chars.rank(np.array([len(data)])).tolist() == [size]
