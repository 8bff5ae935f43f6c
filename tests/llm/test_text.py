"""Text operators against brute force on small tables with nulls, empties, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keyfold.llm import bpe, components, leaks, minhash, neighbours, pages, pii, quality, queries, repeats, suffix_tree, units

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
EXTRA = "score double, ids string, text_ string, kept string, removed string, spans string"


def spaced(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 120))) for _ in range(25)]
    rows = []
    for text in base:
        for _ in range(rng.randrange(1, 4)):
            found = text.split()
            for _ in range(rng.randrange(0, max(1, len(found) // 12))):
                found[rng.randrange(len(found))] = rng.choice(vocab)
            rows.append((" " if rng.random() < 0.8 else "\n").join(found))
    rows += [base[0], base[0], "", None, " \n\t ", "one", "One", "x " * 3000, base[1] + " " + base[2]]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, None, "s", None, 1.0, "x") for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long, score double, ids string")
    return frame.repartition(3), dict(rows)


def empty(spark, schema="doc_id long, text string"):
    return spark.createDataFrame([], schema)


def test_page_blocks():
    page = ("<html><head><title>t</title></head><body><header>Site</header><nav><p>menu</nav><div class='cookie-notice'>Accept</div>"
            "<div class=\"has sidebar\"><article><header><h1>A &amp; B</h1></header><p>One\n two<br>three<p>Four <b>bold</b>"
            "<script>var a='</p>'</script><form>f</form><section id=comments><article>mine</article></section><!-- no --><p>x &lt; y</article></div>"
            "<aside>side</aside><footer>end</footer>")
    assert pages.blocks(page) == (["A & B", "One two three", "Four bold", "x < y"], True)
    assert pages.blocks(None) == pages.blocks("") == ([], False)
    assert pages.blocks("plain  text") == (["plain text"], False)
    assert pages.blocks("<p>unclosed <b>a<p>b") == (["unclosed a", "b"], False)
    assert pages.blocks("<main><p>a<svg id=x /><p>b<p>c<svg><text>no</text></svg>d") == (["a", "b", "cd"], True)


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([str(rng.randrange(6)) for _ in range(rng.randrange(0, 150))] for _ in range(2))
        rows = [[0] * (len(b) + 1)]
        for x in a:
            rows.append([0])
            for j, y in enumerate(b):
                rows[-1].append(rows[-2][j] + 1 if x == y else max(rows[-2][j + 1], rows[-1][j]))
        found = pages.shared_lines(a, b)
        rest = iter(b)
        assert len(found) == rows[-1][-1] and all(a[i] in rest for i in found)


def test_pages_lose_lines_shared_with_the_nearest_page(spark):
    def body(own):
        return f"<p>Menu of site</p><p>{own}</p><p>Copyright by us</p>"

    one, two = "a story about rivers and hills", "another tale of towns"
    rows = [(1, "http://h.org/a/1", body(one)), (2, "http://h.org/a/2", body(two)), (3, "http://other.org/a/1", body(one)),
            (4, None, None), (5, "http://x.org/", ""), (6, "http://y.org/1", body(one)), (7, "http://y.org/2", body(one))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: (r.text, r.n_chars) for r in pages.extract(frame).collect()}
    assert got[1] == (one, len(one)) and got[2][0] == two
    assert got[3][0] == "Menu of site\n" + one + "\nCopyright by us"
    assert got[4] == got[5] == ("", 0)
    assert got[6][0].count("\n") == 2  # copies of each other, not one template
    assert pages.extract(frame.limit(0)).count() == 0
    for kind in ("int", "string"):
        other = {r.page_id: r.text for r in pages.extract(frame.withColumn("page_id", F.col("page_id").cast(kind))).collect()}
        assert other[1 if kind == "int" else "1"] == one and len(other) == 7


def test_marked_articles_lose_what_all_pages_around_them_have(spark):
    def body(n, *more):
        lines = ["Share this story", f"own text of page {n} about rivers", *more, f"and what page {n} ends with", "Story goes on below", f"last of {n}"]
        return "<nav>menu</nav><article>" + "".join(f"<p>{line}</p>" for line in lines) + "</article><p>outside</p>"

    rows = [(n, f"http://h.org/a/{n}", body(n, *["quoted by some"] * (n % 2))) for n in range(6)]
    rows += [(6, "http://h.org/a/5", body(5, "quoted by some"))]  # a copy is no witness
    rows += [(n, f"http://small.org/a/{n}", body(n)) for n in range(10, 14)]  # three others are too few
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text.split("\n") for r in pages.extract(frame).collect()}
    for n in range(7):
        m = min(n, 5)
        assert got[n] == [f"own text of page {m} about rivers", *["quoted by some"] * (m % 2), f"and what page {m} ends with", f"last of {m}"]
    for n in range(10, 14):
        assert len(got[n]) == 5 and got[n][0] == "Share this story"


def test_quality_holds_out_and_separates(spark, docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["good", "plain", "word", "text", "story"]) for _ in range(30)) if i % 2 else
             " ".join(rng.choice(["bad", "junk"]) + "%%%" for _ in range(30)), i % 2) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = quality.score_quality(frame.select("doc_id", "text"), frame.select("doc_id", "quality")).collect()
    assert all((r.score >= 0.3) == r.doc_id % 2 for r in got) and all(0 <= r.score <= 1 for r in got)
    frame, texts = docs
    none = quality.score_quality(frame, empty(spark, "doc_id long, quality int"), length="n_chars")
    assert {r.score for r in none.collect()} == {0.5} and none.count() == len(texts)


def test_factorisation_identity():
    x = quality.features(np.frombuffer(b"a b c a", np.uint8), np.array([0, 7]), np.array([7.0]))
    m = quality.fit(x, np.array([1.0]))
    m.factor = np.random.default_rng(0).normal(size=m.factor.shape)
    v = np.concatenate([m.factor[x.bucket] * x.weight[:, None], m.factor[quality.BUCKETS:] * m.scaled(x.dense)[0][:, None]])
    pairs = sum(v[i] @ v[j] for i in range(len(v)) for j in range(i))
    linear = m.bias + (m.linear[x.bucket] * x.weight).sum() + m.scaled(x.dense)[0] @ m.linear[quality.BUCKETS:]
    assert m.sums(x)[0][0] == pytest.approx(linear + pairs)


def test_suffix_tree_counts_and_states(docs):
    frame, texts = docs
    got = {r.doc_id: r for r in suffix_tree.score_texts(frame, quality.in_fold("doc_id", 1)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    tokens = {i: spaced(t) + [None] for i, t in texts.items()}
    one, two, three = Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if not held[i]:
            w = ["^", *w]
            one.update(w[1:]), two.update(zip(w, w[1:])), three.update(zip(w, w[1:], w[2:]))
    total, distinct = sum(one.values()), len(one)
    p0 = {w: (one[w] + 0.5) / (total + 0.5 * (distinct + 1)) for ws in tokens.values() for w in ws}
    smooth = suffix_tree.smoothed
    n_of = {w: one[w] for w in one} | {"^": one[None]}
    gain_one, gain_two = Counter(), Counter()
    for (b, w), c in two.items():
        if b != "^" and n_of[b] >= 2:
            gain_one[b] += c * math.log(smooth(c - 1, n_of[b] - 1, p0[w]) / p0[w])
    keep_one = {b for b, g in gain_one.items() if g > suffix_tree.KEEP} | ({"^"} if n_of["^"] >= 2 else set())
    for (a, b, w), c in three.items():
        if two[a, b] >= 2:
            p = smooth(two[b, w] - 1, n_of[b] - 1, p0[w]) if b in keep_one else p0[w]
            gain_two[a, b] += c * math.log(smooth(c - 1, two[a, b] - 1, p) / p)
    keep_two = {s for s, g in gain_two.items() if g > suffix_tree.KEEP}
    assert keep_two and keep_one
    for i, w in tokens.items():
        score, w = 0.0, ["^", *w]
        for k in range(1, len(w)):
            p = p0[w[k]]
            if w[k - 1] in keep_one:
                p = smooth(two[w[k - 1], w[k]], n_of[w[k - 1]], p)
            if k > 1 and (w[k - 2], w[k - 1]) in keep_two:
                p = smooth(three[w[k - 2], w[k - 1], w[k]], two[w[k - 2], w[k - 1]], p)
            score += math.log10(p)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w) - 1, sum(one[x] > 0 for x in w[1:]), total)
        assert r.base_score == pytest.approx(sum(math.log10(p0[x]) for x in w[1:])) and r.score == pytest.approx(score, rel=1e-3)


def test_suffix_tree_without_rows_to_learn_from(spark, docs):
    frame, texts = docs
    got = suffix_tree.score_texts(frame, F.lit(True)).collect()
    assert len(got) == len(texts) and {r.n_known for r in got} == {0}
    assert suffix_tree.score_texts(empty(spark), F.lit(False)).count() == 0


def test_suffix_tree_with_equal_blocks(spark, docs, tmp_path):
    docs[0].select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/docs")
    one = spark.read.parquet(f"{tmp_path}/docs")
    names = [r.block for r in suffix_tree._pack(one.union(one).select("doc_id", F.lit(False).alias("held_out"), "text")).collect()]
    assert len(names) == 2 and len(set(names)) == 1

    def scores(frame):
        rows = suffix_tree.score_texts(frame, quality.in_fold("doc_id", 1)).collect()
        return sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.score, 2)) for r in rows)

    got, want = scores(one.union(one)), scores(one.union(one).coalesce(1))
    assert len(got) == 2 * len(docs[1]) and [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-3, abs=0.02)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, docs, width, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 3)
    frame, texts = docs
    sets = {}
    for i, t in texts.items():
        w = spaced(t)
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: r for r in minhash.near_duplicates(frame, width=width).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), root(i), root(i) == i) for i in sets}
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = "a b c d e f g h i j k l"
    rows = [(None, text), (None, "quite other words stand here now"), (4, text), (4, text), (9, text), (7, None)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(None, 4, False), (None, None, True), (4, 4, True), (4, 4, True), (9, 4, False), (7, 7, True)], key=repr)


def test_signature_is_the_least_rank_of_each_component():
    elements = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64))
    one = minhash.signature(elements[:100], 32)
    assert (np.minimum(minhash.signature(elements[:60], 32), minhash.signature(elements[60:100], 32)) >= one).all()
    a, b = minhash.signature(elements[:4000], 400), minhash.signature(elements[1000:5000], 400)
    assert abs((a == b).mean() - 3000 / 5000) < 0.1


@pytest.mark.parametrize("links_per_task", [10, 500_000])
def test_components(spark, links_per_task, monkeypatch):
    monkeypatch.setattr(components, "TASK_LINKS", links_per_task)
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(None, 1)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links[:-1]:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert all(root(n) == c for n, c in got.items()) and {n for a, b in links[:-1] if a != b for n in (a, b)} == set(got)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_leaks(spark, docs, block):
    frame, texts = docs
    items = [(1, " ".join(spaced(texts[3])[2:30])), (2, "one"), (3, None), (4, "!!"), (1, "one"), (30, texts[0]), (5, " ".join(spaced(texts[5])[:9]))]

    def normal(t):
        return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    windows = {}
    for i, t in items:
        w = normal(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    found = leaks.summary(leaks.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block))
    assert found.count() == len(texts)
    for r in found.collect():
        w, hit, own = normal(texts[r.doc_id]), set(), set()
        for k in range(len(w)):
            for n in range(1, 11):
                if tuple(w[k:k + n]) in windows and k + n <= len(w):
                    hit.update(range(k, k + n)), own.update(windows[tuple(w[k:k + n])])
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(own), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        assert sum(len(normal(texts[r.doc_id][s.start:s.end])) for s in r.hit_spans) == len(hit)
    assert leaks.find_leaks(frame, empty(spark, "item_id long, text string")).where(F.size("hit_runs") > 0).count() == 0


@pytest.mark.parametrize("crowd", [4096, 1])
def test_repeats(spark, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_ROWS", crowd)
    rng = random.Random(9)
    passage = ["".join(rng.choice("abc é") for _ in range(n)) for n in (100, 130, 400, 99)]
    rows = []
    for i in range(40):
        parts = ["".join(rng.choice("xyzü ") for _ in range(rng.randrange(0, 150)))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passage)
            parts += [p[rng.randrange(0, 2):], "".join(rng.choice("uvw") for _ in range(rng.randrange(0, 4)))]
        rows.append((i, "".join(parts)))
    rows += [(50, None), (51, ""), (52, "q" * 350), (53, rows[0][1] * 3), (54, passage[2])]
    seen, want = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = True
            seen.add(b[s:s + 100])
        want[i] = (len(b), int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in repeats.dedup_repeats(frame).collect():
        assert (r.n_bytes, sum(s.end - s.start for s in r.removed), bytes(r.kept)) == want[r.doc_id], r.doc_id
    assert repeats.dedup_repeats(frame.limit(0)).count() == 0


def test_repeats_with_null_and_repeated_ids(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef") for _ in range(150))
    rows = [(None, text), (3, text), (3, text), (3, text + "z"), (4, "short")]
    got = sorted(((r.doc_id, r.n_bytes, len(r.kept)) for r in repeats.dedup_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert (None, 150, 150) in got and got.count((3, 150, 0)) == 2 and (4, 5, 5) in got and any(g[:2] == (3, 151) and g[2] <= 1 for g in got)


def test_maximal_repeats_hold_all_occurrences():
    found = {(n, tuple(sorted(at))) for n, at in repeats.maximal_repeats([b"xabcdy", b"abcd", b"zabc"], 3)}
    assert found == {(4, ((0, 1), (1, 0))), (3, ((0, 1), (1, 0), (2, 1)))}


def test_personal_data():
    text = "mail a.b@c.org, ip 10.0.0.256 1.2.3.4.5.6.7.8, card 4539 1488 0343 6467, call +1 (017) 555-7713. x@y a@b.c+d@e.f"
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in pii.base_spans(text)] == [
        ("email", "a.b@c.org"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("card", "4539 1488 0343 6467"), ("phone", "+1 (017) 555-7713"),
        ("email", "a@b.c"), ("email", "+d@e.f")]
    assert pii.base_spans("") == [] and pii.base_spans("no data") == []


def test_skip_chain_carries_a_label_to_the_same_number(spark):
    rng = random.Random(3)

    def phone():
        return f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"

    rows = [(i, f"word {phone()} text {phone()} and {rng.randrange(10 ** 15, 10 ** 16)} more") for i in range(60)]
    rows += [(100, "call +1 (217) 555-7713 today. many words later (217) 555-7713 again, version 2.0 and 1234"), (101, None), (102, ""),
             (103, "plain 12 words 555-7713 here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.redact(pii.all_spans(pii.find_personal_data(frame.withColumn("raw", F.col("text"))))).collect()}
    own = found[100]
    assert [own.raw[s.start:s.end] for s in own.added_spans] == ["(217) 555-7713"]
    assert own.text == "call [PHONE] today. many words later [PHONE] again, version 2.0 and 1234"
    assert found[101].text is None and found[102].text == "" and not found[103].added_spans
    assert pii.find_personal_data(frame.limit(0)).count() == 0


def test_skip_chain_links_numbers_written_in_several_tokens(spark):
    rng = random.Random(4)

    def number(*sizes, mark=" "):
        return mark.join(str(rng.randrange(10 ** (n - 1), 10 ** n)) for n in sizes)

    rows = []
    for i in range(150):
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        rows.append((i, f"call +1 {number(3, 3, 4)} now or +1 ({number(3)}) {number(3, 4, mark='-')} then, host {ip} and the "
                        f"card 4539 1488 0343 6467 of {number(4)} with {number(2)} more and {number(5)} left"))
    rows += [(200, "call +1 217 555 7713 today. many words later 217 555 7713 again and 1234 more"),
             (201, "paid by 4539 1488 0343 6467 today. many words later 4539 / 14880343 6467 again"),
             (202, "host 10.0.0.1 is up. many words later 10.0.0[.]1 again, and 10.0.1 or 1-2-3-4 too")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    links = {i: [tuple(t.split()[0] for t in (text[x.start[a]:x.end[a]], text[x.start[b]:x.end[b]])) for a, b in x.skip]
             for i, text in rows[-3:] for x in [pii.tokens(text, pii.base_spans(text))]}
    assert set(links[200]) == {("217", "217"), ("555", "555"), ("7713", "7713")} and links[202] == [("10.0.0.1", "10.0.0[.]1")]
    assert set(links[201]) == {("1488", "14880343"), ("0343", "14880343"), ("6467", "6467")}
    found = {r.doc_id: r for r in pii.find_personal_data(frame).where("doc_id >= 200").collect()}
    assert [(s.kind, found[200].text[s.start:s.end]) for s in found[200].added_spans] == [("phone", "217 555 7713")]
    assert [(s.kind, found[201].text[s.start:s.end]) for s in found[201].added_spans] == [("card", "14880343 6467")]
    assert [(s.kind, found[202].text[s.start:s.end]) for s in found[202].added_spans] == [("ip", "10.0.0[.]1")]


def test_units(spark):
    line = "The very same line of words stands here."
    rows = [(2, f"{line}\nown words of the second text are here\n{line}"), (1, f"First text begins.  THE very  same line of words stands here. End\nshort"),
            (3, None), (4, ""), (5, f"{line}"), (5, f"{line}"), (6, "short\nshort")]
    got = {}
    for r in units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.kept_text, r.n_units, len(r.removed)))
    assert got == {1: [(rows[1][1], 4, 0)], 2: [("own words of the second text are here\n", 3, 2)], 3: [(None, 0, 0)], 4: [("", 0, 0)],
                   5: [("", 1, 1)] * 2, 6: [("short\nshort", 2, 0)]}


def test_units_of_few_words_and_without_spaces(spark, tmp_path):
    same = "今日は天気がとても良いので散歩に出かけました。"
    rows = [(1, f"Main menu\n{same}駅前で友人に会いました。"), (2, f"main  menu\n  \n店は休みでした！」{same}終わり"), (3, f"{same}\nวันนี้อากาศดี"), (4, "วันนี้อากาศดี\nown")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    texts, want = dict(rows), {1: rows[0][1], 2: "  \n店は休みでした！」終わり", 3: "วันนี้อากาศดี", 4: "own"}
    got = {r.doc_id: r for r in queries.op8_substring_dedup(spark, str(tmp_path)).collect()}
    assert {i: r.kept_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert [texts[2][s.start:s.end] for s in got[2].removed] == ["main  menu", same]
    assert [u[2] for u in units.units("一。二？」 三．四 Five. Six ３．１４")] == ["一。", "二？」", "三．", "四 Five.", "Six ３．１４"]


def brute_units(text):
    """Pieces of each line as (start, end, is a unit), by the letter of the rule."""
    out, base = [], 0
    dense = re.compile("[\u0e00-\u0eff\u2e80-\u9fff]")
    for line in (text or "").split("\n"):
        pieces = [(base + a, base + b) for a, b, _ in units.units(line)]
        words = [len(text[a:b].split()) + len(dense.findall(text[a:b])) for a, b in pieces]
        i = 0
        while i < len(pieces):
            if words[i] >= 5:
                out.append((*pieces[i], True))
                i += 1
            elif len(pieces) == 1 and text[pieces[0][0]:pieces[0][1]].strip()[-1:] not in list(".!?。！？．"):
                out.append((*pieces[0], bool(text[pieces[0][0]:pieces[0][1]].split())))
                i += 1
            else:
                j, n = i, 0
                while j < len(pieces) and words[j] < 5 and n < 5:
                    n, j = n + words[j], j + 1
                out.append((pieces[i][0], pieces[j - 1][1], n >= 5))
                i = j
        base += len(line) + 1
    return out


def test_unit_dedup_equals_brute_force(spark):
    rng = random.Random(12)
    parts = ["Short one. ", "A longer sentence with many words. ", "Menu", "Of.", "\n", "\n", "\n", "今日は天気がとても良い。", "終わり", "Why? ", "No!! ", " ",
             "three words here ", "and a piece without its end "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))) for i in range(120)]
    rows += [(200, None), (201, ""), rows[3], rows[3], (202, "A longer sentence with many words. " * 20_000)]
    got = units.dedup_units(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, removed string").repartition(4), headings=True).collect()
    seen, want = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0], r[1] or "")):
        assert list(units.judged(t, 5)) == brute_units(t)
        for a, b, ok in brute_units(t):
            if ok and seen.setdefault(" ".join(t[a:b].lower().split()), (i, a)) != (i, a):
                want.setdefault(i, []).append((a, b))
    assert len(got) == len(rows)
    assert {r.doc_id: [tuple(s) for s in r.removed] for r in got if r.removed} == want
    assert all(r.kept_text == (None if r.text is None else units.cut(r.text, want.get(r.doc_id, []))) for r in got)
    assert units.dedup_units(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 24)) * rng.uniform(0.5, 2, size=(700, 1))
    x[5] = x[6] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 24), (902, [None] * 24), (903, [float("nan")] * 24), (904, [1.0]), (None, x[1].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    hits = 0
    for q in range(0, 700, 20):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(700), -score))[:20]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        assert all(r.score == pytest.approx(score[r.vec_id]) for r in own)
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits / (35 * 20) >= 0.9
    few = spark.createDataFrame(rows[:6], "vec_id long, embedding array<double>")
    assert neighbours.nearest(few, F.col("vec_id") == 0).count() == 5
    assert neighbours.nearest(few.limit(0), F.lit(True)).count() == 0


def test_bpe_equals_the_library(spark, docs):
    tiktoken = pytest.importorskip("tiktoken")
    vocabulary, pattern = queries.vocabulary()
    ranks = bpe.read_ranks(vocabulary.splitlines())
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    frame, texts = docs
    for r in bpe.digests(bpe.encode_decode(frame, vocabulary, pattern)).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    own, rng = bpe.PrefixBpe(ranks), random.Random(2)
    for _ in range(200):
        old = bytes(rng.choice(b"aeinrst ") for _ in range(rng.randrange(0, 90)))
        a = rng.randrange(len(old) + 1)
        b = rng.randrange(a, min(len(old), a + 5) + 1)
        new = bytes(rng.choice(b"aeinrst ") for _ in range(rng.randrange(0, 6)))
        piece, table = own.edited(old, own.table(old), a, b, new)
        assert piece == old[:a] + new + old[b:] and table == own.table(piece)
    assert bpe.encode_decode(empty(spark), vocabulary, pattern).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    frame, texts = docs
    bench = [(1, " ".join(spaced(texts[3])[:12]))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty(spark, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, current, str(tmp_path))
        assert result.columns == current.columns, name
        result.write.parquet(f"{tmp_path}/{name}")
        current = spark.read.parquet(f"{tmp_path}/{name}")
    kept = {r.doc_id for r in current.collect()}
    groups = {r.doc_id: r.kept for r in minhash.near_duplicates(frame, width=5).collect()}
    leaked = {r.doc_id for r in leaks.find_leaks(frame, spark.createDataFrame(bench, "item_id long, text string")).where(F.size("hit_runs") > 0).collect()}
    assert kept == {i for i, k in groups.items() if k} - leaked
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept


def test_a_worker_keeps_ids_alone():
    """What a worker keeps stays in its memory through later stages: decoded bytes come from the ids."""
    import base64

    vocabulary = b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)) + b"\nYWI= 256\n"
    got = list(bpe.encode_texts(["ab abc", "", "cab"], vocabulary, r"\S+|\s+"))
    ids = [np.frombuffer(i, dtype=np.int32).tolist() for i, _ in got]
    assert ids == [[256, 32, 256, 99], [], [99, 256]] and [b for _, b in got] == [b"ab abc", b"", b"cab"]
    _, _, kept = bpe._loaded(vocabulary, r"\S+|\s+")
    assert len(kept) == 4 and all(type(own) is bytes for own in kept.values())


def test_new_pieces_go_side_by_side(monkeypatch):
    """New pieces are not encoded one by one: few long ones go alone."""
    alone, encode = [], bpe.PrefixBpe.encode
    monkeypatch.setattr(bpe.PrefixBpe, "encode", lambda self, piece: alone.append(piece) or encode(self, piece))
    vocabulary, pattern = queries.vocabulary()
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("aeinrst", k=rng.randrange(3, 12))) for _ in range(400)) for _ in range(5)]
    bpe._loaded.cache_clear()
    list(bpe.encode_texts(texts, vocabulary, pattern))
    assert len(bpe._loaded(vocabulary, pattern)[2]) > 1500 and len(alone) < 200
    with pytest.raises(ValueError, match="lacks"):
        list(bpe.encode_texts(["ab" * n for n in range(1, 300)], b"YQ== 0\nYWE= 1\n", r"\S+"))


def test_side_by_side_equals_the_library(monkeypatch):
    """Random merges in order, gaps between ranks, tokens that no merge makes, pieces of any length, tables of every size."""
    import base64

    tiktoken = pytest.importorskip("tiktoken")
    monkeypatch.setattr(bpe, "SIDE_BY_SIDE", 5, raising=False)
    pattern = r"\S+|\s+"
    for seed in range(12):
        rng = random.Random(seed)
        letters = "abé漢" if seed % 2 else "ab"
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 346:
            new = b"".join(rng.choices([*tokens[256:], b"a", b"b", b"\xc3", b"\xa9"], k=2))
            if new not in tokens and len(new) < 12:
                tokens.append(new)
        tokens += sorted({"".join(rng.choices(letters, k=5)).encode() for _ in range(20)} - set(tokens))
        gap = 1 if seed % 3 else 7
        vocabulary = b"\n".join(base64.b64encode(t) + b" %d" % (i * gap) for i, t in enumerate(tokens))
        texts = [" ".join("".join(rng.choices(letters, k=int(rng.paretovariate(0.7)) % 300)) for _ in range(rng.randrange(60)))
                 for _ in range(30)] + ["", "a" * 5000]
        library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
        want = [[i * gap for i in library.encode_ordinary(text)] for text in texts]
        for kept, size in ((150_000, 1 << 18), (80, 4000), (7, 300)):
            monkeypatch.setattr(bpe, "KEPT_PIECES", kept)
            monkeypatch.setattr(bpe, "SIDE_BYTES", size, raising=False)
            bpe._loaded.cache_clear()
            got = list(bpe.encode_texts(texts, vocabulary, pattern))
            assert [np.frombuffer(i, dtype=np.int32).tolist() for i, _ in got] == want
            assert [b for _, b in got] == [text.encode() for text in texts]
            assert len(bpe._loaded(vocabulary, pattern)[2]) <= kept
    bpe._loaded.cache_clear()
