"""Patterns against plain regular expressions, messages against sums over all labellings."""

import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.llm import pii


def plain(text):
    """The patterns of the contract, word for word."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    parts = ["a", "B", "@", ".", "-", "+", "(", ")", " ", "1", "25", "0", "4539148803436467", "4539 1488 0343 6467", "10.0.0.1", "256.1.1.1",
             "+1 (217) 555-7713", "x.y@c.org", "é", "%", "_", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain(text), text


def test_numbers_of_many_digits():
    assert pii.base_spans("0" * 9_000 + "1.2.3.4 and 1.2.3." + "9" * 9_000) == [(0, 1, 9_007)]
    text = "host 1.2.3.4 or " + "0" * 9_000 + "1-2-3-4 and " + "9" * 9_000
    assert pii.tokens(text, pii.base_spans(text)).skip == [(0, 1)]


@pytest.mark.parametrize("text", ["字" * 1_000_000 + " 1", "a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "+" * 1_000_000 + "1", "a@" * 300_000,
                                  "a." * 500_000 + "@", "( " * 500_000 + "+1 "])
def test_long_runs_take_linear_time(text):
    start = time.time()
    pii.tokens(text, pii.base_spans(text))
    assert time.time() - start < 20


def drawn(seed):
    rng = np.random.default_rng(seed)
    chain, skip = rng.normal(size=(5, 5)), rng.normal(size=(5, 5))
    return pii.Field(rng.normal(size=(pii.N_FEATURES, 5)), chain, skip + skip.T + 2 * np.eye(5)), rng


def drawn_tokens(rng, n, chain, skip, seen=()):
    label, observed = [0] * n, [False] * n
    for i, y in seen:
        label[i], observed[i] = y, True
    shape = (rng.random((n, pii.N_FEATURES)) < 0.1).astype(float)
    return pii.Tokens(list(range(n)), list(range(1, n + 1)), shape, chain, skip, label, observed)


def summed(t, field):
    """Label probabilities by summing over all labellings."""
    unary, a, b, psi = pii.network(t, field)
    p = np.zeros_like(unary)
    for labels in itertools.product(range(5), repeat=len(unary)):
        y = np.array(labels)
        weight = np.exp(unary[np.arange(len(y)), y].sum() + psi[np.arange(len(a)), y[a], y[b]].sum())
        p[np.arange(len(y)), y] += weight
    return (p / p.sum(1, keepdims=True))[:len(t.start)]


@pytest.mark.parametrize("chain, skip, seen", [
    ([False, True, True, True, True, True], [], [(2, 3)]),
    ([False] * 5, [(0, 1), (1, 2), (2, 3), (3, 4)], [(0, 4)]),
    ([False] * 5, [(0, 1), (1, 2), (2, 3), (3, 4)], []),
    ([False, True, False, True, False], [(0, 2), (2, 4)], [(2, 1)]),
])
def test_messages_equal_sums_where_nothing_loops(chain, skip, seen):
    for seed in range(3):
        field, rng = drawn(seed)
        t = drawn_tokens(rng, len(chain), chain, skip, seen)
        assert np.abs(pii.posterior(t, field) - summed(t, field)).max() < 0.01


def test_messages_settle_near_the_sums_in_loops():
    for seed in range(3):
        field, rng = drawn(seed)
        field = pii.Field(field.token, field.chain / 2, field.skip / 2)
        t = drawn_tokens(rng, 5, [False, True, False, True, True], [(0, 2), (1, 3), (2, 4)])
        assert np.abs(pii.posterior(t, field) - summed(t, field)).max() < 0.1


def test_all_forms_of_a_number_take_its_label():
    rng = random.Random(3)

    def phone():
        return f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"

    sample = Counter()
    for _ in range(60):
        text = f"word {phone()} text {phone()} and {rng.randrange(10 ** 15, 10 ** 16)} more"
        sample.update(pii.learned(pii.tokens(text, pii.base_spans(text))))
    text = "call +1 (217) 555-7713 today." + " many words later (217) 555-7713 again" * 20
    added = pii.added_spans(text, pii.base_spans(text), pii.fit(sample))
    assert [(k, text[a:b]) for a, k, b in added] == [(3, "(217) 555-7713")] * 20


def test_sample_is_bounded_and_ignores_layout(spark):
    rng = random.Random(5)
    rows = [(i % 40, f"call +1 ({rng.randrange(100, 999)}) 555-{1000 + i % 40} or write to x{i % 40}@c.org") for i in range(40)] * 5 + [(None, None), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    once = pii.train(frame.distinct().repartition(1), "doc_id", "text", 10)
    again = pii.train(frame.repartition(7), "doc_id", "text", 10)
    assert np.allclose(once.token, again.token) and np.allclose(once.skip, again.skip)
    whole = pii.train(frame, "doc_id", "text", 1_000)
    assert not np.allclose(whole.token, once.token)


def test_repeated_rows_get_the_same_spans(spark):
    rows = [(1, "write to a@b.org"), (1, "write to a@b.org"), (None, "write to a@b.org"), (2, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base_spans", F.lit(0)).withColumn("spans", F.lit("mine"))
    found = pii.find_personal_data(frame)
    assert found.count() == 4 and [len(r.base_spans) for r in found.collect()] == [1, 1, 1, 0]
    assert [r.spans for r in found.collect()] == ["mine"] * 4
