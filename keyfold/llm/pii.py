"""Personal data: fixed patterns, extended by a skip-chain conditional random field.

The patterns give base spans, which stay. The field then labels the tokens that hold a
digit or an at sign. Neighbouring tokens share chain potentials. Tokens of a document
share skip potentials, however far apart they stand, where they are equal, or hold the
same digits of runs of number tokens that end in the same seven digits or the same four
numbers up to 255: one token, or several side by side. All tokens that skip links connect
are one group, however many they are: each has a skip potential with every token of a base
span among them, and without base spans each has one with a hub, a variable of the group.
So no label fades from repeat to repeat, and work is linear in them. Messages are passed
until they settle. Tokens of base spans are observed; tokens without digit or at sign are observed
as outside. A token is taken by its posterior.

Weights are learned piecewise from base spans of a bounded sample: token potentials by
multinomial logistic regression, chain and skip potentials as log odds of label pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm import words

#: Documents with candidate tokens the field is fitted on, at most.
SAMPLE_ROWS = 3_000
#: Digits at the end of two runs that make them the same number, and digits of the longest run.
SAME_DIGITS, MOST_DIGITS = 7, 19
KINDS = ("email", "ip", "card", "phone")
OUTSIDE, LABELS = 0, 5
#: Posterior from which a token is taken.
SURE = 0.9
#: Messages are passed until none changes by more than this, in at most so many rounds.
SETTLED, ROUNDS = 1e-3, 200
#: Linked pairs of each label alike that the fit starts from: numbers that recur are rarely of two kinds.
ALIKE = 50

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ANY = re.compile(r"[0-9@]")
# Starts at blanks only: a long run without digits is read once.
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_SPACE_BEFORE = re.compile(r"[^\s]+\s+\Z")
_DIGITS = re.compile(r"[0-9]")
_GROUPS = re.compile(r"[0-9]+")


def octet(digits: str) -> bool:
    """Whether a number is at most 255, with however many zeros before it."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of pattern matches, leftmost and without overlap in each kind."""
    found: list[tuple[int, int, int]] = []
    if not _ANY.search(text):
        return found
    done, at = 0, text.find("@")
    # One at sign at a time: a match reaches back over local characters to the last match.
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGITS.findall(m[0])) <= 15]
    return sorted(found)


@dataclass
class Tokens:
    """Candidate tokens of one text, their features, links and observed labels."""

    start: list[int]
    end: list[int]
    shape: np.ndarray     # tokens x features
    chain: list[bool]     # next to the token before it
    skip: list[tuple[int, int]]
    label: list[int]      # of base spans; outside otherwise
    observed: list[bool]


_BOUNDS = (1, 3, 4, 7, 10, 14, 17, 20)
_MARKS = "@.+()-/:=\"'"
N_SHAPE = len(_BOUNDS) + 1 + len(_MARKS) + 5
N_FEATURES = 3 * N_SHAPE + 1


def shape(token: str) -> np.ndarray:
    """What a token looks like: digits, marks, letters, dotted numbers, checksum."""
    row = np.zeros(N_SHAPE)
    digits = "".join(_DIGITS.findall(token))
    row[sum(len(digits) >= b for b in _BOUNDS)] = 1
    at = len(_BOUNDS) + 1
    for i, c in enumerate(_MARKS):
        row[at + i] = c in token
    at += len(_MARKS)
    row[at] = any(c.isalpha() for c in token)
    row[at + 1] = token.count(".") == 3 and not row[at]
    row[at + 2] = 14 <= len(digits) <= 19 and luhn(digits)
    row[at + 3] = "@" in token and "." in token.rpartition("@")[2]
    row[at + 4] = len(digits) > 0 and all(not p or len(p) <= 3 and int(p) <= 255 for p in digits.split("."))
    return row


@dataclass
class _Runs:
    """Numbers of the tokens of a text, by token: runs of tokens side by side are read as one."""

    groups: list[list[str]]
    first: list[int]      # first token of the run a token belongs to

    def back(self, i: int):
        """(token, group) of the run that ends with token i, last first."""
        for j in range(i, self.first[i] - 1, -1):
            for group in reversed(self.groups[j]):
                yield j, group

    def digits(self, i: int) -> list[tuple[int, str]]:
        """(token, digit) of the run that ends with token i, last first."""
        out: list[tuple[int, str]] = []
        for j, group in self.back(i):
            out += [(j, c) for c in reversed(group)]
            if len(out) >= MOST_DIGITS:
                break
        return out[:MOST_DIGITS]

    def quad(self, i: int) -> list[tuple[int, str]]:
        """(token, number) of the address that the run up to token i ends with, last first; or none."""
        out = []
        for j, group in self.back(i):
            if not octet(group):
                break
            out.append((j, group.lstrip("0") or "0"))
            if len(out) == 4:
                return out
        return []


def _shared(a: list[tuple[int, str]], b: list[tuple[int, str]], size: dict[int, int], enough: int) -> list[tuple[int, int]]:
    """Pairs of tokens that hold the same places of the common end of two runs.

    One of a pair is inside that end as a whole, unless both share ``enough`` places.
    """
    n = 0
    while n < min(len(a), len(b)) and a[n][1] == b[n][1]:
        n += 1
    inside, pairs = Counter(), Counter()
    for (x, _), (y, _) in zip(a[:n], b[:n]):
        inside[0, x] += 1
        inside[1, y] += 1
        pairs[x, y] += 1
    return [(min(x, y), max(x, y)) for (x, y), shared in pairs.items()
            if x != y and (shared >= enough or inside[0, x] == size[x] or inside[1, y] == size[y])]


def tokens(text: str, base: list[tuple[int, int, int]]) -> Tokens:
    out, rows, last, known = Tokens([], [], np.zeros((0, N_FEATURES)), [], [], [], []), [], {}, -1
    begin, open_spans = 0, []
    runs, linked, size, number, ends = _Runs([], []), {}, {}, {}, True
    for i, m in enumerate(_TOKEN.finditer(text)):
        start, end, body = m.start(), m.end(), m[0]
        while begin < len(base) and base[begin][0] < end:
            open_spans.append(base[begin])
            begin += 1
        open_spans = [s for s in open_spans if s[2] > start]
        label = open_spans[0][1] + 1 if open_spans else OUTSIDE
        out.start.append(start), out.end.append(end), out.label.append(label), out.observed.append(bool(open_spans))
        out.chain.append(known >= 0 and not text[known:start].strip())
        known = end
        rows.append(shape(body))
        groups = _GROUPS.findall(body)
        alone = not groups or any(c.isalpha() or c == "@" for c in body)
        runs.groups.append(groups)
        runs.first.append(i if alone or ends or not out.chain[i] or body[0] == "+" else runs.first[i - 1])
        ends = alone or body[-1] in ".,;:!?"
        size[i], number[i] = sum(map(len, groups)), len(groups)
        if "@" in body:
            key = body.strip(".,;:!?\"'()").lower()
            if key in last:  # a chain of links, one for each occurrence
                linked[last[key], i] = None
            last[key] = i
            continue
        digits, quad = runs.digits(i), runs.quad(i)
        for key, of, length, enough in ((tuple(c for _, c in digits[:SAME_DIGITS]) if len(digits) >= SAME_DIGITS else None, runs.digits, size, SAME_DIGITS),
                                        (tuple(c for _, c in quad) or None, runs.quad, number, 4)):
            if key:
                if key in last:
                    linked.update(dict.fromkeys(_shared(of(last[key]), of(i), length, enough)))
                last[key] = i
    out.skip = list(linked)
    if rows:
        own = np.stack(rows)
        near = np.array(out.chain)
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:] = own[:-1] * near[1:, None]
        after[:-1] = own[1:] * near[1:, None]
        out.shape = np.concatenate([own, before, after, np.ones((len(rows), 1))], axis=1)
    return out


@dataclass
class Field:
    token: np.ndarray     # features x labels
    chain: np.ndarray     # labels x labels, log potentials
    skip: np.ndarray


def learned(t: Tokens) -> Counter:
    """What a text says to the fit: labelled tokens by shape, and label pairs of chains and skips."""
    found: Counter = Counter()
    label, near = np.array(t.label, dtype=np.int64), np.flatnonzero(t.chain)
    # What a base entity's number stands beside without a pattern is unlabelled, not outside.
    known = np.ones(len(label), dtype=bool)
    for a, b in t.skip:
        if (label[a] == OUTSIDE) != (label[b] == OUTSIDE):
            known[a if label[a] == OUTSIDE else b] = False
        else:
            found["skip", bytes([label[a], label[b]]), 0] += 1
            found["skip", bytes([label[b], label[a]]), 0] += 1
    for i, j in [*zip(near - 1, near), *zip(near[::-1], near[::-1] - 1)]:
        if not known[i] and label[j] == OUTSIDE:
            known[j] = False
    for i in near[known[near] & known[near - 1]]:
        found["chain", bytes([label[i - 1], label[i]]), 0] += 1
    packed = np.packbits(t.shape[known].astype(bool), axis=1)
    for row, y in zip(packed, label[known]):
        found["token", row.tobytes(), int(y)] += 1
    return found


def fit(sample: Counter, steps: int = 200) -> Field:
    """Piecewise training on summed ``learned``; without a sample nothing beyond base spans is sure."""
    chain, skip = np.ones((LABELS, LABELS)), np.ones((LABELS, LABELS)) + ALIKE * np.eye(LABELS)
    weights = np.zeros((N_FEATURES, LABELS))
    for (what, key, _), n in sample.items():
        if what != "token":
            (chain if what == "chain" else skip)[key[0], key[1]] += n
    seen = sorted((key, y, n) for (what, key, y), n in sample.items() if what == "token")
    if not seen:
        weights[-1, OUTSIDE] = 10
        return Field(weights, np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    x = np.unpackbits(np.frombuffer(b"".join(k for k, _, _ in seen), np.uint8).reshape(len(seen), -1), axis=1)[:, :N_FEATURES].astype(np.float64)
    target, n = np.eye(LABELS)[[y for _, y, _ in seen]], np.array([float(c) for _, _, c in seen])[:, None]
    past = np.full_like(weights, 1e-8)
    for _ in range(steps):
        raw = x @ weights
        p = np.exp(raw - raw.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        step = x.T @ ((p - target) * n) / n.sum() + 1e-4 * weights
        past += step * step
        weights -= 0.3 * step / np.sqrt(past)

    def odds(pairs):
        joint = pairs / pairs.sum()
        return np.clip(np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True))), -4, 4)

    return Field(weights, odds(chain), odds(skip))


def groups_of(n: int, links: list[tuple[int, int]]) -> list[list[int]]:
    """Tokens that links connect, by group."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    groups: dict[int, list[int]] = {}
    for i in sorted({i for link in links for i in link}):
        groups.setdefault(find(i), []).append(i)
    return list(groups.values())


def network(t: Tokens, field: Field):
    """Log potentials: of each token and hub by label, and of edges (first, second, pair table).

    Observed tokens send no more than a known potential to the others of their group, so
    it is added to these at once. Hubs, of groups with none observed, follow the tokens;
    a group of two needs no hub.
    """
    n, linked = len(t.start), groups_of(len(t.start), t.skip)
    fixed, label = np.array(t.observed, dtype=bool), np.array(t.label, dtype=np.int64)
    unary = t.shape @ field.token
    unary[fixed] = -30.0
    unary[fixed, label[fixed]] = 0.0
    near, hub = np.flatnonzero(t.chain), n
    a, b = [near - 1], [near]
    for group in map(np.array, linked):
        seen = fixed[group]
        if seen.any():
            unary[group[~seen]] += field.skip[label[group[seen]]].sum(0)
        elif len(group) == 2:
            a.append(group[:1]), b.append(group[1:])
        else:
            a.append(np.full(len(group), hub)), b.append(group)
            hub += 1
    unary = np.concatenate([unary, np.zeros((hub - n, LABELS))])
    a, b = np.concatenate(a), np.concatenate(b)
    psi = np.concatenate([np.repeat(field.chain[None], len(near), 0), np.repeat(field.skip[None], len(a) - len(near), 0)])
    return unary, a, b, psi


def posterior(t: Tokens, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of each token by loopy sum-product, exact where chains, pairs and hubs form no loop."""
    n = len(t.start)
    unary, a, b, psi = network(t, field)
    unary -= unary.max(1, keepdims=True)
    m = len(a)
    if m:
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        psi = np.concatenate([psi, psi.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        message = np.zeros((2 * m, LABELS))
        kept = 0.5 if 0 < sum(t.chain) < m else 0.0  # only loops need damping
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + psi
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            new = kept * message + (1 - kept) * new
            change, message = np.abs(new - message).max(), new
            if change < SETTLED:
                break
        np.add.at(unary, target, message)
    p = np.exp(unary[:n] - unary[:n].max(1, keepdims=True))
    return p / p.sum(1, keepdims=True) if n else p


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field, sure: float = SURE) -> list[tuple[int, int, int]]:
    """(start, kind, end) of entities the field finds beside the base spans.

    A token is taken where a label other than outside has a posterior of ``sure``. Tokens
    of one kind side by side are one span.
    """
    if not _ANY.search(text):
        return []
    t = tokens(text, base)
    p = posterior(t, field)
    label, held = p.argmax(1), p.max(1)
    good = [bool(label[i] != OUTSIDE and held[i] >= sure and not t.observed[i]) for i in range(len(label))]
    spans: list[list[int]] = []
    for i, taken in enumerate(good):
        if not taken:
            continue
        kind = int(label[i]) - 1
        if spans and t.chain[i] and good[i - 1] and spans[-1][1] == kind:
            spans[-1][2] = t.end[i]
        else:
            spans.append([t.start[i], kind, t.end[i]])
    out = []
    for start, kind, end in spans:
        while end > start and text[end - 1] in ".,;:!?\"'":
            end -= 1
        while start < end and text[start] in "\"',;:":
            start += 1
        if start < end:
            out.append((start, kind, end))
    return out


def train(docs: DataFrame, doc_id: str, text: str, rows: int = SAMPLE_ROWS) -> Field:
    """Fit on the ``rows`` documents with candidate tokens that come first by hash of id and text.

    Ranks alone are sorted; the last one taken is the threshold under which texts are
    read, in the tasks that hold them. Repeated rows count once.
    """
    ranked = docs.select(F.xxhash64(doc_id, text).alias("rank"), F.col(text).alias("body"))
    candidates = ranked.where(F.col("body").rlike("[0-9]{3}|@"))
    last = candidates.select("rank").distinct().orderBy("rank").limit(rows).agg(F.max("rank")).first()[0]
    if last is None:
        return fit(Counter())
    chosen = candidates.where(F.col("rank") <= last).dropDuplicates(["rank"])

    def extract(batches):
        for batch in batches:
            for at, to, _, _ in words.chunks(batch.column(1)):
                found: Counter = Counter()
                for body in batch.column(1).slice(at, to - at).to_pylist():
                    found.update(learned(tokens(body, base_spans(body))))
                keys = list(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.int32()),
                    pa.array([found[k] for k in keys], pa.int64())], names=["what", "key", "label", "n"])

    got = (chosen.mapInArrow(extract, "what string, key binary, label int, n bigint")
           .groupBy("what", "key", "label").agg(F.sum("n").alias("n")).collect())
    return fit(Counter({(r.what, bytes(r.key), r.label): r.n for r in got}))


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``base_spans`` and ``added_spans``: kind, start and end in code points.

    Spans are ordered by start, then by kind as listed in ``KINDS``. A null or empty text
    has none; rows stay one to one and repeated rows get the same spans; columns of
    ``docs`` with the two names are replaced.
    """
    docs = docs.drop("base_spans", "added_spans")
    field = docs.sparkSession.sparkContext.broadcast(train(docs, doc_id, text, sample_rows))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            column = batch.schema.get_field_index(text)
            for at, to, _, _ in words.chunks(batch.column(column)):
                part, base, added = batch.slice(at, to - at), [], []
                for body in part.column(column).to_pylist():
                    own = base_spans(body or "")
                    base.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in own])
                    added.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in added_spans(body or "", own, field.value)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(base, kind), pa.array(added, kind)],
                                                 names=[*part.schema.names, "base_spans", "added_spans"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("base_spans", _SPANS), T.StructField("added_spans", _SPANS)]))


def all_spans(found: DataFrame) -> DataFrame:
    """``spans``: base and added ones in order."""
    order = F.array(*(F.lit(k) for k in KINDS))
    both = F.transform(F.concat("base_spans", "added_spans"), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.withColumn("spans", F.array_sort(both))


def count(spans: str, kind: str):
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: str):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The text with each span replaced by its kind in square brackets; overlapping spans become one."""
    runs = F.aggregate("spans", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"), lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] > s["start"]),
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
            F.element_at(done, -1)["kind"].alias("kind"))))
    ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))
    made = F.aggregate(runs, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda a, s: F.struct(
        F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"),
        s["end"].alias("at")), lambda a: F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"))))
    return found.withColumn(text, F.when(F.size("spans") > 0, made).otherwise(F.col(text)))
