"""Log probabilities of texts under a probabilistic suffix tree of words.

States of the tree are the empty context, single words and pairs of words that were
seen at least twice. A longer context is retained if, over all its training
occurrences, the next words are likelier under it than under its suffix by
``KEEP`` nats, each occurrence judged by counts that leave it out (so a context does not
pass by remembering itself). Distributions are smoothed towards those of the suffix:
``(count + weight * p_suffix) / (total + weight)`` with ``weight = STRENGTH + SHARE * total``. A token is scored in the longest
retained suffix of what stands before it.

Texts are packed into blocks once. A block asks for the counts of its distinct keys,
packed as sorted differences; keys are dealt by range, summed over blocks, and answered
in the order asked. Nothing is grouped by context, so no frequent word makes a large
group: a key is one entry per block, however often it occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm import words
from keyfold.llm.placed import placed, release
from keyfold.session import materialize

KEEP = 3.0
STRENGTH, SHARE = 2.0, 0.25
#: Bytes of text in a block; a longer text makes a block of its own.
BLOCK_BYTES = 10 << 20

_END = np.uint64(0x6A09E667F3BCC909)
_START = np.uint64(0xBB67AE8584CAA73B)
#: Keys of pairs and triples keep 48 bits: a key meets another with a chance of their
#: number in 2**48, and then counts a little too much. Words keep all 64.
_COARSE = np.uint64(0xFFFFFFFFFFFF0000)
_ONE, _TWO, _GAIN_ONE, _THREE, _GAIN_TWO = range(5)
_BITS_LOST = {_ONE: 0, _TWO: 16, _GAIN_ONE: 20, _THREE: 16, _GAIN_TWO: 16}


def packed(keys: np.ndarray, coarse: int = 0) -> bytes:
    """Sorted distinct numbers: the first, then differences of as many bytes as the largest needs."""
    keys = keys >> np.uint64(coarse)
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(blob: bytes, coarse: int = 0) -> np.ndarray:
    width = blob[0]
    body = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body) + 1, 8), dtype=np.uint8)
    steps[0] = np.frombuffer(blob, np.uint8, count=8, offset=1)
    steps[1:, :width] = body
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64) << np.uint64(coarse)


def numbers(values: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest, sums in half precision where they fit; compressed."""
    if values.dtype.kind == "f":
        kind = "f2" if np.abs(values).max(initial=0) < 6e4 else "f4"
    else:
        kind = next(k for k, most in (("u1", 1 << 8), ("u2", 1 << 16), ("u4", 1 << 32), ("u8", 1 << 64))
                    if int(values.max(initial=0)) < most)
    body = values.astype("<" + kind).tobytes()
    return kind.encode() + len(body).to_bytes(4, "little") + pa.compress(body, codec="zstd", asbytes=True)


def read_numbers(blob: bytes) -> np.ndarray:
    body = pa.decompress(blob[6:], int.from_bytes(blob[2:6], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(body, "<" + blob[:2].decode())


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(keys, return_inverse=True)
    return values, at.astype(np.int32)


def smoothed(count, total, suffix):
    weight = STRENGTH + SHARE * total
    return (count + weight * suffix) / (total + weight)


class Block:
    """Tokens of the texts of a block, an end after each, and their keys."""

    def __init__(self, payload: bytes):
        table = pa.ipc.open_stream(payload).read_all()
        self.ids, self.held_out = table["id"], table["held_out"].to_numpy()
        tokens, size = [], []
        for _, _, w in words.of_column(table["text"].combine_chunks()):
            first = w.first
            own = np.full(len(w.hash) + len(first) - 1, _END, dtype=np.uint64)
            own[np.arange(len(w.hash)) + w.doc] = w.hash
            tokens.append(own)
            size.append(np.diff(first) + 1)
        token, self.size = np.concatenate(tokens), np.concatenate(size)
        del tokens
        self.first = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.train = np.repeat(~self.held_out, self.size)
        self.opens = np.zeros(len(token), dtype=bool)
        self.opens[self.first] = True
        self.one, self.at_one = _distinct(token)
        before = np.concatenate([[_START], token[:-1]])
        before[self.opens] = _START
        # keys of several words keep 48 bits, so that their differences pack better
        self.two, self.at_two = _distinct(words.pair(before, token) & _COARSE)

    def counts(self, at: np.ndarray, n: int, of: np.ndarray | None = None) -> np.ndarray:
        train = self.train if of is None else self.train[of]
        return np.bincount(at[train], minlength=n).astype(np.uint64)

    def learn_one(self, one: np.ndarray, two: np.ndarray, total: int, distinct: int) -> None:
        """Counts of words and pairs, and what follows from them."""
        self.count_one, self.count_two = one, two
        c, self.c_pair = one.astype(np.float32)[self.at_one], two.astype(np.float32)[self.at_two]
        self.known = c > 0
        self.base = ((one + 0.5) / (total + 0.5 * (distinct + 1)))[self.at_one]
        # occurrences of the word before, and of the two before, as contexts
        self.n_one = np.concatenate([c[:1], c[:-1]])
        self.n_one[self.opens] = one[np.searchsorted(self.one, _END)]
        self.n_two = np.concatenate([c[:1], self.c_pair[:-1]])
        self.n_two[self.opens] = 0
        self.long = np.flatnonzero(self.n_two >= 2)
        # a pair never learned has no count after any word either
        self.open = self.c_pair[self.long] >= 1
        of = self.long[self.open]
        self.three, self.at_three = _distinct(words.pair(self.two[self.at_two[of - 1]], self.one[self.at_one[of]]) & _COARSE)

    def gains_one(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of one word seen twice or more, and what this block's occurrences gain by them."""
        of = np.flatnonzero(self.train & ~self.opens & (self.n_one >= 2))
        gain = np.log(self.left_out(of) / self.base[of])
        sums = np.bincount(self.at_one[of - 1], weights=gain, minlength=len(self.one))
        asked = self.count_one >= 2
        return self.one[asked], sums[asked]

    def left_out(self, of: np.ndarray) -> np.ndarray:
        """Smoothed probabilities after one word, without the occurrence itself."""
        return smoothed(self.c_pair[of] - 1, self.n_one[of] - 1, self.base[of])

    def learn_gain_one(self, gain: np.ndarray) -> None:
        kept = np.zeros(len(self.one), dtype=bool)
        kept[self.count_one >= 2] = gain > KEEP
        keep = np.concatenate([[False], kept[self.at_one[:-1]]])
        keep[self.opens] = self.n_one[self.opens] >= 2  # the start of a text is a state
        self.keep_one = keep
        self.p_one = np.where(keep, smoothed(self.c_pair, self.n_one, self.base), self.base)

    def gains_two(self, three: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.c_triple = self.c_pair[self.long]
        self.c_triple[self.open] = three.astype(np.float32)[self.at_three]
        own = self.train[self.long]
        of = self.long[own]
        suffix = np.where(self.keep_one[of], self.left_out(of), self.base[of])
        gain = np.log(smoothed(self.c_triple[own] - 1, self.n_two[of] - 1, suffix) / suffix)
        sums = np.bincount(self.at_two[of - 1], weights=gain, minlength=len(self.two))
        asked = self.count_two >= 2
        return self.two[asked], sums[asked]

    def scores(self, gain: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(self.two), dtype=bool)
        kept[self.count_two >= 2] = gain > KEEP
        p = self.p_one.copy()
        use = kept[self.at_two[self.long - 1]]
        at = self.long[use]
        p[at] = smoothed(self.c_triple[use], self.n_two[at], p[at])
        return np.add.reduceat(np.log10(p), self.first)


def _pack(docs: DataFrame) -> DataFrame:
    """(block, payload): texts in blocks, compressed; the block's name is a hash of its content."""

    def run(batches):
        held, size = [], 0

        def block():
            table = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
                out.write_table(table)
            payload = sink.getvalue().to_pybytes()
            import xxhash
            return pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_64_intdigest(payload) - (1 << 63)], pa.int64()), pa.array([payload], pa.binary())],
                                              names=["block", "payload"])

        for batch in batches:
            for at, to, data, _ in words.chunks(batch.column(2)):
                if size and size + len(data) > BLOCK_BYTES:
                    yield block()
                    held, size = [], 0
                held.append(batch.slice(at, to - at))
                size += len(data)
        if held:
            yield block()

    return docs.mapInArrow(run, "block bigint, payload binary")


def _totals(asked: DataFrame) -> DataFrame:
    """Sums of each key over all blocks, answered to every block in its order."""

    def run(table: pa.Table) -> pa.Table:
        kind, part = table["kind"][0].as_py(), table["part"][0].as_py()
        keys = [unpacked(k.as_buffer().to_pybytes(), _BITS_LOST[kind]) for k in table["keys"]]
        values = np.concatenate([read_numbers(v.as_buffer().to_pybytes()) for v in table["values"]])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=values.astype(np.float64), minlength=len(distinct))
        exact = total if kind in (_GAIN_ONE, _GAIN_TWO) else np.rint(total).astype(np.uint64)
        cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        # Blocks of equal content have one name and one question: each counts, one answer serves them all.
        names, own = np.unique(table["block"].to_numpy(), return_index=True)
        answers = [numbers(exact[at[cut[i]:cut[i + 1]]]) for i in own]
        size = len(own)
        return pa.table({"block": pa.array(names, pa.int64()), "kind": pa.array([kind] * size, pa.int32()), "part": pa.array([part] * size, pa.int32()),
                         "answer": pa.array(answers, pa.binary()),
                         "total": pa.array([int(exact.sum()) if kind == _ONE else 0] + [0] * (size - 1), pa.int64()),
                         "distinct": pa.array([int((exact > 0).sum()) if kind == _ONE else 0] + [0] * (size - 1), pa.int64())})

    totals = materialize(asked.groupBy("kind", "part").applyInArrow(
        run, "block bigint, kind int, part int, answer binary, total bigint, distinct bigint"))
    del asked
    release(totals.sparkSession)  # the questions are answered: their shuffle is the largest there is
    return totals


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learns from rows for which ``held_out`` is not true and scores all. A null or empty
    text is the end token alone. Repeated rows are learned from and scored as often as
    they occur. Without a row to learn from every token has the probability of an unknown
    one. ``base_score`` is the score of the tree's root alone.
    """
    spark = docs.sparkSession
    bits = min(16, max(3, int(np.ceil(np.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))))))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = placed(_pack(rows), "block")

    def asking(block: int, kind: int, keys: np.ndarray, values: np.ndarray):
        part = (keys >> np.uint64(64 - bits)).astype(np.int64)
        cut = np.searchsorted(part, np.arange((1 << bits) + 1))
        filled = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(filled), pa.int32()), pa.array(filled, pa.int32()), pa.array([block] * len(filled), pa.int64()),
             pa.array([packed(keys[cut[p]:cut[p + 1]], _BITS_LOST[kind]) for p in filled], pa.binary()),
             pa.array([numbers(values[cut[p]:cut[p + 1]]) for p in filled], pa.binary())],
            names=["kind", "part", "block", "keys", "values"])

    question = "kind int, part int, block bigint, keys binary, values binary"

    def ask_counts(batches):
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = Block(payload.as_buffer())
                yield asking(number, _ONE, b.one, b.counts(b.at_one, len(b.one)))
                yield asking(number, _TWO, b.two, b.counts(b.at_two, len(b.two)))

    counted = _totals(blocks.mapInArrow(ask_counts, question))
    sums = counted.agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = int(sums[0] or 0), int(sums[1] or 0)

    def answered(*replies: DataFrame) -> DataFrame:
        every = replies[0].select("block", "kind", "part", "answer")
        for r in replies[1:]:
            every = every.union(r.select("block", "kind", "part", "answer"))
        return blocks.join(every.groupBy("block").agg(F.collect_list(F.struct("kind", "part", "answer")).alias("answers")), "block")

    def read(batches):
        """Blocks with the answers of each kind in the order of keys."""
        for batch in batches:
            for i in range(len(batch)):
                got: dict[int, list] = {}
                for kind, _, blob in sorted((a["kind"], a["part"], a["answer"]) for a in batch.column(2)[i].as_py()):
                    got.setdefault(kind, []).append(read_numbers(blob))
                none = np.zeros(0)
                b = Block(batch.column(1)[i].as_buffer())
                b.learn_one(np.concatenate(got[_ONE]), np.concatenate(got[_TWO]), total, distinct)
                yield batch.column(0)[i].as_py(), b, {k: np.concatenate(v) for k, v in got.items()}, none

    def ask_gain_one(batches):
        for number, b, _, _ in read(batches):
            keys, sums = b.gains_one()
            yield asking(number, _GAIN_ONE, keys, sums)
            yield asking(number, _THREE, b.three, b.counts(b.at_three, len(b.three), b.long[b.open]))

    first = _totals(answered(counted).mapInArrow(ask_gain_one, question))

    def ask_gain_two(batches):
        for number, b, got, none in read(batches):
            b.learn_gain_one(got.get(_GAIN_ONE, none))
            yield asking(number, _GAIN_TWO, *b.gains_two(got.get(_THREE, none)))

    second = _totals(answered(counted, first).mapInArrow(ask_gain_two, question))

    def score(batches):
        for _, b, got, none in read(batches):
            b.learn_gain_one(got.get(_GAIN_ONE, none))
            b.gains_two(got.get(_THREE, none))
            scores, known = b.scores(got.get(_GAIN_TWO, none)), np.add.reduceat(b.known.astype(np.int64), b.first)
            base = np.add.reduceat(np.log10(b.base), b.first)
            yield pa.RecordBatch.from_arrays(
                [b.ids.combine_chunks(), pa.array(b.held_out), pa.array(b.size.astype(np.int64)), pa.array(known),
                 pa.array(np.full(len(known), total, dtype=np.int64)), pa.array(base), pa.array(scores)],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = (f"id {docs.schema[doc_id].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    return answered(counted, first, second).mapInArrow(score, schema).withColumnRenamed("id", doc_id)
