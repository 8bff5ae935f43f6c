"""Byte-level BPE by prefix dynamic programming.

BPE gives every byte string one token sequence, and every prefix of it one too. It
is therefore enough to store, for each prefix, the last token of the prefix's own
sequence: a token ending there is the right one if BPE would leave it and the last
token of what stands before it unmerged. The table grows byte by byte, so an append
never touches what is stored, and after an edit the table is computed anew only from
the edit to where it agrees with the old one again. The tables of many pieces grow side
by side, one byte of each at a time.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm import words

#: Distinct pieces whose ids a Python worker keeps, some 30 MB, and pairs of tokens met in
#: pieces that go alone, some 40 MB more if many do. The table of pairs is emptied when full,
#: that of pieces loses the older half, but for those in hand. Decoded bytes are not kept
#: beside the ids: what a worker keeps stays with it through all later stages.
KEPT_PIECES = 150_000
KEPT_PAIRS = 200_000
#: Pieces whose tables grow side by side, at least: the few longer than all others go alone.
SIDE_BY_SIDE = 64
#: Bytes of pieces whose tables grow side by side, and bytes of text cut into pieces at once, or one text.
SIDE_BYTES, TEXT_BYTES = 1 << 18, 1 << 19
#: Places for pairs of tokens beside those, 2 MB; a pair takes the place of an older one.
PAIR_BITS = 18
_NEVER = 1 << 62


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Ranks from lines ``<base64 of the token> <rank>``."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class PrefixBpe:
    """Encoder of single pieces, each merged on its own."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        #: the two tokens that each is merged from; None of a single byte
        self.parts: dict[int, tuple[int, int] | None] = {}
        for token in sorted(ranks, key=lambda t: (len(t) > 1, ranks[t])):
            rank = ranks[token]
            if len(token) == 1:
                self.parts[rank] = None
                continue
            parts = self._merged(token)
            if len(parts) == 2:
                a, b = ranks[parts[0]], ranks[parts[1]]
                if a in self.parts and b in self.parts:
                    self.parts[rank] = a, b
        #: tokens that merges can produce; any other stands only for a whole piece
        self.made = {token: rank for token, rank in ranks.items() if rank in self.parts}

    def _merged(self, token: bytes) -> list[bytes]:
        """The parts of a token before its own merge."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == _NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def ends(self, token: int, side: int) -> list[tuple[int, int]]:
        """Left (0) or right (1) ends of a token through its merges: (token, rank of the merge
        that takes it up), from the single byte to the whole token."""
        found, until = [], _NEVER
        while True:
            found.append((token, until))
            if self.parts[token] is None:
                return found[::-1]
            token, until = self.parts[token][side], token

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens a and b side by side as they are."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        ends, begins, i, j, apart = self.ends(a, 1), self.ends(b, 0), 0, 0, True
        while True:
            (u, u_until), (v, v_until) = ends[i], begins[j]
            merge = self.ranks.get(self.token[u] + self.token[v], _NEVER)
            # Of equal ranks the leftmost goes first.
            if merge < u_until and merge <= v_until:
                apart = False
                break
            if u_until == v_until == _NEVER:
                break
            if u_until <= v_until:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = apart
        return apart

    def extend(self, piece: bytes, last: list[int], upto: int | None = None) -> list[int]:
        """Fill ``last``, whose entry i is the last token of the first i bytes, for more of the piece."""
        made, longest, pairs = self.made, self.longest, self.pairs
        for end in range(len(last), (len(piece) if upto is None else upto) + 1):
            for begin in range(max(0, end - longest), end):
                token = made.get(piece[begin:end])
                if token is None:
                    continue
                if begin == 0:
                    break
                known = pairs.get((last[begin], token))
                if known or known is None and self.stay_apart(last[begin], token):
                    break
            else:
                raise ValueError(f"the vocabulary lacks a token for byte {piece[end - 1]}")
            last.append(token)
        return last

    def table(self, piece: bytes) -> list[int]:
        return self.extend(piece, [-1])

    def edited(self, old: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Table of ``old`` with bytes start to end replaced: only the surroundings are computed anew."""
        piece, shift = old[:start] + new + old[end:], len(new) - (end - start)
        table, same = last[:start + 1], 0
        for at in range(start + 1, len(piece) + 1):
            self.extend(piece, table, at)
            before = at - shift
            same = same + 1 if before > end and table[at] == last[before] else 0
            if same >= self.longest:  # nothing later can look back beyond these
                return piece, table + last[before + 1:]
        return piece, table

    def backtrack(self, last: list[int]) -> list[int]:
        ids, at = [], len(last) - 1
        while at > 0:
            ids.append(last[at])
            at -= len(self.token[last[at]])
        return ids[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self.backtrack(self.table(piece)) if piece else []

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    @cached_property
    def arrays(self) -> TokenArrays:
        return TokenArrays(self)

    def encode_all(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as int32 bytes; none is empty. A bounded number of bytes goes side by side."""
        found = []
        for at, to, data, bounds in words.chunks(pa.array(pieces, pa.large_string()), SIDE_BYTES):
            length, some = np.diff(bounds), [b""] * (to - at)
            longest = np.partition(length, -SIDE_BY_SIDE)[-SIDE_BY_SIDE] if len(length) >= SIDE_BY_SIDE else 0
            together = length <= longest
            if len(self.made) < len(self.ranks):  # tokens that only a whole piece can be
                together &= np.array([p.encode() not in self.ranks for p in pieces[at:to]])
            side = np.flatnonzero(together)
            ids, ends = self.arrays.encode(data, bounds[:-1][side], length[side])
            joined, ends = ids.tobytes(), (4 * ends).tolist()
            for i, begin, end in zip(side.tolist(), ends, ends[1:]):
                some[i] = joined[begin:end]
            for i in np.flatnonzero(~together).tolist():
                some[i] = np.array(self.encode(pieces[at + i].encode()), dtype=np.int32).tobytes()
            found += some
        return found

    @cached_property
    def written(self) -> tuple[np.ndarray, pa.Array]:
        """All ranks in order, and the bytes of their tokens."""
        ranks = sorted(self.token)
        return np.array(ranks, dtype=np.int64), pa.array([self.token[r] for r in ranks], pa.large_binary())

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each range of ids between two of the n + 1 bounds."""
        ranks, tokens = self.written
        if len(ranks) and ranks[-1] >= len(ranks):  # ranks with gaps
            ids = np.searchsorted(ranks, ids)
        taken = tokens.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int64)[bounds].tolist() if len(ids) else [0] * len(bounds)
        body = taken.buffers()[2]
        return [body[begin:end].to_pybytes() if end > begin else b"" for begin, end in zip(ends, ends[1:])]


class TokenArrays:
    """The tokens of an encoder as arrays, numbered by rank, for tables of many pieces at once."""

    def __init__(self, encoder: PrefixBpe):
        made = sorted(encoder.made.items(), key=lambda t: t[1])
        number = {rank: i for i, (_, rank) in enumerate(made)}
        self.count = n = len(made)
        self.rank = np.array([rank for _, rank in made], dtype=np.int32)
        self.length = np.array([len(token) for token, _ in made], dtype=np.int32)
        self._ends(np.frombuffer(b"".join(token for token, _ in made), dtype=np.uint8))
        self.right, self.left = self._chains(encoder, number, 1), self._chains(encoder, number, 0)
        keys, ranks = array("q"), array("q")
        for token, rank in encoder.ranks.items():
            for cut in range(1, len(token)):
                a, b = encoder.made.get(token[:cut]), encoder.made.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(number[a] * n + number[b])
                    ranks.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.merge_keys = np.append(np.array(keys, dtype=np.int64)[order], _NEVER)
        self.merge_ranks = np.append(np.array(ranks, dtype=np.int64)[order], _NEVER)
        self.known = np.full(1 << PAIR_BITS, -1, dtype=np.int64)  # twice the pair, plus one if it stays apart

    @staticmethod
    def _chains(encoder: PrefixBpe, number: dict[int, int], side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ends of each token begin, and all ends: the token, and the rank of the merge that takes it up."""
        first, ends, until = array("q"), array("q"), array("q")
        for rank in number:
            first.append(len(ends))
            for token, merge in encoder.ends(rank, side):
                ends.append(number[token])
                until.append(merge)
        return np.array(first, dtype=np.int64), np.array(ends, dtype=np.int64), np.array(until, dtype=np.int64)

    def _ends(self, data: np.ndarray) -> None:
        """A tree of the tokens read from their ends: node i is reached by key i - 1, 256 times the node before plus the byte."""
        last, live, nodes = np.cumsum(self.length, dtype=np.int64) - 1, np.arange(self.count), 1
        node, keys, best = np.zeros(self.count, dtype=np.int64), [], [np.full(1, -1)]
        shorter = np.full(self.count, -1)
        for depth in range(int(self.length.max(initial=0))):
            key, at = np.unique(node[live] * 256 + data[last[live] - depth], return_inverse=True)
            longest = np.concatenate(best)[key >> 8]  # the longest token on the way to each new node
            node[live] = nodes + at
            whole = live[self.length[live] == depth + 1]
            shorter[whole] = longest[node[whole] - nodes]
            longest[node[whole] - nodes] = whole
            keys.append(key)
            best.append(longest)
            nodes += len(key)
            live = live[self.length[live] > depth + 1]
        self.keys = np.append(np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64), _NEVER)
        self.best, self.shorter = np.concatenate(best).astype(np.int32), shorter.astype(np.int32)

    def longest_ends(self, data: np.ndarray, room: np.ndarray) -> np.ndarray:
        """For each byte the longest token that ends there and has no more than ``room`` bytes; -1 if none."""
        node, live, depth = np.zeros(len(data), dtype=np.int32), np.arange(len(data), dtype=np.int32), 0
        while len(live):
            key = node[live] * np.int64(256) + data[live - depth]
            at = np.searchsorted(self.keys, key)
            hit = self.keys[at] == key
            live = live[hit]
            node[live] = at[hit] + 1
            depth += 1
            live = live[room[live] > depth]
        return self.best[node]

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves tokens a and b side by side as they are, pair by pair."""
        pair = a * np.int64(self.count) + b
        place = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        got = self.known[place]
        apart, new = (got & 1).astype(bool), np.flatnonzero(got >> 1 != pair)
        if len(new):
            apart[new] = self._compute_apart(a[new], b[new])
            self.known[place[new]] = pair[new] * 2 + apart[new]
        return apart

    def _compute_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        (first, ends, until), (start, begins, before) = self.right, self.left
        i, j, live, apart = first[a], start[b], np.arange(len(a)), np.ones(len(a), dtype=bool)
        while len(live):
            key = ends[i] * self.count + begins[j]
            at = np.searchsorted(self.merge_keys, key)
            merge = np.where(self.merge_keys[at] == key, self.merge_ranks[at], _NEVER)
            u, v = until[i], before[j]
            # Of equal ranks the leftmost goes first.
            merged = (merge < u) & (merge <= v)
            apart[live[merged]] = False
            on = ~merged & ((u < _NEVER) | (v < _NEVER))
            live, i, j, step = live[on], i[on], j[on], (u <= v)[on]
            i, j = i + step, j + ~step
        return apart

    def encode(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of ``data``, one piece after the other, and the n + 1 bounds of their ids."""
        order = np.argsort(-length, kind="stable")
        size = length[order].astype(np.int32)
        first = np.cumsum(size, dtype=np.int32) - size
        room = np.arange(1, int(size.sum()) + 1, dtype=np.int32) - np.repeat(first, size)
        data = data[np.repeat(start[order].astype(np.int32) - 1, size) + room]
        last = self.longest_ends(data, room)
        if last.min(initial=0) < 0:
            raise ValueError(f"the vocabulary lacks a token for byte {data[np.argmax(last < 0)]}")
        for end in range(1, int(size.max(initial=0)) + 1):
            at = first[:np.searchsorted(-size, -end, side="right")] + end - 1
            while len(at):
                token = last[at]
                before = at - self.length[token]
                inner = np.flatnonzero(self.length[token] < end)
                wrong = inner[~self.stay_apart(last[before[inner]], token[inner])]
                at = at[wrong]
                last[at] = self.shorter[token[wrong]]
                if len(at) and last[at].min() < 0:
                    raise ValueError(f"the vocabulary lacks a token for byte {data[at[np.argmin(last[at])]]}")
        live, left, rounds, count = np.arange(len(size)), size.copy(), [], np.zeros(len(size), dtype=np.int64)
        while len(live):
            token = last[first[live] + left[live] - 1]
            rounds.append((live, token))
            count[live] += 1
            left[live] -= self.length[token]
            live = live[left[live] > 0]
        counts = np.empty_like(count)
        counts[order] = count
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ids, stop = np.empty(int(bounds[-1]), dtype=np.int32), bounds[1:][order]
        for n, (live, token) in enumerate(rounds, 1):
            ids[stop[live] - n] = self.rank[token]
        return ids, bounds


@lru_cache(maxsize=2)
def _loaded(vocabulary: bytes, pattern: str):
    """Encoder, pattern and table of pieces of this Python worker."""
    import regex

    return PrefixBpe(read_ranks(vocabulary.splitlines())), regex.compile(pattern), {}


def encode_texts(texts: Iterable[str], vocabulary: bytes, pattern: str) -> Iterator[tuple[bytes, bytes]]:
    """Ids of each text as int32 bytes, and the bytes those ids decode to. All texts are held at once."""
    encoder, split, seen = _loaded(vocabulary, pattern)
    parts = [list(filter(None, split.findall(text))) for text in texts]
    pieces, ids = list(chain.from_iterable(parts)), []
    for at in range(0, len(pieces), KEPT_PIECES):
        some = pieces[at:at + KEPT_PIECES]
        distinct = set(some)
        new = [piece for piece in distinct if piece not in seen]
        if len(seen) + len(new) > KEPT_PIECES:
            older = (piece for piece in seen if piece not in distinct)
            for piece in list(islice(older, len(seen) + len(new) - KEPT_PIECES // 2)):
                del seen[piece]
        seen.update(zip(new, encoder.encode_all(new)))
        ids += map(seen.__getitem__, some)
    ends = np.cumsum([0, *map(len, parts)]).tolist()
    joined = [b"".join(ids[begin:end]) for begin, end in zip(ends, ends[1:])]
    bounds = np.cumsum([0, *(len(i) // 4 for i in joined)])
    yield from zip(joined, encoder.decode_all(np.frombuffer(b"".join(joined), dtype=np.int32), bounds))


def encode_decode(df: DataFrame, vocabulary: bytes, pattern: str, text: str = "text") -> DataFrame:
    """Columns ``ids`` (array<int>) and ``decoded`` (binary) beside those of ``df``.

    Each match of ``pattern`` is merged on its own and no special tokens exist.
    ``vocabulary`` is the content of a rank file; vocabularies are bounded, so it
    travels to the tasks as a broadcast. A null or empty text gives no ids. Rows are
    kept one to one, repeated ones too; columns of ``df`` named ids or decoded are
    replaced.
    """
    df = df.drop("ids", "decoded")
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches):
        for batch in batches:
            for at, to, _, _ in words.chunks(batch.column(batch.schema.get_field_index(text)), TEXT_BYTES):
                part = batch.slice(at, to - at)
                column = part.column(part.schema.get_field_index(text)).to_pylist()
                pairs = list(encode_texts((x or "" for x in column), shared.value, pattern))
                offsets = np.cumsum([0, *(len(i) // 4 for i, _ in pairs)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.frombuffer(b"".join(i for i, _ in pairs), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids, pa.array([d for _, d in pairs], pa.binary())],
                    names=[*part.schema.names, "ids", "decoded"])

    schema = df.withColumn("ids", F.lit(None).cast("array<int>")).withColumn("decoded", F.lit(None).cast("binary")).schema
    return df.mapInArrow(encode, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` from ids and decoded bytes."""
    return encoded.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join("ids", ",").cast("binary"), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    })
