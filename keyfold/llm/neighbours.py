"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are rotated by learned rotations (iterative quantisation on a sample) and
signed into codes. A code is cut into substrings, each with its own table. Two codes
within Hamming distance r agree in some substring up to distance r // substrings, so
probing every table that far finds all codes within r; those are ranked by the inner
product of the original vectors.

Vectors of differing length in norm get one more coordinate, which makes all norms
equal without changing any inner product with a query; so angles, which the codes
follow, order candidates as inner products do.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Vectors the rotations and the radius are learned on, at most.
SAMPLE_ROWS = 8_000
SAMPLE_QUERIES = 400
BITS, TABLES = 256, 16
#: Share of the sample's true neighbours that lie within the radius. Neighbours among
#: all vectors are nearer than among the sample, so more of them do.
WITHIN = 0.98
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 4096
_BATCH = 64


@dataclass
class Codes:
    rotation: np.ndarray  # (dimensions + 1) x BITS
    norm: float           # of the longest vector
    radius: int

    def encode(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Codes as TABLES 16-bit numbers per vector."""
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(1), 0))
        signs = np.concatenate([x, extra[:, None]], axis=1) @ self.rotation > 0
        return np.packbits(signs, axis=1).view(np.uint16)


def _rotations(x: np.ndarray, seed: int, rounds: int = 25) -> np.ndarray:
    """Rotations that bring signs close to values, as many as the bits need."""
    rng, d = np.random.default_rng(seed), x.shape[1]
    parts = []
    while sum(p.shape[1] for p in parts) < BITS:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
            r = (u @ vt).T
        parts.append(r)
    return np.concatenate(parts, axis=1)[:, :BITS]


def learn(x: np.ndarray, norm: float, k: int, seed: int = 1) -> Codes:
    raised = np.concatenate([x, np.sqrt(np.maximum(norm ** 2 - (x * x).sum(1), 0))[:, None]], axis=1)
    codes = Codes(_rotations(raised, seed), norm, BITS)
    asked = x[:SAMPLE_QUERIES]
    if len(x) > k + 1:
        score = asked @ x.T
        score[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
        best = np.argpartition(-score, k, axis=1)[:, :k]
        own, other = codes.encode(asked, True), codes.encode(x, False)
        distance = np.bitwise_count(own[:, None, :] ^ other[best]).sum(2, dtype=np.int64)
        codes.radius = int(np.quantile(distance, WITHIN))
    return codes


def usable(vector: str) -> Column:
    """Whether a vector takes part: no null or non-finite component, not all zero."""
    c = F.col(vector)
    finite = F.forall(c, lambda v: F.coalesce((v == v) & (F.abs(v) < float("inf")), F.lit(False)) & ~F.isnan(v))
    return F.coalesce(finite & F.exists(c, lambda v: v != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _codes_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["code"].to_pylist()), dtype=np.uint16).reshape(len(table), TABLES)


def search(ids, vectors, codes, asked_ids, asked, asked_codes, radius: int, k: int):
    """(query, id, score) of each query's k best among codes within the radius."""
    reach = radius // TABLES
    tables = [np.unique(codes[:, t], return_inverse=True) for t in range(TABLES)]
    out = []
    for at in range(0, len(asked), _BATCH):
        q = asked_codes[at:at + _BATCH]
        hit = np.zeros((len(q), len(ids)), dtype=bool)
        for t, (keys, bucket) in enumerate(tables):
            near = np.bitwise_count(keys[None, :] ^ q[:, t][:, None]) <= reach
            hit |= near[:, bucket]
        for i in range(len(q)):
            found = np.flatnonzero(hit[i])
            distance = np.bitwise_count(codes[found] ^ q[i]).sum(1, dtype=np.int64)
            found = found[(distance <= radius) & (ids[found] != asked_ids[at + i])]
            score = vectors[found] @ asked[at + i]
            best = np.lexsort((ids[found], -score))[:k]
            out.append((np.full(len(best), asked_ids[at + i]), ids[found[best]], score[best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def nearest(vectors: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row for which ``queries`` holds.

    Nearness is the inner product in double precision, ties go to the smaller id. Rows
    without id, and vectors that are not ``usable`` or not of the commonest length, take
    no part. A query never finds its own id; repeated rows count once. Queries that find
    fewer than k codes within the radius are asked again with no bound on it.

    Queries and vectors are dealt in blocks; a task holds one block of each, and hands
    on k rows per query.
    """
    spark = vectors.sparkSession
    clean = vectors.where(F.col(vec_id).isNotNull() & usable(vector)).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    lengths = clean.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("long")).alias("q"),
                                                          F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm"))
    commonest = lengths.orderBy(F.desc("n"), "d").first()
    schema = "query_id bigint, vec_id bigint, score double"
    if commonest is None or not commonest.q:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    clean = clean.where(F.size("v") == commonest.d)
    sample = clean.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    learned = spark.sparkContext.broadcast(learn(_matrix(sample["v"]), float(np.sqrt(commonest.norm)), k))

    def encode(query: bool):
        def run(batches):
            for batch in batches:
                if len(batch):
                    code = learned.value.encode(_matrix(batch.column(1)), query)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary())],
                                                     names=["id", "v", "code"])
        return run

    coded = "id bigint, v array<double>, code binary"
    base = clean.select("id", "v").mapInArrow(encode(False), coded)
    asked = clean.where("asked").select("id", "v").distinct().mapInArrow(encode(True), coded)

    def ask(asked: DataFrame, n_asked: int, everywhere: bool) -> DataFrame:
        blocks, turns = -(-commonest.n // BLOCK_VECTORS), -(-n_asked // BLOCK_QUERIES)
        left = base.withColumns({"block": F.pmod(F.xxhash64("id"), F.lit(blocks)), "turn": F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))})
        right = asked.withColumns({"turn": F.pmod(F.xxhash64("id"), F.lit(turns)).cast("int"),
                                   "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))})

        def run(x: pa.Table, y: pa.Table) -> pa.Table:
            if not len(x) or not len(y):
                return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
            radius = BITS if everywhere else learned.value.radius
            q, i, s = search(x["id"].to_numpy(), _matrix(x["v"]), _codes_of(x), y["id"].to_numpy(), _matrix(y["v"]), _codes_of(y), radius, k)
            return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

        found = left.groupBy("block", "turn").cogroup(right.groupBy("block", "turn")).applyInArrow(run, schema)
        ranked = found.distinct().withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    from keyfold.session import materialize

    first = materialize(ask(asked, commonest.q, False))
    enough = min(k, commonest.n - 1)
    full = first.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= enough)
    short = materialize(asked.join(full, asked["id"] == full["query_id"], "left_anti"))
    n_short = short.count()
    if not n_short:
        return first
    again = ask(short, n_short, True)
    return first.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").select(again.columns).union(again)
