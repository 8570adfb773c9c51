"""Operator 10: nearest neighbours with randomly rotated one-bit codes.

Index: the vectors of a block are centred on the block's mean, rotated by one seeded
random orthogonal matrix and reduced to the sign bit of each coordinate; beside the
packed bits stand two correction scalars, the residual's length and its inner product
with its own code. Search: from bits and scalars the inner product of every candidate
with a query is estimated without bias, with an error bound of
``eps * |q| * |residual| * sqrt((1 - f^2) / f^2) / sqrt(dim - 1)`` (f: the inner
product of code and unit residual). The exact scores of the best estimates give a
threshold, and every candidate whose upper bound reaches it is scored exactly in
double precision on the original vectors. Every row is indexed; nothing is capped.

Queries and candidates meet block by block: each candidate block is sent to every
query block, and each pair of blocks returns the ``k`` best of each query, which one
ranked window per query merges. A task holds one pair of blocks.

Cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id or of another length than the most frequent (larger at
a tie); equal scores go to the smaller id; rows with the same id are candidates of
their own; fewer candidates than ``k`` are all returned; an empty table, or one
without queries, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import numbered

BLOCK = 16_384        # candidate vectors in a block
QUERY_BLOCK = 2_048   # queries in a block, on average
TILE = 256            # queries estimated at once
_PACKED = "n int, ids binary, rids binary, vectors binary, codes binary, lengths binary, fits binary, centre binary"


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode_block(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, residual lengths, fits, centre) of float32 row vectors."""
    centre = vectors.mean(axis=0, dtype=np.float64).astype(np.float32)
    rest = vectors - centre
    lengths = np.linalg.norm(rest.astype(np.float64), axis=1).astype(np.float32)
    turned = rest @ turn
    fits = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1], dtype=np.float32) / np.maximum(lengths, 1e-30)
    return np.packbits(turned > 0, axis=1), lengths, np.clip(fits, 1e-6, 1).astype(np.float32), centre


def estimates(codes: np.ndarray, lengths, fits, centre, queries: np.ndarray, turn: np.ndarray, eps: float):
    """(estimated inner products, half width of their bounds), candidates x queries."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    scale = lengths / fits / np.sqrt(dim, dtype=np.float32)
    est = (signs @ (queries @ turn).T) * scale[:, None] + centre @ queries.T
    spread = lengths * np.sqrt(np.maximum(1 - fits * fits, 0)) / fits / np.sqrt(max(dim - 1, 1))
    return est, eps * spread[:, None] * np.linalg.norm(queries, axis=1)[None, :]


def search_block(ids, rids, vectors, codes, lengths, fits, centre, query_rids, queries, turn, k: int, eps: float):
    """For each query (candidate position, score) of its ``k`` best in the block."""
    exact = vectors.astype(np.float64)
    for low in range(0, len(queries), TILE):
        part = queries[low:low + TILE]
        est, half = estimates(codes, lengths, fits, centre, part, turn, eps)
        first = min(len(ids), 2 * k + 1)
        top = np.argpartition(-est, first - 1, axis=0)[:first]
        upper = est + half
        for j in range(len(part)):
            own = query_rids[low + j]
            q = part[j].astype(np.float64)
            best = top[:, j][rids[top[:, j]] != own]
            scores = exact[best] @ q
            reach = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else -np.inf
            found = np.flatnonzero(upper[:, j] >= reach - 1e-6 * (1 + abs(reach)) if np.isfinite(reach) else np.ones(len(ids), bool))
            found = np.union1d(found, best)
            found = found[rids[found] != own]
            scores = np.einsum("ij,j->i", exact[found], q)
            order = np.lexsort((ids[found], -scores))[:k]
            yield low + j, found[order], scores[order]


def nearest(table: DataFrame, every: int = 20, k: int = 20, eps: float = 1.9, seed: int = 7,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id ``every`` divides, its
    ``k`` nearest other rows by inner product."""
    v = F.col("v")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = (numbered(table).select("rid", F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False))))
    is_query = F.col("vec_id") % every == 0
    stats = (rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("queries"))
             .orderBy(F.desc("n"), F.desc("dim")).first())
    schema = "query_id long, rank int, vec_id long, score double"
    if stats is None or not stats["queries"]:
        return table.sparkSession.createDataFrame([], schema)
    dim = stats["dim"]
    query_blocks = -(-stats["queries"] // QUERY_BLOCK)
    rows = rows.filter(F.size("v") == dim)

    def unpack(batch):
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        return (batch.column("vec_id").to_numpy(), batch.column("rid").to_numpy(), flat.astype(np.float32).reshape(-1, dim))

    def index(batches):
        turn = rotation(dim, seed)
        kept: list = []

        def block():
            ids, rids, vectors = (np.concatenate(x) for x in zip(*kept))
            codes, lengths, fits, centre = encode_block(vectors, turn)
            values = [len(ids), *(np.ascontiguousarray(x).tobytes() for x in (ids, rids, vectors, codes, lengths, fits, centre))]
            return pa.RecordBatch.from_arrays([pa.array([x]) if k else pa.array([x], pa.int32()) for k, x in enumerate(values)],
                                              names=["n", "ids", "rids", "vectors", "codes", "lengths", "fits", "centre"])
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                kept.append(unpack(batch.slice(low, BLOCK)))
                if sum(len(x[0]) for x in kept) >= BLOCK:
                    yield block()
                    kept.clear()
        if kept:
            yield block()

    def gather(key, rows):
        ids, rids, vectors = (np.concatenate(x) for x in zip(*(unpack(b) for b in rows.to_batches() if b.num_rows)))
        return pa.table({"query_block": pa.array([key[0].as_py()], pa.int32()),
                         **{n: [np.ascontiguousarray(x).tobytes()] for n, x in (("q_ids", ids), ("q_rids", rids), ("q_vectors", vectors))}})

    def search(batches):
        turn = rotation(dim, seed)
        for batch in batches:
            for row in batch.to_pylist():
                ids, rids, q_ids, q_rids = (np.frombuffer(row[c], np.int64) for c in ("ids", "rids", "q_ids", "q_rids"))
                vectors, queries = (np.frombuffer(row[c], np.float32).reshape(-1, dim) for c in ("vectors", "q_vectors"))
                codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
                lengths, fits, centre = (np.frombuffer(row[c], np.float32) for c in ("lengths", "fits", "centre"))
                out = list(search_block(ids, rids, vectors, codes, lengths, fits, centre, q_rids, queries, turn, k, eps))
                if not out:
                    continue
                which = np.repeat([j for j, _, _ in out], [len(p) for _, p, _ in out])
                at = np.concatenate([p for _, p, _ in out])
                yield pa.RecordBatch.from_arrays([pa.array(q_rids[which]), pa.array(q_ids[which]), pa.array(ids[at]), pa.array(rids[at]),
                                                  pa.array(np.concatenate([s for _, _, s in out]))],
                                                 names=["q_rid", "query_id", "vec_id", "rid", "score"])

    blocks = rows.mapInArrow(index, _PACKED).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = (rows.filter(is_query).withColumn("query_block", F.pmod(F.xxhash64("rid"), F.lit(query_blocks)).cast("int"))
               .groupBy("query_block").applyInArrow(gather, "query_block int, q_ids binary, q_rids binary, q_vectors binary"))
    pairs = blocks.join(queries, "query_block").drop("query_block").repartition(table.sparkSession.sparkContext.defaultParallelism * 2)
    found = pairs.mapInArrow(search, "q_rid long, query_id long, vec_id long, rid long, score double")
    rank = F.row_number().over(Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "rid"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
