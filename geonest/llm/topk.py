"""Exact top-k search (3) with block-at-a-time pruning.

Rows are kept in blocks of near-by rows: a block has the rows themselves
(its forward index) and, for each term, the largest weight that any of them
has. A vector component gives two terms, its positive and its negative part,
so a query's weights are never negative and the sum of query weight times
term maximum bounds every score in the block. For each query the blocks are
ordered by that bound and scored until the next bound is below the k-th
score found so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geonest.llm.common import pick, write_table

K = 5
#: Rows of a block.
BLOCK = 64
#: Queries that are searched for at once; what a task and the driver hold of them is bounded by this.
QUERIES = 2048
#: Blocks that a task holds at once.
HELD = 512
#: Blocks scored between two looks at the bounds.
STEP = 4
#: Components whose signs place a row near others.
SIGNS = 12
#: Rows a partition of the index is meant to hold.
PARTITION_ROWS = 1 << 17


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``v`` (floor(scale * x) per component, x as double) of the
    rows of ``vectors`` (``vec_id``, ``embedding``) without a null id, null
    vector, or null or non-finite component. Of rows that repeat an id, the
    smallest vector stands for it."""
    x = F.col("embedding").cast("array<double>")
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))
    return vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), vectors["embedding"]).where(ok).groupBy("vec_id").agg(F.min(v).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    rows = [np.asarray(v.values) if v.is_valid else np.zeros(0, np.int64) for v in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        whole, ids = _matrix(b.column(1)), b.column(0).to_numpy()
        out = [[], [], [], []]
        for at in range(0, len(ids), BLOCK):
            m = whole[at:at + BLOCK]
            out[0].append(ids[at:at + BLOCK].astype("<i8").tobytes())
            out[1].append(m.astype("<i8").tobytes())
            out[2].append(np.maximum(np.concatenate([m.max(0), (-m).max(0)]), 0).astype("<i8").tobytes())
            out[3].append(m.shape[1])
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.binary()) for c in out[:3]), pa.array(out[3], pa.int32())], ["ids", "rows", "maxima", "dim"]
        )


def block_index(vectors: DataFrame) -> DataFrame:
    """Written blocks of ``vectors`` (``vec_id``, ``v``): rows are put in ranges of
    the signs of their first components, then of their ids, and cut."""
    signs = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.lit(SIGNS)), lambda i: F.when(F.get("v", i - 1) >= 0, 1).otherwise(0)),
        F.lit(0), lambda acc, s: acc * 2 + s,
    )
    n = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-vectors.count() // PARTITION_ROWS))
    placed = vectors.withColumn("near", signs).repartitionByRange(n, "near", "vec_id").sortWithinPartitions("near", "vec_id")
    return write_table(placed.select("vec_id", "v").mapInArrow(_blocks, "ids binary, rows binary, maxima binary, dim int"), "block-index")


class Search:
    """The best scores so far of a set of queries."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.ids = np.zeros((len(query_ids), 0), np.int64)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
        self.scored = 0

    def add(self, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """``blocks``: (ids, rows, maxima) each."""
        dim = max(self.queries.shape[1], *(b[1].shape[1] for b in blocks))
        wide = lambda m, n: np.pad(m, ((0, 0), (0, n - m.shape[1])))
        q = wide(self.queries, dim)
        rows = [wide(b[1], dim) for b in blocks]
        maxima = np.stack([np.concatenate([np.pad(b[2][:b[1].shape[1]], (0, dim - b[1].shape[1])), np.pad(b[2][b[1].shape[1]:], (0, dim - b[1].shape[1]))]) for b in blocks])
        top = max((int(np.abs(r).max(initial=0)) for r in rows), default=0) * int(np.abs(q).max(initial=0)) * max(dim, 1)
        kind = np.float64 if top < 1 << 52 else np.int64  # doubles are exact below
        rows, weights = [r.astype(kind) for r in rows], np.concatenate([np.maximum(q, 0), np.maximum(-q, 0)], axis=1).astype(kind)
        bounds, q = weights @ maxima.T.astype(kind), q.astype(kind)
        order = np.argsort(-bounds, axis=1, kind="stable")
        for i, own in enumerate(self.query_ids):
            ids, scores = self.best[i]
            for at in range(0, len(blocks), STEP):
                if len(scores) == self.k and bounds[i, order[i, at]] < scores[-1]:
                    break
                now = [j for j in order[i, at:at + STEP] if len(scores) < self.k or bounds[i, j] >= scores[-1]]
                self.scored += len(now)
                new_ids = np.concatenate([blocks[j][0] for j in now])
                new = np.concatenate([rows[j] @ q[i] for j in now]).astype(np.int64)
                use = new_ids != own
                if len(scores) == self.k:
                    use &= new >= scores[-1]
                if use.any():
                    ids, scores = np.concatenate([ids, new_ids[use]]), np.concatenate([scores, new[use]])
                    first = np.lexsort((ids, -scores))[: self.k]
                    ids, scores = ids[first], scores[first]
            self.best[i] = ids, scores


def _search(query_ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, held = Search(query_ids, queries, k), []
        for b in batches:
            for ids, rows, maxima, dim in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                held.append((np.frombuffer(ids, "<i8"), np.frombuffer(rows, "<i8").reshape(-1, dim), np.frombuffer(maxima, "<i8")))
                if len(held) == HELD:
                    search.add(held)
                    held = []
        if held:
            search.add(held)
        n = [len(s) for _, s in search.best]
        if sum(n):
            ids, scores = (np.concatenate(x) for x in zip(*search.best, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, n)), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k``
    rows of ``vectors`` (``vec_id``, ``v`` of whole numbers, one row an id)
    with the highest inner product, its own id left out; ties go to the
    smaller vec_id.

    Defined cases: fewer rows give fewer results; a shorter vector has zeros
    for its missing components; equal vectors are ranked by id; empty tables
    give no rows.

    Queries are taken in sets of about ``QUERIES`` by a hash of the id. A set
    goes to every task of a pass over the index, which hands back at most
    ``k`` rows a query."""
    index = block_index(vectors)
    queries = write_table(queries.select("vec_id", "v"), "queries")
    n_sets = max(1, -(-queries.count() // QUERIES))
    found = None
    for at in range(n_sets):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_sets)) == at).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        ids, matrix = rows.column("vec_id").to_numpy(), _matrix(rows.column("v").combine_chunks())
        part = index.mapInArrow(_search(ids, matrix, k), "query_id bigint, vec_id bigint, score bigint")
        found = part if found is None else found.union(part)
    if found is None:
        found = queries.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("bigint").alias("score")).limit(0)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def search_embeddings(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """Top ``k`` of the rows whose vec_id is divisible by ``every`` among all rows of ``vectors`` (``vec_id``, ``embedding``)."""
    whole = write_table(integer_vectors(pick(vectors, vec_id="vec_id:bigint", embedding="embedding:array<double>")), "vectors")
    return top_k(whole, whole.where(F.col("vec_id") % every == 0), k)
