"""Exact top-k inner products by a three-phase uniform threshold over local score lists.

The stated queries meet all vectors in blocks: a block of queries and a block of vectors make one
task's work, a dense product in numpy.  A vector's components are cut into ``LISTS`` segments; each
segment gives a query a list of partial scores, whose sum is the score.

1. Gather: in every block and list, a query's k best partial scores.  These vectors' whole scores are
   worked out, and the k-th best of all a query gets so, from any block, is its cutoff t: k vectors
   are known to reach it.
2. Each block gets its queries' cutoffs and collects every vector with some partial score of at least
   t / LISTS.  A vector that has none scores below t (also with negative partial scores) and can't be
   among the k best.
3. Of the collected ones, the whole scores are worked out; those below t go, and of the rest each block
   passes on a query's k best, so that thousands of equal vectors don't pile up.  A last ranking joins
   the blocks.

Blocks are dealt by a hash of the row's number, so a common vector or id is spread evenly; the queries
are copied to each block of vectors (``BLOCK`` rows), which moves queries * vectors / BLOCK rows.  Tasks
hold one block pair at a time.

Scores are exact: float64 products while every sum stays below 2**53, else Python's integers; a score
beyond 64 bits is held at the limit.  Defined cases: null vectors, or those with null or non-finite
components, and rows without vec_id take no part; vectors of unlike lengths are compared as if the
shorter ended in zeros; repeated ids are rows of their own, each a candidate of the other, and each
query row gets its ranking; ties go to the smaller vec_id; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import columns_of, written
from .sorted_groups import grouped

SCALE = 64
LISTS = 2
#: Vectors of a block; queries of a block.
BLOCK = 4096
QUERIES = 512


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v): the vectors that take part, each component x as floor(scale * x)."""
    e = columns_of(embeddings, "vec_id", "embedding")
    x = F.transform("embedding", lambda a: a.cast("double"))
    ok = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    e = e.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(ok)
    v = F.transform(x, lambda a: F.floor(a * F.lit(scale).cast("double")).cast("double"))
    return e.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as float64, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    n = np.diff(offsets)
    flat = np.asarray(column.values, dtype=np.float64)
    out = np.zeros((len(n), width))
    out[np.repeat(np.arange(len(n)), n), np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], n)] = flat[offsets[0] : offsets[-1]]
    return out


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products as exact integers."""
    top = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1])
    if top < 2.0**53:
        return (q @ c.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    return whole(q) @ whole(c).T


def lists_of(q: np.ndarray, c: np.ndarray, lists: int) -> list[np.ndarray]:
    cuts = [q.shape[1] * i // lists for i in range(lists + 1)]
    return [products(q[:, a:z], c[:, a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def held(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers, held at the limits."""
    if scores.dtype == object:
        scores = np.array([min(max(x, -(2**63)), 2**63 - 1) for x in scores.ravel()], dtype=np.int64).reshape(scores.shape)
    return scores


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: int = SCALE, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, its ``k``
    highest scores among all other rows."""
    vectors = written(quantised(embeddings, scale))
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width, blocks = size.width or 0, max(1, -(-size.n // BLOCK))
    mix = F.xxhash64("row")
    candidates = vectors.select(
        F.pmod(mix, F.lit(blocks)).cast("int").alias("block"), F.lit(-1).alias("part"), "row", "vec_id", "v", F.lit(None).cast("long").alias("cutoff")
    )
    n_queries = vectors.where(F.col("vec_id") % every == 0).count()
    parts = max(1, -(-n_queries // QUERIES))
    queries = vectors.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(mix, F.lit(parts)).cast("int").alias("part"), "row", "vec_id", "v"
    )

    def met(asked: DataFrame, second: bool) -> DataFrame:
        """Each block of vectors, sorted before the parts of queries that meet it."""

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, c = None, None
            for key, t in grouped(batches, ["block", "part"]):
                v, rows, ids = matrix(t["v"], width), t["row"].to_numpy(), t["vec_id"].to_numpy()
                if key[1] == -1:
                    here, c = key[0], (v, rows, ids, np.argsort(ids, kind="stable"))
                    continue
                if c is None or here != key[0]:
                    continue
                cut = t["cutoff"].to_numpy() if second else None
                yield from block(v, rows, ids, cut, *c)

        def block(q, q_rows, q_ids, cut, c, c_rows, c_ids, by_id) -> Iterator[pa.RecordBatch]:
            c, c_rows, c_ids = c[by_id], c_rows[by_id], c_ids[by_id]  # by id: a stable sort gives ties to the smaller
            own = q_rows[:, None] == c_rows[None, :]
            partial = lists_of(q, c, lists)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            if not second:
                take = min(k + 1, len(c))  # one more, as the query's own row may be among them
                near = np.concatenate([np.argpartition(-p, take - 1, axis=1)[:, :take] if p.dtype != object else np.argsort(-p, axis=1, kind="stable")[:, :take] for p in partial], axis=1)
                hit = np.zeros(own.shape, dtype=bool)
                np.put_along_axis(hit, near, True, axis=1)
            else:
                least = cut.astype(object) if partial and partial[0].dtype == object else cut
                hit = np.zeros(own.shape, dtype=bool)
                for p in partial:
                    hit |= p >= (least // lists + (least % lists > 0))[:, None]  # p * lists >= t without its overflow
            hit &= ~own
            for i in range(len(q)):
                j = np.flatnonzero(hit[i])
                s = held(sum(p[i, j] for p in partial)) if len(j) else np.empty(0, dtype=np.int64)
                if second:
                    j, s = j[s >= cut[i]], s[s >= cut[i]]
                best = np.argsort(-s, kind="stable")[:k] if not len(s) or s.min() > -(2**63) else np.array(sorted(range(len(s)), key=lambda x: (-int(s[x]), x))[:k])
                found.append((j[best], s[best]))
            n = [len(j) for j, _ in found]
            at = np.concatenate([j for j, _ in found]) if found else np.empty(0, dtype=int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q_rows, n)), pa.array(np.repeat(q_ids, n)), pa.array(c_ids[at]), pa.array(np.concatenate([s for _, s in found]) if found else np.empty(0, dtype=np.int64), type=pa.int64())],
                names=["row", "query_id", "vec_id", "score"],
            )

        both = candidates.unionByName(asked.withColumn("cutoff", F.col("cutoff") if second else F.lit(None).cast("long")))
        dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "part")
        return dealt.mapInArrow(solve, "row long, query_id long, vec_id long, score long")

    by_query = W.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    first = met(queries, second=False)
    # fewer than k in all blocks: every score counts
    cutoffs = ranked(first).groupBy("row").agg(F.when(F.count("*") == k, F.min("score")).alias("cutoff"))
    lowest = F.lit(-(2**63)).cast("long")
    asked = queries.join(cutoffs, "row", "left").withColumn("cutoff", F.coalesce("cutoff", lowest))
    return ranked(met(written(asked), second=True)).select("query_id", "rank", "vec_id", "score")
