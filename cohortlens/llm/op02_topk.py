"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are quantised to integers and split into ``SLICES`` column slices; the
score of a pair is the sum of its slices' partial scores.  Rows are packed into
blocks, queries into blocks of their own, and every pair of blocks is one unit of
work.  Blocks are bounded in rows and in components, and a task scores a few
queries of a unit at a time, so its memory depends neither on the table nor on the
width of the vectors.

1. Each block lists, for every query and slice, the rows with the best partial
   scores, with their whole scores.  The k-th best of all listed scores is a safe
   cutoff of the query: the true k-th best is no lower.
2. The cutoffs go back to the blocks (one number per query, joined by query block).
   A row whose whole score reaches the cutoff has a slice that reaches
   cutoff / SLICES; all rows with such a slice are collected.
3. Their remaining partial scores are resolved exactly.  A block returns at most k
   rows per query, and the best k of all blocks are ranked.

Work grows with queries times rows, as the whole search does; the data sent per
query do not depend on the vectors beyond 2k per block.  Blocks meet in shuffles
alone: a broadcast would pass every copy of the query blocks through the driver.
What they send is rows times query blocks plus queries times row blocks.

Vectors that are null or hold a null or non-finite component take no part.
Repeated ids count once, with their smallest vector; ties go to the smaller
vec_id; shorter vectors read as padded with zeros.  Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.base import Scratch, table
from cohortlens.llm.registry import query

SCALE = 64
EVERY = 20
SLICES = 2
ROWS_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 16384
#: Components that a block holds at most, whatever the width of its vectors.
COMPONENTS_PER_BLOCK = 1 << 20
#: A small table is cut into smaller blocks, so that all cores have work.
LEAST_ROWS_PER_BLOCK = 1024
#: Scores that a task holds at once.
SCORES_PER_STEP = 1 << 20
#: The cutoff of a query that has none: every score reaches it.
LOWEST = np.iinfo(np.int64).min


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, v: integer components; only whole finite vectors."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    plain = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(plain).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(values, lambda x: F.floor(x * SCALE).cast("long")).alias("v")
    ).groupBy("vec_id").agg(F.min("v").alias("v"))


def _packed(rows: pa.Table) -> pa.Table:
    vectors = rows.column("v").combine_chunks()
    ids = rows.column("vec_id").to_numpy()
    sizes = np.diff(np.asarray(vectors.offsets))
    matrix = np.zeros((len(ids), max(int(sizes.max(initial=0)), 1)), np.int64)
    flat = vectors.flatten().to_numpy()
    matrix[np.repeat(np.arange(len(ids)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    top = int(np.abs(matrix).max(initial=0))
    kind = "<i1" if 0 <= top < 2**7 else "<i2" if 0 <= top < 2**15 else "<i4" if 0 <= top < 2**31 else "<i8"
    return pa.table({"block": pa.array([rows.column("block")[0].as_py()], pa.int32()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                     "width": pa.array([matrix.shape[1]], pa.int32()), "kind": pa.array([kind]),
                     "matrix": pa.array([matrix.astype(kind).tobytes()], pa.binary())})


def _blocks(vectors: DataFrame, n: int) -> DataFrame:
    return vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).groupBy("block").applyInArrow(
        _packed, "block int, ids binary, width int, kind string, matrix binary")


def _top(matrix: np.ndarray) -> int:
    return max(abs(int(matrix.min())), abs(int(matrix.max())))


def _steps(row: dict) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Each slice's scores of some queries with all rows of a pair of blocks, for some queries after the other."""
    q = np.frombuffer(row["q_matrix"], row["q_kind"]).reshape(-1, row["q_width"])
    r = np.frombuffer(row["matrix"], row["kind"]).reshape(-1, row["width"])
    width = min(row["q_width"], row["width"])
    bound = _top(q) * _top(r) * width
    # Floats are exact below 2**24, doubles below 2**53; beyond, 64-bit integers are used.
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**52 else np.int64
    edges = np.linspace(0, width, SLICES + 1).astype(int)
    cuts = list(zip(edges[:-1], edges[1:], strict=True))
    sides = [np.ascontiguousarray(r[:, a:b].T, kind) for a, b in cuts]
    step = max(1, SCORES_PER_STEP // len(r))
    for at in range(0, len(q), step):
        some = slice(at, at + step)
        yield some, [q[some, a:b].astype(kind) @ side for (a, b), side in zip(cuts, sides, strict=True)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _listed(k: int, share: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            q_ids, r_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
            take = min(share, len(r_ids))
            found_q, found_s = [], []
            for some, parts in _steps(row):
                # A row may be listed by several slices: count it once.
                picked = np.zeros(parts[0].shape, bool)
                for part in parts:
                    best = np.argpartition(-part, take - 1, axis=1)[:, :take]
                    np.put_along_axis(picked, best, True, axis=1)
                at, to = np.nonzero(picked)
                other = q_ids[some][at] != r_ids[to]
                at, to = at[other], to[other]
                found_q.append(q_ids[some][at])
                found_s.append(sum(p[at, to] for p in parts).astype(np.int64))
            yield pa.record_batch({"query_id": pa.array(np.concatenate(found_q)), "score": pa.array(np.concatenate(found_s))})

    return job


def _resolved(k: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            q_ids, r_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
            known = dict(zip(row["cut_ids"] or [], row["cuts"] or [], strict=True))
            cuts = np.array([known.get(i, LOWEST) for i in q_ids.tolist()], np.int64)
            found_q, found_r, found_s = [], [], []
            for some, parts in _steps(row):
                ids, cut = q_ids[some], cuts[some]
                # Whole numbers: a slice reaches cutoff / SLICES if it reaches that number rounded up. A cutoff too large
                # to be exact in the scores' type is beyond all scores of these blocks before and after rounding.
                need = (cut // SLICES + (cut % SLICES > 0)).astype(parts[0].dtype)[:, None]
                at, to = np.nonzero(np.logical_or.reduce([p >= need for p in parts]))
                score = sum(p[at, to] for p in parts).astype(np.int64)
                kept = (score >= cut[at]) & (ids[at] != r_ids[to])
                at, near, score = at[kept], r_ids[to[kept]], score[kept]
                order = np.lexsort((near, -score, at))
                at, near, score = at[order], near[order], score[order]
                best = np.arange(len(at)) - np.searchsorted(at, at) < k
                found_q.append(ids[at[best]])
                found_r.append(near[best])
                found_s.append(score[best])
            yield pa.record_batch({"query_id": pa.array(np.concatenate(found_q)), "vec_id": pa.array(np.concatenate(found_r)),
                                   "score": pa.array(np.concatenate(found_s))})

    return job


def _pairs(rows: DataFrame, queries: DataFrame, n_rows: int, n_q: int) -> DataFrame:
    """Every row block with every query block, once; both sides are shuffled, none is broadcast."""
    spark = rows.sparkSession
    tasks = min(2 * n_rows * n_q, max(16 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    left = rows.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    return left.repartition(tasks, "block", "q_block").join(right.repartition(tasks, "block", "q_block").hint("merge"), ["block", "q_block"])


def top_k(embeddings: DataFrame, k: int = 20, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for every query."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "topk")
    vectors = scratch.store(quantised(embeddings))
    n, n_queries, width = vectors.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.max(F.size("v"))).first()
    most = max(1, COMPONENTS_PER_BLOCK // max(1, width or 1))
    n_q = max(1, -(-n_queries // min(QUERIES_PER_BLOCK, most)))
    spread = min(-(-n // LEAST_ROWS_PER_BLOCK), -(-4 * spark.sparkContext.defaultParallelism // n_q))
    n_rows = max(1, -(-n // min(ROWS_PER_BLOCK, most)), spread)
    rows = scratch.store(_blocks(vectors, n_rows))
    queries = scratch.store(_blocks(vectors.where(F.col("vec_id") % every == 0), n_q).select(
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("kind").alias("q_kind"), F.col("matrix").alias("q_matrix")))
    scratch.discard(vectors)
    share = min(k, max(1, -(-2 * k // n_rows)))
    listed = _pairs(rows, queries, n_rows, n_q).mapInArrow(_listed(k, share), "query_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    cutoffs = listed.withColumn("i", F.row_number().over(best)).where(F.col("i") == k).select(
        F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int").alias("q_block"), "query_id", "score"
    ).groupBy("q_block").agg(F.collect_list(F.struct("query_id", "score")).alias("c")).select(
        "q_block", F.col("c.query_id").alias("cut_ids"), F.col("c.score").alias("cuts"))
    known = scratch.store(queries.join(cutoffs.hint("merge"), "q_block", "left"))
    scratch.discard(queries)
    scratch.free()
    found = _pairs(rows, known, n_rows, n_q).mapInArrow(_resolved(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM embeddings
   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY 1),
 s AS (SELECT q.vec_id AS query_id, r.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
   FROM v q JOIN v r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id),
 o AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 20
"""


@query("op2_exact_top_k", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
