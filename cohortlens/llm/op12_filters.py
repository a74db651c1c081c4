"""Filter interaction audit over failing-id relations.

One table of ids per filter is stored: the rows that fail it (the whole texts are
read once for that).  A prefix of an order is a set of filters that have already
run.  A left-anti join of a filter's table with the tables of the prefix gives the
rows it removes there, a left-semi join the rows it would have removed (redundant);
labels are joined in the same way, by left-semi joins with the ids of label 1.  What a
prefix keeps is the part less what its steps remove.  All prefixes meet in the two
joins: a failing row is offered to each set without its filter, and tables are told
apart by a bit in the join condition, so the work is one shuffle of ids.

Rows are told apart by a number of their own, so repeated and absent ids are rows like
others.  A null text is empty, a null ``lang`` the empty string; copies (E) are
compared by SHA-256, a row without an id is no copy and makes none; equal rows of one id
are no copies of each other.  Very long texts are one value of a row.  A digest that
many rows share is joined by a broadcast, limited to ``HOT_KEYS`` digests, all others
by a shuffle.  An empty table gives no part, a table without failing rows zeros.  Other
columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.base import Scratch, table
from cohortlens.llm.registry import query

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
#: A digest is hot with this share of all rows, so there are at most as many hot digests.
HOT_KEYS = 2000
COUNTS = ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column) -> dict[str, Column]:
    """Failure conditions of one text alone, by filter."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 100,
        "B": 100 * distinct < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def _set_bits(names: str) -> int:
    return sum(_bit(x) for x in names)


def _copies(read: DataFrame) -> DataFrame:
    """row of each row whose text a smaller doc_id has."""
    with_id = read.where("doc_id is not null")
    texts = with_id.groupBy("print").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).where("low < high")
    hot_from = read.count() / HOT_KEYS
    hot, cold = texts.where(F.col("n") >= hot_from).select("print", "low"), texts.where(F.col("n") < hot_from).select("print", "low")
    rows = with_id.select("row", "doc_id", "print").join(F.broadcast(hot.withColumn("hot", F.lit(True))), "print", "left")
    found = rows.where("hot").where("doc_id > low").select("row")
    return found.unionByName(rows.where("hot is null").drop("low").join(cold, "print").where("doc_id > low").select("row"))


def failing_ids(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stored tables (row, part, good, toxic) of the rows that fail each filter, and the rows of each part."""
    text = F.coalesce(F.col("text"), F.lit(""))
    alone = failures(F.col("text"))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("print"), *[c.alias(name) for name, c in alone.items()])
    read = scratch.store(read.withColumn("row", F.monotonically_increasing_id()))
    # Labels by id: the good and the toxic ids, whatever else the labels say of them.
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = marked.select("doc_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")]).where("good = 1 or toxic = 1")
    copies = scratch.store(_copies(read))
    fails = {"E": read.select("row", "doc_id", "part").join(copies, "row", "left_semi")}
    fails |= {name: read.where(name).select("row", "doc_id", "part") for name in alone}
    stored = {}
    for name in FILTERS:
        rows = fails[name].join(marked, "doc_id", "left")
        stored[name] = scratch.store(rows.select("row", "part", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")]))
    return stored, scratch.store(read.groupBy("part").agg(F.count("*").alias("total")))


def prefix_counts(failing: dict[str, DataFrame]) -> DataFrame:
    """part, before (bits of the filters that have run), bit, removed, redundant, good_lost, toxic_lost."""
    parts = [rows.withColumn("bit", F.lit(_bit(name))) for name, rows in failing.items()]
    every = parts[0]
    for rows in parts[1:]:
        every = every.unionByName(rows)
    sets = range(1 << len(FILTERS))
    offered = every.withColumn("before", F.explode(F.filter(F.array(*map(F.lit, sets)), lambda s: s.bitwiseAND(F.col("bit")) == 0)))
    earlier = every.select(F.col("row").alias("other"), F.col("bit").alias("other_bit"))
    ran_before = (F.col("row") == F.col("other")) & (F.col("before").bitwiseAND(F.col("other_bit")) != 0)
    removed = offered.join(earlier, ran_before, "left_anti").groupBy("part", "before", "bit").agg(
        F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
    redundant = offered.join(earlier, ran_before, "left_semi").groupBy("part", "before", "bit").agg(F.count("*").alias("redundant"))
    keys = ["part", "before", "bit"]
    return removed.join(redundant, keys, "full").select(*keys, *[
        F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")])


def _steps(parts: DataFrame) -> DataFrame:
    """part, total, filter_order, step, before, bit: every step of every order for each part."""
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(FILTERS))), ",")
    bit = lambda name: F.pow(F.lit(2), F.position(name, F.lit(FILTERS)) - 1).cast("int")
    letters = [F.substring("filter_order", k + 1, 1) for k in range(len(FILTERS))]
    steps, before = [], F.lit(0)
    for k, name in enumerate(letters):
        steps.append(F.struct(F.lit(k + 1).alias("step"), before.alias("before"), bit(name).alias("bit")))
        before = before + bit(name)
    return parts.withColumn("filter_order", F.explode(orders)).withColumn("at", F.explode(F.array(*steps))).select(
        "part", "total", "filter_order", "at.*")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "filters")
    failing, parts = failing_ids(docs, labels, scratch)
    counts = scratch.store(prefix_counts(failing))
    everything = _set_bits(FILTERS)
    last = counts.where(F.col("before") + F.col("bit") == everything).select("part", "bit", F.col("removed").alias("unique_fails"))
    # Of all orders, |before|! * (4 - |before|)! have exactly these filters before this one.
    k, n = F.bit_count("before"), len(FILTERS)
    orders = F.element_at(F.array(*[F.lit(factorial(i) * factorial(n - 1 - i)) for i in range(n)]), k + 1)
    shapley = counts.groupBy("part", "bit").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    rows = _steps(parts)
    rows = rows.join(counts, ["part", "before", "bit"], "left").join(last, ["part", "bit"], "left").join(shapley, ["part", "bit"], "left")
    rows = rows.fillna(0, [*COUNTS, "shapley"])
    gone = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    result = scratch.store(rows.withColumn("kept", F.col("total") - gone).select("part", "filter_order", "step", "kept", *COUNTS, "shapley"))
    scratch.drop()
    return result


_LETTERS = ", ".join(f"('{f}', {_bit(f)})" for f in FILTERS)
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
 w AS (SELECT row, doc_id, part, text, regexp_extract_all(text, '{WORD}') AS ws, min(doc_id) OVER (PARTITION BY text) AS low FROM d),
 l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
 f AS (SELECT row, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
   CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
   + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
   + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
   + CASE WHEN w.doc_id > low THEN 16 ELSE 0 END AS fails FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
 c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
 t AS (SELECT part, sum(n) AS total FROM c GROUP BY 1),
 letters(name, bit) AS (VALUES {_LETTERS}),
 orders AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
   FROM letters a, letters b, letters c, letters d, letters e
   WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
 steps AS (SELECT filter_order, CAST(s AS INT) AS step, bits[s] AS bit, coalesce(list_sum(bits[:s - 1]), 0) AS before FROM orders, range(1, 6) r(s)),
 found AS (SELECT s.filter_order, s.step, s.bit, t.part, t.total,
   coalesce(sum(CASE WHEN fails & CAST(before + bit AS INT) = 0 THEN n END), 0) AS kept,
   coalesce(sum(CASE WHEN fails & bit <> 0 AND fails & CAST(before AS INT) = 0 THEN n END), 0) AS removed,
   coalesce(sum(CASE WHEN fails & bit <> 0 AND fails & CAST(before AS INT) <> 0 THEN n END), 0) AS redundant,
   coalesce(sum(CASE WHEN fails = bit THEN n END), 0) AS unique_fails,
   coalesce(sum(CASE WHEN fails & bit <> 0 AND fails & CAST(before AS INT) = 0 THEN good END), 0) AS good_lost,
   coalesce(sum(CASE WHEN fails & bit <> 0 AND fails & CAST(before AS INT) = 0 THEN toxic END), 0) AS toxic_lost
   FROM steps s, t JOIN c ON c.part = t.part GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
 CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM found
"""


@query("op12_filter_audit", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
