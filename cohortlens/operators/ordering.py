"""Order-dependent operators that never put a whole group into one task.

A window partitioned only by a group key sends the group to a single task, so
one hot key (or a global ranking) would not scale.  The operators here cut each
group into chunks first.  Work inside a chunk uses an ordinary window; what
crosses chunk borders travels in a small table with one row per chunk.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialise

# 64 steps per power of two; the shift keeps codes of positive values positive
# over the whole exponent range of a double; infinities lie beyond all of them.
_STEPS_PER_OCTAVE = 64
_CODE_SHIFT = 80_000
_CODE_INFINITE = 1_000_000

UNBOUNDED = Window.unboundedPreceding


def _window(partition: Sequence[str], order: Sequence[Column]) -> Window:
    return Window.partitionBy(*([F.col(c) for c in partition] or [F.lit(0)])).orderBy(*order)


def _asc(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc() for c in columns]


def _attach(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(side, keys, "left")


def keep_last(df: DataFrame, keys: list[str], position: str | Column, first: bool = False) -> DataFrame:
    """One row per key: the one at the highest (or lowest) position.

    An aggregate with map-side combine, so a hot key is reduced before the shuffle.
    """
    pick = F.min_by if first else F.max_by
    where = F.col(position) if isinstance(position, str) else position
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(pick(row, where).alias("_ord_row")).select("_ord_row.*")


def keep_first(df: DataFrame, keys: list[str], position: str | Column) -> DataFrame:
    return keep_last(df, keys, position, first=True)


def quantile_chunks(df: DataFrame, column: str, rows_per_chunk: int = 100_000, out: str = "chunk") -> DataFrame:
    """Adds the number of a chunk of consecutive values of ``column``, about ``rows_per_chunk`` rows each.

    The edges come from a quantile summary of the data, so the number of chunks grows
    with the rows; equal values share a chunk.  Nulls are the first chunk's.
    """
    parts = -(-df.count() // rows_per_chunk)
    edges = sorted(set(df.approxQuantile(column, [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    if not edges:
        return df.withColumn(out, F.lit(0))
    known = F.from_json(F.lit(json.dumps(edges)), "array<double>")
    return df.withColumn(out, F.coalesce(F.size(F.filter(known, lambda e: e < F.col(column))), F.lit(0)))


def running_total(df: DataFrame, by: list[str], chunk: str, position: list[str], value: Column, out: str) -> DataFrame:
    """Running sum of ``value`` in (chunk, position) order within ``by``."""
    cells = df.withColumn("_ord_v", value)
    totals = cells.groupBy(*by, chunk).agg(F.sum("_ord_v").alias("_ord_t"))
    before = F.sum("_ord_t").over(_window(by, _asc([chunk])).rowsBetween(UNBOUNDED, -1))
    offsets = totals.select(*by, chunk, F.coalesce(before, F.lit(0)).alias("_ord_before"))
    inside = F.sum("_ord_v").over(_window([*by, chunk], _asc(position)).rowsBetween(UNBOUNDED, 0))
    return (
        _attach(cells.withColumn("_ord_in", inside), offsets, [*by, chunk])
        .withColumn(out, F.col("_ord_before") + F.col("_ord_in"))
        .drop("_ord_v", "_ord_in", "_ord_before")
    )


def carry_last(df: DataFrame, by: list[str], chunk: str, position: list[str], value: Column, out: str) -> DataFrame:
    """Last non-null ``value`` at or before each row, in (chunk, position) order."""
    cells = df.withColumn("_ord_v", value)
    place = F.struct(*[F.col(c) for c in position])
    ends = cells.where(F.col("_ord_v").isNotNull()).groupBy(*by, chunk).agg(F.max_by("_ord_v", place).alias("_ord_end"))
    every = cells.select(*by, chunk).distinct()
    prior = F.last("_ord_end", ignorenulls=True).over(_window(by, _asc([chunk])).rowsBetween(UNBOUNDED, -1))
    offsets = _attach(every, ends, [*by, chunk]).select(*by, chunk, prior.alias("_ord_before"))
    inside = F.last("_ord_v", ignorenulls=True).over(_window([*by, chunk], _asc(position)).rowsBetween(UNBOUNDED, 0))
    return (
        _attach(cells.withColumn("_ord_in", inside), offsets, [*by, chunk])
        .withColumn(out, F.coalesce("_ord_in", "_ord_before"))
        .drop("_ord_v", "_ord_in", "_ord_before")
    )


def previous(df: DataFrame, by: list[str], chunk: str, position: list[str], value: str, out: str) -> DataFrame:
    """Value of the preceding row in (chunk, position) order; null on the first row."""
    place = F.struct(*[F.col(c) for c in position])
    ends = df.groupBy(*by, chunk).agg(F.max_by(value, place).alias("_ord_end"))
    offsets = ends.select(*by, chunk, F.lag("_ord_end").over(_window(by, _asc([chunk]))).alias("_ord_before"))
    inner = _window([*by, chunk], _asc(position))
    cells = df.withColumn("_ord_in", F.lag(value).over(inner)).withColumn("_ord_rn", F.row_number().over(inner))
    return (
        _attach(cells, offsets, [*by, chunk])
        .withColumn(out, F.when(F.col("_ord_rn") == 1, F.col("_ord_before")).otherwise(F.col("_ord_in")))
        .drop("_ord_in", "_ord_rn", "_ord_before")
    )


def value_code(x: Column) -> Column:
    """Monotone integer code of a double: sign, octave and 1/64 octave."""
    size = F.abs(x)
    finite = F.when(size < F.lit(float("inf")), size)
    step = F.coalesce(
        F.floor(F.log2(finite) * F.lit(_STEPS_PER_OCTAVE)) + F.lit(_CODE_SHIFT), F.lit(_CODE_INFINITE)
    )
    return F.when(x > 0, step).when(x < 0, -step).otherwise(F.lit(0)).cast("long")


def value_bits(x: Column) -> Column:
    """The bits of a double as an order-preserving long (negative values below zero).

    Powers of two and scaling by them are exact, so the code differs for any two
    different values, up to the smallest and largest ones.
    """
    size = F.abs(x)
    two = lambda e: F.pow(F.lit(2.0), e)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    exponent = guess - (size < two(guess)).cast("long") + (size >= two(guess + 1)).cast("long")
    normal = (exponent + 1023) * F.lit(1 << 52) + ((size / two(exponent) - 1) * F.lit(2.0**52)).cast("long")
    bits = (
        F.when(size == F.lit(float("inf")), F.lit(2047 << 52))
        .when(size < F.lit(2.0**-1022), (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .otherwise(normal)
    )
    return F.when(x < 0, -bits).otherwise(bits)


#: A rung is the values whose bits agree down to one of these places: sign, octave and 1/64 octave first,
#: then ten more bits at a time where it is crowded; below the last place there are 65,536 values at most.
_PLACES = (46, 36, 26, 16)


def _down_to(bits: Column, place: int) -> Column:
    return F.shiftleft(F.shiftright(bits, place), place)


def distinct_ladder(df: DataFrame, value: str, by: list[str] | None = None, rows_per_rung: int = 250_000,
                    weight: str | None = None) -> DataFrame:
    """Distinct values of each group with the number of rows before them.

    Output: ``by``, ``value``, ``n`` (rows holding the value, or their ``weight``),
    ``below`` (rows with a smaller value), ``total`` (rows in the group) and ``_rung``,
    the lowest bits of the rung that the value lies in.  Nulls and NaN are left out.

    Ties are counted before the shuffle, so a hot value costs one row per map
    task (this job runs at once).  Distinct values are counted by the leading bits, and a crowded rung is split
    by further bits, again and again until it is small: values may lie as close together
    as they like, and no task orders more than the larger of ``rows_per_rung`` and 65,536
    values of a group.  Crowded rungs are few (one for each ``rows_per_rung`` values at
    most), which bounds their broadcast.  Every step is a deterministic function of the
    data, so a recomputed task agrees with the rest.
    """
    by = by or []
    keyed = df.select(*by, F.col(value).cast("double").alias(value), *([weight] if weight else []))
    keyed = keyed.where(F.col(value).isNotNull() & ~F.isnan(value))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    # Stored once: every step below reads the counts, not what they come from.
    counts = materialise(keyed.groupBy(*by, value).agg(n.alias("n")).withColumn("_bits", value_bits(F.col(value))))
    rungs = counts.withColumn("_rung", _down_to(F.col("_bits"), _PLACES[0]))
    for finer in _PLACES[1:]:
        crowded = rungs.groupBy(*by, "_rung").agg(F.count(F.lit(1)).alias("_ord_n")).where(F.col("_ord_n") > rows_per_rung)
        crowded = materialise(crowded.select(*by, "_rung", F.lit(True).alias("_ord_open")))
        if crowded.isEmpty():
            break
        split = F.when(F.col("_ord_open"), _down_to(F.col("_bits"), finer)).otherwise(F.col("_rung"))
        rungs = rungs.join(F.broadcast(crowded), [*by, "_rung"], "left").withColumn("_rung", split).drop("_ord_open")
    rungs = rungs.drop("_bits")
    before = F.coalesce(F.sum("n").over(_window([*by, "_rung"], _asc([value])).rowsBetween(UNBOUNDED, -1)), F.lit(0))
    offsets = _rung_offsets(rungs.groupBy(*by, "_rung").agg(F.sum("n").alias("_ord_n")), by)
    return (
        rungs.withColumn("_ord_in", before)
        .join(offsets, [*by, "_rung"])
        .withColumn("below", F.col("_ord_before") + F.col("_ord_in"))
        .drop("_ord_before", "_ord_in")
    )


def _rung_offsets(totals: DataFrame, by: list[str]) -> DataFrame:
    """Rows before each rung and in its group, by two levels of prefix sums: over the first places, and inside each."""
    placed = totals.withColumn("_top", F.shiftright("_rung", _PLACES[0]))
    tops = placed.groupBy(*by, "_top").agg(F.sum("_ord_n").alias("_ord_n"))
    whole = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)]))
    tops = tops.select(
        *by, "_top", F.sum("_ord_n").over(whole).alias("total"),
        F.coalesce(F.sum("_ord_n").over(_window(by, _asc(["_top"])).rowsBetween(UNBOUNDED, -1)), F.lit(0)).alias("_ord_upto"))
    inner = F.coalesce(F.sum("_ord_n").over(_window([*by, "_top"], _asc(["_rung"])).rowsBetween(UNBOUNDED, -1)), F.lit(0))
    return placed.withColumn("_ord_in", inner).join(tops, [*by, "_top"]).select(
        *by, "_rung", (F.col("_ord_upto") + F.col("_ord_in")).alias("_ord_before"), "total")


#: Rows from which a value is joined by broadcast: of a table there are at most rows / HOT_ROWS such values.
HOT_ROWS = 1_000_000


def join_by_value(df: DataFrame, side: DataFrame, value: str, by: list[str], columns: list[str]) -> DataFrame:
    """Attach ``columns`` of ``side`` (one row per ``by`` and ``value``, with its number of rows ``n``) to the rows of ``df``.

    Rows without a value match nothing and are spread over the tasks, values of very
    many rows are joined by broadcast, all others by a shuffle; so no key meets in one task.
    """
    keyed = df.withColumn("_ord_key", F.col(value).cast("double"))
    side = side.withColumnRenamed(value, "_ord_key") if value != "_ord_key" else side
    hot = side.where(F.col("n") >= HOT_ROWS).select(*by, "_ord_key", F.lit(True).alias("_ord_hot"), *[F.col(c).alias(f"_hot_{c}") for c in columns])
    aside = F.col("_ord_key").isNull() | F.isnan("_ord_key") | F.col("_ord_hot").isNotNull()
    spread = keyed.join(F.broadcast(hot), [*by, "_ord_key"], "left").withColumn(
        "_ord_slot", F.when(aside, 1 + F.monotonically_increasing_id() % 65_536).otherwise(F.lit(0).cast("long")))
    cold = side.where(F.col("n") < HOT_ROWS).select(*by, "_ord_key", *columns, F.lit(0).cast("long").alias("_ord_slot"))
    joined = spread.join(cold, [*by, "_ord_key", "_ord_slot"], "left")
    return joined.withColumns({c: F.coalesce(f"_hot_{c}", c) for c in columns}).drop(
        "_ord_key", "_ord_slot", "_ord_hot", *[f"_hot_{c}" for c in columns])


def with_ranks(df: DataFrame, value: str, by: list[str] | None = None, *, mid: str | None = None,
               low: str | None = None, descending: bool = False) -> DataFrame:
    """Attach mid-ranks and/or minimum ranks of ``value``; null values get null ranks."""
    by = by or []
    ladder = distinct_ladder(df, value, by)
    first = F.col("total") - F.col("below") - F.col("n") if descending else F.col("below")
    columns = []
    if mid:
        columns.append((first + (F.col("n") + 1) / F.lit(2.0)).alias(mid))
    if low:
        columns.append((first + 1).cast("long").alias(low))
    ranks = ladder.select(*by, F.col(value).alias("_ord_key"), "n", *columns)
    return join_by_value(df, ranks, value, by, [c for c in (mid, low) if c])


def mid_rank(df: DataFrame, value: str, by: list[str] | None = None, out: str = "mid_rank") -> DataFrame:
    """Average rank of ties, ``(start + 1 + end) / 2``."""
    return with_ranks(df, value, by, mid=out)


def bh_adjust(df: DataFrame, p: str, by: list[str] | None = None, out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg adjusted p-values; nulls stay null and do not count."""
    by = by or []
    adjusted = bh_ladder(distinct_ladder(df, p, by), p, by)
    return join_by_value(df, adjusted.select(*by, F.col(p).alias("_ord_key"), "n", F.col("_padj").alias(out)), p, by, [out])


def bh_ladder(ladder: DataFrame, p: str, by: list[str]) -> DataFrame:
    """Adjusted value per distinct p: suffix minimum of ``p * total / rank``."""
    step = ladder.withColumn("_ord_q", F.col(p) * F.col("total") / (F.col("below") + F.col("n")))
    # Two levels, as for the sums: the minimum of later first places, and of later rungs of the same one.
    lows = step.groupBy(*by, "_rung").agg(F.min("_ord_q").alias("_ord_low")).withColumn("_top", F.shiftright("_rung", _PLACES[0]))
    later = lambda keys, order: _window(keys, [F.col(order).desc()]).rowsBetween(UNBOUNDED, -1)
    tops = lows.groupBy(*by, "_top").agg(F.min("_ord_low").alias("_ord_low")).select(
        *by, "_top", F.min("_ord_low").over(later(by, "_top")).alias("_ord_upper"))
    after = lows.withColumn("_ord_near", F.min("_ord_low").over(later([*by, "_top"], "_rung"))).join(tops, [*by, "_top"]).select(
        *by, "_rung", F.least("_ord_near", "_ord_upper").alias("_ord_after"))
    inner = _window([*by, "_rung"], [F.col(p).desc()]).rowsBetween(UNBOUNDED, 0)
    return (
        step.withColumn("_ord_own", F.min("_ord_q").over(inner))
        .join(after, [*by, "_rung"])
        .withColumn("_padj", F.least(F.lit(1.0), "_ord_own", "_ord_after"))
        .drop("_ord_q", "_ord_own", "_ord_after")
    )


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: rows ``(by, prob, quantile)``.

    A histogram over value codes (a few thousand rows at most) tells which code
    holds each wanted rank; only the rows of these codes, a small share of the
    data, are then ordered.
    """
    by = by or []
    raw = df.select(*by, F.col(value).cast("double").alias(value))
    keyed = raw.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("_pick", value_code(F.col(value)))
    histogram = keyed.groupBy(*by, "_pick").agg(F.count(F.lit(1)).alias("_ord_n"))
    whole = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)]))
    placed = histogram.select(
        *by, "_pick", "_ord_n",
        F.coalesce(F.sum("_ord_n").over(_window(by, _asc(["_pick"])).rowsBetween(UNBOUNDED, -1)), F.lit(0)).alias("_ord_before"),
        F.sum("_ord_n").over(whole).alias("_ord_total"),
    )
    # The quantile at prob lies between the ranks lo and lo + 1, counted from 0.
    at = F.col("prob") * (F.col("_ord_total") - 1)
    lo = F.floor(at)
    hi = F.least(lo + 1, F.col("_ord_total") - 1)
    prob = F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("prob")
    within = lambda rank, start, n: (rank >= start) & (rank < start + n)
    in_code = lambda rank: within(rank, F.col("_ord_before"), F.col("_ord_n"))
    wanted = placed.select("*", prob).where(in_code(lo) | in_code(hi)).drop("_ord_n")
    codes = wanted.select(*by, "_pick").distinct()
    rows = keyed.join(codes, [*by, "_pick"])
    ladder = distinct_ladder(rows, value, [*by, "_pick"]).join(wanted, [*by, "_pick"])
    start = F.col("_ord_before") + F.col("below")
    hit = lambda rank: within(rank, start, F.col("n"))
    return ladder.where(hit(lo) | hit(hi)).groupBy(*by, "prob").agg(
        F.max(F.when(hit(lo), F.col(value))).alias("_ord_a"),
        F.max(F.when(hit(hi), F.col(value))).alias("_ord_b"),
        F.max(at - lo).alias("_ord_w"),
    ).select(*by, "prob", (F.col("_ord_a") + (F.col("_ord_b") - F.col("_ord_a")) * F.col("_ord_w")).alias("quantile"))


def exact_median(df: DataFrame, value: str, by: list[str] | None = None, out: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by).select(*(by or []), F.col("quantile").alias(out))


def ordinal_rank(df: DataFrame, by: list[str], chunk: str, position: list[str], out: str) -> DataFrame:
    """1-based row number in (chunk, position) order, chunk by chunk."""
    return running_total(df, by, chunk, position, F.lit(1), out)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows; Spark keeps only ``k`` rows per task (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, by: list[str], value: str, key: str, k: int, salts: int = 16) -> DataFrame:
    """The ``k`` largest rows of each group, ties broken by ``key``.

    A first pass ranks inside salted sub-groups, so a hot group is cut to
    ``k * salts`` rows before it meets in one task.
    """
    order = [F.col(value).desc_nulls_last(), F.col(key).asc()]
    salted = df.withColumn("_ord_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    local = salted.withColumn("_ord_rn", F.row_number().over(_window([*by, "_ord_salt"], order))).where(F.col("_ord_rn") <= k)
    final = local.withColumn("_ord_rn", F.row_number().over(_window(by, order))).where(F.col("_ord_rn") <= k)
    return final.withColumnRenamed("_ord_rn", "position").drop("_ord_salt")


def sort_nulls_last(df: DataFrame, column: str, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_last(), *[F.col(t).asc() for t in tiebreak])
