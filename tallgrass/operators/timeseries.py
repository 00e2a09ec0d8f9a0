"""Bars, previous and look-back values, rolling extrema and interval sums, all as windows or grouped folds over one shuffle by entity."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def roll_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks (id, ts, value) to daily bars."""
    return ticks.groupBy("id", F.col("ts").cast("date").alias("d")).agg(
        F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"), F.count("*").alias("volume"), F.sum("value").alias("trade_value"),
    )


def roll_bars(bars: DataFrame, period: str, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Daily bars to weeks (from Monday) or months: first open, highest, lowest, last close, sums."""
    unit = {"W": "week", "M": "month"}[period]
    sums = [F.sum(c).alias(c) for c in ("volume", "trade_value") if c in bars.columns]
    return bars.groupBy(*keys, F.trunc("d", unit).alias("base_date")).agg(F.min_by("open", "d").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "d").alias("close"), *sums).withColumn("period", F.lit(period))


def roll_current(bars: DataFrame, period: str, since: Column | None = None) -> DataFrame:
    """The bucket that holds each entity's latest day; with since, only of entities that have a bar on or after it."""
    unit = {"W": "week", "M": "month"}[period]
    latest = bars.groupBy("id").agg(F.max("d").alias("latest"))
    latest = latest.filter(F.col("latest") >= since) if since is not None else latest
    current = bars.join(latest, "id").filter(F.trunc("d", unit) == F.trunc("latest", unit)).drop("latest")
    return roll_bars(current, period)


def previous(df: DataFrame, column: str, alias: str, keys: tuple[str, ...] = ("id",), order: str = "d") -> DataFrame:
    """The value of the row before, in each entity; take it before any filter on the order column."""
    return df.withColumn(alias, F.lag(column).over(W.partitionBy(*keys).orderBy(order)))


def change_rate(now: Column, base: Column, digits: int = 6) -> Column:
    """Percent change; NULL where the base is missing or 0."""
    return F.round((now / F.nullif(base, F.lit(0.0)) - 1) * 100, digits)


def looked_back(df: DataFrame, column: str, alias: str, interval: str, keys: tuple[str, ...] = ("id",), order: str = "d") -> DataFrame:
    """The latest value at or before the order date less an interval, as a range frame instead of a correlated subquery."""
    frame = f"max_by({column}, {order}) OVER (PARTITION BY {', '.join(keys)} ORDER BY {order} RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL {interval} PRECEDING)"
    return df.withColumn(alias, F.expr(frame))


def _points_and_facts(points: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts at the start of their day and points a second later: a frame of months before a point leaves out the day at its far end."""
    early = facts.withColumn("t", F.col("d").cast("timestamp")).withColumn("is_point", F.lit(False))
    late = points.withColumn("t", F.col("d").cast("timestamp") + F.expr("INTERVAL '1' SECOND")).withColumn("is_point", F.lit(True))
    return early.unionByName(late, allowMissingColumns=True)


def _frame(keys: tuple[str, ...], months: int) -> str:
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY t RANGE BETWEEN INTERVAL '{months}' MONTH PRECEDING AND CURRENT ROW)"


def _codes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 1 in the order of the values, NaN last, and which values are there."""
    there = values.is_valid().to_numpy(zero_copy_only=False)
    kept = values.drop_null()
    out = np.zeros(len(values), np.int64)
    if pa.types.is_floating(values.type) or pa.types.is_integer(values.type):
        out[there] = np.unique(kept.to_numpy(zero_copy_only=False), return_inverse=True)[1] + 1
    else:
        out[there] = pc.rank(kept, tiebreaker="dense").to_numpy()
    return out, there


def _first_extreme(marks: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The least of marks from start to stop (exclusive), by tables of the least of 1, 2, 4 ... marks."""
    level = np.log2(stop - start).astype(np.int64)
    out, table = np.empty(len(start), np.int64), marks
    for j in range(int(level.max()) + 1):
        at = np.flatnonzero(level == j)
        out[at] = np.minimum(table[start[at]], table[stop[at] - (1 << j)])
        table = np.minimum(table[: -(1 << j)], table[1 << j :])
    return out


def range_extrema(df: DataFrame, value: str, months: int, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Highest and lowest value and their dates in (d - months, d]; ties go to the earliest date. Missing values don't count, NaN is above all others; rows without a date go.

    Rows come in order of keys and d, and a batch's frames are answered at once, so a row costs the logarithm of its frame's rows. Of an entity that
    goes on in the next batch one frame is kept, and rows of the latest date wait for the others of that date.
    """
    names = df.columns
    x = df.filter("d IS NOT NULL").withColumns({"__d": F.unix_date("d"), "__after": F.unix_date(F.add_months("d", -months))}).repartition(*keys).sortWithinPartitions(*keys, "d")

    def changed(column: pa.Array) -> np.ndarray:
        """Where a value isn't that of the row before."""
        a, b = column[1:], column[:-1]
        equal = pc.or_kleene(pc.equal(a, b), pc.and_(a.is_null(), b.is_null())).fill_null(False)
        return ~equal.to_numpy(zero_copy_only=False)

    def run(batches):
        held, done = None, 0  # the rows that the next batch may need, and how many of them are answered
        for batch in itertools.chain(batches, (None,)):
            if batch is not None:
                batch = pa.Table.from_batches([batch])
                held = batch if held is None else pa.concat_tables([held, batch])
            if held is None or not len(held):
                continue
            held = held.combine_chunks()
            column = lambda c: held.column(c).chunk(0)
            n, d, after = len(held), column("__d").to_numpy().astype(np.int64), column("__after").to_numpy().astype(np.int64)
            new = np.zeros(n, bool)
            for k in keys:
                new[1:] |= changed(column(k))
            group = np.cumsum(new)
            width = int(d.max() - d.min()) + 2
            place = group * width + d - d.min()
            ready = n if batch is None else int(np.searchsorted(place, place[-1]))  # before the rows of the latest date
            if ready > done:
                these = slice(done, ready)
                start = np.searchsorted(place, group[these] * width + np.maximum(after[these] + 1 - d.min(), 0))
                stop = np.searchsorted(place, place[these], side="right")
                codes, there = _codes(column(value))
                found = []
                for marks in (np.where(there, n + 1 - codes, n + 1), np.where(there, codes, n + 1)):
                    best = _first_extreme(marks * n + np.arange(n), start, stop) % n
                    index = pa.array(best, mask=~there[best])
                    found += [column(value).take(index), column("d").take(index)]
                yield pa.RecordBatch.from_arrays([*(held.column(c).chunk(0)[these] for c in names), *found], [*names, "high_value", "high_date", "low_value", "low_date"])
            keep = int(np.searchsorted(place, group[-1] * width + max(int(after[-1]) + 1 - int(d.min()), 0)))
            held, done = held.slice(keep), ready - keep

    out = [T.StructField(c, df.schema["d" if c.endswith("date") else value].dataType) for c in ("high_value", "high_date", "low_value", "low_date")]
    return x.mapInArrow(run, T.StructType([*df.schema.fields, *out]))


def interval_sum(points: DataFrame, events: DataFrame, amount: str, alias: str, months: int, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """For each point (keys, d), the sum of events (keys, d, amount) in (d - months, d]; NULL without events. One shuffle serves both."""
    both = _points_and_facts(points.select(*keys, "d"), events.select(*keys, "d", F.col(amount).cast("double").alias("x")))
    return both.withColumn(alias, F.expr(f"sum(x) {_frame(keys, months)}")).filter("is_point").select(*keys, "d", alias)


def as_of(points: DataFrame, facts: DataFrame, columns: tuple[str, ...], keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Each point (keys, at) with the latest fact (keys, at, columns) at or before it, by union and forward fill in one shuffle."""
    fact = F.struct(*columns)
    both = points.withColumn("fact", F.lit(None).cast(facts.select(fact.alias("x")).schema["x"].dataType)).withColumn("is_point", F.lit(1)).unionByName(facts.select(*keys, "at", fact.alias("fact"), F.lit(0).alias("is_point")), allowMissingColumns=True)
    filled = both.withColumn("fact", F.last("fact", ignorenulls=True).over(W.partitionBy(*keys).orderBy("at", "is_point").rowsBetween(W.unboundedPreceding, W.currentRow)))
    return filled.filter("is_point = 1").select(*points.columns, *(F.col(f"fact.{c}").alias(c) for c in columns))


def trailing_quarters(quarters: DataFrame, value: str, alias: str) -> DataFrame:
    """Sum of the four latest quarters (id, q, value), q counting quarters; NULL unless there are four in a row of rows."""
    w = W.partitionBy("id").orderBy("q").rowsBetween(-3, 0)
    return quarters.withColumn(alias, F.when(F.count(value).over(w) == 4, F.sum(value).over(w)))


def decumulated(facts: DataFrame, value: str, first_month: int = 3) -> DataFrame:
    """Quarter values from year-to-date values (id, yymm, value): less the value three months earlier of the same id; a gap gives no row."""
    month = F.col("yymm") % 100
    before = facts.select(F.col("id").alias("b_id"), F.col("yymm").alias("b_yymm"), F.col(value).alias("b_value"))
    joined = facts.join(before, (F.col("id") == F.col("b_id")) & (F.col("yymm") - 3 == F.col("b_yymm")), "left")
    return joined.filter((month == first_month) | F.col("b_value").isNotNull()).select("id", "yymm", F.when(month == first_month, F.col(value)).otherwise(F.col(value) - F.col("b_value")).alias(value))


def adjusted_entities(pairs: DataFrame, tolerance: float = 0.005, least_move: float = 0.01, least_dates: int = 2) -> DataFrame:
    """Entities whose new and stored closes (id, d, stored, fetched) differ by one factor: the sign of a split.

    The last two dates don't count; every ratio must be within tolerance of the median, and the median off 1 by more than least_move.
    """
    late = F.row_number().over(W.partitionBy("id").orderBy(F.desc("d")))
    x = pairs.withColumn("late", late).filter("late > 2 AND stored > 0").withColumn("ratio", F.col("fetched") / F.col("stored"))
    middle = x.groupBy("id").agg(F.median("ratio").alias("factor"), F.count("*").alias("dates"))
    off = x.join(middle, "id").groupBy("id", "factor", "dates").agg(F.max(F.abs(F.col("ratio") / F.col("factor") - 1)).alias("spread"))
    return off.filter((F.col("spread") <= tolerance) & (F.abs(F.col("factor") - 1) > least_move) & (F.col("dates") >= least_dates)).select("id", F.round("factor", 6).alias("factor"), "dates")
