"""Registered queries: bars, rates, look-backs, valuation."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.operators import timeseries as ts
from tallgrass.sources.tables import event_bars, supplier_bars, table

_BARS = "bars AS (SELECT user_id AS id, CAST(ts AS DATE) AS d, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS volume, sum(value) AS trade_value FROM events GROUP BY 1, 2)"
_LONG = "bars AS (SELECT l_suppkey AS id, CAST(l_shipdate AS DATE) AS d, first(p ORDER BY l_orderkey, l_linenumber, p) AS open, max(p) AS high, min(p) AS low, last(p ORDER BY l_orderkey, l_linenumber, p) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2)"
_QUARTERS = "q AS (SELECT o_custkey AS id, year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS q, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)"


def q_daily_change_rate(spark, d):
    """Daily bars and their change rates."""
    x = ts.previous(event_bars(spark, d), "close", "prev_close")
    return x.select("id", "d", "open", "high", "low", "close", "volume", F.round("trade_value", 4).alias("trade_value"), ts.change_rate(F.col("close"), F.col("prev_close")).alias("change_rate"))


def q_base_price_rate(spark, d):
    """W1 with a base price: it wins over the previous close, and bars before the window still serve as previous."""
    x = ts.previous(event_bars(spark, d), "close", "prev_close").withColumn("base_price", F.when(F.col("volume") % 3 == 0, F.col("low")))
    x = x.filter(F.col("d") >= F.lit("2024-01-15").cast("date"))
    return x.select("id", "d", "close", ts.change_rate(F.col("close"), F.coalesce("base_price", "prev_close")).alias("change_rate"))


def _period(period):
    def run(spark, d):
        x = ts.roll_bars(event_bars(spark, d), period)
        return x.select("id", "period", "base_date", "open", "high", "low", "close", "volume", F.round("trade_value", 4).alias("trade_value"))

    return run


def _current(period):
    def run(spark, d):
        x = ts.roll_current(event_bars(spark, d), period, F.lit("2024-01-29").cast("date"))
        return x.select("id", "base_date", "open", "high", "low", "close", "volume")

    return run


def q_period_change_rate(spark, d):
    """Change rates of weeks and months, previous bar in the same period."""
    bars = event_bars(spark, d)
    x = ts.roll_bars(bars, "W").unionByName(ts.roll_bars(bars, "M"))
    x = ts.previous(x, "close", "prev_close", ("id", "period"), "base_date")
    return x.select("id", "period", "base_date", "close", ts.change_rate(F.col("close"), F.col("prev_close")).alias("change_rate"))


def q_week52(spark, d):
    """52-week high and low with dates, (t - 12 months, t]."""
    x = ts.range_extrema(supplier_bars(spark, d).select("id", "d", "close").filter("id IS NOT NULL"), "close", 12)
    return x.select("id", "d", "close", *("high_value", "high_date", "low_value", "low_date"))


def q_returns(spark, d):
    """Returns over a week, a month and three months."""
    x = supplier_bars(spark, d).select("id", "d", "close")
    for alias, interval in (("b1w", "7 DAYS"), ("b1m", "1 MONTH"), ("b3m", "3 MONTHS")):
        x = ts.looked_back(x, "close", alias, interval)
    return x.select("id", "d", *(ts.change_rate(F.col("close"), F.col(f"b{p}")).alias(f"r_{p}") for p in ("1w", "1m", "3m")))


def _quarters(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("id"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).cast("long").alias("q")).agg(F.sum("o_totalprice").alias("v"))


def q_trailing_four(spark, d):
    """Sum of the four latest quarters at each order month, NULL unless there are four."""
    facts = ts.trailing_quarters(_quarters(spark, d), "v", "ttm").select("id", F.col("q").alias("at"), "ttm", F.lit(True).alias("known"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("id"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 2).cast("long").alias("at"))
    return ts.as_of(o, facts, ("ttm", "known")).select("o_orderkey", "id", F.round("ttm", 4).alias("ttm"))


def q_latest_balance(spark, d):
    """The latest quarter value at or before the quarter before each order."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("id"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 2).cast("long").alias("at"))
    facts = _quarters(spark, d).select("id", F.col("q").alias("at"), "v")
    return ts.as_of(o, facts, ("v",)).select("o_orderkey", "id", F.round("v", 4).alias("balance"))


def q_year_sums(spark, d):
    """Sum of urgent orders in (t - 1 year, t] at each order day of a customer."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("d"), "o_totalprice", "o_orderpriority")
    x = ts.interval_sum(o.select("id", "d").distinct(), o.filter("o_orderpriority = '1-URGENT'"), "o_totalprice", "total", 12)
    return x.select("id", "d", F.round("total", 2).alias("total"))


def q_valuation(spark, d):
    """Price over trailing sum, price over balance and yield, each guarded against missing or non-positive bases."""
    bars = supplier_bars(spark, d).select("id", "d", "close", "volume")
    q = bars.withColumn("q", (F.year("d") * 4 + F.quarter("d") - 1).cast("long")).groupBy("id", "q").agg(F.sum("volume").cast("double").alias("v"))
    facts = ts.trailing_quarters(q, "v", "ttm").select("id", F.col("q").alias("at"), "ttm", "v")
    points = bars.withColumn("at", (F.year("d") * 4 + F.quarter("d") - 2).cast("long"))
    x = ts.as_of(points, facts, ("ttm", "v"))
    pays = bars.filter("volume >= 50").withColumn("amount", F.lit(1.0))
    y = ts.interval_sum(bars.select("id", "d"), pays, "amount", "paid", 12).select(F.col("id").alias("y_id"), F.col("d").alias("y_d"), "paid")
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 8))
    both = x.join(y, (F.col("id") == F.col("y_id")) & (F.col("d") == F.col("y_d")))
    return both.select("id", "d", ratio(F.col("close"), F.col("ttm")).alias("per"), ratio(F.col("close"), F.col("v")).alias("pbr"), F.when((F.col("close") > 0) & (F.col("paid") > 0), F.round(F.col("paid") / F.col("close") * 100, 8)).alias("yield_rate"))


def q_decumulate(spark, d):
    """Quarter values from year-to-date values; a missing quarter gives no row."""
    o = table(spark, d, "orders").withColumn("yymm", (F.year("o_orderdate") * 100 + F.quarter("o_orderdate") * 3).cast("long"))
    q = o.groupBy(F.col("o_custkey").alias("id"), "yymm").agg(F.sum("o_totalprice").alias("v"))
    ytd = q.withColumn("v", F.sum("v").over(W.partitionBy("id", F.floor(F.col("yymm") / 100)).orderBy("yymm")))
    return ts.decumulated(ytd, "v").select("id", "yymm", F.round("v", 2).alias("v"))


def q_split_detection(spark, d):
    """Entities whose closes moved by one factor."""
    b = event_bars(spark, d).select("id", "d", F.col("close").alias("stored"))
    factor = F.when(F.col("id") % 5 == 0, 0.5).when(F.col("id") % 5 == 1, 1.002).when(F.col("id") % 5 == 2, 0.8 + F.dayofmonth("d") / 100).otherwise(1.0)
    return ts.adjusted_entities(b.withColumn("fetched", F.col("stored") * factor))


def q_calendar(spark, d):
    """Distinct trading days, and the latest day that both feeds have settled."""
    days = event_bars(spark, d).select("d").distinct()
    last = table(spark, d, "lineitem").agg(F.max(F.col("l_shipdate").cast("date")).alias("x")).crossJoin(table(spark, d, "events").agg(F.max(F.col("ts").cast("date")).alias("y")))
    return days.crossJoin(F.broadcast(last.select(F.least("x", "y").alias("settled"), F.greatest("x", "y").alias("latest")))).select("d", "settled", "latest", F.col("d").between(F.col("settled"), F.col("latest")).alias("in_window"))


def q_previous_trading_day(spark, d):
    """The last trading day before a date, with the latest weekday as an estimate where the calendar has none."""
    open_ = table(spark, d, "events").select(F.col("ts").cast("date").alias("at")).distinct().filter(F.dayofweek("at").between(2, 6)).select(F.lit(1).alias("id"), "at", F.col("at").alias("day"))
    asked = table(spark, d, "events").select(F.lit(1).alias("id"), F.date_sub(F.col("ts").cast("date"), 1).alias("at")).unionByName(spark.range(3).select(F.lit(1).alias("id"), F.date_sub(F.lit("2023-12-27").cast("date"), F.col("id").cast("int")).alias("at"))).distinct()
    weekday = F.date_sub("at", F.when(F.dayofweek("at") == 1, 2).when(F.dayofweek("at") == 7, 1).otherwise(0))
    return ts.as_of(asked, open_, ("day",)).select(F.date_add("at", 1).alias("asked"), F.coalesce("day", weekday).alias("previous_day"), F.col("day").isNull().alias("estimated"))


def q_stale_first(spark, d):
    """The 25 customers with the oldest order, those without any first."""
    last = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("last_order"))
    c = table(spark, d, "customer").select("c_custkey").join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.orderBy(F.col("last_order").asc_nulls_first(), "c_custkey").limit(25).select("c_custkey", "last_order")


_CUR = "SELECT id, date_trunc('{u}', d)::DATE AS base_date, arg_min(open, d) AS open, max(high) AS high, min(low) AS low, arg_max(close, d) AS close, sum(volume)::BIGINT AS volume FROM bars JOIN (SELECT id, max(d) AS m FROM bars GROUP BY id HAVING max(d) >= DATE '2024-01-29') USING (id) WHERE date_trunc('{u}', d) = date_trunc('{u}', m) GROUP BY 1, 2"
_PER = "SELECT id, '{p}' AS period, date_trunc('{u}', d)::DATE AS base_date, arg_min(open, d) AS open, max(high) AS high, min(low) AS low, arg_max(close, d) AS close, sum(volume)::BIGINT AS volume, {t} AS trade_value FROM bars GROUP BY id, date_trunc('{u}', d)::DATE"

QUERIES = {
    "q_daily_change_rate": q_daily_change_rate, "q_base_price_rate": q_base_price_rate, "q_weekly_bars": _period("W"), "q_monthly_bars": _period("M"),
    "q_current_week": _current("W"), "q_current_month": _current("M"), "q_period_change_rate": q_period_change_rate, "q_week52": q_week52, "q_returns": q_returns,
    "q_trailing_four": q_trailing_four, "q_latest_balance": q_latest_balance, "q_year_sums": q_year_sums, "q_valuation": q_valuation, "q_decumulate": q_decumulate,
    "q_split_detection": q_split_detection, "q_calendar": q_calendar, "q_previous_trading_day": q_previous_trading_day, "q_stale_first": q_stale_first,
}

ORACLE_SQL = {
    "q_daily_change_rate": f"WITH {_BARS} SELECT id, d, open, high, low, close, volume, round(trade_value, 4) AS trade_value, round((close / nullif(lag(close) OVER (PARTITION BY id ORDER BY d), 0) - 1) * 100, 6) AS change_rate FROM bars",
    "q_base_price_rate": f"WITH {_BARS}, p AS (SELECT *, lag(close) OVER (PARTITION BY id ORDER BY d) AS prev, CASE WHEN volume % 3 = 0 THEN low END AS base FROM bars) SELECT id, d, close, round((close / nullif(coalesce(base, prev), 0) - 1) * 100, 6) AS change_rate FROM p WHERE d >= DATE '2024-01-15'",
    "q_weekly_bars": f"WITH {_BARS} " + _PER.format(p="W", u="week", t="round(sum(trade_value), 4)"),
    "q_monthly_bars": f"WITH {_BARS} " + _PER.format(p="M", u="month", t="round(sum(trade_value), 4)"),
    "q_current_week": f"WITH {_BARS} " + _CUR.format(u="week"),
    "q_current_month": f"WITH {_BARS} " + _CUR.format(u="month"),
    "q_period_change_rate": f"WITH {_BARS}, p AS ({_PER.format(p='W', u='week', t='0')} UNION ALL {_PER.format(p='M', u='month', t='0')}) SELECT id, period, base_date, close, round((close / nullif(lag(close) OVER (PARTITION BY id, period ORDER BY base_date), 0) - 1) * 100, 6) AS change_rate FROM p",
    "q_week52": f"WITH {_LONG} SELECT a.id, a.d, any_value(a.close) AS close, max(b.close) AS high_value, min(b.d) FILTER (b.close = m.hi) AS high_date, min(b.close) AS low_value, min(b.d) FILTER (b.close = m.lo) AS low_date FROM bars a JOIN (SELECT x.id, x.d, max(y.close) AS hi, min(y.close) AS lo FROM bars x JOIN bars y ON x.id = y.id AND y.d <= x.d AND y.d > x.d - INTERVAL 12 MONTH GROUP BY 1, 2) m ON a.id = m.id AND a.d = m.d JOIN bars b ON a.id = b.id AND b.d <= a.d AND b.d > a.d - INTERVAL 12 MONTH GROUP BY a.id, a.d",
    "q_returns": f"WITH {_LONG} SELECT a.id, a.d, " + ", ".join(f"round((a.close / nullif(b{p}.close, 0) - 1) * 100, 6) AS r_{p}" for p in ("1w", "1m", "3m")) + " FROM bars a " + " ".join(f"ASOF LEFT JOIN bars b{p} ON a.id = b{p}.id AND (a.d - INTERVAL {i})::DATE >= b{p}.d" for p, i in (("1w", "7 DAY"), ("1m", "1 MONTH"), ("3m", "3 MONTH"))),
    "q_trailing_four": f"WITH {_QUARTERS}, t AS (SELECT id, q, CASE WHEN count(*) OVER w = 4 THEN sum(v) OVER w END AS ttm FROM q WINDOW w AS (PARTITION BY id ORDER BY q ROWS 3 PRECEDING)) SELECT o_orderkey, o_custkey AS id, round(ttm, 4) AS ttm FROM orders o ASOF LEFT JOIN t ON o.o_custkey = t.id AND year(o_orderdate) * 4 + quarter(o_orderdate) - 2 >= t.q",
    "q_latest_balance": f"WITH {_QUARTERS} SELECT o_orderkey, o_custkey AS id, round(v, 4) AS balance FROM orders o ASOF LEFT JOIN q ON o.o_custkey = q.id AND year(o_orderdate) * 4 + quarter(o_orderdate) - 2 >= q.q",
    "q_year_sums": "WITH o AS (SELECT o_custkey AS id, o_orderdate::DATE AS d, o_totalprice AS p, o_orderpriority AS u FROM orders) SELECT a.id, a.d, round(sum(b.p), 2) AS total FROM (SELECT DISTINCT id, d FROM o) a LEFT JOIN o b ON a.id = b.id AND b.u = '1-URGENT' AND b.d <= a.d AND b.d > a.d - INTERVAL 1 YEAR GROUP BY 1, 2",
    "q_valuation": f"WITH {_LONG}, q AS (SELECT id, year(d) * 4 + quarter(d) - 1 AS q, sum(volume)::DOUBLE AS v FROM bars GROUP BY 1, 2), t AS (SELECT id, q, v, CASE WHEN count(*) OVER w = 4 THEN sum(v) OVER w END AS ttm FROM q WINDOW w AS (PARTITION BY id ORDER BY q ROWS 3 PRECEDING)), x AS (SELECT a.id, a.d, a.close, t.ttm, t.v FROM bars a ASOF LEFT JOIN t ON a.id = t.id AND year(a.d) * 4 + quarter(a.d) - 2 >= t.q), y AS (SELECT a.id, a.d, nullif(count(b.d), 0)::DOUBLE AS paid FROM bars a LEFT JOIN bars b ON a.id = b.id AND b.volume >= 50 AND b.d <= a.d AND b.d > a.d - INTERVAL 1 YEAR GROUP BY 1, 2) SELECT id, d, CASE WHEN ttm > 0 THEN round(close / ttm, 8) END AS per, CASE WHEN v > 0 THEN round(close / v, 8) END AS pbr, CASE WHEN close > 0 AND paid > 0 THEN round(paid / close * 100, 8) END AS yield_rate FROM x JOIN y USING (id, d)",
    "q_decumulate": "WITH q AS (SELECT o_custkey AS id, (year(o_orderdate) * 100 + quarter(o_orderdate) * 3)::BIGINT AS yymm, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2) SELECT id, yymm, round(v, 2) AS v FROM q a WHERE yymm % 100 = 3 OR EXISTS (SELECT 1 FROM q b WHERE b.id = a.id AND b.yymm = a.yymm - 3)",
    "q_split_detection": f"WITH {_BARS}, f AS (SELECT id, d, close AS stored, close * CASE id % 5 WHEN 0 THEN 0.5 WHEN 1 THEN 1.002 WHEN 2 THEN 0.8 + day(d) / 100.0 ELSE 1.0 END AS fetched, row_number() OVER (PARTITION BY id ORDER BY d DESC) AS late FROM bars), r AS (SELECT id, fetched / stored AS ratio FROM f WHERE late > 2 AND stored > 0), m AS (SELECT id, median(ratio) AS factor, count(*) AS dates FROM r GROUP BY id) SELECT id, round(factor, 6) AS factor, dates FROM m JOIN r USING (id) GROUP BY id, factor, dates HAVING max(abs(ratio / factor - 1)) <= 0.005 AND abs(factor - 1) > 0.01 AND dates >= 2",
    "q_calendar": "WITH s AS (SELECT least(max(a), max(b)) AS settled, greatest(max(a), max(b)) AS latest FROM (SELECT (SELECT max(l_shipdate)::DATE FROM lineitem) AS a, (SELECT max(ts)::DATE FROM events) AS b)) SELECT d, settled, latest, d BETWEEN settled AND latest AS in_window FROM (SELECT DISTINCT ts::DATE AS d FROM events), s",
    "q_previous_trading_day": "WITH o AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE isodow(ts) <= 5), a AS (SELECT DISTINCT ts::DATE AS asked FROM events UNION SELECT DATE '2023-12-28' - i::INTEGER FROM range(3) t(i)) SELECT asked, coalesce(day, (asked - 1) - CASE isodow(asked - 1) WHEN 7 THEN 2 WHEN 6 THEN 1 ELSE 0 END) AS previous_day, day IS NULL AS estimated FROM a ASOF LEFT JOIN o ON a.asked - 1 >= o.day",
    "q_stale_first": "SELECT c_custkey, max(o_orderdate)::DATE AS last_order FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1 ORDER BY last_order NULLS FIRST, c_custkey LIMIT 25",
}
