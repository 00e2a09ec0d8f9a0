"""Range scans against sources that cut long responses: which requests bring all rows, planned from counts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _path(day: Column, lo: Column, hi: Column) -> Column:
    """The ranges, from [lo, hi] to the day alone, that halving gives a day: an array of (lo, hi, p_lo, p_hi), the latter the range that was halved."""
    one = lambda a, b, p, q: F.struct(a.alias("lo"), b.alias("hi"), p.alias("p_lo"), q.alias("p_hi"))
    none = F.lit(None).cast("date")

    def step(path, _):
        last = F.element_at(path, -1)
        middle = F.date_add(last["lo"], F.floor(F.date_diff(last["hi"], last["lo"]) / 2).cast("int"))
        half = F.when(day <= middle, one(last["lo"], middle, last["lo"], last["hi"])).otherwise(one(F.date_add(middle, 1), last["hi"], last["lo"], last["hi"]))
        return F.when(last["lo"] < last["hi"], F.concat(path, F.array(half))).otherwise(path)

    rounds = F.ceil(F.log2(F.date_diff(hi, lo) + 1)).cast("int") + 1
    return F.aggregate(F.sequence(F.lit(1), rounds), F.array(one(lo, hi, none, none)), step)


def halved(counts: DataFrame, keys: list[str], page: int) -> DataFrame:
    """(keys, lo, hi, n, wanted): the ranges with which each key's scan of its range ends: those of at most `page` rows, and single days.

    counts are (keys, day, n, wanted, lo, hi): rows of a day, how many of them are wanted, and the key's range. Halving depends on the
    range alone, so each day knows all ranges that may hold it; a range is asked for when the range that it halves has more than `page` rows.
    """
    x = counts.select(*keys, "n", "wanted", F.posexplode(_path(F.col("day"), F.col("lo"), F.col("hi"))).alias("level", "r"))
    x = x.groupBy(*keys, "level", "r").agg(F.sum("n").alias("n"), F.sum("wanted").alias("wanted"))
    above = F.sum("n").over(W.partitionBy(*keys, "level", "r.p_lo", "r.p_hi"))
    x = x.withColumn("asked", (F.col("level") == 0) | (above > page))
    return x.filter(F.col("asked") & ((F.col("n") <= page) | (F.col("r.lo") == F.col("r.hi")))).select(*keys, "r.lo", "r.hi", "n", "wanted")


def scan(rows: DataFrame, day: str, ticker: str, start: datetime.date, end: datetime.date, page: int, split: str | None = None) -> DataFrame:
    """(split, ticker, lo, hi, n, cut): the requests of a scan of [start, end] that bring rows, and how many of them count.

    Ranges are halved while a response is cut at `page` rows. A day that alone is cut is asked for by each value of the split column; where that
    is cut too, or there is none, ticker by ticker over the range of all such days, halved likewise, and of the responses only the rows of such
    days count. cut: a single day of one ticker is still too long, so its response lacks rows; n counts all of them.
    Null days and days outside the range aren't scanned; null splits and tickers are values like others.
    """
    kind = F.col(split).cast("string") if split else F.lit(None).cast("string")
    per = rows.select(F.col(day).cast("date").alias("day"), kind.alias("split"), F.col(ticker).cast("string").alias("ticker"))
    per = per.filter(F.col("day").between(F.lit(start), F.lit(end))).groupBy("day", "split", "ticker").agg(F.count("*").alias("n"))

    whole = halved(per.groupBy("day").agg(F.sum("n").alias("n")).select("day", "n", F.col("n").alias("wanted"), F.lit(start).alias("lo"), F.lit(end).alias("hi")), [], page)
    over = whole.filter(F.col("n") > page).select(F.col("lo").alias("day"))
    by_kind = per.join(over, "day", "left_semi").groupBy("day", "split").agg(F.sum("n").alias("n"))
    # Without kinds, a crowded day's only group is its whole, which is cut as the day was.
    crowded = by_kind.filter(F.col("n") > page).select(F.col("day").alias("c_day"), F.col("split").alias("c_split"))
    spans = crowded.groupBy(F.col("c_split").alias("s_split")).agg(F.min("c_day").alias("lo"), F.max("c_day").alias("hi"))

    asked = per.join(spans, F.col("split").eqNullSafe(F.col("s_split")) & F.col("day").between(F.col("lo"), F.col("hi")))
    asked = asked.join(crowded, F.col("split").eqNullSafe(F.col("c_split")) & (F.col("day") == F.col("c_day")), "left")
    swept = halved(asked.select("split", "ticker", "day", "n", F.when(F.col("c_day").isNotNull(), F.col("n")).otherwise(0).alias("wanted"), "lo", "hi"), ["split", "ticker"], page)

    none = F.lit(None).cast("string")
    out = whole.filter(F.col("n") <= page).select(none.alias("split"), none.alias("ticker"), "lo", "hi", "n", F.lit(False).alias("cut"))
    out = out.unionByName(by_kind.filter(F.col("n") <= page).select("split", none.alias("ticker"), F.col("day").alias("lo"), F.col("day").alias("hi"), "n", F.lit(False).alias("cut")))
    return out.unionByName(swept.filter("wanted > 0").select("split", "ticker", "lo", "hi", F.col("wanted").alias("n"), (F.col("n") > page).alias("cut")))
