"""Capped-weight chain-linked index of groups of constituents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BASE_LEVEL, CAP, LARGEST_MOVE = 1000.0, 0.25, 0.30


def capped(df: DataFrame, keys: list[str], size: str, alias: str = "weight", cap: float = CAP) -> DataFrame:
    """Weights in proportion to size, none above cap; what a capped row gives up is shared by the rest in proportion.

    With at most 1 / cap rows all weigh the same. Each pass caps the rows above; a row can only be capped while it holds more
    than cap of what is left, so fewer than 1 / cap rows ever are, and that many passes of window sums settle it.
    """
    w = W.partitionBy(*keys)
    x = df.withColumn("__n", F.count("*").over(w)).withColumn("__fixed", F.lit(False))
    free = lambda: F.sum(F.when(~F.col("__fixed"), F.col(size)).otherwise(0.0)).over(w)
    left = lambda: 1 - cap * F.sum(F.col("__fixed").cast("int")).over(w)
    for _ in range(int(1 / cap) - 1):
        x = x.withColumn("__free", free()).withColumn("__left", left())
        x = x.withColumn("__fixed", F.col("__fixed") | (F.col(size) / F.col("__free") * F.col("__left") > cap))
    x = x.withColumn("__free", free()).withColumn("__left", left())
    weight: Column = F.when(F.col("__n") * cap <= 1, 1 / F.col("__n")).when(F.col("__fixed"), F.lit(cap)).otherwise(F.col(size) / F.col("__free") * F.col("__left"))
    return x.withColumn(alias, weight).drop("__n", "__fixed", "__free", "__left")


def chain_index(bars: DataFrame, calendar: DataFrame, members: DataFrame, anchors: DataFrame | None = None, cap: float = CAP) -> DataFrame:
    """Daily index bars of each group.

    bars (id, d, open, high, low, close, volume, trade_value), calendar (d), members (group, id, shares), anchors (group, level).
    A constituent takes part on a day when it has bars on this and the calendar's previous day, shares, and a move of at most
    LARGEST_MOVE. Days without any give no row and carry the level. Only what is returned is rounded, not the level.
    """
    days = calendar.select("d").distinct().withColumn("before", F.lag("d").over(W.partitionBy(F.lit(0)).orderBy("d")))
    prior = bars.select(F.col("id").alias("p_id"), F.col("d").alias("p_d"), F.col("close").alias("prior"))
    x = bars.join(F.broadcast(days), "d").join(prior, (F.col("id") == F.col("p_id")) & (F.col("before") == F.col("p_d")))
    x = x.join(members, "id").filter((F.col("prior") > 0) & (F.col("shares") > 0) & (F.round(F.abs(F.col("close") / F.col("prior") - 1), 10) <= LARGEST_MOVE))
    x = capped(x.withColumn("size", F.col("prior") * F.col("shares")), ["group", "d"], "size", cap=cap)
    factor = lambda c: F.sum(F.col("weight") * F.col(c) / F.col("prior")).alias(f"f_{c}")
    daily = x.groupBy("group", "d").agg(*(factor(c) for c in ("open", "high", "low", "close")), F.sum("volume").alias("volume"), F.sum("trade_value").alias("trade_value"))
    run = W.partitionBy("group").orderBy("d")
    level = F.exp(F.coalesce(F.sum(F.ln("f_close")).over(run.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    if anchors is not None:
        daily = daily.join(anchors, "group", "left")
        level = level * F.coalesce("level", F.lit(BASE_LEVEL))
    else:
        level = level * BASE_LEVEL
    y = daily.withColumn("at", level)
    o, h, low, c = (F.col("at") * F.col(f"f_{k}") for k in ("open", "high", "low", "close"))
    return y.select("group", "d", o.alias("open"), F.greatest(o, h, low, c).alias("high"), F.least(o, h, low, c).alias("low"), c.alias("close"), "volume", "trade_value")
