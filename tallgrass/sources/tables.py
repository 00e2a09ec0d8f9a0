"""Readers of landed tables. Every reader selects columns late, so that scans are pruned by Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each user from ticks: (id, d, open, high, low, close, volume, trade_value)."""
    from tallgrass.operators.timeseries import roll_ticks

    ticks = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts", "value")
    return roll_ticks(ticks)


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily unit-price bars of each supplier, a long history: (id, d, open, high, low, close, volume)."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"), F.col("l_shipdate").cast("date").alias("d"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
    )
    at = F.struct("l_orderkey", "l_linenumber", "price")
    return rows.groupBy("id", "d").agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("quantity").cast("long").alias("volume"))
