"""Sinks as pure merges: target and incoming tables to the new target, by key and policy, each running twice to the same result.

A policy names for each column who wins: `new` (incoming), `fill` (incoming unless NULL), `keep` (stored unless NULL),
`least`, `greatest`, `union` (ordered set of array elements). Rows of one side only pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_POLICY = {
    "new": lambda old, new: new,
    "fill": lambda old, new: F.coalesce(new, old),
    "keep": lambda old, new: F.coalesce(old, new),
    "least": lambda old, new: F.least(old, new),
    "greatest": lambda old, new: F.greatest(old, new),
    "union": lambda old, new: F.array_union(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>"))),
}


def last_wins(df: DataFrame, keys: list[str], arrival: Column) -> DataFrame:
    """Of rows that share a key, the one that arrived last."""
    return df.withColumn("__at", F.row_number().over(W.partitionBy(*keys).orderBy(arrival.desc()))).filter("__at = 1").drop("__at")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__at", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__at = 1").drop("__at")


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], policy: dict[str, str]) -> DataFrame:
    """target with incoming merged in; columns without a policy are overwritten. One full outer join on the keys."""
    t, n = target.withColumn("__old", F.lit(True)).alias("t"), incoming.withColumn("__new", F.lit(True)).alias("n")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    both = t.join(n, on, "full")
    out = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"n.{c}") if c in incoming.columns else None
        if new is None:
            out.append(old.alias(c))
        elif c in keys:
            out.append(F.coalesce(old, new).alias(c))
        else:
            merged = _POLICY[policy.get(c, "new")](old, new)
            out.append(F.when(F.col("t.__old").isNull(), new).when(F.col("n.__new").isNull(), old).otherwise(merged).alias(c))
    return both.select(*out)


def changed(target: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of merged that are new or differ from target: what a change guard would write."""
    values = [c for c in merged.columns if c not in keys]
    t = target.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*values).alias("__old"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return merged.join(t, on, "left").filter(~F.struct(*values).eqNullSafe(F.col("__old"))).select(*merged.columns)


def insert_absent(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """target and those incoming rows, one a key, whose key it lacks."""
    fresh = incoming.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def deactivate_missing(target: DataFrame, snapshot: DataFrame, keys: list[str], stamp: str, now: Column) -> DataFrame:
    """Rows whose key the snapshot lacks get the stamp, unless they have one; rows that are back lose it."""
    seen = snapshot.select(*keys).distinct().withColumn("__seen", F.lit(True))
    x = target.join(seen, keys, "left")
    return x.withColumn(stamp, F.when(F.col("__seen").isNull(), F.coalesce(F.col(stamp), now))).drop("__seen")


def replace_slice(target: DataFrame, incoming: DataFrame, in_slice: Column, guard: bool = True) -> DataFrame:
    """target with the rows of a slice replaced by incoming. With guard, an empty incoming leaves target as it is."""
    if guard and incoming.isEmpty():
        return target
    return target.filter(~F.coalesce(in_slice, F.lit(False))).unionByName(incoming.select(*target.columns))


def replace_guarded(target: DataFrame, incoming: DataFrame, least_share: float = 0.5) -> DataFrame:
    """incoming as a full replacement; raises when it has less than the share of target's rows."""
    old, new = target.count(), incoming.count()
    if new < old * least_share:
        raise ValueError(f"{new} rows would replace {old}")
    return incoming


def compare_and_set(target: DataFrame, incoming: DataFrame, keys: list[str], column: str) -> DataFrame:
    """column of target set from incoming only where it is NULL."""
    x = incoming.select(*keys, F.col(column).alias("__new")).dropDuplicates(keys)
    return target.join(x, keys, "left").withColumn(column, F.coalesce(F.col(column), F.col("__new"))).select(*target.columns)


def overwrite(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Writes a merged table; with partition, only the partitions that df holds are replaced."""
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.parquet(path)
