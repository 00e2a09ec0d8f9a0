"""Forests and chains: roots by pointer jumping, chain parents, edges of chains, climbs along one kind of edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.sources.landed import settled

def roots(parents: DataFrame, node: str = "node", parent: str = "parent", cut=None) -> DataFrame:
    """(node, root) of each row (node, parent), a NULL or unknown parent making its own root; rounds are logarithmic in the depth.

    cut, a function of DataFrame, cuts the lineage after each round; by default the table is written below the shared folder.
    """
    known = parents.select(F.col(node).alias("__p"))
    x = parents.join(known, F.col(parent) == F.col("__p"), "left").select(F.col(node).alias("node"), F.coalesce("__p", node).alias("root"))
    cut = cut or settled
    x = cut(x)
    while True:
        up = x.select(F.col("node").alias("root"), F.col("root").alias("__up"))
        y = cut(x.join(up, "root").select("node", F.col("__up").alias("root"), (F.col("__up") != F.col("root")).alias("moved")))
        if y.filter("moved").isEmpty():
            return y.select("node", "root")
        x = y.select("node", "root")


def chain_parents(items: DataFrame, owner: str, key: str, day: str, target_day: str, is_correction) -> DataFrame:
    """(key, parent): for each correction, the latest item of the same owner on its target day with a smaller key."""
    base = items.select(F.col(owner).alias("b_owner"), F.col(day).alias("b_day"), F.col(key).alias("b_key"))
    c = items.filter(is_correction)
    near = c.join(base, (F.col(owner) == F.col("b_owner")) & (F.col(target_day) == F.col("b_day")) & (F.col("b_key") < F.col(key)))
    found = near.groupBy(key).agg(F.max("b_key").alias("parent"))
    return items.select(key).join(found, key, "left")


def latest_of_chains(items: DataFrame, chain: DataFrame, key: str, day: str) -> DataFrame:
    """(root, latest, first_day, last_day, length): of each chain (node, root), its latest item and its days."""
    x = items.select(F.col(key).alias("node"), F.col(day).alias("day")).join(chain, "node")
    return x.groupBy("root").agg(F.max_by("node", F.struct("day", "node")).alias("latest"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("length"))


def climbed(items: DataFrame, same: str = "same") -> DataFrame:
    """(node, lead) of items (node, parent, same): the nearest ancestor or self whose edge upward isn't of the same kind."""
    return roots(items.select("node", F.when(F.col(same), F.col("parent")).alias("parent"))).withColumnRenamed("root", "lead")


def best_member(members: DataFrame, group: str, *order) -> DataFrame:
    """The first member of each group in the given order."""
    return members.withColumn("__at", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter("__at = 1").drop("__at")


def edge_diff(stored: DataFrame, wanted: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """What makes stored edges equal to wanted: rows (keys, values, action) to insert, update or delete."""
    s = stored.select(*(F.col(k).alias(f"s_{k}") for k in keys), F.struct(*values).alias("s_values"), F.lit(True).alias("in_s"))
    w = wanted.select(*keys, *values, F.lit(True).alias("in_w"))
    on = [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in keys]
    x = s.join(w, on, "full")
    action = F.when(F.col("in_s").isNull(), "insert").when(F.col("in_w").isNull(), "delete").when(~F.struct(*values).eqNullSafe(F.col("s_values")), "update")
    return x.withColumn("action", action).filter("action IS NOT NULL").select(*(F.coalesce(k, f"s_{k}").alias(k) for k in keys), *values, "action")
