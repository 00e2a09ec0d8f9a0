"""Names to entities: alias tables, unique resolution, nearest matches, dictionary matches in text, URL and theme duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.sources.landed import settled

from tallgrass.functions.text import hides_name, name_forms, name_key, names_several


def resolved(names: DataFrame, name: str, registry: DataFrame, aliases: DataFrame) -> DataFrame:
    """names with entity, rule and source; NULL where hidden, several, unknown or ambiguous.

    registry (entity, code, label, listed), aliases (alias, entity). Forms are tried in order, and for each form listed names,
    all names, aliases. A key that names more than one code in registry and aliases together resolves to nothing.
    """
    own = registry.select(name_key("label").alias("key"), "entity", "code", F.when(F.col("listed"), 0).otherwise(1).alias("source"))
    other = aliases.join(registry.select("entity", "code"), "entity").select(name_key("alias").alias("key"), "entity", "code", F.lit(2).alias("source"))
    keys = own.unionByName(other).groupBy("key").agg(F.count_distinct("code").alias("codes"), F.min(F.struct("source", "entity")).alias("at")).filter("codes = 1")
    asked = names.select(name).distinct().filter(~hides_name(F.col(name)) & ~names_several(F.col(name)))
    forms = asked.select(name, F.posexplode(name_forms(F.col(name))).alias("place", "f")).select(name, "place", "f.rule", name_key("f.form").alias("key")).filter("key <> ''")
    best = forms.join(keys, "key").groupBy(name).agg(F.min_by(F.struct(F.col("at.entity").alias("entity"), "rule", F.element_at(F.array(F.lit("listed"), F.lit("all"), F.lit("alias")), F.col("at.source") + 1).alias("source")), "place").alias("hit"))
    return names.join(best, name, "left").select(*names.columns, "hit.entity", "hit.rule", "hit.source")


def single_owner(candidates: DataFrame) -> DataFrame:
    """(alias, entity) of candidates (alias, entity, priority): the owner with the least priority, none if two share it."""
    per = candidates.groupBy("alias", "entity").agg(F.min("priority").alias("priority"))
    least = per.groupBy("alias").agg(F.min("priority").alias("priority"))
    won = per.join(least, ["alias", "priority"])
    return won.groupBy("alias").agg(F.min("entity").alias("entity"), F.count("*").alias("n")).filter("n = 1").select("alias", "entity")


def nearest(asked: DataFrame, known: DataFrame, key: str, day: str, most_days: int, label: str) -> DataFrame:
    """asked with label of the known row of the same key whose day is nearest within most_days; ties to the smaller label."""
    k = known.select(F.col(key).alias("k_key"), F.col(day).alias("k_day"), F.col(label).alias("k_label"))
    a = asked.withColumn("__row", F.struct(*asked.columns))
    near = a.join(k, (F.col(key) == F.col("k_key")) & (F.abs(F.datediff("k_day", day)) <= most_days))
    best = near.groupBy("__row").agg(F.min(F.struct(F.abs(F.datediff("k_day", day)).alias("off"), "k_label")).alias("m")).select("__row", F.col("m.k_label").alias(label))
    return a.join(best, "__row", "left").select(*asked.columns, label)


_MATCHES = "array<struct<text:string,start:int,stop:int,entity:long>>"


def matches(texts: DataFrame, key: str, text: str, aliases: list[tuple[str, int]]) -> DataFrame:
    """(key, matches): longest, leftmost, non-overlapping, case-sensitive matches of a dictionary in whole texts.

    The dictionary is a parameter, bounded by its caller; each task builds its automaton once.
    """
    ordered = sorted(dict(aliases).items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for alias, entity in ordered:
            found.add_word(alias, (alias, entity))
        if ordered:
            found.make_automaton()
        for batch in batches:
            out = []
            for t in batch[text].fillna(""):
                hits = sorted(((end - len(a) + 1, -len(a), a, e) for end, (a, e) in found.iter(t)), key=lambda h: h[:2]) if ordered else []
                kept, last = [], 0
                for start, minus, alias, entity in hits:
                    if start >= last:
                        last = start - minus
                        kept.append({"text": alias, "start": start, "stop": last, "entity": entity})
                out.append(kept)
            yield pd.DataFrame({key: batch[key], "matches": out})

    return texts.select(key, text).mapInPandas(run, f"{key} {texts.schema[key].dataType.simpleString()}, matches {_MATCHES}")


def url_survivors(items: DataFrame, key: str, urls: Column) -> DataFrame:
    """(key, survivor): items that share a URL, directly or through others, belong to the one with the smallest key."""
    pairs = items.select(key, F.explode(F.array_distinct(F.filter(urls, lambda u: u != ""))).alias("url"))
    first = pairs.groupBy("url").agg(F.min(key).alias("b"))
    edges = pairs.join(first, "url").select(F.col(key).alias("a"), "b").filter("a <> b")  # repeated edges do no harm; an item's edge to itself tells nothing
    both = settled(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = settled(items.select(F.col(key).alias("node"), F.col(key).alias("label")))
    while True:  # labels jump to their labels' labels, so rounds grow with the logarithm of the longest path
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("hop"))
        step = settled(step.join(hop, "label", "left").select("node", "old", F.least("label", "hop").alias("label")))
        if step.filter("old <> label").isEmpty():
            return step.select(F.col("node").alias(key), F.col("label").alias("survivor"))
        labels = step.select("node", "label")


def merged_themes(themes: DataFrame) -> DataFrame:
    """One row a name of themes (name, place, members, reason): members united in order, the longest reason, ties to the first."""
    one = themes.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "members"))).alias("m"), F.max_by("reason", F.struct(F.length("reason"), -F.col("place"))).alias("reason"))
    return one.select("name", F.array_distinct(F.flatten(F.transform("m", lambda x: x["members"]))).alias("members"), "reason")


def first_of(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without repetition by trimmed columns; rows that are blank in all of them go."""
    x = df.filter(F.concat_ws("", *(F.trim(c) for c in columns)) != "").withColumns({f"__{c}": F.trim(c) for c in columns})
    return x.withColumn("__at", F.row_number().over(W.partitionBy(*(f"__{c}" for c in columns)).orderBy(*df.columns))).filter("__at = 1").select(*df.columns)
