"""Deterministic rules around model verdicts: the verdicts themselves are columns of an input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the rules.
COMPANY, SIGNAL, PARTY = 0.7, 0.55, 0.5
SAME_EVENT_HOURS, CLOSE_HOURS, CLOSE_COSINE = 24, 168, 0.75


def relevant(is_company: Column, has_event: Column, has_driver: Column) -> Column:
    """NULL where a verdict is missing."""
    return (is_company >= COMPANY) & (F.greatest(has_event, has_driver) >= SIGNAL)


def role(is_company: Column, party: Column, others: dict[str, Column]) -> Column:
    """not_company, party, or the likeliest other role; ties go to the role named first."""
    ranked = F.array_max(F.array(*(F.struct(p.alias("p"), F.lit(-i).alias("i"), F.lit(name).alias("name")) for i, (name, p) in enumerate(others.items()))))["name"]
    return F.when(is_company < PARTY, "not_company").when(party >= PARTY, "party").otherwise(ranked)


def escalates(kind: Column, title: Column, cue: str, readable: Column) -> Column:
    """Whether a first verdict needs a second: reactions, events with a report's cue, and unreadable replies."""
    return ~readable | (kind == "market_reaction") | ((kind == "event") & title.rlike(cue))


def relation(gap_hours: Column, cosine: Column, same_votes: Column) -> Column:
    """same_event within a day, or within a week when very similar, or when two voters say so; else follow_up."""
    near = (gap_hours <= SAME_EVENT_HOURS) | ((cosine >= CLOSE_COSINE) & (gap_hours <= CLOSE_HOURS))
    return F.when(near | ((same_votes >= 2) & (gap_hours <= CLOSE_HOURS)), "same_event").otherwise("follow_up")


def parents(votes: DataFrame, child: str) -> DataFrame:
    """(child, parent) of votes (child, candidate, judge, check, pair, rank, votes, cosine, event, start): accepted when judge and check
    pass and either vote does; the parent has the largest (votes, better score, start, candidate)."""
    accepted = F.col("judge") & F.col("check") & (F.col("pair") | F.col("rank"))
    best = F.max(F.when(accepted, F.struct("votes", F.greatest("event", "cosine").alias("score"), "start", "candidate")))
    return votes.groupBy(child).agg(best["candidate"].alias("parent"))


def passes(votes: DataFrame, keys: list[str], accepted: str, least: int) -> DataFrame:
    """(keys, yes, n, passed) of rows with a boolean verdict each."""
    x = votes.groupBy(*keys).agg(F.count_if(F.col(accepted)).alias("yes"), F.count("*").alias("n"))
    return x.withColumn("passed", F.col("yes") >= least)


def valid_triples(triples: DataFrame, relations: list[str], needs_item: list[str]) -> DataFrame:
    """triples with drop_reason: the first rule that a triple (relation, subject, object, item, evidence, sentence) breaks, else NULL."""
    flat = lambda c: F.regexp_replace(F.col(c), r"\s+", "")
    rules = (
        ("unknown_relation", ~F.col("relation").isin(relations)),
        ("same_ends", F.col("subject").eqNullSafe(F.col("object"))),
        ("no_item", F.col("relation").isin(needs_item) & (F.coalesce(F.trim("item"), F.lit("")) == "")),
        ("long_evidence", F.length("evidence") > 200),
        ("not_in_sentence", ~F.coalesce(flat("sentence").contains(flat("evidence")), F.lit(False))),
    )
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(broken, name).otherwise(reason)
    return triples.withColumn("drop_reason", reason)


def as_of_members(members: Column, at: Column) -> Column:
    """Members (at, ...) up to a time; the earliest alone when none is."""
    seen = F.filter(members, lambda m: m["at"] <= at)
    return F.when(F.size(seen) > 0, seen).otherwise(F.slice(F.array_sort(members), 1, 1))


def longest_run(flags: Column) -> Column:
    """The length of the longest run of true in an array."""
    step = F.aggregate(flags, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda s, f: F.struct(F.when(f, s["now"] + 1).otherwise(0).alias("now"), F.greatest(s["most"], F.when(f, s["now"] + 1).otherwise(0)).alias("most")))
    return step["most"]
