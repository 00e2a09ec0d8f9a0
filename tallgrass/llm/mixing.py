"""Mixing of sources to target weights by subset-sum fitting over exact lengths.

Sources in code-point order, null last, weigh WEIGHTS in turn, and share a budget of words. A source's target stops at a cap,
a multiple of its size; the excess goes to the others by weight until none is above. A source takes all its documents
as often as its target holds its size in full. For the rest of the target, documents are counted by exact length; lengths
are sampled in proportion to their counts, and a bounded-knapsack dynamic program over the counts left fits what is then missing.
Documents of a length are chosen by a seeded hash.

All per-document work is on (key, source, length) rows. The largest groups, those of one source and length, are dealt into
buckets by the same hash before they are ranked, so no task sees more of a group than a few hundred rows on average.

Null or empty text: length 0, never worth taking, taken 0. Very long texts are lengths like others. Each row counts by itself,
also where ids repeat or are null. An empty table gives no rows; a table without words gives targets of 0. Extra columns are not
read, and mix() returns the columns of its input, whatever their names. Reruns agree, since hash, order and fitting depend on the rows alone.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.llm.common import keyed, quoted, written

WEIGHTS, SHARE_PERCENT, MOST_TIMES, SEED = (3, 1, 2), 150, 2, 20_231
#: Rows of one source and length that a bucket holds on average.
BUCKET = 256
#: Words that the dynamic program fits at once; what exceeds them is first taken in documents, longest first.
FIT = 1 << 15


def size_of(text_col: str):
    return F.coalesce(F.regexp_count(quoted(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most_times: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources are taken by cap / weight, smallest first: those reach their caps first, and the rest shares by weight what is left.
    """
    everything, by_name = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    x = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(most_times))
    x = x.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share_percent) / F.lit(100))
    filled = W.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    x = x.withColumn("below", F.sum("cap").over(filled.rowsBetween(W.unboundedPreceding, -1)))
    x = x.withColumn("open", F.sum("weight").over(filled.rowsBetween(0, W.unboundedFollowing)))
    # The share of one unit of weight once all below are at their caps; the first source whose cap isn't reached sets it for the rest.
    x = x.withColumn("unit", (F.col("budget") - F.coalesce("below", F.lit(0))) / F.col("open"))
    x = x.withColumn("is_open", F.col("unit") * F.col("weight") < F.col("cap"))
    x = x.withColumn("level", F.first(F.when(F.col("is_open"), F.col("unit")), ignorenulls=True).over(filled.rowsBetween(W.unboundedPreceding, 0)))
    return x.select("source", "source_size", F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")).alias("target"))


def sampled(counts: dict[int, int], wanted: int, seed: int = SEED) -> dict[int, int]:
    """How many of each length a systematic sample takes: documents in order of length, evenly spaced, about wanted words."""
    total = sum(size * n for size, n in counts.items())
    take, upto, at = {}, 0, random.Random(seed).randrange(max(1, total))
    for size in sorted(counts):
        before, upto = upto, upto + counts[size]
        take[size] = (upto * wanted + at) // total - (before * wanted + at) // total if total else 0
    return take


def reachable(spare: list[tuple[int, int]], wanted: int) -> tuple[dict[int, int], int]:
    """Of (length, count), how many of each to take so that the total is nearest to wanted, ties going to the smaller total; and the total.

    Sums reachable with the lengths so far are the bits of a number; a length's count is split in powers of two. Among ways to one
    total, lengths that come first in spare are taken first.
    """
    take = {size: 0 for size, _ in spare}
    bound = wanted + max([size for size, _ in spare if size <= wanted] or [0]) + 1
    reach, steps = 1, []
    for size, n in spare:
        n, power = min(n, bound // size), 1
        while n and size < bound:
            part = min(power, n)
            steps.append((size, part, reach))
            reach |= reach << size * part & (1 << bound) - 1
            n -= part
            power *= 2
        if reach >> wanted & 1:
            break
    low = wanted
    while not reach >> low & 1:
        low -= 1
    high = wanted
    while high < bound and not reach >> high & 1:
        high += 1
    goal = high if high < bound and high - wanted < wanted - low else low
    longer = min((size for size, _ in spare if size >= bound), default=None)  # too long to combine, maybe nearest alone
    if longer is not None and longer - wanted < abs(goal - wanted):
        take[longer] = 1
        return take, longer
    total = goal
    for size, part, before in reversed(steps):
        if not before >> goal & 1:
            take[size] += part
            goal -= size * part
    return take, total


def fit(counts: dict[int, int], wanted: int, seed: int = SEED) -> dict[int, int]:
    """How many of each length to take, at most counts of it, so that the total comes near to wanted.

    The sample of lengths settles all but about one document's words, at every size. What is missing is fitted by the dynamic program, which
    tries lengths in seeded order, so that short ones aren't preferred. While it meets the total not exactly, the sample
    gives back more and more of its documents, up to FIT words, and they are fitted anew.
    """
    wanted = max(0, min(wanted, sum(size * n for size, n in counts.items())))
    take = sampled(counts, wanted, seed)
    left = wanted - sum(size * n for size, n in take.items())
    while left < 0:  # a sample that is too large gives back the shortest document that suffices, or else its longest
        held = [size for size in counts if take[size]]
        size = min((size for size in held if size >= -left), default=max(held))
        take[size] -= 1
        left += size
    for size in sorted(counts, reverse=True):
        more = min(counts[size] - take[size], (left - FIT) // size + 1, left // size) if left >= FIT else 0
        take[size] += more
        left -= more * size
    order = sorted(counts)
    random.Random(seed).shuffle(order)
    best, nearest, give = take, None, 0
    while True:
        back = given_back(take, order, give)
        more = left + sum(size * n for size, n in back.items())
        added, total = reachable([(size, counts[size] - take[size] + back[size]) for size in order if counts[size] > take[size] - back[size]], more)
        if nearest is None or abs(total - more) < nearest:
            best, nearest = {size: take[size] - back[size] + added.get(size, 0) for size in take}, abs(total - more)
        if nearest == 0 or give > FIT or back == take:
            return best
        give = max(256, 2 * give)


def given_back(take: dict[int, int], order: list[int], words: int) -> dict[int, int]:
    """Documents of take, by length, of at most so many words, as evenly over lengths as order and words allow."""
    back, again = dict.fromkeys(order, 0), True
    while again:
        again = False
        for size in order:
            if back[size] < take[size] and size <= words:
                back[size] += 1
                words -= size
                again = True
    return back


def _fit_group(rows: pd.DataFrame) -> pd.DataFrame:
    counts = dict(zip(rows["size"].tolist(), rows["n"].tolist()))
    total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    whole = int(target // total) if total else 0
    take = fit({s: n for s, n in counts.items() if s > 0}, round(target - whole * total))
    return rows.assign(whole=whole, extra=[take.get(s, 0) for s in counts])[["source", "size", "n", "source_size", "target", "whole", "extra"]]


def _times(sized: DataFrame, seed: int) -> DataFrame:
    """(key, doc_id, size, source_size, target, times) for each row of sized (key, doc_id, source, size), a written table."""
    lengths = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(sizes)
    named = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    asked = lengths.join(named, F.col("source").eqNullSafe(F.col("g_source"))).select("source", "size", "n", "source_size", "target")
    plan = written(asked.groupBy("source").applyInPandas(_fit_group, "source string, size long, n long, source_size long, target double, whole long, extra long"), "plan")

    drawn = F.xxhash64(F.lit(seed), "key")
    bucket = F.pmod(F.shiftright(drawn, 20), F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET)).cast("long"))
    named = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n", "source_size", "target", "whole", "extra")
    dealt = sized.join(named, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    dealt = written(dealt.select("key", "doc_id", "source", "size", "n", "source_size", "target", "whole", "extra", drawn.alias("drawn"), bucket.alias("bucket")), "dealt")
    out = ("key", "doc_id", "size", "source_size", "target")
    settled = dealt.filter("extra = 0 or extra = n").select(*out, (F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).alias("times"))
    torn = dealt.filter("extra > 0 and extra < n")
    held = torn.groupBy("source", "size", "bucket").agg(F.count("*").alias("held"))
    held = held.withColumn("before", F.coalesce(F.sum("held").over(W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    held = held.select(*(F.col(c).alias(f"h_{c}") for c in ("source", "size", "bucket", "before")))
    ranked = torn.withColumn("rank", F.row_number().over(W.partitionBy("source", "size", "bucket").orderBy("drawn", "key")))
    ranked = ranked.join(held, F.col("source").eqNullSafe(F.col("h_source")) & (F.col("size") == F.col("h_size")) & (F.col("bucket") == F.col("h_bucket")))
    chosen = ranked.select(*out, (F.col("whole") + F.when(F.col("h_before") + F.col("rank") <= F.col("extra"), 1).otherwise(0)).alias("times"))
    return settled.unionByName(chosen)


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(key, doc_id, size, source_size, target, times) for each row of docs; times is how often the mix takes it."""
    return _counted(keyed(docs, id_col, text_col), source_col, seed)


def _counted(rows: DataFrame, source_col: str, seed: int) -> DataFrame:
    source = F.col("row")[source_col].cast("string").alias("source")
    return _times(written(rows.select("key", F.col("id").alias("doc_id"), source, size_of("text").alias("size")), "sizes"), seed)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs."""
    rows = keyed(docs, id_col, text_col)
    times = _counted(rows, source_col, seed).filter("times > 0").select("key", F.sequence(F.lit(1).cast("long"), "times").alias("copies"))
    return rows.select("key", "row").join(times, "key").select("row", F.explode("copies")).select("row.*")


def op3_mix(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: for each, its size, its source's size and target, and the words taken."""
    found = mix_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))
