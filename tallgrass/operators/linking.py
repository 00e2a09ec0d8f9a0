"""Rules of linking: who may be whose parent, which names are one theme, heads of filings, texts for embeddings, pages of a search."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.functions import text
from tallgrass.operators.vectors import normed

# The least cosine where two items share a company, where neither has one, and else; the least share of members; marks of names.
SHARED, NEITHER, ELSE = 0.10, 0.50, 0.45
COVERAGE = 0.8
BLANK_CHEQUE = ("기업인수목적", "스팩")


def candidates(items: DataFrame, days: int, size: int = 4096) -> DataFrame:
    """(child, parent, cosine) of items (id, day, linked, embedding): the parent is earlier by (day, id), by at most so many days, and its cosine reaches the tier's least.

    Items meet by spans of `days`: a child meets its own span and the one before, so no pair further apart is made. A span's items are
    dealt to blocks of about `size`, and cosines are products of two blocks: a task holds two blocks and the pairs of some rows.
    """
    kind = items.schema["id"].dataType.simpleString()
    # Companies of the parents have a column each, so that those that two items share are counted by a product.
    x = items.select("id", "day", "linked", normed("embedding").alias("v")).filter("id IS NOT NULL AND day IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)").withColumn("span", F.floor(F.col("day") / days))
    counts = x.groupBy("span").agg(F.ceil(F.count("*") / size).alias("blocks"))
    blocks = x.join(counts, "span").groupBy("span", F.pmod(F.xxhash64("id"), "blocks").alias("block")).agg(F.collect_list(F.struct("id", "day", "linked", "v")).alias("m"))
    child = blocks.select("span", F.col("block").alias("c_block"), F.col("m").alias("c"))
    parent = blocks.select(F.explode(F.array(F.col("span"), F.col("span") + 1)).alias("span"), F.col("block").alias("p_block"), F.col("span").alias("p_span"), F.col("m").alias("p"))
    parts = items.sparkSession.sparkContext.defaultParallelism * 4
    names = F.struct("span", "c_block", "p_span", "p_block")
    pairs = child.join(parent, "span").repartition(parts, names).select("c", "p")

    def columns(members):
        ids, day, v = (members.field(n) for n in ("id", "day", "v"))
        return ids, day.to_numpy(zero_copy_only=False).astype(np.int64), members.field("linked"), v.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(v), -1)

    def rows_of(linked, known):
        """Of each row, whether it has each of the companies known, and whether it has none and isn't null."""
        offsets = np.diff(linked.offsets.to_numpy())
        row, at = np.repeat(np.arange(len(linked)), offsets), pc.index_in(linked.flatten(), value_set=known)
        valid = at.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros((len(linked), max(1, len(known))), np.float32)
        out[row[valid], at.drop_null().to_numpy()] = 1
        return out, (offsets == 0) & linked.is_valid().to_numpy(zero_copy_only=False)

    def run(batches):
        for batch in batches:
            for c, p in zip(batch.column("c"), batch.column("p")):
                (c_id, c_day, c_linked, c_v), (p_id, p_day, p_linked, p_v) = columns(c.values), columns(p.values)
                known = pc.unique(p_linked.flatten().drop_null())
                (c_has, c_none), (p_has, p_none) = rows_of(c_linked, known), rows_of(p_linked, known)
                before, after = (pc.rank(pa.chunked_array([p_id, c_id]), tiebreaker="dense").to_numpy().astype(np.int64)[part] for part in (slice(0, len(p_id)), slice(len(p_id), None)))
                for at in range(0, len(c_day), 256):
                    i = slice(at, at + 256)
                    gap = c_day[i, None] - p_day
                    least = np.where(c_has[i] @ p_has.T > 0, SHARED, np.where(c_none[i, None] & p_none, NEITHER, ELSE))
                    cosine = c_v[i] @ p_v.T
                    hit = (gap <= days) & ((gap > 0) | ((gap == 0) & (before < after[i, None]))) & ((cosine >= least) | np.isnan(cosine))
                    a, b = np.nonzero(hit)
                    yield pa.RecordBatch.from_arrays([c_id.take(pa.array(a + at)), p_id.take(pa.array(b)), pa.array(cosine[a, b])], ["child", "parent", "cosine"])

    return pairs.mapInArrow(run, f"child {kind}, parent {kind}, cosine double")


def theme_key(name: Column) -> Column:
    """A theme's name without white space and case."""
    return F.lower(F.regexp_replace(name, r"\s+", ""))


def same_themes(new: DataFrame, existing: DataFrame) -> DataFrame:
    """(name, existing) for each theme of new (name, stocks) that one of existing (name, stocks) is: by its name, or else, where one alone has a parenthesis, by coverage."""
    has, core = lambda c: c.rlike(r"\([^)]*\)"), lambda c: theme_key(F.regexp_replace(c, r"\([^)]*\)", ""))
    a = new.select("name", "stocks", core(F.col("name")).alias("core"))
    b = existing.select(F.col("name").alias("existing"), F.col("stocks").alias("others"), core(F.col("name")).alias("core"))
    x = a.join(b, "core")
    equal = theme_key(F.col("name")) == theme_key(F.col("existing"))
    generic = F.when(has(F.col("name")), F.col("others")).otherwise(F.col("stocks"))
    covered = F.coalesce(F.try_divide(F.size(F.array_intersect("stocks", "others")), F.size(generic)), F.lit(0.0)) >= COVERAGE
    found = x.filter(equal | ((has(F.col("name")) != has(F.col("existing"))) & covered)).withColumn("rank", F.when(equal, 0).otherwise(1))
    return found.groupBy("name").agg(F.min_by("existing", F.struct("rank", "existing")).alias("existing"))


def base_report_name(name: Column) -> Column:
    """A report's name without the tags in square brackets before it; NULL is empty."""
    return F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"^(?:\s*\[[^\]]*\])+", ""))


def is_blank_cheque(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike("|".join(BLANK_CHEQUE))


def error_status(status: Column, message: Column) -> Column:
    """The status of a reply, or else the three digits that its message holds as XML."""
    return F.when(F.coalesce(status, F.lit("")) != "", status).otherwise(F.regexp_extract(F.coalesce(message, F.lit("")), r"<status>\s*(\d{3})\s*</status>", 1))


def theme_text(name: Column, about: Column) -> Column:
    return F.concat(name, F.lit("\n"), F.coalesce(about, F.lit("")))


def reason_text(name: Column, reason: Column) -> Column:
    return F.concat(F.lit("["), name, F.lit("] "), reason)


def node_summary(points: Column, summary: Column) -> Column:
    """The first CHANGE of points (kind, text) that has text, else the first sentence of the summary, else NULL."""
    changes = F.filter(F.transform(F.filter(points, lambda p: p["kind"] == "CHANGE"), lambda p: text.collapsed(F.coalesce(p["text"], F.lit("")))), lambda t: t != "")
    sentence = F.split(text.collapsed(summary), r"(?<=[.!?])\s+")[0]
    return F.coalesce(F.try_element_at(changes, F.lit(1)), F.when(sentence != "", sentence))


def embedding_text(title: Column, summary: Column, titles: Column, most: int) -> Column:
    """The title, the summary where there is one, and the first titles of members, one a line."""
    shown = F.slice(F.filter(F.transform(titles, lambda t: text.collapsed(F.coalesce(t, F.lit("")))), lambda t: t != ""), 1, most)
    head = F.filter(F.array(F.coalesce(text.collapsed(summary), F.lit(""))), lambda t: t != "")
    return F.concat_ws("\n", F.array(text.collapsed(title)), head, shown)


def collected_pages(items: DataFrame, search: str, place: str, link: str, day: str, cutoff: Column, size: int) -> DataFrame:
    """Items of each search, in pages of `size` by place, up to the first page whose last item is older than the cutoff; of a link the first item stays."""
    x = items.withColumn("page", F.floor(F.col(place) / size))
    last = x.groupBy(search, "page").agg(F.max_by(day, place).alias("last"))
    stop = last.filter(F.col("last") < cutoff).groupBy(search).agg(F.min("page").alias("stop"))
    kept = x.join(stop, search, "left").filter(F.col("page") <= F.coalesce("stop", F.col("page")))
    rank = F.row_number().over(W.partitionBy(search, link).orderBy(place))
    return kept.withColumn("first", rank).filter("first = 1").drop("first", "page", "stop")


def canonical(column: Column, names: dict[str, str]) -> Column:
    """Text with every whole name of a small dictionary replaced by its entity's, the longest first, from left to right."""
    pattern = r"(?<![\p{L}\p{N}])(?:" + "|".join(re.escape(n).replace(r"\ ", " ") for n in sorted(names, key=lambda n: (-len(n), n))) + r")(?![\p{L}\p{N}])"
    whole = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    found = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
    between = F.split(column, pattern)
    return F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(F.try_element_at(whole, b), F.lit("")))), "")
