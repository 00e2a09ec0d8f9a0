"""Registered queries: pages, tables, fixed-width lines, clustering, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import cluster, html, vectors
from tallgrass.sources import landed
from tallgrass.sources.tables import table
from tallgrass.streaming import streams


def q_article_text(spark, d):
    """Title and main text of pages, the text as length and digest."""
    x = html.page_texts(table(spark, d, "pages"), "page_id", "html", "url", "example.com")
    return x.select("page_id", "title", F.length("text").alias("n"), F.sha2("text", 256).alias("digest"))


def q_table_cells(spark, d):
    """Tables with row and column spans filled in, one row a cell."""
    made = F.concat(F.lit("<table><tr><th rowspan=2>"), F.col("p_brand"), F.lit("</th><td colspan=2>"), F.col("p_type"), F.lit("</td></tr><tr><td>"), F.col("p_size").cast("string"), F.lit("<td>x</table>"))
    return html.table_cells(table(spark, d, "part").select("p_partkey", made.alias("html")), "p_partkey", "html").select("p_partkey", "row", "column", "text")


def q_labelled_fields(spark, d):
    """Labels of a table's cells to named fields."""
    made = F.concat(F.lit("<table><tr><td>1. Brand :</td><td>"), F.col("p_brand"), F.lit("</td></tr><tr><td>- Size</td><td>"), F.col("p_size").cast("string"), F.lit("</td><td>Size</td><td>9</td></tr></table>"))
    cells = html.table_cells(table(spark, d, "part").select("p_partkey", made.alias("html")), "p_partkey", "html")
    x = html.labelled_values(cells, "p_partkey", {"Brand": "brand", "Size": "size"})
    return x.select("p_partkey", F.col("fields")["brand"].alias("brand"), F.col("fields")["size"].cast("int").alias("size"))


def q_fixed_width(spark, d):
    """Fixed heads and tails of a line, the name between, short lines left out, and a filter on what was read."""
    p = table(spark, d, "part")
    line = F.concat(F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.rpad("p_brand", 12, " "), F.col("p_name"), F.rpad(F.when(F.col("p_size") % 3 == 0, "ST").otherwise("EF"), 3, " "), F.when(F.col("p_size") % 2 == 0, "Y").otherwise("N"))
    lines = p.select(F.when(F.col("p_size") == 7, "short").otherwise(line).alias("value"))
    x = landed.fixed_tail(lines, {"code": 9, "brand": 12}, "name", {"kind": 3, "preferred": 1})
    return x.filter(landed.collectible(F.col("kind"), F.col("preferred") == "Y", F.lit(False))).select(F.col("code").cast("long").alias("code"), "brand", "name")


def q_paged_rows(spark, d):
    """Pages of one key overlap, the newest page's row stays."""
    o = table(spark, d, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("month"), "o_orderkey")
    return landed.paged_rows(o, ["o_custkey", "month"], "o_orderkey")


def q_online_clusters(spark, d):
    """ST1 W11 M4 M5: online clusters of documents, blocked by source; arrival order gives the time."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("key"), (F.col("doc_id") * 1800.0).alias("epoch"), F.split("text", "\n")[0].alias("title"), F.expr("substr(text, nullif(locate('\\n', text), 0) + 1)").alias("body"), F.col("source").alias("block"))
    return cluster.online_clusters_of_texts(docs, docs.count()).select("key", "cluster", F.round("score", 6).alias("score"))


def q_online_seeds(spark, d):
    """ST1 W11: two runs in order of time, the second of which begins with the clusters that the first has stored; all tokens weigh alike."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("key"), (F.col("doc_id") * 1800.0).alias("epoch"), F.col("source").alias("block"), F.split("text", "\n")[0].alias("title"))
    counts = lambda c: F.aggregate(vectors.tokens(F.coalesce(c, F.lit(""))), F.create_map().cast("map<string,double>"), lambda m, t: F.map_zip_with(m, F.create_map(t, F.lit(1.0)), lambda _, a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))))
    docs = docs.select("key", "epoch", "block", counts(F.col("title")).alias("title"), F.lit(None).cast("map<string,double>").alias("body"), F.lit(None).cast("map<string,double>").alias("entities"))
    n = docs.count()
    middle = docs.agg(F.percentile("key", F.lit(0.5))).first()[0]
    one = landed.settled(cluster.online_step(docs.filter(F.col("key") <= middle), None, "block", {}, n))
    two = landed.settled(cluster.online_step(docs.filter(F.col("key") > middle), cluster.stored(one), "block", {}, n))
    return cluster.assigned(one).unionByName(cluster.assigned(two)).select("key", "cluster", F.round("score", 6).alias("score"))


def _ticks(spark, d):
    return streams.stream_of(spark, d, "events").select(F.col("user_id").alias("id"), "ts", "value")


def _checkpoints(spark):
    return landed.scratch(spark, "stream")


def q_stream_weeks(spark, d):
    """ST6 ST2: weekly bars as a stream on all input there is."""
    return streams.drained(streams.weekly(_ticks(spark, d)), "complete", _checkpoints(spark))


def q_stream_sessions(spark, d):
    """ST8: sessions of users as a stream."""
    x = streams.drained(streams.sessions(_ticks(spark, d)), "complete", _checkpoints(spark))
    return x.select("id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "ticks", F.round("total", 4).alias("total"))


def q_stream_upsert(spark, d):
    """ST9 ST10: a stream merged batch by batch into a table, exactly once."""
    at = _checkpoints(spark)
    rows = _ticks(spark, d).select("id", F.col("ts").cast("date").alias("d"), "value")
    sink = streams.upserting(f"{at}/table", ["id", "d"], {})
    rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start().awaitTermination()
    return streams.newest_version(spark, f"{at}/table")


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

ORACLE_SQL = {
    "q_table_cells": "SELECT p_partkey, row, col AS \"column\", text FROM (SELECT p_partkey, unnest([0, 0, 0, 1, 1, 1]) AS row, unnest([0, 1, 2, 0, 1, 2]) AS col, unnest([p_brand, p_type, p_type, p_brand, p_size::VARCHAR, 'x']) AS text FROM part)",
    "q_labelled_fields": "SELECT p_partkey, p_brand AS brand, p_size AS size FROM part",
    "q_fixed_width": "SELECT p_partkey AS code, p_brand AS brand, p_name AS name FROM part WHERE p_size % 3 = 0 AND p_size % 2 = 1 AND p_size <> 7",
    "q_paged_rows": "SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2",
    "q_stream_weeks": "SELECT user_id AS id, date_trunc('week', ts)::DATE AS base_date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS volume FROM events GROUP BY 1, 2",
    "q_stream_sessions": "WITH g AS (SELECT user_id, ts, value, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g) SELECT user_id AS id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS ticks, round(sum(value), 4) AS total FROM s GROUP BY user_id, n",
    "q_stream_upsert": "SELECT user_id AS id, ts::DATE AS d, max(value) AS value FROM events GROUP BY 1, 2",
}
