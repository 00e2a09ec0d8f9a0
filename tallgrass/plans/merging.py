"""Registered queries: merge policies, semi and anti joins, guards and queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import merge
from tallgrass.sources.tables import event_bars, table

_BARS = "bars AS (SELECT user_id AS id, CAST(ts AS DATE) AS d, arg_max(value, ts) AS close, count(*) AS volume, sum(value) AS tv FROM events GROUP BY 1, 2)"


def _old_new_bars(spark, d):
    b = event_bars(spark, d).select("id", "d", "close", "volume", F.round("trade_value", 4).alias("tv"))
    old = b.filter("dayofmonth(d) <= 20")
    new = b.filter("dayofmonth(d) >= 10").withColumn("close", F.col("close") + 1).withColumn("tv", F.when(F.col("volume") % 2 == 0, F.col("tv") * 2))
    return old, new


def q_upsert_bars(spark, d):
    """K1 K2 K5 K6: incoming overwrites, but a NULL trade value leaves the stored one."""
    old, new = _old_new_bars(spark, d)
    return merge.upsert(old, new, ["id", "d"], {"tv": "fill"}).select("id", "d", "close", "volume", F.round("tv", 4).alias("tv"))


def q_changed_rows(spark, d):
    """Rows that a change guard would write, struct compared without regard to NULL."""
    old, new = _old_new_bars(spark, d)
    same = event_bars(spark, d).select("id", "d", F.col("close").alias("as_before"))
    new = new.join(same, ["id", "d"]).select("id", "d", F.when(F.col("id") % 2 == 0, F.col("as_before")).otherwise(F.col("close")).alias("close"), "volume", F.lit(None).cast("double").alias("tv"))
    merged = merge.upsert(old, new, ["id", "d"], {"tv": "fill"})
    return merge.changed(old, merged, ["id", "d"]).select("id", "d", F.round("close", 6).alias("close"), "volume")


def q_last_wins(spark, d):
    """In a batch with repeated keys the last arrival wins."""
    o = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    x = merge.last_wins(o, ["l_orderkey", "l_linenumber"], F.struct("l_partkey", "l_suppkey", "l_extendedprice"))
    return x


def q_insert_absent(spark, d):
    """Rows are inserted where the key is absent, and stored ones stay."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", F.lit("stored").alias("origin"))
    old = o.filter("o_custkey % 3 = 0").select("o_custkey", "o_orderpriority", "origin").distinct()
    new = o.filter("o_custkey % 2 = 0").withColumn("origin", F.lit("new"))
    return merge.insert_absent(old, new, ["o_custkey", "o_orderpriority"])


def q_deactivate(spark, d):
    """Customers absent from the order snapshot become inactive; a stamp that is there stays."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.lit("2020-01-01").cast("date")).alias("inactive_at"))
    snap = table(spark, d, "orders").filter("o_orderdate >= '2001-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return merge.deactivate_missing(c, snap, ["c_custkey"], "inactive_at", F.lit("2024-01-31").cast("date")).select("c_custkey", "inactive_at")


def q_union_sources(spark, d):
    """An upsert that unites ordered sources and keeps the stored description."""
    p = table(spark, d, "part")
    old = p.filter("p_size <= 25").groupBy("p_brand").agg(F.sort_array(F.collect_set("p_type")).alias("sources"), F.min("p_name").alias("about"))
    new = p.filter("p_size > 20").groupBy("p_brand").agg(F.sort_array(F.collect_set("p_name")).alias("sources"), F.max("p_name").alias("about"))
    x = merge.upsert(old, new, ["p_brand"], {"sources": "union", "about": "keep"})
    return x.select("p_brand", F.array_join("sources", "|").alias("sources"), "about")


def q_replace_range(spark, d):
    """The slice of a range is deleted and inserted anew, other rows stay."""
    b = event_bars(spark, d).select("id", "d", "close")
    inside = F.col("d").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-15").cast("date"))
    return merge.replace_slice(b, b.filter(inside & (F.col("id") % 2 == 0)).withColumn("close", F.col("close") * 2), inside)


def q_replace_empty(spark, d):
    """An empty incoming table leaves the stored rows alone."""
    b = event_bars(spark, d).select("id", "d", "close")
    return merge.replace_slice(b, b.filter("id < 0"), F.lit(True))


def q_fill_profile(spark, d):
    """New values fill in, missing ones leave the stored."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))
    new = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.min("o_orderstatus") == "F", F.min("o_orderpriority")).alias("c_mktsegment"))
    stored = new.join(c.select("c_custkey"), "c_custkey", "left_semi")
    return merge.upsert(c, stored, ["c_custkey"], {"c_mktsegment": "fill"})


def q_attach_codes(spark, d):
    """Attach by name where it names one supplier only, else by key."""
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("n"), (F.col("s_suppkey") % 70).cast("string")).alias("name"))
    unique = s.groupBy("name").agg(F.count("*").alias("n"), F.min("s_suppkey").alias("by_name")).filter("n = 1").select("name", "by_name")
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("n"), (F.col("c_custkey") % 90).cast("string")).alias("name"))
    key = s.select(F.col("s_suppkey").alias("by_key"))
    return c.join(unique, "name", "left").join(key, F.col("c_custkey") == F.col("by_key"), "left").select("c_custkey", F.coalesce("by_name", "by_key").alias("s_suppkey"))


def q_mark_delisted(spark, d):
    """Anti join and stamp with a change guard; the rows that change."""
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") > 5).alias("listed"))
    sold = table(spark, d, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey")).distinct()
    gone = p.join(sold, "p_partkey", "left_anti").filter("listed").select("p_partkey", F.lit(False).alias("listed"))
    back = p.filter("NOT listed").join(sold, "p_partkey", "left_semi").select("p_partkey", F.lit(True).alias("listed"))
    return gone.unionByName(back)


def q_map_merge(spark, d):
    """Shallow merge of two maps, the new side winning, without the duplicate-key error."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("event_type", F.lit(1))))).alias("old"), F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("value") > 60, F.struct("event_type", F.lit(2)))))).alias("new"))
    both = F.map_zip_with("old", "new", lambda k, a, b: F.coalesce(b, a))
    return e.select("user_id", F.array_join(F.transform(F.array_sort(F.map_entries(both)), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",").alias("merged"))


def q_search_watermarks(spark, d):
    """K27 S20 ST3 ST5: per-key watermarks move by greatest; rows older than their key's watermark are dropped, undated ones stay."""
    e = table(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("ts"))
    marks = e.filter("event_id < 3000").groupBy("user_id").agg(F.max("ts").alias("seen"))
    late = F.greatest(F.col("seen"), F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    x = e.filter("event_id >= 2500").join(marks, "user_id", "left").filter(F.col("ts").isNull() | (F.col("ts") >= F.coalesce(late, F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))))
    return x.select("event_id", "user_id")


def q_due(spark, d):
    """ST4: users that are due: never seen, or last seen at least 6 hours less slack before the run; one row each."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last"))
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return e.filter(F.col("last").isNull() | (F.col("last") <= now - F.expr("INTERVAL '5:55' HOUR TO MINUTE"))).select("user_id")


def q_queue_unprocessed(spark, d):
    """Readiness: blank-free name and (enough stock, or the deadline passed); oldest first within a cap by key."""
    p = table(spark, d, "part").withColumn("note", F.when(F.col("p_size") % 7 == 0, F.lit("  ")).otherwise(F.col("p_name")))
    ready = (F.trim("note") != "") & ((F.col("p_retailprice") > 1500) | (F.col("p_size") >= 40))
    return p.filter(ready).select("p_partkey", "note", (F.col("p_size") >= 40).alias("by_deadline"))


def q_keyset_page(spark, d):
    """Rows before a (date, key) cursor in descending order, one page."""
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d"), "o_orderkey")
    before = F.struct("d", "o_orderkey") < F.struct(F.lit("1999-06-01").cast("date"), F.lit(5000).cast("long"))
    return o.filter(before).orderBy(F.desc("d"), F.desc("o_orderkey")).limit(30)


def q_cache_hits(spark, d):
    """A response cache keyed by content: hits by digest, first writer wins, the rest are requests to make once."""
    m = table(spark, d, "conversations").select("conv_id", "turn", F.sha2(F.concat_ws("|", "role", "text"), 256).alias("key"))
    cache = m.filter("turn = 0").groupBy("key").agg(F.min("conv_id").alias("writer"))
    return m.join(cache, "key", "left").groupBy("turn").agg(F.count_if(F.col("writer").isNotNull()).alias("hits"), F.count_distinct(F.when(F.col("writer").isNull(), F.col("key"))).alias("requests"))


def q_pair_list(spark, d):
    """Closes for a list of (entity, date) pairs given as arrays."""
    b = event_bars(spark, d).select("id", "d", "close")
    pairs = spark.range(1).select(F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(149)).alias("id"), F.transform(F.sequence(F.lit(0), F.lit(149)), lambda i: F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int"))).alias("d"))).alias("p")).select("p.id", "p.d")
    return b.join(pairs, ["id", "d"]).select("id", "d", "close")


def q_semi_anti(spark, d):
    """Customers with an order of this year and none before, keys split into found and new."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey")
    late, early = o.filter("o_orderdate >= '2000-06-01'").select(F.col("o_custkey").alias("c_custkey")), o.filter("o_orderdate < '1996-06-01'").select(F.col("o_custkey").alias("c_custkey"))
    found = c.join(late, "c_custkey", "left_semi")
    return found.join(early, "c_custkey", "left_anti").withColumn("state", F.lit("new")).unionByName(found.join(early, "c_custkey", "left_semi").withColumn("state", F.lit("found")))


def q_role_join(spark, d):
    """One dimension in two roles: nations of customer and supplier of each order line, by nation pair."""
    li, o = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice"), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c, s, n = table(spark, d, "customer").select("c_custkey", "c_nationkey"), table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), table(spark, d, "nation")
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    x = x.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    cn, sn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("buyer")), n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller"))
    return x.join(cn, "c_nationkey").join(sn, "s_nationkey").select("buyer", "seller", "lines", "revenue")


def q_full_outer(spark, d):
    """Two feeds by month, matched where both have it."""
    o = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("ym")).agg(F.count("*").alias("orders"))
    e = table(spark, d, "events").groupBy(F.date_format("ts", "yyyyMM").alias("ym")).agg(F.count("*").alias("events"))
    return o.join(e, "ym", "full").select("ym", "orders", "events")


def q_optional_filter(spark, d, ids=(1, 2, 3, 5, 8)):
    """an optional list of keys; none means all."""
    x = table(spark, d, "supplier").select("s_suppkey", "s_name")
    return x.filter(F.col("s_suppkey").isin(list(ids))) if ids is not None else x


def q_reason_case(spark, d):
    """F16: why a customer has no current order."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"), F.count_if(F.col("o_orderstatus") == "O").alias("open"))
    c = table(spark, d, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    reason = F.when(F.col("last").isNull(), "no orders").when(F.col("open") == 0, "none open").when(F.col("last") < F.lit("2001-01-01"), "stale").otherwise("current")
    return c.select("c_custkey", reason.alias("reason"))


def q_monotone_edges(spark, d):
    """First and last times of an edge move outward only."""
    a = table(spark, d, "events").filter("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    b = table(spark, d, "events").filter("event_id % 2 = 1").groupBy("user_id", "event_type").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return merge.upsert(a, b, ["user_id", "event_type"], {"first": "least", "last": "greatest"})


def q_compare_and_set(spark, d):
    """A representative is set only where there is none."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_name")).alias("title"))
    new = table(spark, d, "part").filter("p_size % 2 = 0").select("p_partkey", F.upper("p_name").alias("title"))
    return merge.compare_and_set(p, new, ["p_partkey"], "title")


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_M = f"WITH {_BARS}, o AS (SELECT id, d, close, volume, round(tv, 4) AS tv FROM bars WHERE day(d) <= 20), n AS (SELECT id, d, close + 1 AS close, volume, CASE WHEN volume % 2 = 0 THEN round(tv, 4) * 2 END AS tv FROM bars WHERE day(d) >= 10)"
ORACLE_SQL = {
    "q_upsert_bars": _M + " SELECT id, d, coalesce(n.close, o.close) AS close, coalesce(n.volume, o.volume) AS volume, round(coalesce(n.tv, o.tv), 4) AS tv FROM o FULL JOIN n USING (id, d)",
    "q_changed_rows": f"WITH {_BARS} SELECT id, d, round(close + CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END, 6) AS close, volume FROM bars WHERE day(d) >= 10 AND (day(d) > 20 OR id % 2 <> 0)",
    "q_last_wins": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1",
    "q_insert_absent": "WITH o AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) SELECT o_custkey, o_orderpriority, CASE WHEN o_custkey % 3 = 0 THEN 'stored' ELSE 'new' END AS origin FROM o WHERE o_custkey % 3 = 0 OR o_custkey % 2 = 0",
    "q_deactivate": "SELECT c_custkey, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '2001-01-01') THEN CASE WHEN c_custkey % 4 = 0 THEN DATE '2020-01-01' ELSE DATE '2024-01-31' END END AS inactive_at FROM customer",
    "q_union_sources": "WITH o AS (SELECT p_brand, list_sort(list(DISTINCT p_type)) AS s, min(p_name) AS a FROM part WHERE p_size <= 25 GROUP BY 1), n AS (SELECT p_brand, list_sort(list(DISTINCT p_name)) AS s, max(p_name) AS a FROM part WHERE p_size > 20 GROUP BY 1) SELECT p_brand, array_to_string(list_concat(coalesce(o.s, []), list_filter(coalesce(n.s, []), lambda x: NOT list_contains(coalesce(o.s, []), x))), '|') AS sources, coalesce(o.a, n.a) AS about FROM o FULL JOIN n USING (p_brand)",
    "q_replace_range": f"WITH {_BARS} SELECT id, d, CASE WHEN d BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' THEN close * 2 ELSE close END AS close FROM bars WHERE NOT (d BETWEEN DATE '2024-01-10' AND DATE '2024-01-15') OR id % 2 = 0",
    "q_replace_empty": f"WITH {_BARS} SELECT id, d, close FROM bars",
    "q_fill_profile": "SELECT c_custkey, coalesce(n.s, c_mktsegment) AS c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN min(o_orderstatus) = 'F' THEN min(o_orderpriority) END AS s FROM orders GROUP BY 1) n ON o_custkey = c_custkey",
    "q_attach_codes": "WITH s AS (SELECT s_suppkey, 'n' || (s_suppkey % 70) AS name FROM supplier), u AS (SELECT name, min(s_suppkey) AS k FROM s GROUP BY 1 HAVING count(*) = 1) SELECT c_custkey, coalesce(u.k, s.s_suppkey) AS s_suppkey FROM customer c LEFT JOIN u ON u.name = 'n' || (c_custkey % 90) LEFT JOIN s ON s.s_suppkey = c_custkey",
    "q_mark_delisted": "WITH p AS (SELECT p_partkey, p_size > 5 AS listed, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) AS sold FROM part) SELECT p_partkey, sold AS listed FROM p WHERE listed <> sold",
    "q_map_merge": "SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS merged FROM (SELECT user_id, event_type, CASE WHEN max(value) > 60 THEN 2 ELSE 1 END AS n FROM events GROUP BY 1, 2) GROUP BY 1",
    "q_search_watermarks": "WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts FROM events), m AS (SELECT user_id, max(ts) AS seen FROM e WHERE event_id < 3000 GROUP BY 1) SELECT event_id, user_id FROM e LEFT JOIN m USING (user_id) WHERE event_id >= 2500 AND (ts IS NULL OR ts >= greatest(coalesce(seen, TIMESTAMP '2024-01-08'), TIMESTAMP '2024-01-08'))",
    "q_due": "SELECT user_id FROM (SELECT user_id, max(ts) FILTER (event_type = 'purchase') AS last FROM events GROUP BY 1) WHERE last IS NULL OR last <= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL '5 hours 55 minutes'",
    "q_queue_unprocessed": "SELECT p_partkey, p_name AS note, p_size >= 40 AS by_deadline FROM part WHERE p_size % 7 <> 0 AND (p_retailprice > 1500 OR p_size >= 40)",
    "q_keyset_page": "SELECT o_orderdate::DATE AS d, o_orderkey FROM orders WHERE (o_orderdate::DATE, o_orderkey) < (DATE '1999-06-01', 5000) ORDER BY d DESC, o_orderkey DESC LIMIT 30",
    "q_cache_hits": "WITH m AS (SELECT turn, conv_id, sha256(role || '|' || text) AS key FROM conversations), c AS (SELECT DISTINCT key FROM m WHERE turn = 0) SELECT turn, count(c.key) AS hits, count(DISTINCT m.key) FILTER (c.key IS NULL) AS requests FROM m LEFT JOIN c ON m.key = c.key GROUP BY 1",
    "q_pair_list": f"WITH {_BARS} SELECT id, d, close FROM bars WHERE id BETWEEN 0 AND 149 AND d = DATE '2024-01-01' + (id % 30)::INTEGER",
    "q_semi_anti": "WITH l AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= '2000-06-01') SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < '1996-06-01') THEN 'found' ELSE 'new' END AS state FROM l",
    "q_role_join": "SELECT a.n_name AS buyer, b.n_name AS seller, count(*) AS lines, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey GROUP BY 1, 2",
    "q_full_outer": "SELECT ym, orders, events FROM (SELECT strftime(o_orderdate, '%Y%m') AS ym, count(*) AS orders FROM orders GROUP BY 1) FULL JOIN (SELECT strftime(ts, '%Y%m') AS ym, count(*) AS events FROM events GROUP BY 1) USING (ym)",
    "q_optional_filter": "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (1, 2, 3, 5, 8)",
    "q_reason_case": "SELECT c_custkey, CASE WHEN last IS NULL THEN 'no orders' WHEN open = 0 THEN 'none open' WHEN last < '2001-01-01' THEN 'stale' ELSE 'current' END AS reason FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders GROUP BY 1) ON c_custkey = o_custkey",
    "q_monotone_edges": "SELECT user_id, event_type, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1, 2",
    "q_compare_and_set": "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name WHEN p_size % 2 = 0 THEN upper(p_name) END AS title FROM part",
}
