"""Registered queries: verdict rules, small projections and resets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import dates
from tallgrass.operators import voting
from tallgrass.sources.tables import event_bars, table


def q_roles(spark, d):
    """Roles from probabilities."""
    e = table(spark, d, "events").select("event_id", (F.col("event_id") % 10 / 10.0).alias("c"), (F.col("user_id") % 10 / 10.0).alias("p"), (F.col("event_id") % 7 / 7.0).alias("a"), (F.col("user_id") % 7 / 7.0).alias("b"))
    return e.select("event_id", voting.role(F.col("c"), F.col("p"), {"mention": F.col("a"), "source": F.col("b")}).alias("role"))


def q_escalation(spark, d):
    """Which first verdicts need a second."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "market_reaction").when(F.col("p_size") % 3 == 1, "event").otherwise("other").alias("kind"), F.col("p_name").alias("title"), (F.col("p_size") % 10 != 9).alias("readable"))
    return p.select("p_partkey", voting.escalates(F.col("kind"), F.col("title"), "^(red|small)", F.col("readable")).alias("again"))


def q_parents_by_vote(spark, d):
    """Parents by votes that judge and check accept."""
    li = table(spark, d, "lineitem")
    v = li.select(F.col("l_orderkey").alias("child"), F.col("l_partkey").alias("candidate"), (F.col("l_quantity") > 10).alias("judge"), (F.col("l_discount") < 0.08).alias("check"), (F.col("l_tax") > 0.03).alias("pair"), (F.col("l_returnflag") == "R").alias("rank"), F.col("l_linenumber").alias("votes"), F.col("l_discount").alias("cosine"), F.col("l_tax").alias("event"), F.col("l_shipdate").alias("start"))
    return voting.parents(v, "child")


def q_vote_passes(spark, d):
    """Every line votes, and so many votes must accept."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_linestatus", (F.col("l_quantity") > 25).alias("ok"))
    return voting.passes(li, ["l_suppkey", "l_linestatus"], "ok", 40)


def q_relation_kind(spark, d):
    """Same event or follow-up by gap, similarity and votes."""
    e = table(spark, d, "events").select("event_id", dates.gap_hours(F.col("ts"), F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).alias("gap"), (F.col("user_id") % 100 / 100.0).alias("cosine"), (F.col("event_id") % 3).alias("same"))
    return e.filter("gap >= 0").select("event_id", voting.relation(F.col("gap"), F.col("cosine"), F.col("same")).alias("relation"))


def q_triple_rules(spark, d):
    """Drop reasons of triples, counted."""
    li, s = table(spark, d, "lineitem"), table(spark, d, "supplier").select("s_suppkey", "s_name")
    x = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.element_at(F.array(F.lit("SUPPLIES_TO"), F.lit("INVESTS_IN"), F.lit("LIKES")), (F.col("l_linenumber") % 3 + 1).cast("int")).alias("relation"), F.col("l_suppkey").alias("subject"), (F.col("l_partkey") % 100).alias("object"), F.when(F.col("l_quantity") > 5, "part").otherwise(" ").alias("item"), F.when(F.col("l_tax") > 0.07, F.repeat(F.lit("x"), 201)).otherwise(F.substring("s_name", 1, 8)).alias("evidence"), F.when(F.col("l_discount") > 0.09, "other").otherwise(F.col("s_name")).alias("sentence"))
    return voting.valid_triples(x, ["SUPPLIES_TO", "INVESTS_IN", "ACQUIRES"], ["SUPPLIES_TO"]).groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def q_members_as_of(spark, d):
    """Members of a group up to a time, the earliest alone where none is."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("k"))).alias("m"))
    x = voting.as_of_members(F.col("m"), F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
    return o.select("o_custkey", F.size(x).cast("long").alias("n"), F.array_min(F.transform(x, lambda m: m["at"])).cast("date").alias("first"))


def q_longest_run(spark, d):
    """The longest run of lines over a quantity in an order."""
    li = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))).alias("a"))
    return li.select("l_suppkey", voting.longest_run(F.transform("a", lambda x: x["l_quantity"] > 25)).cast("long").alias("run"))


def q_placeholders(spark, d):
    """Bars of the day before the opening without volume go; undated rows go; a missing label has its default."""
    b = event_bars(spark, d).withColumn("volume", F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("volume")))
    day = F.lit("2024-01-30").cast("date")
    return b.filter(~((F.col("d") == day) & (F.col("volume") == 0))).filter(F.col("d").isNotNull()).select("id", "d", "volume", F.coalesce(F.when(F.col("id") % 3 == 0, F.lit("cash")), F.lit("unknown")).alias("kind"))


def q_small_groups(spark, d):
    """Groups with fewer than three members are left out."""
    return table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("members")).filter("members >= 3")


def q_mean_time(spark, d):
    """Mean time of a group in whole seconds."""
    return table(spark, d, "events").groupBy("event_type").agg(F.floor(F.avg(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).alias("mean_at"), F.min("ts").alias("first"), F.max("ts").alias("last"))


def q_reset_links(spark, d):
    """Links of a time range are released; root is the parent's root, else the parent, else the row itself."""
    e = table(spark, d, "events").select("event_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("event_id") - 1).alias("parent"))
    inside = F.col("ts") >= F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    cut = e.withColumn("parent", F.when(~inside, F.col("parent")))
    p = cut.select(F.col("event_id").alias("p_id"), F.col("parent").alias("p_parent"))
    return cut.join(p, F.col("parent") == F.col("p_id"), "left").select("event_id", "parent", F.coalesce("p_parent", "parent", "event_id").alias("root"))


def q_symbol_variants(spark, d):
    """Candidate symbols by market."""
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("t"), (F.col("s_nationkey") % 2 == 0).alias("first"))
    x = F.when(F.col("first"), F.array(F.concat("t", F.lit(".O")), F.concat("t", F.lit(".K")))).otherwise(F.array(F.col("t"), F.concat("t", F.lit(".N"))))
    return s.select("s_suppkey", F.posexplode(x).alias("place", "symbol"))


def q_reply_parse(spark, d):
    """The last label in a reply; what can't be read counts as different."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("x VERDICT: SAME "), F.substring(F.coalesce("text", F.lit("")), 1, 5), F.when(F.col("turn") % 3 == 0, " VERDICT: FOLLOW").when(F.col("turn") % 3 == 1, "").otherwise(" done")).alias("r"))
    labels = F.regexp_extract_all(F.when(F.col("conv_id") % 5 != 0, F.col("r")).otherwise(F.lit("??")), F.lit(r"VERDICT: (SAME|FOLLOW|DIFFERENT)"), F.lit(1))
    return c.select("conv_id", "turn", F.coalesce(F.try_element_at(labels, F.lit(-1)), F.lit("DIFFERENT")).alias("label"))


def q_title_words(spark, d):
    """Whether half of a title's words of two letters or more are in the text."""
    t = table(spark, d, "documents").select("doc_id", "text", F.filter(F.split(F.reverse(F.split("text", "\n"))[0], " +"), lambda w: F.length(w) >= 2).alias("w"), F.split("text", "\n")[0].alias("head"))
    found = F.size(F.filter("w", lambda w: F.col("head").contains(w)))
    return t.select("doc_id", (found * 2 >= F.size("w")).alias("verified"))


def q_describe_targets(spark, d):
    """Members of a service set, those without a description first."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit("text")).alias("about"))
    served = table(spark, d, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(served, "c_custkey", "left_semi").orderBy(F.col("about").isNotNull(), "c_custkey").limit(40)


def q_latest_holding(spark, d):
    """A snapshot value is attached to an entity's latest day only."""
    b = event_bars(spark, d).select("id", "d")
    last = b.groupBy("id").agg(F.max("d").alias("m"))
    return b.join(last, "id").select("id", "d", F.when(F.col("d") == F.col("m"), F.col("id") * 1.5).alias("held"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

ORACLE_SQL = {
    "q_roles": "SELECT event_id, CASE WHEN event_id % 10 / 10.0 < 0.5 THEN 'not_company' WHEN user_id % 10 / 10.0 >= 0.5 THEN 'party' WHEN event_id % 7 >= user_id % 7 THEN 'mention' ELSE 'source' END AS role FROM events",
    "q_escalation": "SELECT p_partkey, p_size % 10 = 9 OR p_size % 3 = 0 OR (p_size % 3 = 1 AND regexp_matches(p_name, '^(red|small)')) AS again FROM part",
    "q_parents_by_vote": "WITH a AS (SELECT l_orderkey AS child, l_partkey AS parent, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, greatest(l_tax, l_discount) DESC, l_shipdate DESC, l_partkey DESC) AS r FROM lineitem WHERE l_quantity > 10 AND l_discount < 0.08 AND (l_tax > 0.03 OR l_returnflag = 'R')) SELECT o.child, a.parent FROM (SELECT DISTINCT l_orderkey AS child FROM lineitem) o LEFT JOIN a ON o.child = a.child AND r = 1",
    "q_vote_passes": "SELECT l_suppkey, l_linestatus, count(*) FILTER (l_quantity > 25) AS yes, count(*) AS n, count(*) FILTER (l_quantity > 25) >= 40 AS passed FROM lineitem GROUP BY 1, 2",
    "q_relation_kind": "WITH e AS (SELECT event_id, epoch_us(ts) / 3.6e9 - epoch_us(TIMESTAMP '2024-01-10') / 3.6e9 AS gap, user_id % 100 / 100.0 AS c, event_id % 3 AS s FROM events WHERE ts >= TIMESTAMP '2024-01-10') SELECT event_id, CASE WHEN gap <= 24 OR (c >= 0.75 AND gap <= 168) OR (s >= 2 AND gap <= 168) THEN 'same_event' ELSE 'follow_up' END AS relation FROM e",
    "q_triple_rules": "WITH x AS (SELECT l_linenumber % 3 AS r, l_suppkey AS s, l_partkey % 100 AS o, l_quantity > 5 AS item, l_tax > 0.07 AS long, l_discount > 0.09 AS other FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) SELECT CASE WHEN r = 2 THEN 'unknown_relation' WHEN s = o THEN 'same_ends' WHEN r = 0 AND NOT item THEN 'no_item' WHEN long THEN 'long_evidence' WHEN other THEN 'not_in_sentence' ELSE 'kept' END AS reason, count(*) AS n FROM x GROUP BY 1",
    "q_members_as_of": "SELECT o_custkey, greatest(count(*) FILTER (o_orderdate <= TIMESTAMP '1996-01-01'), 1) AS n, min(o_orderdate)::DATE AS first FROM orders GROUP BY 1",
    "q_longest_run": "WITH a AS (SELECT l_suppkey, l_quantity > 25 AS f, row_number() OVER w AS i FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)), g AS (SELECT l_suppkey, i - row_number() OVER (PARTITION BY l_suppkey ORDER BY i) AS k FROM a WHERE f), c AS (SELECT l_suppkey, count(*) AS n FROM g GROUP BY l_suppkey, k) SELECT s.l_suppkey, coalesce(max(n), 0) AS run FROM (SELECT DISTINCT l_suppkey FROM lineitem) s LEFT JOIN c USING (l_suppkey) GROUP BY 1",
    "q_placeholders": "WITH b AS (SELECT user_id AS id, ts::DATE AS d, CASE WHEN user_id % 4 = 0 THEN 0 ELSE count(*) END AS volume FROM events GROUP BY 1, 2) SELECT id, d, volume, CASE WHEN id % 3 = 0 THEN 'cash' ELSE 'unknown' END AS kind FROM b WHERE NOT (d = DATE '2024-01-30' AND volume = 0)",
    "q_small_groups": "SELECT s_nationkey, count(*) AS members FROM supplier GROUP BY 1 HAVING members >= 3",
    "q_mean_time": "SELECT event_type, floor(avg(epoch_us(ts) / 1e6))::BIGINT AS mean_at, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1",
    "q_reset_links": "WITH c AS (SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-28' AND event_id % 3 <> 0 THEN event_id - 1 END AS parent FROM events) SELECT c.event_id, c.parent, coalesce(p.parent, c.parent, c.event_id) AS root FROM c LEFT JOIN c p ON c.parent = p.event_id",
    "q_symbol_variants": "SELECT s_suppkey, place, 'T' || s_suppkey || CASE WHEN s_nationkey % 2 = 0 THEN CASE place WHEN 0 THEN '.O' ELSE '.K' END ELSE CASE place WHEN 0 THEN '' ELSE '.N' END END AS symbol FROM supplier, (VALUES (0), (1)) v(place)",
    "q_reply_parse": "SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 THEN 'DIFFERENT' WHEN turn % 3 = 0 THEN 'FOLLOW' ELSE 'SAME' END AS label FROM conversations",
    "q_title_words": "WITH t AS (SELECT doc_id, split_part(text, chr(10), 1) AS head, list_filter(regexp_split_to_array(split_part(text, chr(10), -1), ' +'), lambda w: length(w) >= 2) AS w FROM documents) SELECT doc_id, len(list_filter(w, lambda x: contains(head, x))) * 2 >= len(w) AS verified FROM t",
    "q_describe_targets": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'text' END AS about FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) ORDER BY about IS NOT NULL, c_custkey LIMIT 40",
    "q_latest_holding": "WITH b AS (SELECT DISTINCT user_id AS id, ts::DATE AS d FROM events) SELECT id, d, CASE WHEN d = max(d) OVER (PARTITION BY id) THEN (id * 1.5)::DOUBLE END AS held FROM b",
}
