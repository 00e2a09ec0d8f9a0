"""Registered queries: index, ledger, chains, term vectors, similarity, voting."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.operators import chainindex, graph, vectors, voting
from tallgrass.sources.tables import supplier_bars, table


def q_capped_weights(spark, d):
    """M8: capped weights of suppliers in their nation."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", (F.abs("s_acctbal") + 1).alias("size"))
    return chainindex.capped(s, ["s_nationkey"], "size").select("s_suppkey", "s_nationkey", F.round("weight", 9).alias("weight"))


def q_chain_index(spark, d):
    """Chain-linked index of nations over their suppliers."""
    b = supplier_bars(spark, d).withColumn("trade_value", F.when(F.col("volume") % 2 == 0, F.col("close") * F.col("volume")))
    # Prices of one supplier jump from day to day; they are pulled together so that moves fall on both sides of the limit.
    b = b.select("id", "d", *((F.col(c) / 2000 + 4).alias(c) for c in ("open", "high", "low", "close")), "volume", "trade_value")
    m = table(spark, d, "supplier").select(F.col("s_nationkey").alias("group"), F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 11 != 0, 100 + F.col("s_suppkey") % 7 * 50).alias("shares"))
    x = chainindex.chain_index(b, b.select("d"), m)
    # Levels are products over thousands of days: relative digits are what both engines agree on.
    sig = lambda c: F.round(F.ln(c), 6).alias(f"ln_{c}")
    return x.select("group", "d", *map(sig, ("open", "high", "low", "close")), F.col("volume").cast("long"), F.round("trade_value", 2).alias("trade_value"))


def _ledger(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", F.col("l_shipdate").cast("date").alias("day"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))


def q_edge_summary(spark, d):
    """Evidence per edge: filtered counts, dates, ordered and filtered arrays."""
    news = F.col("l_linestatus") == "O"
    arr = lambda cond: F.array_join(F.transform(F.array_sort(F.collect_set(F.when(cond, F.struct("day", "l_orderkey")))), lambda x: x["l_orderkey"].cast("string")), ",")
    return _ledger(spark, d).groupBy("l_suppkey", "l_returnflag", "s_nationkey").agg(
        F.count_if(news).alias("news"), F.count_if(~news).alias("filings"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        arr(news).alias("news_keys"), arr(~news).alias("filing_keys"), F.count_if(F.col("l_quantity") > 25).alias("positive"), F.count_if(F.col("l_quantity") < 10).alias("negative"),
    )


def q_distinct_threshold(spark, d):
    """Customers with at least 6 distinct order priorities and states, most first."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderpriority", "o_orderstatus").alias("kinds"), F.count("*").alias("orders"))
    return o.filter("kinds >= 6")


def _corrections(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("owner"), F.trunc("o_orderdate", "month").alias("day"), "o_orderstatus")
    # A correction names the month of its target: the owner's latest earlier month with an order.
    months = o.select("owner", "day").distinct().withColumn("target", F.lag("day").over(W.partitionBy("owner").orderBy("day")))
    return o.join(months, ["owner", "day"])


def _chains(spark, d):
    x = _corrections(spark, d)
    p = graph.chain_parents(x, "owner", "o_orderkey", "day", "target", F.col("o_orderstatus") == "P")
    return x, p, graph.roots(p, "o_orderkey", "parent")


def q_chain_parents(spark, d):
    """The correction's parent: same owner, target day, smaller key, the latest."""
    return _chains(spark, d)[1].filter("parent IS NOT NULL").select("o_orderkey", "parent")


def q_chain_roots(spark, d):
    """Roots of correction chains by pointer jumping."""
    return _chains(spark, d)[2].select(F.col("node").alias("o_orderkey"), "root")


def q_chain_latest(spark, d):
    """R2: the latest filing of each chain and its days."""
    x, _, r = _chains(spark, d)
    return graph.latest_of_chains(x, r, "o_orderkey", "day")


def q_event_leads(spark, d):
    """Climb along same-kind edges to the lead, deeper than a recursive query's limit."""
    w = W.partitionBy("user_id").orderBy("ts")
    e = table(spark, d, "events").select(F.col("event_id").alias("node"), F.lag("event_id").over(w).alias("parent"), (F.hour("ts") % 6 > 0).alias("same"))
    return graph.climbed(e).select(F.col("node").alias("event_id"), "lead")


def q_best_member(spark, d):
    """The best row of a group by blankness, size, date and key."""
    p = table(spark, d, "part").withColumn("title", F.when(F.col("p_size") % 5 == 0, F.lit(" ")).otherwise(F.col("p_name")))
    x = graph.best_member(p, "p_brand", (F.trim("title") == "").asc(), F.desc("p_size"), F.asc("p_retailprice"), F.asc("p_partkey"))
    return x.select("p_brand", "p_partkey")


def q_edge_diff(spark, d):
    """What makes stored edges equal to the wanted ones."""
    g = lambda df: df.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    o = table(spark, d, "orders")
    return graph.edge_diff(g(o.filter("o_orderdate < '2000-01-01'")), g(o.filter("o_orderdate >= '1995-06-01'")), ["o_custkey", "o_orderpriority"], ["n"])


def q_visible(spark, d):
    """Clusters with a member of the wanted kind."""
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'")
    hit = o.select(F.col("o_custkey").alias("k")).distinct()
    return c.join(hit, F.col("c_custkey") == F.col("k"), "left").select("c_custkey", F.col("k").isNotNull().alias("visible"))


def q_idf(spark, d):
    """Document frequencies of each field; the text holds the title, so it is the union of both."""
    x = table(spark, d, "documents").select(F.split("text", "\n")[0].alias("title"), "text")
    return vectors.token_frequencies(x, "title", "title").unionByName(vectors.token_frequencies(x, "text", "all"))


def q_tf_idf(spark, d):
    """M3 H7: unit TF-IDF vectors of whole texts, as their length, largest weight and number of tokens."""
    docs = table(spark, d, "documents")
    x = vectors.vector_sums(docs, "doc_id", "text", docs.count())
    return x.select("doc_id", F.round("l1", 6).alias("l1"), F.round("largest", 6).alias("largest"), "tokens")


def q_centroids(spark, d):
    """Centroids of clusters, here of sources, with documents without a token counted."""
    return vectors.text_centroids(table(spark, d, "documents"), "source", "text").select("source", "token", "total", F.round("mean", 9).alias("mean"))


def q_top_keywords(spark, d):
    """T5: five heaviest tokens of a source, ties in order of the token."""
    x = vectors.token_totals(table(spark, d, "documents"), "source", "text")
    return x.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(F.desc("n"), "token")).cast("long")).filter("rank <= 5")


def q_medoids(spark, d):
    """Of a source's documents of 200 characters or more, or of all that have text where none is so long, the one nearest to all of them."""
    docs = table(spark, d, "documents")
    m = vectors.eligible(docs.select("doc_id", "source", "text", F.length("text").alias("n")), "source", "n", 200)
    return vectors.text_medoids(docs, m, "doc_id", "text", "source", docs.count())


def q_similar_earlier(spark, d):
    """Similar earlier vectors of the same label within a look-back, at most 12."""
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    return vectors.earlier_candidates(e, "vec_id", "label", "embedding", 0.10, 200, 12).select("vec_id", "candidate", "cosine", F.col("rank").cast("long").alias("rank"))


def q_link_decision(spark, d):
    """The parent of each vector, the largest (cosine, key), and how they relate."""
    c = q_similar_earlier(spark, d)
    best = c.groupBy("vec_id").agg(F.max(F.struct("cosine", "candidate")).alias("m"))
    gap = F.col("vec_id") - F.col("m.candidate")
    relation = F.when((gap <= 24) | ((F.col("m.cosine") >= 0.75) & (gap <= 168)), "same_event").otherwise("follow_up")
    return best.select("vec_id", F.col("m.candidate").alias("parent"), "m.cosine", relation.alias("relation"))


def q_votes(spark, d):
    """Each line votes, two votes pass, and the winner is the largest (votes, score, key)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_quantity") > 20).alias("yes"))
    per = li.groupBy("l_orderkey", (F.col("l_partkey") % 4).alias("candidate")).agg(F.count_if("yes").alias("votes"), F.count("*").alias("n"))
    ok = per.filter("votes >= 2")
    return ok.groupBy("l_orderkey").agg(F.max(F.struct("votes", "n", "candidate")).alias("m")).select("l_orderkey", F.col("m.candidate").alias("winner"), F.col("m.votes").alias("votes"))


def q_relevance(spark, d):
    """Verdicts of a judge as probabilities; a missing verdict is neither pass nor fail."""
    docs, lab = table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels")
    x = docs.join(lab, "doc_id", "left").withColumn("is_company", F.col("quality") * 0.8).withColumn("has_event", (F.col("n_chars") % 100) / 100.0).withColumn("has_driver", F.col("toxic") * 0.6)
    passed = voting.relevant(F.col("is_company"), F.col("has_event"), F.col("has_driver"))
    return x.select("doc_id", F.when(F.col("quality").isNotNull(), passed).alias("passed"))


def q_percentiles(spark, d):
    """Nearest-rank percentiles and the maximum of a latency-like value."""
    return table(spark, d, "events").groupBy("event_type").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value)").alias("p50"), F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY value)").alias("p95"), F.max("value").alias("most"))


def q_invariant(spark, d):
    """A total and its parts, and whether they agree."""
    e = table(spark, d, "events").agg(F.count("*").alias("total"), *(F.count_if(F.col("event_type") == k).alias(k) for k in ("view", "click", "error", "signup", "purchase")))
    return e.withColumn("balanced", F.expr("total = view + click + error + signup + purchase"))


def q_mode(spark, d):
    """The most frequent month of a customer, ties to the smallest, and its orders."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.month("o_orderdate").cast("long").alias("m"))
    mode = o.groupBy("o_custkey", "m").agg(F.count("*").alias("n")).groupBy("o_custkey").agg(F.max_by("m", F.struct("n", -F.col("m"))).alias("mode"))
    return o.join(mode, "o_custkey").filter("m = mode").groupBy("o_custkey", "mode").agg(F.count("*").alias("orders"))


def q_statement_pivot(spark, d):
    """A long statement to wide, each cell from the statement with the best rank, then the earliest row."""
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    li = table(spark, d, "lineitem").withColumn("at", F.struct(rank.alias("r"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    cell = lambda m, a: F.min_by(F.when(F.col("l_linestatus") == m, F.col("l_extendedprice")), F.when(F.col("l_linestatus") == m, F.col("at"))).alias(a)
    return li.groupBy("l_orderkey").agg(cell("O", "open_amount"), cell("F", "filled_amount"))


def q_size_buckets(spark, d):
    """H5: a histogram of group sizes."""
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.groupBy(F.when(F.col("n") < 5, "1-4").when(F.col("n") < 10, "5-9").when(F.col("n") < 20, "10-19").otherwise("20+").alias("bucket")).agg(F.count("*").alias("groups"))


def q_chunks(spark, d):
    """Ids in chunks of 64."""
    n = F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    return table(spark, d, "customer").select("c_nationkey", "c_custkey", F.floor(n / 16).alias("chunk"))


def q_event_similarity(spark, d):
    """M7: half of the cosine of two groups' title vectors plus half of the mean over one side of the best cosine to the other; a group's first vector is its title."""
    e = table(spark, d, "embeddings")
    best = vectors.best_cosines(e, "vec_id", "label", "embedding")
    label = e.schema["label"].dataType
    titles = e.filter("label IS NOT NULL AND embedding IS NOT NULL").groupBy(F.col("label").cast("long").alias("g")).agg(F.min_by("embedding", "vec_id").alias("t")).select("g", vectors.normed("t").alias("t"))
    a, b = titles.select(F.col("g").alias("a_group"), F.col("t").alias("a_t")), titles.select(F.col("g").alias("b_group"), F.col("t").alias("b_t"))
    means = best.groupBy("a_group", "b_group").agg(F.avg("cosine").alias("mean")).join(a, "a_group").join(b, "b_group")
    title = F.aggregate(F.zip_with("a_t", "b_t", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return means.select(F.col("a_group").cast(label).alias("a_label"), F.col("b_group").cast(label).alias("b_label"), F.round(title * 0.5 + F.col("mean") * 0.5, 6).alias("score"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_CORR = "o AS (SELECT o_orderkey, o_custkey AS owner, date_trunc('month', o_orderdate)::DATE AS day, o_orderstatus FROM orders), m AS (SELECT owner, day, lag(day) OVER (PARTITION BY owner ORDER BY day) AS target FROM (SELECT DISTINCT owner, day FROM o)), x AS (SELECT * FROM o JOIN m USING (owner, day)), p AS (SELECT x.o_orderkey, max(b.o_orderkey) AS parent FROM x LEFT JOIN x b ON x.o_orderstatus = 'P' AND b.owner = x.owner AND b.day = x.target AND b.o_orderkey < x.o_orderkey GROUP BY 1)"
_ROOT = "r AS (SELECT o_orderkey AS node, o_orderkey AS root FROM p WHERE parent IS NULL UNION ALL SELECT p.o_orderkey, r.root FROM p JOIN r ON p.parent = r.node)"
_TOK = "d AS (SELECT doc_id, source, list_filter(regexp_split_to_array(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{N}]+'), lambda t: length(t) >= 2) AS t, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: length(t) >= 2) AS b FROM documents), tt AS (SELECT doc_id, source, token, count(*) AS n FROM (SELECT doc_id, source, unnest(b) AS token FROM d) GROUP BY 1, 2, 3)"
_TFIDF = _TOK + ", f AS (SELECT token, count(*) AS df FROM tt GROUP BY 1), w0 AS (SELECT doc_id, source, token, ln(1 + n) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tt JOIN f USING (token)), w AS (SELECT doc_id, source, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w0)"
_NORM = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS v FROM embeddings)"
_SIM = _NORM + ", c AS (SELECT a.vec_id, b.vec_id AS candidate, round(list_dot_product(a.v, b.v), 6) AS cosine FROM v a JOIN v b ON a.label = b.label AND b.vec_id < a.vec_id AND b.vec_id >= a.vec_id - 200), s AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, candidate DESC) AS rank FROM c WHERE cosine >= 0.10)"
_LONG = "bars AS (SELECT l_suppkey AS id, CAST(l_shipdate AS DATE) AS d, first(p ORDER BY l_orderkey, l_linenumber, p) / 2000 + 4 AS open, max(p) / 2000 + 4 AS high, min(p) / 2000 + 4 AS low, last(p ORDER BY l_orderkey, l_linenumber, p) / 2000 + 4 AS close, last(p ORDER BY l_orderkey, l_linenumber, p) AS raw, CAST(sum(l_quantity) AS BIGINT) AS volume FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2)"
_INDEX = (
    f"WITH {_LONG}, cal AS (SELECT d, lag(d) OVER (ORDER BY d) AS before FROM (SELECT DISTINCT d FROM bars)), "
    "x AS (SELECT s_nationkey AS g, b.*, y.close AS prior, y.close * (100 + s_suppkey % 7 * 50) AS m FROM bars b JOIN cal ON b.d = cal.d JOIN bars y ON y.id = b.id AND y.d = cal.before JOIN supplier ON s_suppkey = b.id AND s_suppkey % 11 <> 0 WHERE round(abs(b.close / y.close - 1), 10) <= 0.3), "
    "c0 AS (SELECT *, count(*) OVER w AS n, m / sum(m) OVER w > 0.25 AS f1 FROM x WINDOW w AS (PARTITION BY g, d)), "
    "c1 AS (SELECT *, f1 OR m / sum(m) FILTER (NOT f1) OVER w * (1 - 0.25 * count(*) FILTER (f1) OVER w) > 0.25 AS f2 FROM c0 WINDOW w AS (PARTITION BY g, d)), "
    "c2 AS (SELECT *, f2 OR m / sum(m) FILTER (NOT f2) OVER w * (1 - 0.25 * count(*) FILTER (f2) OVER w) > 0.25 AS f3 FROM c1 WINDOW w AS (PARTITION BY g, d)), "
    "k AS (SELECT *, CASE WHEN n <= 4 THEN 1.0::DOUBLE / n WHEN f3 THEN 0.25::DOUBLE ELSE m / sum(m) FILTER (NOT f3) OVER w * (1 - 0.25 * count(*) FILTER (f3) OVER w) END AS wt FROM c2 WINDOW w AS (PARTITION BY g, d)), "
    "f AS (SELECT g, d, sum(wt * open / prior) AS o, sum(wt * high / prior) AS h, sum(wt * low / prior) AS l, sum(wt * close / prior) AS c, sum(volume)::BIGINT AS volume, sum(CASE WHEN volume % 2 = 0 THEN raw * volume END) AS tv FROM k GROUP BY 1, 2), "
    "v AS (SELECT *, ln(1000) + coalesce(sum(ln(c)) OVER (PARTITION BY g ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM f) "
    "SELECT g AS \"group\", d, round(a + ln(o), 6) AS ln_open, round(a + ln(greatest(o, h, l, c)), 6) AS ln_high, round(a + ln(least(o, h, l, c)), 6) AS ln_low, round(a + ln(c), 6) AS ln_close, volume, round(tv, 2) AS trade_value FROM v"
)
ORACLE_SQL = {
    "q_chain_index": _INDEX,
    "q_capped_weights": "WITH s AS (SELECT s_suppkey, s_nationkey, abs(s_acctbal) + 1 AS m, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier), a AS (SELECT *, m / sum(m) OVER w > 0.25 AS f1 FROM s WINDOW w AS (PARTITION BY s_nationkey)), b AS (SELECT *, f1 OR m / sum(m) FILTER (NOT f1) OVER w * (1 - 0.25 * count(*) FILTER (f1) OVER w) > 0.25 AS f2 FROM a WINDOW w AS (PARTITION BY s_nationkey)), c AS (SELECT *, f2 OR m / sum(m) FILTER (NOT f2) OVER w * (1 - 0.25 * count(*) FILTER (f2) OVER w) > 0.25 AS f3 FROM b WINDOW w AS (PARTITION BY s_nationkey)) SELECT s_suppkey, s_nationkey, round(CASE WHEN n <= 4 THEN 1.0 / n WHEN f3 THEN 0.25 ELSE m / sum(m) FILTER (NOT f3) OVER w * (1 - 0.25 * count(*) FILTER (f3) OVER w) END, 9) AS weight FROM c WINDOW w AS (PARTITION BY s_nationkey)",
    "q_edge_summary": "SELECT l_suppkey, l_returnflag, s_nationkey, count(*) FILTER (l_linestatus = 'O') AS news, count(*) FILTER (l_linestatus <> 'O') AS filings, min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day, coalesce(array_to_string(list_transform(list_sort(list(DISTINCT {'d': l_shipdate, 'k': l_orderkey}) FILTER (l_linestatus = 'O')), lambda x: x.k), ','), '') AS news_keys, coalesce(array_to_string(list_transform(list_sort(list(DISTINCT {'d': l_shipdate, 'k': l_orderkey}) FILTER (l_linestatus <> 'O')), lambda x: x.k), ','), '') AS filing_keys, count(*) FILTER (l_quantity > 25) AS positive, count(*) FILTER (l_quantity < 10) AS negative FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3",
    "q_distinct_threshold": "SELECT o_custkey, count(DISTINCT (o_orderpriority, o_orderstatus)) AS kinds, count(*) AS orders FROM orders GROUP BY 1 HAVING kinds >= 6",
    "q_chain_parents": f"WITH {_CORR} SELECT o_orderkey, parent FROM p WHERE parent IS NOT NULL",
    "q_chain_roots": f"WITH RECURSIVE {_CORR}, {_ROOT} SELECT node AS o_orderkey, root FROM r",
    "q_chain_latest": f"WITH RECURSIVE {_CORR}, {_ROOT} SELECT root, arg_max(node, (day, node)) AS latest, min(day) AS first_day, max(day) AS last_day, count(*) AS length FROM r JOIN x ON r.node = x.o_orderkey GROUP BY 1",
    "q_event_leads": "WITH e AS (SELECT event_id, user_id, ts, lag(event_id) OVER w IS NOT NULL AND hour(ts) % 6 > 0 AS same FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT event_id, last_value(CASE WHEN NOT same THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS lead FROM e",
    "q_best_member": "SELECT p_brand, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size % 5 = 0, p_size DESC, p_retailprice, p_partkey) = 1",
    "q_edge_diff": "WITH s AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate < '2000-01-01' GROUP BY 1, 2), w AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= '1995-06-01' GROUP BY 1, 2) SELECT o_custkey, o_orderpriority, w.n AS n, CASE WHEN s.n IS NULL THEN 'insert' WHEN w.n IS NULL THEN 'delete' ELSE 'update' END AS action FROM s FULL JOIN w USING (o_custkey, o_orderpriority) WHERE s.n IS DISTINCT FROM w.n",
    "q_visible": "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') AS visible FROM customer",
    "q_idf": f"WITH {_TOK} SELECT 'title' AS field, token, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(t) AS token FROM d) GROUP BY 2 UNION ALL SELECT 'all', token, count(*) FROM tt GROUP BY 2",
    "q_tf_idf": f"WITH {_TFIDF} SELECT doc_id, round(sum(w), 6) AS l1, round(max(w), 6) AS largest, count(*) AS tokens FROM w GROUP BY 1",
    "q_centroids": f"WITH {_TOK}, z AS (SELECT source, count(*) AS size FROM documents GROUP BY 1) SELECT source, token, sum(n)::BIGINT AS total, round(sum(n) / any_value(size), 9) AS mean FROM tt JOIN z USING (source) GROUP BY 1, 2",
    "q_top_keywords": f"WITH {_TOK} SELECT source, token, sum(n)::BIGINT AS n, row_number() OVER (PARTITION BY source ORDER BY sum(n) DESC, token) AS rank FROM tt GROUP BY 1, 2 QUALIFY rank <= 5",
    "q_medoids": f"WITH {_TFIDF}, e AS (SELECT doc_id, source FROM documents WHERE length(text) > 0 QUALIFY length(text) >= 200 OR max(length(text)) OVER (PARTITION BY source) < 200), v AS (SELECT w.* FROM w JOIN e USING (doc_id)), t AS (SELECT source, token, sum(w) AS total FROM v GROUP BY 1, 2), "
    "s AS (SELECT source, doc_id, round(sum(w * (total - w)), 9) AS score FROM v JOIN t USING (source, token) GROUP BY 1, 2) SELECT e.source, e.doc_id AS medoid FROM e LEFT JOIN s USING (doc_id) QUALIFY row_number() OVER (PARTITION BY e.source ORDER BY coalesce(score, 0) DESC, e.doc_id) = 1",
    "q_similar_earlier": f"WITH {_SIM} SELECT vec_id, candidate, cosine, rank FROM s WHERE rank <= 12",
    "q_link_decision": f"WITH {_SIM} SELECT vec_id, candidate AS parent, cosine, CASE WHEN vec_id - candidate <= 24 OR (cosine >= 0.75 AND vec_id - candidate <= 168) THEN 'same_event' ELSE 'follow_up' END AS relation FROM s WHERE rank = 1",
    "q_votes": "WITH p AS (SELECT l_orderkey, l_partkey % 4 AS candidate, count(*) FILTER (l_quantity > 20) AS votes, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, candidate AS winner, votes FROM p WHERE votes >= 2 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY votes DESC, n DESC, candidate DESC) = 1",
    "q_relevance": "SELECT doc_id, CASE WHEN quality IS NOT NULL THEN quality * 0.8 >= 0.7 AND greatest((n_chars % 100) / 100.0, toxic * 0.6) >= 0.55 END AS passed FROM documents LEFT JOIN labels USING (doc_id)",
    "q_percentiles": "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, max(value) AS most FROM events GROUP BY 1",
    "q_invariant": "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in ("view", "click", "error", "signup", "purchase")) + ", true AS balanced FROM events",
    "q_mode": "WITH c AS (SELECT o_custkey, month(o_orderdate) AS mode, count(*) AS orders FROM orders GROUP BY 1, 2) SELECT o_custkey, mode, orders FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY orders DESC, mode) = 1",
    "q_statement_pivot": "WITH l AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS r FROM lineitem) SELECT l_orderkey, first(l_extendedprice ORDER BY r, l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_linestatus = 'O') AS open_amount, first(l_extendedprice ORDER BY r, l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_linestatus = 'F') AS filled_amount FROM l GROUP BY 1",
    "q_size_buckets": "SELECT CASE WHEN n < 5 THEN '1-4' WHEN n < 10 THEN '5-9' WHEN n < 20 THEN '10-19' ELSE '20+' END AS bucket, count(*) AS groups FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1",
    "q_chunks": "SELECT c_nationkey, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 16 AS chunk FROM customer",
    "q_event_similarity": f"WITH {_NORM}, p AS (SELECT a.label AS a_label, b.label AS b_label, b.vec_id AS b_id, max(list_dot_product(a.v, b.v)) AS c FROM v a JOIN v b ON a.label <> b.label GROUP BY 1, 2, 3), t AS (SELECT label, arg_min(v, vec_id) AS t FROM v GROUP BY 1) SELECT a_label, b_label, round(avg(c) * 0.5 + 0.5 * list_dot_product(any_value(x.t), any_value(y.t)), 6) AS score FROM p JOIN t x ON x.label = a_label JOIN t y ON y.label = b_label GROUP BY 1, 2",
}
