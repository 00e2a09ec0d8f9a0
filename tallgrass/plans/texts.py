"""Registered queries: text and date functions, name resolution, matching, events of a calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import dates, numbers, text
from tallgrass.operators import entity
from tallgrass.sources.tables import table


def q_url_keys(spark, d):
    """Two URL keys; one lowers all, one keeps the path's case."""
    link = F.concat(F.lit(" "), F.regexp_replace("url", "^http", "HTTP"), F.lit("/A/b//?q="), F.col("page_id").cast("string"))
    p = table(spark, d, "pages").select("page_id", link.alias("link"))
    return p.select("page_id", F.trim(text.url_key_lower(F.col("link"))).alias("stored_key"), text.url_key(F.col("link")).alias("url_key"))


def q_new_articles(spark, d):
    """Pages of which neither URL is stored."""
    p = table(spark, d, "pages").select("page_id", text.url_key(F.col("url")).alias("u"), F.concat(text.url_key(F.col("url")), F.lit("/m")).alias("v"))
    stored = p.filter("page_id % 3 = 0").select("u").unionByName(p.filter("page_id % 5 = 0").select(F.col("v").alias("u"))).distinct()
    hit = p.select("page_id", F.explode(F.array("u", "v")).alias("u")).join(stored, "u", "left_semi").select("page_id").distinct()
    return p.join(hit, "page_id", "left_anti").select("page_id")


def q_url_groups(spark, d):
    """Items that share a URL, also through others, with the smallest key as survivor."""
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("u"), F.concat(F.lit("p"), F.floor(F.col("o_totalprice") / 40).cast("string")).alias("v"))
    return entity.url_survivors(o, "o_orderkey", F.array("u", "v"))


def q_name_keys(spark, d):
    """Keys and forms of names with legal forms and brackets."""
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.when(F.col("s_suppkey") % 3 == 0, "(주) ").when(F.col("s_suppkey") % 3 == 1, "").otherwise("주식회사 "), F.lit("Acme-"), (F.col("s_suppkey") % 17).cast("string"), F.when(F.col("s_suppkey") % 2 == 0, " Co., Ltd. (ACME Korea)").otherwise(", Inc.")).alias("name"))
    return s.select("s_suppkey", text.name_key(F.col("name")).alias("key"), F.array_join(F.transform(text.name_forms(F.col("name")), lambda x: F.concat_ws("=", x["rule"], x["form"])), ";").alias("forms"), text.names_several(F.col("name")).alias("several"))


def q_resolve_names(spark, d):
    """Names to suppliers over registry and aliases; ambiguous names resolve to nothing."""
    s = table(spark, d, "supplier")
    reg = s.select(F.col("s_suppkey").alias("entity"), F.concat(F.lit("k"), (F.col("s_suppkey") % 95).cast("string")).alias("code"), F.concat(F.lit("Firm "), (F.col("s_suppkey") % 80).cast("string"), F.lit(" Corp.")).alias("label"), (F.col("s_suppkey") % 2 == 0).alias("listed"))
    ali = s.filter("s_suppkey % 7 = 0").select(F.concat(F.lit("Alias "), F.floor(F.col("s_suppkey") / 14).cast("string")).alias("alias"), F.col("s_suppkey").alias("entity"))
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("(주)firm-"), (F.col("c_custkey") % 100).cast("string"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("Unknown (Firm "), (F.col("c_custkey") % 90).cast("string"), F.lit(")"))).otherwise(F.concat(F.lit("alias "), (F.col("c_custkey") % 12).cast("string"))).alias("name"))
    return entity.resolved(c, "name", reg, ali).select("c_custkey", "name", "entity", "rule", "source")


def q_single_owner(spark, d):
    """Aliases with one owner by priority; two owners of equal priority drop it."""
    p = table(spark, d, "part")
    c = p.select(F.col("p_name").alias("alias"), (F.col("p_partkey") % 50).alias("entity"), (F.col("p_size") + 1).alias("priority")).unionByName(p.select(F.concat("p_brand", F.lit(" "), "p_type").alias("alias"), (F.col("p_partkey") % 40).alias("entity"), F.col("p_size").alias("priority")))
    return entity.single_owner(c)


def q_nearest_day(spark, d):
    """The nearest order of a customer within three days, ties to the smaller key."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    asked = o.filter("o_orderkey % 5 = 0").select("k", F.date_add("day", 1).alias("day"), F.col("o_orderkey").alias("asked"))
    return entity.nearest(asked, o.filter("o_orderkey % 5 <> 0"), "k", "day", 3, "o_orderkey").select("asked", "o_orderkey")


def q_dictionary_matches(spark, d):
    """Longest non-overlapping matches of a dictionary in whole texts, counted by entry."""
    words = [("the", 1), ("the thand", 2), ("of", 3), ("of the", 4), ("and", 5), ("que la", 6), ("la", 7), ("die der", 8), ("der", 9)]
    x = entity.matches(table(spark, d, "documents"), "doc_id", "text", words).select(F.explode("matches").alias("m"))
    return x.groupBy(F.col("m.text").alias("alias"), F.col("m.entity").alias("entity")).agg(F.count("*").alias("n"), F.sum("m.start").alias("starts"))


def q_merge_themes(spark, d):
    """Themes of one name united in order of arrival; the longest reason stays."""
    p = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("place"), F.array_sort(F.collect_set((F.col("p_partkey") % 30).cast("string"))).alias("members"), F.max("p_name").alias("reason"))
    x = entity.merged_themes(p.select(F.col("p_brand").alias("name"), "place", "members", "reason"))
    return x.select("name", F.array_join("members", ",").alias("members"), "reason")


def q_theme_overlap(spark, d):
    """Pairs of brands of one part type whose members overlap by 0.3 or more of the smaller."""
    p = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.collect_set(F.col("p_size").cast("string")).alias("m"))
    b = p.select(F.col("p_brand").alias("other"), F.col("p_type").alias("o_type"), F.col("m").alias("o_m"))
    x = p.join(b, (F.col("p_type") == F.col("o_type")) & (F.col("p_brand") < F.col("other"))).withColumn("o", F.round(text.overlap(F.col("m"), F.col("o_m")), 6))
    return x.filter("o >= 0.3").select("p_brand", "other", "p_type", "o")


def q_constituents(spark, d):
    """Constituents whose key is known and whose name agrees."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).otherwise("other").alias("name")).distinct()
    return x.join(s, (F.col("k") == F.col("s_suppkey")) & (F.col("name") == F.col("s_name"))).select("s_suppkey", "s_name")


def q_title_filter(spark, d):
    """Titles that are excluded by pattern, list or noise, and cleaned titles of the others."""
    t = table(spark, d, "documents").select("doc_id", F.concat(F.when(F.col("doc_id") % 4 == 0, "[단독] (종합) ").otherwise(""), F.split("text", "\n")[0]).alias("title"))
    why = F.when(F.regexp_count("title", F.lit("[|]")) >= 4, "listing").when(F.regexp_count("title", F.lit(r"[#$%&*]")) * 5 > F.length("title"), "noise").when(F.col("title").rlike("(?i)all rights reserved|license"), "excluded")
    return t.select("doc_id", why.alias("reason"), F.when(why.isNull(), text.without_leading_brackets(F.col("title"))).alias("title"))


def q_clean_text(spark, d):
    """Whole pages without entities and tags, letters and digits in lower case; as in the SQL, an entity ends with a semicolon."""
    p = table(spark, d, "pages").select("page_id", text.clean_text(F.col("html"), text.closed_unescaped).alias("t"))
    return p.select("page_id", F.length("t").cast("long").alias("n"), F.sha2("t", 256).alias("digest"))


def q_sentences(spark, d):
    """Sentences, the first of them, and those with a word."""
    s = table(spark, d, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n"), F.sha2(F.coalesce(F.try_element_at("s", F.lit(1)), F.lit("")), 256).alias("lead"), F.size(F.filter("s", lambda x: x.contains("the"))).cast("long").alias("with_word"))


def q_masked(spark, d):
    """Aliases masked, longest first, runs collapsed."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    m = text.masked(F.col("text"), F.array(*map(F.lit, ["the", "in the", "que", "und", "of"])))
    return c.select("conv_id", "turn", F.sha2(m, 256).alias("digest"), F.regexp_count(m, F.lit(r"\[기업\]")).cast("long").alias("masks"))


def q_grounded(spark, d):
    """Whether a quoted evidence, with an ellipsis, is in its source."""
    t = table(spark, d, "documents").select("doc_id", "text", F.concat(F.substring("text", 1, 12), F.lit("..."), F.when(F.col("doc_id") % 3 == 0, "zzzz").otherwise(F.substring("text", 20, 10))).alias("quote"))
    return t.select("doc_id", text.grounded(F.col("quote"), F.col("text")).alias("grounded"))


def q_summary_rules(spark, d):
    """Rules of a summary: lines, lengths, no repetition."""
    t = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return t.select("doc_id", text.valid_summary(F.col("lines"), 4, 400).alias("valid"))


def q_dates(spark, d):
    """Dates from text of several forms."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    form = F.element_at(F.array(F.lit("yyyyMMdd"), F.lit("yyyy/MM/dd"), F.lit("yyyy.MM.dd"), F.lit("x")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    t = F.when(form == "yyyyMMdd", F.date_format("day", "yyyyMMdd")).when(form == "yyyy/MM/dd", F.date_format("day", "yyyy/MM/dd")).when(form == "yyyy.MM.dd", F.date_format("day", "yyyy.MM.dd")).otherwise(F.concat(F.date_format("day", "yyyy"), F.lit("0231")))
    r = dates.date_range(F.concat(t, F.lit(" ~ "), F.date_format(F.date_add("day", 3), "yyyyMMdd")))
    return o.select("o_orderkey", dates.compact_date(t).alias("day"), r["start"].alias("start"), r["end"].alias("stop"), dates.worded_date(F.concat(F.year("day"), F.lit("년 "), F.month("day"), F.lit("월 "), F.dayofmonth("day"), F.lit("일"))).alias("worded"))


def q_published(spark, d):
    """Publication times of several forms, those without a zone in Seoul."""
    e = table(spark, d, "events").select("event_id", F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("t"))
    s = F.when(F.col("event_id") % 4 == 0, F.concat(F.date_format("t", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0900"))).when(F.col("event_id") % 4 == 1, F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).when(F.col("event_id") % 4 == 2, F.date_format("t", "yyyy.MM.dd. HH:mm")).otherwise("unknown")
    return e.select("event_id", F.unix_seconds(dates.published_at(s)).alias("at"))


def q_month_windows(spark, d):
    """Ranges cut at months, and months shifted."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("a"), F.date_add(F.col("o_orderdate").cast("date"), 75).alias("b"))
    x = o.select("o_orderkey", "a", F.explode(dates.month_windows(F.col("a"), F.col("b"))).alias("w"))
    return x.select("o_orderkey", "w.start", F.col("w.end").alias("stop"), dates.month_shift((F.year("a") * 100 + F.month("a")), -5).cast("long").alias("shifted"))


def q_numbers(spark, d):
    """Numbers from text, base price, sane values, unit repair."""
    p = table(spark, d, "part")
    t = F.when(F.col("p_partkey") % 5 == 0, " - ").when(F.col("p_partkey") % 5 == 1, F.format_string("%,d", (F.col("p_retailprice") * 100).cast("long"))).when(F.col("p_partkey") % 5 == 2, "0").otherwise(F.col("p_retailprice").cast("string"))
    price = F.col("p_retailprice")
    return p.select("p_partkey", numbers.number(t).alias("number"), numbers.amount(t).alias("amount"), numbers.count(t).alias("whole"), F.round(numbers.base_price(price, F.col("p_size") * 20.0), 6).alias("base"), numbers.sane(F.col("p_size") * 3.0, 100.0, 99.0).alias("sane"), F.round(numbers.repaired_scale(price, price * F.when(F.col("p_size") % 3 == 0, 1e6).when(F.col("p_size") % 3 == 1, 900.0).otherwise(1.5)), 4).alias("scaled"), numbers.holding_ratio(F.col("p_size").cast("double"), (F.col("p_partkey") % 10).cast("double")).alias("held"))


def q_calendar_events(spark, d):
    """One raw row becomes one to three dated events; rows without a date give none."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    ev = lambda kind, day, when: F.when(when, F.struct(F.lit(kind).alias("kind"), day.alias("event_day")))
    x = F.array_compact(F.array(ev("record", F.col("day"), F.lit(True)), ev("pay", F.date_add("day", 30), F.col("o_orderstatus") == "F"), ev("ex", F.date_sub("day", 1), F.col("o_orderstatus") != "O")))
    return o.select("o_orderkey", F.explode(x).alias("e")).select("o_orderkey", "e.kind", "e.event_day")


def q_agenda(spark, d):
    """Meetings grouped, agenda in order without repetition, and whether any part was cut."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.struct("l_linenumber", "l_returnflag"))).alias("a"), F.bool_or(F.col("l_quantity") > 49).alias("cut"))
    return li.select("l_orderkey", F.array_join(F.array_distinct(F.transform("a", lambda x: x["l_returnflag"])), ",").alias("agenda"), "cut")


def q_filing_heads(spark, d):
    """The head record of filings of a customer: status by precedence, first and latest, terms of the latest that has them."""
    o = table(spark, d, "orders")
    at = F.struct("o_orderdate", "o_orderkey")
    rank = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return o.groupBy("o_custkey").agg(F.min_by("o_orderstatus", rank).alias("status"), F.min_by("o_orderkey", at).alias("first"), F.max_by("o_orderkey", at).alias("latest"), F.max_by(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")), F.when(F.col("o_orderpriority") == "1-URGENT", at)).alias("terms"))


def q_json_props(spark, d):
    """JSON read by schema, keys and values taken, wrong rows NULL."""
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 97 == 0, "{broken").otherwise(F.col("props")).alias("j"))
    return e.select("event_id", F.from_json("j", "k INT", {"mode": "PERMISSIVE"})["k"].alias("k"))


def q_row_dedupe(spark, d):
    """Rows without repetition after trimming, blank rows gone."""
    p = table(spark, d, "part").select(F.concat(F.when(F.col("p_size") % 2 == 0, " ").otherwise(""), F.when(F.col("p_size") % 11 == 0, "").otherwise(F.col("p_name"))).alias("name"), F.when(F.col("p_size") % 11 == 0, " ").otherwise(F.col("p_type")).alias("kind"))
    return entity.first_of(p, "name", "kind").select(F.trim("name").alias("name"), F.trim("kind").alias("kind"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

_NK = "lower(regexp_replace(regexp_replace({x}, '주식회사|\\(주\\)|㈜|\\(유\\)|유한회사|\\(재\\)|\\(사\\)|Co\\.,?\\s*Ltd\\.?|Corp(oration)?\\.?|Inc\\.?|LLC|Ltd\\.?|Company', ' ', 'gi'), '[\\s·․.,''\"\\-()\\[\\]]+', '', 'g'))"
_BARE = "lower(regexp_replace({x}, '[^A-Za-z0-9가-힣]', '', 'g'))"
ORACLE_SQL = {
    "q_grounded": "WITH t AS (SELECT doc_id, text, substring(text, 1, 12) || '...' || CASE WHEN doc_id % 3 = 0 THEN 'zzzz' ELSE substring(text, 20, 10) END AS q FROM documents), b AS (SELECT doc_id, " + _BARE.format(x="coalesce(text, '')") + " AS b, " + _BARE.format(x="q") + " AS n, list_filter(list_transform(regexp_split_to_array(q, '\\.\\.\\.|…|⋯'), lambda p: " + _BARE.format(x="p") + "), lambda p: p <> '') AS p FROM t) SELECT doc_id, length(n) >= 4 AND (contains(b, n) OR (len(p) > 1 AND len(list_filter(p, lambda x: length(x) < 2 OR NOT contains(b, x))) = 0)) AS grounded FROM b",
    "q_numbers": "WITH p AS (SELECT *, CASE p_partkey % 5 WHEN 0 THEN ' - ' WHEN 1 THEN format('{:,}', trunc(p_retailprice * 100)::BIGINT) WHEN 2 THEN '0' ELSE p_retailprice::VARCHAR END AS t, p_retailprice - p_size * 20.0 AS b FROM part), n AS (SELECT *, try_cast(replace(trim(t), ',', '') AS DOUBLE) AS x FROM p) SELECT p_partkey, x AS number, nullif(x, 0) AS amount, CASE WHEN x = floor(x) THEN x::BIGINT END AS whole, CASE WHEN b > 0 AND abs(p_retailprice / b - 1) <= 0.3 THEN round(b, 6) END AS base, CASE WHEN p_size * 3.0 <> 99 AND p_size * 3.0 <= 100 THEN (p_size * 3.0)::DOUBLE END AS sane, round(p_retailprice * CASE p_size % 3 WHEN 0 THEN 1000000.0 WHEN 1 THEN 1000.0 ELSE 1.0 END, 4) AS scaled, round(p_size::DOUBLE / nullif(p_partkey % 10, 0) * 100, 4) AS held FROM n",
    "q_clean_text": "WITH t AS (SELECT page_id, regexp_replace(replace(replace(replace(replace(coalesce(html, ''), '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '<[^\\n]*?>', '', 'g') AS t FROM pages), c AS (SELECT page_id, lower(trim(regexp_replace(t, '[^가-힣a-zA-Z0-9]+', ' ', 'g'))) AS t FROM t) SELECT page_id, length(t) AS n, sha256(t) AS digest FROM c",
    "q_url_keys": "WITH p AS (SELECT page_id, regexp_replace(url, '^http', 'HTTP') || '/A/b//?q=' || page_id AS link FROM pages) SELECT page_id, rtrim(lower(split_part(link, '?', 1)), '/') AS stored_key, lower(regexp_extract(link, '^([A-Za-z]+)://([^/?#]+)([^?#;]*)', 1)) || '://' || lower(regexp_extract(link, '^([A-Za-z]+)://([^/?#]+)([^?#;]*)', 2)) || rtrim(regexp_extract(link, '^([A-Za-z]+)://([^/?#]+)([^?#;]*)', 3), '/') AS url_key FROM p",
    "q_name_keys": "WITH s AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '(주) ' WHEN 1 THEN '' ELSE '주식회사 ' END || 'Acme-' || (s_suppkey % 17) || CASE WHEN s_suppkey % 2 = 0 THEN ' Co., Ltd. (ACME Korea)' ELSE ', Inc.' END AS name FROM supplier), b AS (SELECT *, trim(regexp_replace(name, '\\((주|유|재|사)\\)|㈜', '', 'g')) AS bare FROM s) SELECT s_suppkey, " + _NK.format(x="name") + " AS key, 'original=' || name || CASE WHEN s_suppkey % 2 = 0 THEN ';paren_outer=' || trim(split_part(bare, '(', 1)) || ';paren_inner=ACME Korea' ELSE '' END AS forms, false AS several FROM b",
    "q_single_owner": "WITH c AS (SELECT p_name AS alias, p_partkey % 50 AS entity, p_size + 1 AS priority FROM part UNION ALL SELECT p_brand || ' ' || p_type, p_partkey % 40, p_size FROM part), p AS (SELECT alias, entity, min(priority) AS priority FROM c GROUP BY 1, 2), w AS (SELECT * FROM p QUALIFY priority = min(priority) OVER (PARTITION BY alias)) SELECT alias, min(entity) AS entity FROM w GROUP BY 1 HAVING count(*) = 1",
    "q_nearest_day": "WITH a AS (SELECT o_custkey AS k, o_orderdate::DATE + 1 AS day, o_orderkey AS asked FROM orders WHERE o_orderkey % 5 = 0), m AS (SELECT asked, o.o_orderkey, abs(o.o_orderdate::DATE - day) AS off FROM a JOIN orders o ON o.o_custkey = k AND o.o_orderkey % 5 <> 0 AND abs(o.o_orderdate::DATE - day) <= 3), b AS (SELECT asked, o_orderkey FROM m QUALIFY row_number() OVER (PARTITION BY asked ORDER BY off, o_orderkey) = 1) SELECT asked, o_orderkey FROM a LEFT JOIN b USING (asked)",
    "q_theme_overlap": "WITH p AS (SELECT p_brand, p_type, list(DISTINCT p_size) AS m FROM part GROUP BY 1, 2) SELECT a.p_brand, b.p_brand AS other, a.p_type, round(len(list_intersect(a.m, b.m)) / least(len(a.m), len(b.m)), 6) AS o FROM p a JOIN p b ON a.p_type = b.p_type AND a.p_brand < b.p_brand WHERE o >= 0.3",
    "q_constituents": "SELECT DISTINCT s_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber % 2 = 0 AND s_name = 'Supplier#' || lpad(l_suppkey::VARCHAR, 9, '0')",
    "q_title_filter": "WITH t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '[단독] (종합) ' ELSE '' END || split_part(text, chr(10), 1) AS title FROM documents), w AS (SELECT *, CASE WHEN len(regexp_extract_all(title, '[|]')) >= 4 THEN 'listing' WHEN len(regexp_extract_all(title, '[#$%&*]')) * 5 > length(title) THEN 'noise' WHEN regexp_matches(title, '(?i)all rights reserved|license') THEN 'excluded' END AS reason FROM t) SELECT doc_id, reason, CASE WHEN reason IS NULL THEN trim(regexp_replace(title, '^(\\s*\\[[^\\]]*\\])+\\s*', '')) END AS title FROM w",
    "q_sentences": "WITH a AS (SELECT doc_id, regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g') AS t FROM documents), s AS (SELECT doc_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS s FROM a) SELECT doc_id, len(s) AS n, sha256(coalesce(s[1], '')) AS lead, len(list_filter(s, lambda x: contains(x, 'the'))) AS with_word FROM s",
    "q_masked": "WITH m AS (SELECT conv_id, turn, trim(regexp_replace(replace(regexp_replace(replace(replace(replace(replace(replace(coalesce(text, ''), 'in the', chr(1)), 'que', chr(1)), 'the', chr(1)), 'und', chr(1)), 'of', chr(1)), '\\x01(\\s*[·,/&–-]?\\s*\\x01)+', chr(1), 'g'), chr(1), '[기업]'), '\\s+', ' ', 'g')) AS m FROM conversations) SELECT conv_id, turn, sha256(m) AS digest, len(regexp_extract_all(m, '\\[기업\\]')) AS masks FROM m",
    "q_summary_rules": "WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) SELECT doc_id, len(l) <= 4 AND len(list_filter(l, lambda x: length(x) > 400)) = 0 AND len(list_distinct(l)) = len(l) AS valid FROM t",
    "q_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate::DATE END AS start, o_orderdate::DATE + 3 AS stop, o_orderdate::DATE AS worded FROM orders",
    "q_published": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch(date_trunc('minute', ts))::BIGINT - 32400 WHEN 1 THEN epoch(date_trunc('minute', ts))::BIGINT WHEN 2 THEN epoch(date_trunc('minute', ts))::BIGINT - 32400 END AS at FROM events ",
    "q_month_windows": "WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS a, o_orderdate::DATE + 75 AS b FROM orders), w AS (SELECT *, unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH))::DATE AS m FROM o) SELECT o_orderkey, greatest(m, a) AS start, least(last_day(m), b) AS stop, strftime((date_trunc('month', a) - INTERVAL 5 MONTH), '%Y%m')::BIGINT AS shifted FROM w",
    "q_calendar_events": "SELECT o_orderkey, 'record' AS kind, o_orderdate::DATE AS event_day FROM orders UNION ALL SELECT o_orderkey, 'pay', o_orderdate::DATE + 30 FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'ex', o_orderdate::DATE - 1 FROM orders WHERE o_orderstatus <> 'O'",
    "q_agenda": "WITH f AS (SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag) AS p FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)), g AS (SELECT l_orderkey, l_returnflag, min(p) AS p FROM f GROUP BY 1, 2), c AS (SELECT l_orderkey, bool_or(l_quantity > 49) AS cut FROM lineitem GROUP BY 1) SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY p) AS agenda, any_value(cut) AS cut FROM g JOIN c USING (l_orderkey) GROUP BY 1",
    "q_filing_heads": "SELECT o_custkey, arg_min(o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS status, first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS first, last(o_orderkey ORDER BY o_orderdate, o_orderkey) AS latest, last(o_totalprice ORDER BY o_orderdate, o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS terms FROM orders GROUP BY 1",
    "q_json_props": "SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN (props->>'k')::INT END AS k FROM events",
    "q_row_dedupe": "SELECT DISTINCT p_name AS name, p_type AS kind FROM part WHERE p_size % 11 <> 0",
    "q_new_articles": "WITH p AS (SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://([^/?#]+)([^?#;]*)', 1)) || '://' || lower(regexp_extract(url, '^([A-Za-z]+)://([^/?#]+)([^?#;]*)', 2)) || rtrim(regexp_extract(url, '^([A-Za-z]+)://([^/?#]+)([^?#;]*)', 3), '/') AS u FROM pages), s AS (SELECT u FROM p WHERE page_id % 3 = 0 UNION SELECT u || '/m' FROM p WHERE page_id % 5 = 0) SELECT page_id FROM p WHERE u NOT IN (FROM s) AND u || '/m' NOT IN (FROM s)",
    "q_merge_themes": "WITH g AS (SELECT p_brand, p_type, min(p_partkey) AS place, list_sort(list(DISTINCT (p_partkey % 30)::VARCHAR)) AS m, max(p_name) AS reason FROM part GROUP BY 1, 2), u AS (SELECT p_brand, place, unnest(m) AS x, generate_subscripts(m, 1) AS i FROM g), f AS (SELECT p_brand, x, min((place, i)) AS pos FROM u GROUP BY 1, 2), r AS (SELECT p_brand, first(reason ORDER BY length(reason) DESC, place) AS reason FROM g GROUP BY 1) SELECT p_brand AS name, string_agg(x, ',' ORDER BY pos) AS members, any_value(reason) AS reason FROM f JOIN r USING (p_brand) GROUP BY 1",
}
