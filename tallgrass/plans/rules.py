"""Registered queries: rules of text and time over hand-made forms, whose SQL states what must come out, and sinks and selections that merge, guard and plan."""

from __future__ import annotations

import datetime

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.functions import dates, text
from tallgrass.operators import filings, html, linking, merge
from tallgrass.sources import landed, scans
from tallgrass.sources.tables import table


def _forms(spark, cases, schema):
    """A numbered table of hand-made cases."""
    return spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"n int, {schema}")


def _quoted(x) -> str:
    if x is None:
        return "NULL"
    return str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def _stated(results, kind: str) -> str:
    """SQL of the results that the cases must have, in order."""
    rows = ", ".join(f"({i}, {_quoted(r)})" for i, r in enumerate(results))
    return f"SELECT n::INTEGER AS n, r::{kind} AS result FROM (VALUES {rows}) v(n, r)"


# Publication times and the second since 1970 that each means.
_TIMES = (
    ("Mon, 01 Jan 2024 00:00:00 GMT", 1704067200), ("Mon, 01 Jan 2024 09:00:00 +0900", 1704067200), ("1 Jan 2024 09:00 +0900", 1704067200),
    ("2024-01-01T00:00:00Z", 1704067200), ("2024-01-01T00:00:00.123+00:00", 1704067200), ("2024-01-01T09:00:00.5+09:00", 1704067200),
    ("2024-01-01 09:00:00", 1704067200), ("2024-01-01T09:00", 1704067200), ("2024-01-01", 1704034800), ("2024.01.01. 09:00", 1704067200),
    ("2024.01.01. 10:20:30", 1704072030), ("2024.1.1. 9:00", 1704067200), (" 2024-01-01 09:00:00 ", 1704067200), ("2024.01.01 09:00", None), ("2024-13-01", None),
    ("yesterday", None), ("", None), (None, None),
)


def q_published_forms(spark, d):
    """Every form of a publication time."""
    return _forms(spark, [c[:1] for c in _TIMES], "t string").select("n", F.unix_seconds(dates.published_at(F.col("t"))).alias("result"))


_CLEAN = (
    ("&lt;b&gt;Up&lt;/b&gt; 3.5%&hellip; &middot; &amp;", "up 3 5"), ("<b>삼성전자</b>, 3분기 (잠정) 실적!", "삼성전자 3분기 잠정 실적"), ("a\n\t b c", "a b c"),
    ("1 < 2 and 3 > 2", "1 2"), ("<a\nb>", "a b"), ("", ""), (None, ""), ("漢字 ABC é", "abc"),
)


def q_clean_forms(spark, d):
    """Text for comparison."""
    return _forms(spark, [c[:1] for c in _CLEAN], "t string").select("n", text.clean_text(F.col("t")).alias("result"))


_LONG, _LONGER = "many words " * 11, "more words than many " * 8
# Pages, whether they are the anchor's, and their text, title and time.
_PAGES = (
    (f"<article>{_LONGER}</article><div id=articleBody><b>{_LONG}</b> end </div>", False, f"{_LONG.strip()}\nend", None, None),
    (f"<article>{_LONGER}</article><div id=articleBody>short</div>", False, _LONGER.strip(), None, None),
    (f"<div class='x content'>{_LONG}</div><div class=content>{_LONGER}<p>tail<script>no()</script></div>", False, f"{_LONGER.strip()}\ntail", None, None),
    (f"<header>h</header><p>{_LONG}<form>f</form><p>tiny</p></p><nav><p>{_LONGER}</p></nav>", False, f"{_LONG.strip()}\ntiny", None, None),
    ("<p>nothing here</p><meta property=og:title content=' &lt;b&gt;A &amp;amp; B&lt;/b&gt; '>", False, None, "A & B", None),
    ("<meta property=og:title content=second><h2 id=title_area><span>The</span> first</h2>", False, None, "The first", None),
    (f"<article>{_LONGER}</article><div itemprop=articleBody>{_LONG}</div><span class=_ARTICLE_DATE_TIME data-date-time='2024-01-01 10:00:00'>", True, _LONGER.strip(), None, "2024-01-01 10:00:00"),
    ("<meta name=article:published_time content=2024-01-02><meta property=article:published_time content=''>", True, None, None, "2024-01-02"),
    ("<meta name=article:published_time content=2024-01-02>", False, None, None, None), ("", False, None, None, None), (None, False, None, None, None),
)


def q_page_forms(spark, d):
    """Pages by ordered selectors: text, title and time, each empty where it lacks."""
    pages = _forms(spark, [(p, "https://news.example.com/1" if own else "https://example.org/1") for p, own, *_ in _PAGES], "html string, url string")
    x = html.page_texts(pages, "n", "html", "url", "example.com")
    return x.select("n", F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in ("title", "published", "text"))).alias("result"))


# Reports with sections in broken markup, and the part that tells of the business.
_SECTIONS = (
    ("<SECTION-1><SECTION-2><TITLE>1. 회사의 개요</TITLE><P>name</P></SECTION-2><SECTION-2><TITLE>1. 사업의 개요</TITLE><P>makes\n <b>cells</b></P><TABLE><TR><TD>9</TD></TR></TABLE> and sells &amp; ships</SECTION-2>", "makes cells and sells & ships"),
    ("<SECTION-2><TITLE ATOC='Y'>사업의 개요</TITLE><TABLE>only</TABLE></SECTION-2><SECTION-2><TITLE>회사의 <b>개요</b></TITLE>who it is<SECTION-2><TITLE>x</TITLE>y", "who it is"),
    ("<P>목 차</P><P>사업의 개요</P> <P>주요 사업의 내용</P><P>sells</P>", "sells"), ("<P>회사의 개요 </P>told here", "told here"), ("<P>nothing</P>", ""), ("", ""), (None, ""),
    ("<SECTION-2><TITLE>사업의 개요</TITLE>" + "a" * 5000 + "</SECTION-2>", "a" * 4000),
)


def q_business_section(spark, d):
    """The section of a report that tells of the business, by title, else behind a keyword; its first 4,000 characters."""
    return _forms(spark, [c[:1] for c in _SECTIONS], "t string").select("n", filings.business_section(F.col("t")).alias("result"))


_BRACKETS = (("[속보] [단독] 제목", "제목"), (" [1보]제목 [사진]", "제목 [사진]"), ("(종합) 제목", "(종합) 제목"), ("<b> 제목", "<b> 제목"), ("【속보】 제목", "【속보】 제목"), ("[속보", "[속보"), ("[]", ""), (None, None))


def q_bracket_forms(spark, d):
    """Square brackets before a title."""
    return _forms(spark, [c[:1] for c in _BRACKETS], "t string").select("n", text.without_leading_brackets(F.col("t")).alias("result"))


_RESTORED = (
    ("Big order from abroad...", "[Exclusive] Big order from abroad for batteries - Daily Press", "Big order from abroad for batteries"),
    ("Big order from abroad…", "Big order  from abroad for batteries | Press", "Big order from abroad for batteries"),
    ("A - B merge...", "A - B merge done", "A - B merge done"), ("Whole title", "Whole title and more", "Whole title"), ("Other story...", "Big order from abroad", "Other story..."),
    ("Same...", "Same...", "Same..."), ("...", "Big order", "..."), ("Cut &amp; run…", "<b>Cut &amp; run</b> again", "Cut &amp; run…"), ("Cut…", None, "Cut…"), (None, "x", None),
)


def q_restored_titles(spark, d):
    """Titles that a feed cut, from their pages."""
    return _forms(spark, [c[:2] for c in _RESTORED], "t string, p string").select("n", text.restored_title(F.col("t"), F.col("p")).alias("result"))


_MASKED = (
    ("Acme·Acme Korea, Beta/Beta & Acme win", "[기업] win"), ("Acme and Beta", "[기업] and [기업]"), ("Acme – Beta – Acme", "[기업]"), ("no  names", "no names"), ("Acme;Beta", "[기업];[기업]"), ("", ""),
)


def q_masked_forms(spark, d):
    """Names joined by signs become one mask."""
    aliases = F.array(*map(F.lit, ("Acme", "Acme Korea", "Beta")))
    return _forms(spark, [c[:1] for c in _MASKED], "t string").select("n", text.masked(F.col("t"), aliases).alias("result"))


_GROUNDED = (
    ("a...b...c...d", "zzz", False), ("Order of 300 units", "an ORDER of 300-units came", True), ("order…units", "order of units", True), ("order…cars", "order of units", False),
    ("abc", "abc", False), ("order ... x", "order of x", False), ("or...der", "order", True), ("계약 체결", "계약체결 완료", True), (None, "abcd", False), ("abcd", None, False), ("...abcd", "zz abcd", True),
)


def q_grounded_forms(spark, d):
    """Quotations with and without ellipses."""
    return _forms(spark, [c[:2] for c in _GROUNDED], "q string, b string").select("n", F.coalesce(text.grounded(F.col("q"), F.col("b")), F.lit(False)).alias("result"))


_REPORTS = (("[기재정정][첨부추가] 증권신고서(지분증권)", "증권신고서(지분증권)"), (" [정정] 투자설명서 ", "투자설명서"), ("철회신고서", "철회신고서"), ("증권 [a]", "증권 [a]"), (None, ""))


def q_report_names(spark, d):
    """Names of reports without the tags before them."""
    return _forms(spark, [c[:1] for c in _REPORTS], "t string").select("n", linking.base_report_name(F.col("t")).alias("result"))


def q_offer_heads(spark, d):
    """Heads of filings keep the earliest stored receipt; names tell blank-cheque companies; a status comes from the reply or its message."""
    o = table(spark, d, "orders")
    head = o.groupBy(F.col("o_custkey").alias("corp")).agg(F.min("o_orderkey").alias("first_receipt"), F.min_by(F.col("o_orderdate").cast("date"), "o_orderkey").alias("first_day"))
    stored = o.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("corp")).agg((F.min("o_orderkey") - F.when(F.col("corp") % 2 == 0, 5000).otherwise(0)).alias("s_receipt"), F.date_add(F.min_by(F.col("o_orderdate").cast("date"), "o_orderkey"), -3).alias("s_day"))
    x = head.join(stored, "corp", "left")
    older = F.col("s_receipt").isNotNull() & (F.col("s_receipt") < F.col("first_receipt"))
    name = F.concat(F.lit("Corp"), F.when(F.col("corp") % 7 == 0, "기업인수목적").otherwise(""))
    status = linking.error_status(F.when(F.col("corp") % 3 == 0, "013").otherwise(""), F.concat(F.lit("<status> "), F.lpad((F.col("corp") % 900).cast("string"), 3, "0"), F.lit(" </status>")))
    return x.select("corp", F.when(older, F.col("s_receipt")).otherwise(F.col("first_receipt")).alias("first_receipt"), F.when(older, F.col("s_day")).otherwise(F.col("first_day")).alias("first_day"), linking.is_blank_cheque(name).alias("spac"), status.alias("status"))


def q_filing_updates(spark, d):
    """Heads overwrite, terms, readiness and codes are set apart from them, only where a row is stored."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("corp"), "o_orderkey", "o_totalprice", "o_orderstatus")
    last = F.max_by("o_totalprice", "o_orderkey")
    stored = o.filter("o_orderkey % 3 = 0").groupBy("corp").agg(F.max("o_orderkey").alias("latest"), F.lit(None).cast("double").alias("terms"), F.lit(False).alias("ready"), F.lit(None).cast("string").alias("code"))
    heads = o.filter("o_orderkey % 3 = 1").groupBy("corp").agg(F.max("o_orderkey").alias("latest"))
    heads = heads.withColumns({"terms": F.lit(None).cast("double"), "ready": F.lit(False), "code": F.lit(None).cast("string")})
    x = merge.upsert(stored, heads, ["corp"], {"terms": "keep", "ready": "keep", "code": "keep"})
    terms = o.filter("o_orderstatus = 'F'").groupBy("corp").agg(last.alias("new_terms"))
    marks = o.filter("o_orderstatus = 'P'").select("corp").distinct().withColumn("mark", F.lit(True))
    x = x.join(terms, "corp", "left").join(marks, "corp", "left")
    return x.select("corp", "latest", F.coalesce("new_terms", "terms").alias("terms"), (F.col("ready") | F.coalesce("mark", F.lit(False))).alias("ready"), F.when(F.col("corp") % 5 == 0, F.concat(F.lit("T"), F.col("corp").cast("string"))).otherwise(F.col("code")).alias("code"))


def q_expression_key(spark, d):
    """K9: financials overwrite on a key in which a missing receipt counts as an empty one."""
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("company"), F.col("l_returnflag").alias("kind"), F.when(F.col("l_linenumber") < 3, F.col("l_linestatus")).alias("receipt"), "l_orderkey", "l_extendedprice")
    keys = ["company", "kind", "key"]
    one = lambda x: x.withColumn("key", F.coalesce("receipt", F.lit(""))).groupBy(*keys).agg(F.sum("l_extendedprice").alias("revenue"), F.max("l_orderkey").alias("source"))
    merged = merge.upsert(one(li.filter("l_orderkey % 2 = 0")), one(li.filter("l_orderkey % 2 = 1 and company % 3 <> 0")), keys, {})
    return merged.select("company", "kind", "key", F.round("revenue", 2).alias("revenue"), "source")


def q_gazetteer(spark, d):
    """A full replacement is taken, or refused where it has less than half of the stored rows."""
    p = table(spark, d, "part").select(F.col("p_name").alias("alias"), F.col("p_partkey").alias("entity"))
    out = None
    for name, part in (("most", p.filter("entity % 4 <> 0")), ("few", p.filter("entity % 4 = 0"))):
        try:
            now, taken = merge.replace_guarded(p, part), True
        except ValueError:
            now, taken = p, False
        x = now.agg(F.count("*").alias("rows"), F.count_distinct("alias").alias("aliases")).select(F.lit(name).alias("attempt"), F.lit(taken).alias("taken"), "rows", "aliases")
        out = x if out is None else out.unionByName(x)
    return out


def q_effective_day(spark, d):
    """The time that counts is that of publication, else of collection, else now."""
    o = table(spark, d, "orders")
    published, collected = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("timestamp")), F.when(F.col("o_orderkey") % 3 == 1, F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 30 HOURS"))
    return o.select("o_orderkey", dates.effective_at(published, collected, F.lit("2024-05-05 12:00:00").cast("timestamp")).cast("date").alias("day"))


def q_token_cost(spark, d):
    """Costs of calls by price tables for a million tokens; a model without prices costs nothing and is named."""
    prices = spark.createDataFrame([(0, 3.3, 16.5), (1, 1.1, 5.5), (2, 0.6, 3.0)], "model int, price_in double, price_out double")
    e = table(spark, d, "documents").select((F.col("doc_id") % 4).cast("int").alias("model"), F.length("text").alias("tokens_in"), (F.length("text") / 10).cast("long").alias("tokens_out"))
    cost = (F.col("tokens_in") * F.coalesce("price_in", F.lit(0.0)) + F.col("tokens_out") * F.coalesce("price_out", F.lit(0.0))) / 1e6
    return e.join(F.broadcast(prices), "model", "left").groupBy("model").agg(F.count("*").alias("calls"), F.round(F.sum(cost), 6).alias("cost"), F.max(F.col("price_in").isNull()).alias("unpriced"))


def q_embedding_plan(spark, d):
    """What lacks an embedding, in order, in chunks of at most 512 of each language."""
    docs, stored = table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id")).filter("doc_id % 3 = 0")
    missing = docs.join(stored, "doc_id", "left_anti")
    place = F.row_number().over(W.partitionBy("lang").orderBy("doc_id")) - 1
    return missing.select("doc_id", "lang", F.floor(place / 512).alias("chunk"), (place % 512).cast("long").alias("place"))


def q_member_articles(spark, d):
    """H4: members of each cluster with the length of their texts, by time, those without a time last."""
    x = table(spark, d, "documents").select("source", "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("length"), F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") * 7919 % 1000).alias("at"))
    return x.select("source", "doc_id", "length", F.row_number().over(W.partitionBy("source").orderBy(F.col("at").asc_nulls_last(), "doc_id")).alias("place"))


def q_candidate_since(spark, d):
    """H6: the earliest time from which stored clusters may take a batch's rows, and the rows of other batches from then on."""
    o = table(spark, d, "orders").select("o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    since = o.filter("day >= DATE'1997-01-01'").groupBy("o_orderpriority").agg(F.date_sub(F.min("day"), 10).alias("since"))
    return o.filter("day < DATE'1997-01-01'").join(F.broadcast(since), "o_orderpriority").filter("day >= since").groupBy("o_orderpriority", "since").agg(F.count("*").alias("candidates"))


def q_graph_patterns(spark, d):
    """Companies that belong to a theme and have an event, listed ones only; edges without a reason are counted apart."""
    belongs = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("company"), F.col("l_returnflag").alias("theme"), F.when(F.col("l_quantity") > 2, F.col("l_shipmode") if "l_shipmode" in table(spark, d, "lineitem").columns else F.col("l_linestatus")).alias("reason"))
    listed = table(spark, d, "supplier").filter("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("company"))
    events = table(spark, d, "lineitem").filter("l_quantity = 50").select(F.col("l_suppkey").alias("company")).distinct()
    x = belongs.join(listed, "company", "left_semi").join(events, "company", "left_semi")
    return x.groupBy("theme").agg(F.count_distinct("company").alias("companies"), F.count_if(F.col("reason").isNull()).alias("without_reason"))


def q_map_pairs(spark, d):
    """Keys and values of stored maps, one row for each pair."""
    e = table(spark, d, "events").select("event_type" if "event_type" in table(spark, d, "events").columns else "event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return e.groupBy("key", "value").agg(F.count("*").alias("n"))


def q_link_candidates(spark, d):
    """Who may be whose parent: earlier, within the days, and by tiers of cosine: shared companies, none on both sides, else."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    company = F.when(F.col("vec_id") % 5 != 0, F.array((F.col("vec_id") % 7).cast("long"), (F.col("vec_id") % 11 + 7).cast("long"))).otherwise(F.array().cast("array<long>"))
    items = e.select(F.col("vec_id").alias("id"), (F.col("vec_id") * 6 % 1000).cast("int").alias("day"), company.alias("linked"), "embedding")
    return linking.candidates(items, 90).select("child", "parent", F.round("cosine", 6).alias("cosine"))


def q_theme_identity(spark, d):
    """names that mean one theme: equal when normalised, else one with a parenthesis whose members cover those of the one without by 0.8."""
    p = table(spark, d, "part").filter("p_size <= 40").select(F.col("p_brand").alias("core"), F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("stock"), (F.col("p_size") % 8).alias("k"))
    generic = p.filter("k < 2").groupBy(F.col("core").alias("name")).agg(F.collect_set("stock").alias("stocks"))
    detailed = p.filter(F.when(F.col("core").endswith("1"), F.col("k") < 3).otherwise(F.col("k") == 1)).groupBy(F.concat(F.lower("core"), F.lit(" ( x )")).alias("name")).agg(F.collect_set("stock").alias("stocks"))
    return linking.same_themes(detailed, generic).select("name", "existing")


def q_theme_texts(spark, d):
    """The texts of themes and of reasons from which embeddings are made."""
    p = table(spark, d, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("about"))
    return p.select("p_partkey", linking.theme_text(F.col("p_name"), F.col("about")).alias("theme_text"), linking.reason_text(F.col("p_name"), F.coalesce("about", F.lit("-"))).alias("reason_text"))


def q_issue_texts(spark, d):
    """X11: a title, the change that a summary names or else its first sentence, and the first titles of members, one a line."""
    x = table(spark, d, "documents").select("doc_id", "source", F.split("text", "\n")[0].alias("title"), "text")
    members = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "title"))), lambda m: m["title"])
    heads = x.groupBy("source").agg(members.alias("titles"), F.min_by("title", "doc_id").alias("title"), F.min_by("text", "doc_id").alias("summary"))
    kind = F.when(F.length("source") % 2 == 0, "CHANGE").otherwise("CAUSE")
    points = F.array(F.struct(kind.alias("kind"), F.concat(F.lit(" what  changed in "), F.col("source")).alias("text")))
    line = linking.node_summary(points, F.col("summary"))
    return heads.select("source", F.sha2(linking.embedding_text(F.col("title"), line, F.col("titles"), 3), 256).alias("digest"), F.length(line).cast("long").alias("summary_length"))


def q_search_pages(spark, d):
    """Pages of a newest-first search up to the first whose last item is older than the cutoff; of repeated links the first stays."""
    p = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("link"), (F.row_number().over(W.partitionBy("o_orderpriority").orderBy(F.col("o_orderdate").desc(), "o_orderkey")) - 1).alias("place"), "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    return linking.collected_pages(p, "o_orderpriority", "place", "link", "day", F.lit("1997-06-01").cast("date"), 25).select("o_orderpriority", "o_orderkey", "place")


def q_range_scan(spark, d):
    """The requests that bring all rows of a source that cuts responses at 30: ranges halved, crowded days by kind, then ticker by ticker."""
    o = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("day"), "o_orderpriority", (F.col("o_custkey") % 7).alias("ticker"))
    return scans.scan(o, "day", "ticker", datetime.date(1990, 1, 1), datetime.date(2001, 12, 31), 30, "o_orderpriority")


def q_newest_folder(spark, d):
    """Of dated folders, the newest that holds all required files, read back."""
    root = landed.scratch(spark, "dated")
    for name, tables in (("20240105", ("nation", "region")), ("20240203", ("nation", "region")), ("20240301", ("nation",)), ("latest", ("nation", "region"))):
        for t in tables:
            table(spark, d, t).withColumn("folder", F.lit(name)).write.mode("overwrite").parquet(f"{root}/{name}/{t}")
    found = landed.newest_folder(spark, root, ("nation", "region"))
    return spark.read.parquet(f"{found}/nation").select("folder", "n_nationkey")


def q_stock_master(spark, d):
    """A master file of fixed widths in cp949, written and read back: codes, names, groups, flags, shares times a thousand, and all fields as a map."""
    root = landed.scratch(spark, "master")
    p = table(spark, d, "part").select(F.concat(F.rpad(F.col("p_partkey").cast("string"), 9, " "), F.rpad(F.concat(F.lit("KR"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")), 12, " "), F.rpad(F.concat(F.lit("한국"), F.col("p_partkey").cast("string")), 40, " "), F.when(F.col("p_size") % 2 == 0, "ST").otherwise("EF"), F.when(F.col("p_size") % 3 == 0, "Y").otherwise("N"), F.lpad(F.col("p_size").cast("string"), 15, "0")).alias("value"))
    landed.write_lines(p, root, "cp949")
    lines = landed.text_lines(spark, root, "cp949")
    return landed.stock_master(lines, "value", {"group": 2, "suspended": 1, "shares": 15}).select("ticker", "standard_code", "name", "group", "suspended", "listed_shares", F.col("raw")["shares"].alias("raw_shares"))


def q_canonical_text(spark, d):
    """Text with every name of the gazetteer replaced by its entity's name, longest match first."""
    names = {"lt": "LT Corp", "LT Chem": "LT Chemicals", "LT": "LT Corp", "Beta": "Beta Bio"}
    c = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("LT Chem and Beta vs LT; BetaX "), F.col("o_orderstatus")).alias("t"))
    return c.select("o_orderkey", linking.canonical(F.col("t"), names).alias("text"))


def q_contract_filings(spark, d):
    """Filings of contracts: sections, labels and values of tables with spans, typed fields, conditions, notes and corrections."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("k"), F.date_format("o_orderdate", "yyyy.MM.dd").alias("day"), "o_orderstatus", F.floor("o_totalprice").cast("long").cast("string").alias("price"))
    tr = lambda *cells: F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))
    td = lambda value, more="": F.concat(F.lit(f"<td{more}>"), value if not isinstance(value, str) else F.lit(value), F.lit("</td>"))
    fixes = F.concat(F.lit("<table>"), tr(td("1. 정정관련 공시서류", " colspan=2"), td("단일판매 공급계약체결")), tr(td("2. 정정관련 공시서류제출일", " colspan=2"), td(F.col("day"))), tr(td("정정항목"), td("정정전"), td("정정후")), tr(td("계약금액"), td("10"), td(F.col("price"))), F.lit("</table>"))
    body = F.concat(
        F.lit("<table>"), tr(td("1. 판매ㆍ공급계약 구분", " colspan=2"), td("공사수주")), tr(td("- 체결계약명", " colspan=2"), td(F.concat(F.lit("Plant "), F.col("k")))), tr(td("2. 계약내역", " rowspan=3"), td("계약금액(원)"), td(F.concat(F.lit("1,"), F.substring(F.concat(F.lit("00"), F.col("k")), -3, 3)))),
        tr(td("최근매출액(원)"), td(F.col("price"))), tr(td("매출액대비(%)"), td("12.5 %")), tr(td("3. 계약상대", " colspan=2"), td(F.when(F.col("o_orderstatus") == "O", "-").otherwise("Buyer"))), tr(td("- 최근매출액(원)", " colspan=2"), td("n/a")),
        tr(td("5. 계약기간", " rowspan=2"), td("시작일"), td(F.col("day"))), tr(td("종료일"), td("계약 종료시")), tr(td("6. 주요 계약조건", " rowspan=2"), td("대금 지급"), td("monthly")), tr(td("선급금"), td("-")),
        tr(td("9. 기타 투자판단에 참고할 사항", " colspan=3")), tr(td("text one", " colspan=3")), tr(td("text two", " colspan=3")), tr(td("※ 관련공시", " colspan=2"), td("-")), F.lit("</table>"),
    )
    pages = o.select("o_orderkey", F.concat(F.when(F.col("o_orderstatus") == "F", fixes).otherwise(""), body).alias("html"))
    x = filings.contracts(pages, "o_orderkey", "html")
    return x.select("o_orderkey", "contract_type", "contract_name", "contract_amount", "recent_sales", "counterparty_recent_sales", "sales_ratio", "counterparty", "start_date", "end_date", F.col("conditions")["대금 지급"].alias("payment"), F.col("conditions")["선급금"].alias("advance"), "note", "related_disclosures", "is_correction", "correction_target_report", "correction_target_date", F.get("corrected", F.lit(0))["after"].alias("after"))


def q_reset(spark, d):
    """A full reset: assignments and derived tables are emptied, sources stay."""
    o = table(spark, d, "orders")
    kept, emptied = o.agg(F.count("*").alias("rows")).select(F.lit("source").alias("what"), "rows"), o.filter(F.lit(False)).agg(F.count("*").alias("rows")).select(F.lit("clusters").alias("what"), "rows")
    return kept.unionByName(emptied)


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

ORACLE_SQL = {
    "q_published_forms": _stated([c[-1] for c in _TIMES], "BIGINT"),
    "q_clean_forms": _stated([c[-1] for c in _CLEAN], "VARCHAR"),
    "q_page_forms": _stated(["|".join(x or "" for x in (title, time, t)) for _, _, t, title, time in _PAGES], "VARCHAR"),
    "q_business_section": _stated([c[-1] for c in _SECTIONS], "VARCHAR"),
    "q_bracket_forms": _stated([c[-1] for c in _BRACKETS], "VARCHAR"),
    "q_restored_titles": _stated([c[-1] for c in _RESTORED], "VARCHAR"),
    "q_masked_forms": _stated([c[-1] for c in _MASKED], "VARCHAR"),
    "q_grounded_forms": _stated([c[-1] for c in _GROUNDED], "BOOLEAN"),
    "q_report_names": _stated([c[-1] for c in _REPORTS], "VARCHAR"),
    "q_offer_heads": """
WITH h AS (SELECT o_custkey AS corp, min(o_orderkey) AS r, arg_min(o_orderdate::DATE, o_orderkey) AS d FROM orders GROUP BY 1),
s AS (SELECT o_custkey AS corp, min(o_orderkey) - CASE WHEN o_custkey % 2 = 0 THEN 5000 ELSE 0 END AS r, arg_min(o_orderdate::DATE, o_orderkey) - 3 AS d FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT corp, least(h.r, s.r) AS first_receipt, CASE WHEN s.r < h.r THEN s.d ELSE h.d END AS first_day, corp % 7 = 0 AS spac,
  CASE WHEN corp % 3 = 0 THEN '013' ELSE lpad((corp % 900)::VARCHAR, 3, '0') END AS status FROM h LEFT JOIN s USING (corp)
""",
    "q_filing_updates": """
WITH c AS (SELECT o_custkey AS corp, max(o_orderkey) FILTER (o_orderkey % 3 = 0) AS s, max(o_orderkey) FILTER (o_orderkey % 3 = 1) AS h,
  arg_max(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'F') AS terms, coalesce(bool_or(o_orderstatus = 'P'), false) AS ready FROM orders GROUP BY 1)
SELECT corp, coalesce(h, s) AS latest, terms, ready, CASE WHEN corp % 5 = 0 THEN 'T' || corp END AS code FROM c WHERE s IS NOT NULL OR h IS NOT NULL
""",
    "q_expression_key": """
WITH l AS (SELECT l_suppkey AS company, l_returnflag AS kind, coalesce(CASE WHEN l_linenumber < 3 THEN l_linestatus END, '') AS key, l_orderkey, l_extendedprice FROM lineitem),
g AS (SELECT company, kind, key, l_orderkey % 2 AS fresh, sum(l_extendedprice) AS revenue, max(l_orderkey) AS source FROM l WHERE l_orderkey % 2 = 0 OR company % 3 <> 0 GROUP BY 1, 2, 3, 4)
SELECT company, kind, key, round(arg_max(revenue, fresh), 2) AS revenue, arg_max(source, fresh) AS source FROM g GROUP BY 1, 2, 3
""",
    "q_gazetteer": "SELECT 'most' AS attempt, true AS taken, count(*) AS rows, count(DISTINCT p_name) AS aliases FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT 'few', false, count(*), count(DISTINCT p_name) FROM part",
    "q_effective_day": "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN (o_orderdate::TIMESTAMP + INTERVAL 30 HOURS)::DATE ELSE DATE '2024-05-05' END AS day FROM orders",
    "q_token_cost": """
SELECT (doc_id % 4)::INTEGER AS model, count(*) AS calls, round(sum((length(text) * CASE doc_id % 4 WHEN 0 THEN 3.3 WHEN 1 THEN 1.1 WHEN 2 THEN 0.6 ELSE 0 END
  + length(text) // 10 * CASE doc_id % 4 WHEN 0 THEN 16.5 WHEN 1 THEN 5.5 WHEN 2 THEN 3.0 ELSE 0 END)::DOUBLE / 1e6), 6) AS cost, doc_id % 4 = 3 AS unpriced FROM documents GROUP BY ALL
""",
    "q_embedding_plan": """
WITH m AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE vec_id % 3 = 0))
SELECT doc_id, lang, p // 512 AS chunk, p % 512 AS place FROM m
""",
    "q_member_articles": "SELECT source, doc_id, coalesce(length(text), 0) AS length, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN doc_id % 5 <> 0 THEN doc_id * 7919 % 1000 END NULLS LAST, doc_id) AS place FROM documents",
    "q_candidate_since": """
WITH s AS (SELECT o_orderpriority, min(o_orderdate::DATE) - 10 AS since FROM orders WHERE o_orderdate::DATE >= DATE '1997-01-01' GROUP BY 1)
SELECT o_orderpriority, since, count(*) AS candidates FROM orders JOIN s USING (o_orderpriority) WHERE o_orderdate::DATE < DATE '1997-01-01' AND o_orderdate::DATE >= since GROUP BY 1, 2
""",
    "q_graph_patterns": """
SELECT l_returnflag AS theme, count(DISTINCT l_suppkey) AS companies, count(*) FILTER (NOT l_quantity > 2) AS without_reason FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0) AND l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50) GROUP BY 1
""",
    "q_map_pairs": "WITH k AS (SELECT props, unnest(json_keys(props)) AS key FROM events) SELECT key, json_extract_string(props, '$.\"' || key || '\"') AS value, count(*) AS n FROM k GROUP BY 1, 2",
    "q_link_candidates": """
WITH v AS (SELECT vec_id AS id, (vec_id * 6 % 1000)::INTEGER AS day, CASE WHEN vec_id % 5 <> 0 THEN [vec_id % 7, vec_id % 11 + 7] ELSE [] END AS l,
  list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS e FROM embeddings),
p AS (SELECT c.id AS child, p.id AS parent, list_dot_product(c.e, p.e) AS cosine, len(list_intersect(c.l, p.l)) > 0 AS shared, len(c.l) = 0 AND len(p.l) = 0 AS neither
  FROM v c JOIN v p ON (p.day, p.id) < (c.day, c.id) AND c.day - p.day <= 90)
SELECT child, parent, round(cosine, 6) AS cosine FROM p WHERE cosine >= CASE WHEN shared THEN 0.10 WHEN neither THEN 0.50 ELSE 0.45 END
""",
    "q_theme_identity": """
WITH p AS (SELECT p_brand AS core, 's' || p_partkey AS stock, p_size % 8 AS k FROM part WHERE p_size <= 40),
g AS (SELECT core AS existing, list(DISTINCT stock) AS m FROM p WHERE k < 2 GROUP BY 1),
x AS (SELECT core, lower(core) || ' ( x )' AS name, list(DISTINCT stock) AS m FROM p WHERE CASE WHEN ends_with(core, '1') THEN k < 3 ELSE k = 1 END GROUP BY 1)
SELECT name, existing FROM x JOIN g ON core = existing WHERE len(list_intersect(g.m, x.m)) >= 0.8 * len(g.m)
""",
    "q_theme_texts": "SELECT p_partkey, p_name || chr(10) || CASE WHEN p_size % 3 <> 0 THEN p_type ELSE '' END AS theme_text, '[' || p_name || '] ' || CASE WHEN p_size % 3 <> 0 THEN p_type ELSE '-' END AS reason_text FROM part",
    "q_search_pages": """
WITH p AS (SELECT o_orderkey, o_custkey, o_orderpriority AS g, o_orderdate::DATE AS day, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) - 1 AS place FROM orders),
l AS (SELECT g, place // 25 AS page, arg_max(day, place) AS last FROM p GROUP BY 1, 2),
e AS (SELECT g, min(page) AS stop FROM l WHERE last < DATE '1997-06-01' GROUP BY 1)
SELECT g AS o_orderpriority, o_orderkey, place FROM p LEFT JOIN e USING (g) WHERE place // 25 <= coalesce(stop, 1000000000) QUALIFY row_number() OVER (PARTITION BY g, o_custkey ORDER BY place) = 1
""",
    "q_range_scan": """
WITH RECURSIVE c AS (SELECT date_trunc('month', o_orderdate)::DATE AS d, o_orderpriority AS s, o_custkey % 7 AS t, count(*) AS n FROM orders GROUP BY ALL), v(side) AS (VALUES (0), (1)),
r(lo, hi) AS (SELECT DATE '1990-01-01', DATE '2001-12-31' UNION ALL
  SELECT CASE side WHEN 0 THEN lo ELSE lo + ((hi - lo) // 2 + 1)::INTEGER END, CASE side WHEN 0 THEN lo + ((hi - lo) // 2)::INTEGER ELSE hi END
  FROM r, v WHERE lo < hi AND (SELECT sum(n) FROM c WHERE d BETWEEN r.lo AND r.hi) > 30),
f AS (SELECT lo, hi, sum(n) AS n FROM r JOIN c ON d BETWEEN lo AND hi GROUP BY 1, 2),
o AS (SELECT s, d, sum(n) AS n FROM c WHERE d IN (SELECT lo FROM f WHERE lo = hi AND n > 30) GROUP BY 1, 2),
k AS (SELECT s, d FROM o WHERE n > 30), b AS (SELECT s, min(d) AS lo, max(d) AS hi FROM k GROUP BY 1),
q(s, t, lo, hi) AS (SELECT b.s, x.t, b.lo, b.hi FROM b, (SELECT DISTINCT t FROM c) x UNION ALL
  SELECT s, t, CASE side WHEN 0 THEN lo ELSE lo + ((hi - lo) // 2 + 1)::INTEGER END, CASE side WHEN 0 THEN lo + ((hi - lo) // 2)::INTEGER ELSE hi END
  FROM q, v WHERE lo < hi AND (SELECT sum(c.n) FROM c WHERE c.s = q.s AND c.t = q.t AND d BETWEEN q.lo AND q.hi) > 30),
g AS (SELECT q.s, q.t, lo, hi, sum(c.n) AS n, sum(CASE WHEN k.d IS NOT NULL THEN c.n ELSE 0 END) AS kept FROM q JOIN c ON c.s = q.s AND c.t = q.t AND c.d BETWEEN lo AND hi LEFT JOIN k ON k.s = c.s AND k.d = c.d GROUP BY 1, 2, 3, 4)
SELECT NULL::VARCHAR AS split, NULL::VARCHAR AS ticker, lo, hi, n::BIGINT AS n, false AS cut FROM f WHERE n <= 30 UNION ALL SELECT s, NULL, d, d, n::BIGINT, false FROM o WHERE n <= 30
UNION ALL SELECT s, t::VARCHAR, lo, hi, kept::BIGINT, n > 30 FROM g WHERE (n <= 30 OR lo = hi) AND kept > 0
""",
    "q_newest_folder": "SELECT '20240203' AS folder, n_nationkey FROM nation",
    "q_stock_master": """
SELECT lpad(p_partkey::VARCHAR, greatest(6, length(p_partkey::VARCHAR))::INTEGER, '0') AS ticker, 'KR' || lpad(p_partkey::VARCHAR, 10, '0') AS standard_code, '한국' || p_partkey AS name,
  CASE WHEN p_size % 2 = 0 THEN 'ST' ELSE 'EF' END AS "group", p_size % 3 = 0 AS suspended, p_size::BIGINT * 1000 AS listed_shares, lpad(p_size::VARCHAR, 15, '0') AS raw_shares FROM part
""",
    "q_canonical_text": "SELECT o_orderkey, 'LT Chemicals and Beta Bio vs LT Corp; BetaX ' || o_orderstatus AS text FROM orders",
    "q_contract_filings": """
SELECT o_orderkey, '공사수주' AS contract_type, 'Plant ' || o_orderkey AS contract_name, ('1' || right('00' || o_orderkey, 3))::BIGINT AS contract_amount, floor(o_totalprice)::BIGINT AS recent_sales, NULL::BIGINT AS counterparty_recent_sales, 12.5::DOUBLE AS sales_ratio,
  CASE WHEN o_orderstatus <> 'O' THEN 'Buyer' END AS counterparty, strftime(o_orderdate, '%Y-%m-%d') AS start_date, '계약 종료시' AS end_date, 'monthly' AS payment, '-' AS advance, 'text one text two' AS note, NULL::VARCHAR AS related_disclosures,
  o_orderstatus = 'F' AS is_correction, CASE WHEN o_orderstatus = 'F' THEN '단일판매 공급계약체결' END AS correction_target_report, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS correction_target_date,
  CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice)::BIGINT::VARCHAR END AS after FROM orders
""",
    "q_reset": "SELECT 'source' AS what, count(*) AS rows FROM orders UNION ALL SELECT 'clusters', 0",
}
