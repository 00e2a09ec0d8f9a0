"""Registered queries on small tables of odd rows, against their SQL or brute force."""

import duckdb
from pyspark.sql import functions as F

from tallgrass.functions import text
from tallgrass.plans import registry
from tests.oracle import rows


def _folder(spark, tmp_path, **tables):
    """A folder with these tables, each (rows, schema), and a DuckDB connection that sees them."""
    con = duckdb.connect()
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return str(tmp_path), con


def _same(spark, name, folder, con):
    got, want = rows(registry.queries()[name](spark, folder).toPandas()), rows(con.sql(registry.oracle_sql()[name]).df())
    assert got == want and want


def test_sentences_keep_digits_and_lose_spaces(spark, tmp_path):
    forms = ["0997 | a. | 1b. 2 \n 3 c 3 \n\n  0 ", "  x.　 y. \t\x0bz.\x0bw  ", "10. 21! 32? 0", "", " \n ", "1\r\n2. \r\n.0", None]
    folder, con = _folder(spark, tmp_path, documents=(list(enumerate(forms)), "doc_id long, text string"))
    first = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id = 0").select(text.sentences(F.col("text"))).first()[0]
    assert first == ["0997 | a.", "| 1b.", "2", "3 c 3", "0"]
    _same(spark, "q_sentences", folder, con)


def test_clean_text_keeps_entities_that_are_cut_off(spark, tmp_path):
    pages = ["<title>a &amp; b&amp</title>x", "&quot;A&middot;b&copy&quo;&quot", "&am &a; &ampz; &amp;amp &amp;quot; &", "<b>&amp;&amp;</b>C&amp", "", None, "plain <i>T\next</i> 가A"]
    folder, con = _folder(spark, tmp_path, pages=(list(enumerate(pages)), "page_id long, html string"))
    _same(spark, "q_clean_text", folder, con)
    x = spark.createDataFrame([("&lt;b&gt;Up&lt;/b&gt; &#65;&#x42;&amp &hellip;&nosuch; &amp",)], "t string")
    assert tuple(x.select(text.clean_text(F.col("t")), text.clean_text(F.col("t"), text.closed_unescaped)).first()) == ("up ab nosuch", "up ab amp nosuch amp")


def test_pipeline_stages_keep_rows_without_shuffling_them(spark):
    """Rows that stay are picked by bitmap: no exchange carries a row, and exact dedup has a task for each SHARE of text."""
    from tallgrass.llm import common, exact_dedup, near_dedup, quality

    docs = spark.createDataFrame([(i, f"some text {i % 7} of a few words more", "en", i) for i in range(40)], "doc_id long, text string, lang string, other long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    for kept, n in ((exact_dedup.drop_copies(docs), 7), (near_dedup.drop_near(docs), 7), (quality.keep_good(docs, labels), 40)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        carried = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "row#" in x]
        assert not carried, carried
        assert kept.count() == n and kept.columns == docs.columns
    many = docs.select("doc_id", F.repeat("text", 40000).alias("text"))
    assert exact_dedup.exact_groups(many).rdd.getNumPartitions() >= 40 * 37 * 40000 // exact_dedup.SHARE
    ids = common.written(spark.createDataFrame([(i,) for i in range(0, 3000, 3)], "k long"), "ids")
    x = spark.range(3000).select(F.col("id").alias("k"), F.lit(1).alias("bucket"))
    for bits in (32, 1):
        assert sorted(r["k"] for r in common.among(x.select("k"), ids, "k", bits=bits).collect()) == list(range(0, 3000, 3))


def test_link_candidates_meet_as_blocks(spark):
    """Pairs across many blocks, odd links and vectors included, are those of brute force, and no join compares vectors pair by pair."""
    import math
    import random

    from tallgrass.operators import linking

    r = random.Random(5)
    data = [(i, r.randrange(400), r.choice([None, [], [1], [2, 3], [3, None], [4, 1]]), [r.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    data += [(150, 7, [], [0.0] * 4), (151, 7, [], None), (152, None, [], [1.0] * 4), (153, 9, [1], [None, 1.0, 2.0, 3.0])]
    df = spark.createDataFrame(data, "id long, day int, linked array<long>, embedding array<float>")
    found = linking.candidates(df, 30, size=8)
    want = {}
    rows_ = [x for x in df.collect() if x["embedding"] is not None and x["day"] is not None and None not in x["embedding"] and any(x["embedding"])]
    for c in rows_:
        for p in rows_:
            if (p["day"], p["id"]) < (c["day"], c["id"]) and c["day"] - p["day"] <= 30:
                cos = sum(a * b for a, b in zip(c["embedding"], p["embedding"])) / math.hypot(*c["embedding"]) / math.hypot(*p["embedding"])
                shared = set(c["linked"] or []) & set(p["linked"] or []) - {None}
                if cos >= (0.10 if shared else 0.50 if c["linked"] == p["linked"] == [] else 0.45):
                    want[c["id"], p["id"]] = round(cos, 9)
    assert {(x["child"], x["parent"]): round(x["cosine"], 9) for x in found.collect()} == want and want


def test_totals_of_tokens_need_no_terms_of_documents(spark, tmp_path):
    """Repeated and null ids, sources and texts count as in the SQL; no exchange carries texts or terms by document."""
    texts = ["Aa bb aa", "bb, bb cc", None, "", "x aa", "aa bb aa", "한글 한글 cc"]
    data = [(i % 5 if i else None, ["s", "t", None][i % 3], texts[i % 7]) for i in range(20)]
    folder, con = _folder(spark, tmp_path, documents=(data, "doc_id long, source string, text string"))
    for name in ("q_top_keywords", "q_centroids"):
        plan = registry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(doc_id" not in plan and "SinglePartition" not in plan
        _same(spark, name, folder, con)


def test_grounded_reads_its_block_once(spark):
    df = spark.createDataFrame([("Alpha, beta. Gamma 12", "alpha...gamma"), ("Alpha", "alph…zz"), (None, "alpha"), ("Alpha beta", None)], "b string, q string")
    x = df.select(text.grounded(F.col("q"), F.col("b")).alias("g"))
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_bare_block(b#") == 1 and "regexp_replace(coalesce(b#" not in plan
    assert [r[0] for r in x.collect()] == [True, False, False, False]


def test_range_extrema_across_batches(spark):
    """Frames that begin in earlier batches, repeated dates, ties, missing values and null keys give what brute force gives."""
    import datetime as dt
    import random

    from dateutil.relativedelta import relativedelta

    from tallgrass.operators import timeseries as ts

    r, day = random.Random(3), dt.date(2019, 12, 1)
    data = [(k, day + dt.timedelta(days=r.randrange(800)), r.choice([None, 1.0, 2.0, 3.0, r.random() * 4])) for k in (1, 2, None, 4) for _ in range(60)]
    data += [(9, dt.date(2024, 2, 29), 5.0), (9, dt.date(2023, 2, 28), 9.0), (9, dt.date(2023, 3, 1), 6.0), (3, day, None), (3, None, 1.0)]
    want = []
    for k, d, v in data:
        if d is None:
            continue
        seen = sorted((y, x) for j, y, x in data if j == k and y is not None and d - relativedelta(months=12) < y <= d and x is not None)
        hi, lo = (max((x for _, x in seen), default=None), min((x for _, x in seen), default=None))
        want.append((k, d, v, hi, next((y for y, x in seen if x == hi), None), lo, next((y for y, x in seen if x == lo), None)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        x = ts.range_extrema(spark.createDataFrame(data, "id long, d date, close double"), "close", 12)
        assert "Window" not in x._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, map(tuple, x.collect()))) == sorted(map(str, want))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_vectors_by_block_are_those_of_terms(spark, tmp_path, monkeypatch):
    """Small blocks, repeated ids and texts without tokens give what the table of terms gives; no term travels with its document's id."""
    import random

    from tallgrass.operators import vectors

    r = random.Random(4)
    texts = [" ".join(r.choice(["Aa", "bb,", "cc", f"w{r.randrange(60)}", "é"]) for _ in range(r.randrange(70))) for _ in range(60)] + [None, "", ".."]
    data = [(i % 60, f"s{i % 60 % 3}", t) for i, t in enumerate(texts)]
    folder, con = _folder(spark, tmp_path, documents=(data, "doc_id long, source string, text string"))
    monkeypatch.setattr(vectors, "BLOCK", 300)
    df = spark.read.parquet(f"{folder}/documents.parquet")
    blocks = vectors.blocked(df, "doc_id", "text", vectors.block_counts(df, "text", "source"), "source")
    assert blocks.select("block").distinct().count() > 9 and blocks.count() == 60
    _same(spark, "q_tf_idf", folder, con)
    plan = registry.queries()["q_tf_idf"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan
    members = vectors.eligible(df.select("doc_id", "source", "text", F.length("text").alias("n")), "source", "n", 200)
    terms = vectors.term_counts(df, "doc_id", "text")
    weights = vectors.tf_idf(terms, vectors.document_frequencies(terms, "all"), df.count(), "doc_id")
    want = vectors.medoids(weights, members.dropDuplicates(["doc_id"]), "doc_id", "source")
    assert sorted(map(tuple, registry.queries()["q_medoids"](spark, folder).collect())) == sorted(map(tuple, want.collect()))


def test_contracts_are_the_fields_of_entries(spark):
    """Random tables, read by pattern or by parser, give one result; fields found in the page's task are those of grouped entries, repeated keys included."""
    import random

    from tallgrass.operators import filings, html

    r, read = random.Random(6), 0
    pieces = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th rowspan=2>", '<td colspan="2" rowspan=0>', "<td rowspan=2 rowspan=1>", "a", " b\n c ", "가", "</th>", "<b>", "&amp;", "<TD>"]
    for _ in range(3000):
        page = "<table><tr>" + "".join(r.choices(pieces, weights=[1, 1, 4, 3, 6, 4, 2, 2, 2, 5, 5, 5, 2, 0.1, 0.1, 0.1], k=14))
        reader = html._Reader()
        reader.feed(page)
        reader.close()
        plain = html._plain_tables(page)
        read += plain is not None
        assert plain is None or plain == reader.tables, page
    assert read > 1500
    labels = [*list(filings.LABELS)[:12], "- 최근매출액(원)", "2. 계약내역", "6. 주요 계약조건", "9. 기타 투자판단에 참고할 사항", "※ 관련공시", "3. 계약상대", "정정항목", "1. 정정관련 공시서류", "2. 정정관련 공시서류제출일"]
    values = ["-", "", "1,234", "12.5 %", "2024.1.2", "text", "9" * 30, ",,", "정정전", "정정후"]
    cells = lambda: [r.choice(labels if r.random() < 0.6 else values) for _ in range(r.choice([2, 3, 3]))]
    table = lambda first: "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in [first, *(cells() for _ in range(12))]) + "</table>"
    made = [table(["정정항목", "정정전", "정정후"]) * r.choice([0, 1]) + table(["1. 판매ㆍ공급계약 구분", "x", "공사"]) for _ in range(150)] + ["", "no table", None]
    pages = spark.createDataFrame(list(enumerate(made)), "k long, h string")
    for df in (pages, pages.unionByName(pages.filter("k < 3"))):
        got, want = filings.contracts(df, "k", "h"), filings.contract_fields(filings.filing_entries(df, "k", "h"), "k")
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_url_survivors_write_no_edge_to_itself(spark, monkeypatch):
    from tallgrass.operators import entity

    made, settled = [], entity.settled
    monkeypatch.setattr(entity, "settled", lambda df: made.append(settled(df)) or made[-1])
    items = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "c"), (4, "", "d"), (5, None, "c"), (6, "", "")], "k long, u string, v string")
    got = {r["k"]: r["survivor"] for r in entity.url_survivors(items, "k", F.array("u", "v")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 6}
    assert made[0].filter("a = b").isEmpty() and not made[0].isEmpty()
