"""Rules of linking, filings and landed files by hand."""

import random

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import cluster, linking, merge
from tallgrass.sources import landed


def test_summaries_and_texts_for_embeddings(spark):
    rows = [
        (1, [("CAUSE", "x"), ("CHANGE", "  "), ("CHANGE", " two  words ")], "First. Second."), (2, [], " First one!  Second."), (3, None, ""), (4, [("CAUSE", "x")], None),
    ]
    df = spark.createDataFrame(rows, "n int, points array<struct<kind: string, text: string>>, summary string")
    line = linking.node_summary(F.coalesce("points", F.array().cast("array<struct<kind: string, text: string>>")), F.col("summary"))
    assert [r[0] for r in df.orderBy("n").select(line).collect()] == ["two words", "First one!", None, None]
    titles = F.array(F.lit(" a  b "), F.lit(""), F.lit(None), F.lit("c"), F.lit("d"))
    assert [r[0] for r in df.orderBy("n").select(linking.embedding_text(F.lit("T"), line, titles, 2)).collect()] == ["T\ntwo words\na b\nc", "T\nFirst one!\na b\nc", "T\na b\nc", "T\na b\nc"]


def test_candidates_by_tiers(spark):
    rows = [(1, 0, [1], [1.0, 0.0]), (2, 90, [1], [0.2, 0.98]), (3, 91, [1], [1.0, 0.0]), (4, 50, [], [0.6, 0.8]), (5, 60, [], [1.0, 0.0]), (6, 60, [2], [0.5, 0.866]), (7, 60, [2], [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, day int, linked array<long>, embedding array<double>")
    got = {(r["child"], r["parent"]) for r in linking.candidates(df, 90).collect()}
    v = {i: (d, set(c), x) for i, d, c, x in rows}
    want = set()
    for c in v:
        for p in v:
            a, b = v[c], v[p]
            norm = lambda x: (x[0] ** 2 + x[1] ** 2) ** 0.5
            cos = (a[2][0] * b[2][0] + a[2][1] * b[2][1]) / norm(a[2]) / norm(b[2])
            least = 0.10 if a[1] & b[1] else 0.50 if not a[1] and not b[1] else 0.45
            if (b[0], p) < (a[0], c) and a[0] - b[0] <= 90 and cos >= least:
                want.add((c, p))
    assert got == want and (2, 1) in want and (3, 1) not in want


def test_themes_that_are_one(spark):
    new = spark.createDataFrame([("Meta verse", ["x"]), ("Metal (copper)", ["a", "b", "c", "d", "e"]), ("Metal (iron)", ["a"]), ("Other", ["a"])], "name string, stocks array<string>")
    old = spark.createDataFrame([("metaverse", ["a"]), ("metal", ["a", "b", "c", "d", "z"]), ("Other (x)", ["b"])], "name string, stocks array<string>")
    assert {tuple(r) for r in linking.same_themes(new, old).collect()} == {("Meta verse", "metaverse"), ("Metal (copper)", "metal")}


def test_pages_end_with_the_first_old_one(spark):
    rows = [("s", i, f"l{i % 4}", 10 - i) for i in range(9)] + [("t", 0, "z", 1)]
    df = spark.createDataFrame(rows, "search string, place int, link string, day int")
    got = sorted((r["search"], r["place"]) for r in linking.collected_pages(df, "search", "place", "link", "day", F.lit(6), 3).collect())
    assert got == [("s", 0), ("s", 1), ("s", 2), ("s", 3), ("t", 0)]


def test_canonical_names_and_short_masters(spark):
    df = spark.createDataFrame([("LT Chem. LTX LT",), ("",), ("none",)], "t string")
    assert [r[0] for r in df.select(linking.canonical(F.col("t"), {"LT": "L", "LT Chem": "C."})).collect()] == ["C.. LTX L", "", "none"]
    lines = spark.createDataFrame([("123      KR0000000001name of it  STY000000000000007",), ("",)], "value string")
    tail = {"group": 2, "suspended": 1, "shares": 15}
    row = landed.stock_master(lines, "value", tail).collect()
    assert [(r["ticker"], r["standard_code"], r["name"], r["group"], r["suspended"], r["listed_shares"], r["raw"]["shares"]) for r in row] == [("000123", "KR0000000001", "name of it", "ST", True, 7000, "000000000000007")]
    with pytest.raises(Exception, match="too short"):
        landed.stock_master(spark.createDataFrame([("123 KR",)], "value string"), "value", tail).collect()


def test_replacement_is_refused_below_half(spark):
    old, new = spark.range(10), spark.range(5)
    assert merge.replace_guarded(old, new).count() == 5
    with pytest.raises(ValueError):
        merge.replace_guarded(old, spark.range(4))


def test_runs_in_sequence_equal_one_run(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, i * 20_000.0, f"b{i % 2}", {r.choice(words): 1.0 for _ in range(4)}, {r.choice(words): 2.0 for _ in range(3)}, {}) for i in range(120)]
    schema = "key long, epoch double, block string, title map<string,double>, body map<string,double>, entities map<string,double>"
    df, options = spark.createDataFrame(docs, schema), cluster.Options(candidate_days=5.0, span_days=8.0, threshold=1.5)
    want = {tuple(x) for x in cluster.online_clusters(df, "block", {}, 120, options).collect()}
    step, got = None, set()
    for a, b in ((0, 50), (50, 51), (51, 120)):
        part = df.filter((F.col("key") >= a) & (F.col("key") < b))
        step = landed.settled(cluster.online_step(part, None if step is None else cluster.stored(step), "block", {}, 120, options))
        got |= {tuple(x) for x in cluster.assigned(step).collect()}
    assert {x[:2] for x in got} == {x[:2] for x in want} and len({x[1] for x in want}) > 5 and sum(x[2] is not None for x in want) > 20


def test_stored_clusters_take_late_documents_within_days():
    day, text = 86_400.0, {"chip": 1.0, "supply": 1.0}
    seed = lambda d: (7, d * day, d * day, d * day, 1, text, {}, {})
    run = lambda d, at: cluster.fold_from([seed(d)], [(1, at * day, text, {}, {})], {}, 2, cluster.Options())
    assert run(20, 1)[0][0][1] == 1 and run(10, 1)[0][0][1] == 7 and run(1, 11.01)[0][0][1] == 1
    ((number, first, last, seconds, size, *_),) = run(3, 2)[1]
    assert (number, first, last, seconds, size) == (7, 2 * day, 3 * day, 5 * day, 2)


def test_entries_of_filings():
    from tallgrass.operators import filings, html

    page = """<table><tr><td colspan=3>정정신고</td></tr><tr><td>정정항목</td><td>정정전</td><td>정정후</td></tr><tr><td>금액</td><td>1</td><td>2</td></tr><tr><td>-</td><td></td><td>-</td></tr><tr><td>사유</td><td>오기</td></tr></table>
    <table><tr><td colspan=2>1. 판매ㆍ공급계약 내용</td><td>A</td></tr><tr><td rowspan=2>2. 계약내역</td><td>x</td><td>1</td></tr><tr><td>y</td><td> 2 3 </td></tr><tr><td>label</td><td colspan=2>v</td></tr>
    <tr><td colspan=3>7. 기타</td></tr><tr><td colspan=3>more</td></tr><tr><td colspan=3>text</td></tr><tr><td>single</td></tr><tr><td colspan=3>※ 관련</td></tr></table>"""
    fixes, body = filings.scopes(html.tables_of(page))
    assert list(filings.entries(fixes)) == [("정정사항", "금액", "2", "1"), ("", "사유", "오기", None)]
    assert list(filings.entries(body)) == [
        ("1. 판매ㆍ공급계약 내용", "1. 판매ㆍ공급계약 내용", "A", None), ("2. 계약내역", "x", "1", None), ("2. 계약내역", "y", "2 3", None), ("2. 계약내역", "label", "v", None),
        ("7. 기타", "7. 기타", "more text", None), ("※ 관련", "※ 관련", "", None),
    ]


def test_scans_bring_all_rows(spark):
    from collections import Counter
    from datetime import date, timedelta

    from tallgrass.sources.scans import scan

    r = random.Random(3)
    start, end, page = date(2024, 1, 1), date(2024, 2, 9), 8
    rows = [(start + timedelta(r.choice([0, 3, 3, 9, 9, 9, 9, 20, 39, 60])), r.choice(["a", "b", None]), r.choice(["x", "y", None])) for _ in range(150)]
    df = spark.createDataFrame(rows, "day date, kind string, ticker string")

    def ask(lo, hi, **by):
        return [x for x in rows if lo <= x[0] <= hi and all(x[i] == v for i, v in ((1, by.get("kind", x[1])), (2, by.get("ticker", x[2]))))]

    def brute(kinds):
        out, over, crowded = [], [], {}

        def halve(lo, hi, done, late, **by):
            got = ask(lo, hi, **by)
            if len(got) <= page or lo == hi:
                (done if len(got) <= page else late)(lo, hi, got)
            else:
                middle = lo + (hi - lo) // 2
                halve(lo, middle, done, late, **by)
                halve(middle + timedelta(1), hi, done, late, **by)

        halve(start, end, lambda lo, hi, got: out.append((None, None, lo, hi, len(got), False)), lambda lo, hi, got: over.append(lo))
        for day in over:
            for kind in kinds or [None]:
                got = ask(day, day, kind=kind) if kinds else ask(day, day)
                if len(got) > page:
                    crowded.setdefault(kind, []).append(day)
                else:
                    out.append((kind, None, day, day, len(got), False))
        for kind, days in crowded.items():
            for ticker in ("x", "y", None):
                keep = lambda got, days=days: sum(x[0] in days for x in got)
                by = {"ticker": ticker} | ({"kind": kind} if kinds else {})
                halve(min(days), max(days), lambda lo, hi, got: out.append((kind, ticker, lo, hi, keep(got), False)), lambda lo, hi, got: out.append((kind, ticker, lo, hi, keep(got), True)), **by)
        return Counter(x for x in out if x[4])

    for kinds in (["a", "b", None], None):
        got = Counter(map(tuple, scan(df, "day", "ticker", start, end, page, "kind" if kinds else None).collect()))
        assert got == brute(kinds) and any(x[5] for x in got)
        assert sum(x[4] for x in got.elements()) == len(ask(start, end))
    assert scan(df.limit(0), "day", "ticker", start, end, page).isEmpty()


def test_pages_end_open_elements():
    from tallgrass.operators.html import page_of

    long = "word " * 40
    assert page_of(f"<article><div><p>{long}</article>tail") == (long.strip(), None, None)
    assert page_of(f"</div><p>{long}<p>{long}") == ("\n".join([long.strip()] * 3), None, None)  # a paragraph that isn't closed holds the next
    assert page_of(f"<span class='_ARTICLE_DATE_TIME' data-date-time='t'></span><div id=dic_area>{long}</div>", True) == (long.strip(), None, "t")


def test_fixed_widths_strict_json_and_brackets(spark):
    from tallgrass.functions import text

    lines = spark.createDataFrame([("ab 12",), ("abc",), ("",), ("xyz7 tail",)], "value string")
    assert [tuple(r) for r in landed.fixed_width(lines, {"code": 3, "n": 2}).collect()] == [("ab", "12"), ("xyz", "7")]
    names = spark.createDataFrame([("A (b) [c] （d）",), ("(x)",), (None,)], "t string")
    assert [r[0] for r in names.select(text.without_brackets(F.col("t"))).collect()] == ["A", "", None]
