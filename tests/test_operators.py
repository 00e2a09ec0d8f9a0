"""Operators on small inputs with results by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallgrass.functions import dates, numbers, text
from tallgrass.operators import chainindex, entity, graph, merge
from tallgrass.operators import timeseries as ts


@pytest.mark.parametrize(
    ("sizes", "weights"),
    [
        ([90, 5, 3, 2], [0.25] * 4),
        ([40, 15, 15, 15, 15], [0.25] + [0.1875] * 4),
        ([50, 20, 15, 10, 5], [0.25, 0.25, 0.25, 1 / 6, 1 / 12]),
        ([7], [1.0]),
        ([1] * 8, [0.125] * 8),
    ],
)
def test_capped_weights(spark, sizes, weights):
    df = spark.createDataFrame([(1, i, float(s)) for i, s in enumerate(sizes)], "g int, i int, s double")
    got = [r["weight"] for r in chainindex.capped(df, ["g"], "s").orderBy("i").collect()]
    assert got == pytest.approx(weights)


def _bars(rows):
    return [(i, dt.date(2024, 1, d), float(o), float(o), float(o), float(c), 10, t) for i, d, o, c, t in rows]


def test_chain_index_links_days_and_leaves_out_wild_moves(spark):
    bars = spark.createDataFrame(
        _bars([(1, 1, 100, 100, 5), (2, 1, 50, 50, None), (1, 2, 100, 110, 5), (2, 2, 50, 45, None), (1, 4, 110, 121, None), (2, 4, 45, 70, None), (1, 5, 121, 157.3, 1), (2, 5, 70, 91.1, 2)]),
        "id int, d date, open double, high double, low double, close double, volume int, trade_value int",
    )
    calendar = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 4, 5)], "d date")
    members = spark.createDataFrame([("x", 1, 10), ("x", 2, 20)], "group string, id int, shares int")
    got = chainindex.chain_index(bars, calendar, members).orderBy("d").collect()
    # Day 2: two names weigh a half each: (1.1 + 0.9) / 2. Day 4: the second moves by 56 % and is out. Day 5: 30 % is in, 30.1 % out.
    assert [round(r["close"], 4) for r in got] == [1000.0, 1100.0, 1430.0]
    assert [r["trade_value"] for r in got] == [5, None, 1]


def test_chain_index_anchor_and_gap(spark):
    bars = spark.createDataFrame(_bars([(1, 1, 10, 10, 1), (1, 3, 10, 11, 1), (1, 4, 11, 12.1, 1)]), "id int, d date, open double, high double, low double, close double, volume int, trade_value int")
    calendar = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3, 4)], "d date")
    members, anchors = spark.createDataFrame([("x", 1, 1)], "group string, id int, shares int"), spark.createDataFrame([("x", 500.0)], "group string, level double")
    got = chainindex.chain_index(bars, calendar, members, anchors).collect()
    assert [(r["d"].day, round(r["close"], 6)) for r in got] == [(4, 550.0)]


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([(1, 5.0, 7.0), (2, 6.0, None)], "k int, c double, v double")
    new = spark.createDataFrame([(1, 8.0, None), (3, 9.0, 1.0)], "k int, c double, v double")
    once = merge.upsert(old, new, ["k"], {"v": "fill"})
    assert sorted(map(tuple, once.collect())) == [(1, 8.0, 7.0), (2, 6.0, None), (3, 9.0, 1.0)]
    assert sorted(map(tuple, merge.upsert(once, new, ["k"], {"v": "fill"}).collect())) == sorted(map(tuple, once.collect()))
    assert merge.changed(once, merge.upsert(once, new, ["k"], {"v": "fill"}), ["k"]).count() == 0


def test_policies(spark):
    old = spark.createDataFrame([(1, 5, 5, ["a", "b"], "x")], "k int, lo int, hi int, s array<string>, keep string")
    new = spark.createDataFrame([(1, 3, 9, ["c", "a"], "y")], "k int, lo int, hi int, s array<string>, keep string")
    got = merge.upsert(old, new, ["k"], {"lo": "least", "hi": "greatest", "s": "union", "keep": "keep"}).first()
    assert tuple(got) == (1, 3, 9, ["a", "b", "c"], "x")


def test_replacing_guards(spark):
    t, none = spark.range(10), spark.range(0)
    assert merge.replace_slice(t, none, F.lit(True)).count() == 10
    with pytest.raises(ValueError):
        merge.replace_guarded(t, spark.range(4))
    assert merge.replace_guarded(t, spark.range(5)).count() == 5


def test_roots_of_long_chains(spark):
    rows = [(i, i - 1 if i % 300 else None) for i in range(900)] + [(1000, 5000)]
    random.Random(1).shuffle(rows)
    got = dict(map(tuple, graph.roots(spark.createDataFrame(rows, "node int, parent int")).collect()))
    assert got == {i: i // 300 * 300 for i in range(900)} | {1000: 1000}


def test_chain_parent_is_the_latest_smaller_key_of_the_target_day(spark):
    day = dt.date(2024, 1, 2)
    rows = [("a", 1, day, None, False), ("a", 2, day, None, False), ("a", 5, day, day, True), ("b", 3, day, None, False), ("b", 4, dt.date(2024, 1, 9), dt.date(2024, 1, 8), True)]
    got = graph.chain_parents(spark.createDataFrame(rows, "o string, k int, d date, t date, c boolean"), "o", "k", "d", "t", F.col("c"))
    assert dict(map(tuple, got.collect())) == {1: None, 2: None, 5: 2, 3: None, 4: None}


def test_windows_leave_out_their_far_day(spark):
    days = [dt.date(2023, 2, 28), dt.date(2023, 3, 1), dt.date(2024, 2, 28), dt.date(2024, 2, 29)]
    df = spark.createDataFrame([(1, d, float(v)) for d, v in zip(days, (9, 8, 1, 2))], "id int, d date, close double")
    got = {r["d"]: (r["high_value"], r["high_date"]) for r in ts.range_extrema(df, "close", 12).collect()}
    assert got[dt.date(2024, 2, 28)] == (8.0, dt.date(2023, 3, 1)) and got[dt.date(2024, 2, 29)] == (8.0, dt.date(2023, 3, 1))
    sums = {r["d"]: r["s"] for r in ts.interval_sum(df.select("id", "d"), df, "close", "s", 12).collect()}
    assert sums[dt.date(2024, 2, 28)] == 9.0 and sums[dt.date(2023, 2, 28)] == 9.0


def test_trailing_quarters_need_four(spark):
    df = spark.createDataFrame([(1, q, float(q)) for q in (1, 2, 3, 4, 5)], "id int, q int, v double")
    got = [r["t"] for r in ts.trailing_quarters(df, "v", "t").orderBy("q").collect()]
    assert got == [None, None, None, 10.0, 14.0]


def test_decumulation_drops_gaps(spark):
    df = spark.createDataFrame([(1, 202303, 5.0), (1, 202306, 9.0), (1, 202312, 30.0)], "id int, yymm int, v double")
    assert sorted(map(tuple, ts.decumulated(df, "v").collect())) == [(1, 202303, 5.0), (1, 202306, 4.0)]


def test_names_resolve_or_stay_null(spark):
    reg = spark.createDataFrame([(1, "c1", "Acme Corp.", True), (2, "c2", "Borealis", False), (3, "c3", "Twin", True), (4, "c4", "(주)Twin", False)], "entity long, code string, label string, listed boolean")
    ali = spark.createDataFrame([("Nord", 2), ("Acme", 1)], "alias string, entity long")
    names = ["㈜ACME", "Foo (Borealis)", "twin", "nord", "국내 반도체 기업", "주식회사 Acme, (주)Borealis", None]
    got = entity.resolved(spark.createDataFrame([(n,) for n in names], "name string"), "name", reg, ali)
    found = {r["name"]: (r["entity"], r["rule"], r["source"]) for r in got.collect()}
    assert found["㈜ACME"] == (1, "original", "listed") and found["Foo (Borealis)"] == (2, "paren_inner", "all") and found["nord"] == (2, "original", "alias")
    assert all(found[n] == (None, None, None) for n in ("twin", "국내 반도체 기업", "주식회사 Acme, (주)Borealis", None))


def test_matches_are_longest_leftmost_and_apart(spark):
    df = spark.createDataFrame([(1, "abcab ab"), (2, None), (3, "")], "k long, t string")
    got = {r["k"]: [(m["text"], m["start"]) for m in r["matches"]] for r in entity.matches(df, "k", "t", [("ab", 1), ("abc", 2), ("cab", 3)]).collect()}
    assert got == {1: [("abc", 0), ("ab", 3), ("ab", 6)], 2: [], 3: []}


def test_text_functions(spark):
    df = spark.createDataFrame([("HTTP://Ex.com/A/b/?q=1", "[a] (b) Title &amp; more", "20240131 ~ 2024.02.03", "1,234")], "u string, t string, d string, n string")
    got = df.select(text.url_key(F.col("u")), text.url_key_lower(F.col("u")), text.without_leading_brackets(F.col("t")), text.clean_text(F.lit("<b>a</b>&lt;&amp;lt;  b")), dates.date_range(F.col("d"))["end"], numbers.number(F.col("n")), text.masked(F.lit("abc ab x"), F.array(F.lit("ab"), F.lit("abc")), "#")).first()
    assert tuple(got)[:4] == ("http://ex.com/A/b", "http://ex.com/a/b", "(b) Title &amp; more", "a lt b") and got[4] == dt.date(2024, 2, 3) and got[5] == 1234.0


def test_shuffled_input_gives_the_same(spark):
    rows = [("t", i, [str(i % 3), str(i)], "r" * (i % 4)) for i in range(8)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        seen.add(str(entity.merged_themes(spark.createDataFrame(rows, "name string, place int, members array<string>, reason string").repartition(3)).collect()))
    assert len(seen) == 1


# Clustering, pages, streams


def _doc(key, hours, title=None, body=None):
    return (key, hours * 3600.0, title or {}, body or {}, {})


def test_clusters_join_by_text_not_by_time():
    from tallgrass.operators.cluster import Options, fold

    same = {"a": 1.0, "b": 2.0}
    got = {k: (c, s) for k, c, s in fold([_doc(1, 0, same), _doc(2, 1, same), _doc(3, 1, {"z": 1.0}), _doc(4, 2), _doc(5, 2)], {}, 10, Options())}
    assert got[1] == (1, None) and got[2][0] == 1 and got[2][1] > 2 and got[3] == (3, None) and got[4] == (4, None) and got[5] == (5, None)


def test_clusters_end_by_age_and_ties_stay_early():
    from tallgrass.operators.cluster import Options, fold

    same = {"a": 1.0}
    days = [_doc(i, 24 * d, same) for i, d in ((1, 0), (2, 5), (3, 9), (4, 11), (5, 30))]
    got = {k: c for k, c, _ in fold(days[::-1], {}, 10, Options())}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    assert {k: c for k, c, _ in fold([_doc(1, 0, same), _doc(2, 0, {"b": 1.0}), _doc(3, 0, {"a": 1.0, "b": 1.0})], {}, 10, Options())}[3] == 1
    with pytest.raises(ValueError):
        Options(threshold=0.2)


def test_clusters_of_a_table_do_not_depend_on_its_order(spark):
    from tallgrass.operators.cluster import online_clusters

    r, rows = random.Random(2), []
    for i in range(60):
        rows.append((i, i * 3600.0, {r.choice("abcdef"): 1.0, r.choice("abcdef"): 2.0}, {}, {}, i % 2))
    seen = set()
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "key long, epoch double, title map<string,double>, body map<string,double>, entities map<string,double>, block int")
        seen.add(str(sorted(map(tuple, online_clusters(df, "block", {}, 60).select("key", "cluster").collect()))))
    assert len(seen) == 1


def _whole_frequencies(docs):
    """fold()'s answer for docs (doc_id, source, text), with document frequencies of all tokens, counted here."""
    import math
    import re
    from collections import Counter

    from tallgrass.operators.cluster import Options, fold

    words = lambda x: Counter(t for t in re.split(r"[^\w]+|_", x.lower()) if len(t) >= 2)
    parts = [(k, s, words(t.partition("\n")[0]), words(t.partition("\n")[2])) for k, s, t in docs]
    idf = {}
    for f, of in (("title", lambda p: p[2]), ("body", lambda p: p[3]), ("all", lambda p: p[2] | p[3])):
        df = Counter(t for p in parts for t in of(p))
        idf[f] = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
    out = []
    for source in {p[1] for p in parts}:
        out += fold([(k, k * 1800.0, dict(t), dict(b), {}) for k, s, t, b in parts if s == source], idf, len(docs), Options())
    return {k: (c, None if s is None else round(s, 6)) for k, c, s in out}


def _clusters_of(spark, folder, docs):
    from tallgrass.plans.pagesflow import q_online_clusters

    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{folder}/documents.parquet")
    rows = q_online_clusters(spark, str(folder)).collect()
    assert len(rows) == len(docs)
    return {r["key"]: (r["cluster"], None if r["score"] is None else pytest.approx(r["score"], abs=2e-6)) for r in rows}


def test_clusters_weigh_each_title_token_by_all_documents(spark, tmp_path):
    r = random.Random(5)
    docs = [(i, f"s{i % 3}", " ".join([f"w{min(r.randrange(60), r.randrange(60))}" for _ in range(r.randrange(6))] + [f"once{i}"] * (i % 2))) for i in range(240)]
    # More repeated tokens than any fixed dictionary of 20,000 would hold; two documents share them.
    docs += [(240 + i, "big", " ".join(f"v{j}" for j in range(21_000)) + f" rare{i}") for i in range(2)] + [(242, "big", "v20999 z9 zz9"), (243, "big", "v20999 z9 zz8"), (244, "big", "")]
    assert _whole_frequencies(docs) == _clusters_of(spark, tmp_path, docs)


def test_clusters_read_titles_and_bodies(spark, tmp_path):
    r = random.Random(6)
    some = lambda n, most: " ".join(f"w{min(r.randrange(n), r.randrange(n))}" for _ in range(r.randrange(most)))
    docs = [(i, f"s{i % 3}", some(40, 4) + "".join("\n" + some(80, 12) for _ in range(r.randrange(4)))) for i in range(300)]
    docs += [(300, "same", "alpha\none two three\nfour"), (301, "same", "beta\none two three\nfour"), (302, "same", "\n"), (303, "same", "")]
    got = _clusters_of(spark, tmp_path, docs)
    assert _whole_frequencies(docs) == got and got[301][0] == 300


def test_url_groups_take_all_orders(spark, tmp_path):
    from tallgrass.plans.texts import q_url_groups

    r = random.Random(7)
    orders = [(k, r.randrange(150), float(40 * r.randrange(150))) for k in range(2_900, 3_100)]
    orders += [(5_000, 900, 400_000.0), (5_001, 900, 440_000.0), (5_002, 901, 440_000.0), (5_003, 902, 480_000.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, c, p in orders:
        for u in (f"c{c}", f"p{int(p // 40)}"):
            a, b = find(k), find(u)
            parent[b] = a
    least = {}
    for k, _, _ in orders:
        least[find(k)] = min(k, least.get(find(k), k))
    got = {x["o_orderkey"]: x["survivor"] for x in q_url_groups(spark, str(tmp_path)).collect()}
    assert got == {k: least[find(k)] for k, _, _ in orders} and got[5_002] == 5_000 and got[5_003] == 5_003


@pytest.mark.parametrize("name, cut", [("q_published", " WHERE event_id < 4000"), ("q_month_windows", " WHERE o_orderkey < 500")])
def test_text_queries_take_all_rows(spark, name, cut):
    """The registered SQL still reads a subset of ids; without that filter it is the whole answer."""
    from tallgrass.plans.texts import ORACLE_SQL, QUERIES
    from tests.oracle import connect, rows

    folder = "/root/testdata/sf0.01"
    assert rows(QUERIES[name](spark, folder).toPandas()) == rows(connect(folder).sql(ORACLE_SQL[name].replace(cut, "")).df())


def test_event_similarity_takes_all_members(spark, tmp_path):
    import math

    from tallgrass.operators.vectors import best_cosines
    from tallgrass.plans.analytics import q_event_similarity

    r = random.Random(8)
    data = [(i, i % 4, [r.gauss(0, 1) for _ in range(5)]) for i in range(100, 260)] + [(260, 1, [0.0] * 5)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    unit = [(k, g, [x / math.hypot(*v) for x in v]) for k, g, v in data if any(v)]
    best = {(a, g, k): max(sum(x * y for x, y in zip(u, v)) for _, h, u in unit if h == a) for k, g, v in unit for a in range(4) if a != g}
    want = {}
    for (a, g, _), c in best.items():
        want.setdefault((a, g), []).append(c)
    got = {(x["a_label"], x["b_label"]): x["score"] for x in q_event_similarity(spark, str(tmp_path)).collect()}
    title = {g: v for _, g, v in reversed(unit)}  # a group's first vector
    assert got == {(a, b): pytest.approx(0.5 * sum(c) / len(c) + 0.5 * sum(x * y for x, y in zip(title[a], title[b])), abs=2e-6) for (a, b), c in want.items()}
    small = {(x["a_group"], x["b_group"], x["key"]): x["cosine"] for x in best_cosines(df, "vec_id", "label", "embedding", 16).collect() if x["key"] != 260}
    assert small == {k: pytest.approx(c, abs=1e-6) for k, c in best.items()}


def test_grids_fill_spans():
    from tallgrass.operators.html import main_text, tables_of

    assert tables_of("<table><tr><td rowspan=2>a<td colspan=2>b</tr><tr><td>c</td><td>d</td></tr><tr><td>e</table>") == [[["a", "b", "b"], ["a", "c", "d"], ["e"]]]
    assert tables_of(None) == [] and main_text(None) is None and main_text("<p>short</p>") is None
    long = "word " * 40
    assert main_text(f"<nav>{long}</nav><article><p>{long}</p><script>x</script></article>") == long.strip()
    assert main_text(f"<div><p>{long}</p><p>tiny</p></div>") == long.strip()


def test_fixed_tails_take_the_middle(spark):
    from tallgrass.sources import landed

    df = spark.createDataFrame([("001AB  long name  XY9",), ("short",)], "value string")
    got = landed.fixed_tail(df, {"code": 3, "kind": 4}, "name", {"tail": 2, "n": 1}).collect()
    assert [tuple(r) for r in got] == [("001", "AB", "long name", "XY", "9")]


def test_newest_complete_folder(spark, tmp_path):
    from tallgrass.sources import landed

    for name, files in (("20240101", ["a", "b"]), ("20240103", ["a"]), ("x", ["a", "b"])):
        (tmp_path / name).mkdir()
        for f in files:
            (tmp_path / name / f).write_text("x")
    assert landed.newest_folder(spark, str(tmp_path), ("a", "b")) == f"{tmp_path}/20240101"
    assert landed.newest_folder(spark, str(tmp_path), ("c",)) is None and landed.newest_folder(spark, str(tmp_path / "none")) is None


def test_repeated_batches_change_nothing(spark, tmp_path):
    from tallgrass.streaming import streams

    sink = streams.upserting(str(tmp_path / "t"), ["k"], {"v": "fill"})
    a, b = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int"), spark.createDataFrame([(1, None), (3, 7)], "k int, v int")
    for number, batch in ((0, a), (1, b), (1, b)):
        sink(batch, number)
    assert sorted(map(tuple, streams.newest_version(spark, str(tmp_path / "t")).collect())) == [(1, 5), (2, 6), (3, 7)]
