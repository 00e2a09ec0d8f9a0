"""The operators of the optional subpackage against brute force, exact round trips and hand-made cases."""

import hashlib
import io
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import bpe, chat, common, exact_dedup, mixing, near_dedup, quality, substring_dedup, token_counts, top_k, vocabulary, warc
from tallgrass.llm import queries as registered
from tests.oracle import connect, rows

FOLDER = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, id string, label string"


def documents(spark, pairs, extra="clash"):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), extra, extra, extra) for i, t in pairs], SCHEMA)


def awkward(seed=0, n=60):
    """Copies, near copies, ties, nulls, empty and long texts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ä", "ß", "漢字", "a b"]
    base = [" ".join(r.choice(words) for _ in range(r.choice([3, 5, 30, 90]))) for _ in range(12)]
    texts = [None, "", " \t\n", "one", base[0], base[0].replace(" ", "\n "), base[0].upper(), "x " * 5000]
    while len(texts) < n:
        words_ = r.choice(base).split(" ")
        for _ in range(r.randrange(3)):
            words_[r.randrange(len(words_))] = r.choice(words)
        texts.append(" ".join(words_))
    pairs = list(enumerate(texts))
    r.shuffle(pairs)
    return pairs


# Near dedup


def shingle_set(text, k=5):
    w = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_groups(pairs):
    sets, up = {i: shingle_set(t) for i, t in pairs}, {i: i for i, _ in pairs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("seed", [0, 1])
def test_near_dedup_is_brute_force(spark, seed):
    pairs = awkward(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(documents(spark, pairs)).collect()}
    assert got == brute_groups(pairs)


def test_near_dedup_finds_links_outside_the_hub(spark):
    """Near copies whose similarities lie on both sides of the limit: what no hub reaches is paired across components."""
    r = random.Random(5)
    base = [f"t{i}" for i in range(150)]
    pairs = []
    for i in range(80):
        w = list(base)
        for _ in range(r.randrange(1, 5)):
            w[r.randrange(150)] = f"u{r.randrange(10**6)}"
        pairs.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(documents(spark, pairs)).collect()}
    assert got == brute_groups(pairs)


def test_near_dedup_of_nothing_and_of_null_ids(spark):
    assert near_dedup.near_dedup(documents(spark, [])).count() == 0
    got = near_dedup.near_dedup(documents(spark, [(None, "a b c d e f g"), (4, "a b c d e f g")])).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(None, 4, False), (4, 4, True)}


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_near_dedup_of_repeated_ids_and_of_alike_words(spark):
    """An id is one document, of its least text; words that sums of powers would confuse stay apart."""
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    word = thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    rows_ = [(1, a), (1, b), (2, b), (3, a), (4, word), (5, other), (6, None), (6, " "), (None, a), (None, b)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(documents(spark, rows_)).collect()}
    assert got == {1: (26, 1), 2: (26, 2), 3: (26, 1), 4: (1, 4), 5: (1, 5), 6: (0, 6), None: (26, 1)}


def test_stages_keep_columns_and_judge_rows_by_themselves(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows_ = [(1, a), (1, b), (2, b), (3, a + " end"), (None, b + " end"), (None, "c d e f g h"), (8, None), (9, ""), (9, "c  d e f g h")]
    docs = documents(spark, rows_).withColumns({"key": F.lit("k"), "row": F.lit("r"), "a.b": F.lit("d"), "__id": F.lit("e"), "__digest": F.lit("f")})
    copies, near = exact_dedup.drop_copies(docs), near_dedup.drop_near(docs)
    assert copies.columns == near.columns == docs.columns
    # None comes last; 8 and 9 have empty texts, which are copies but not near copies of one another.
    assert sorted((r["doc_id"] or 99, (r["text"] or "")[:2]) for r in copies.collect()) == [(1, "a0"), (1, "b0"), (3, "a0"), (8, ""), (9, "c "), (99, "b0")]
    assert sorted((r["doc_id"] or 99, (r["text"] or "")[:2]) for r in near.collect()) == [(1, "a0"), (1, "b0"), (8, ""), (9, ""), (9, "c ")]
    assert {(r["key"], r["row"], r["a.b"], r["__id"], r["__digest"]) for r in near.union(copies).collect()} == {("k", "r", "d", "e", "f")}
    assert near_dedup.drop_near(docs.limit(0)).count() == exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_recall_just_above_the_limit():
    """Pairs with similarities from 0.75 to 0.80 share a band, and no odd sketch rejects them."""
    r, shared = np.random.default_rng(23), 0
    pairs = []
    for _ in range(400):
        n = int(r.integers(40, 400))
        pool = np.unique(r.integers(0, 2**63, 3 * n, dtype=np.uint64))
        apart = int(n * r.uniform(0.112, 0.142))
        pairs += [np.sort(pool[:n]), np.sort(np.concatenate([pool[: n - apart], pool[n : n + apart]]))]
    keys = near_dedup.band_keys(near_dedup.superminhash(pairs))
    for x, y in zip(keys[::2], keys[1::2]):
        shared += bool((x == y).any())
    assert shared == 400


def test_frequent_values_are_dealt_out(spark):
    rows_ = common.written(spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")), "rows")
    groups = rows_.groupBy("k").agg(F.count("*").alias("n"))
    got = common.join_groups(rows_, groups, "k")
    assert got.count() == 5000 and got.filter("k = 'hot' and n = 1667").count() == 1667 and got.columns == ["k", "id", "n"]


def test_superminhash_estimates_similarity_and_stops_early():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[200:1200])
    x, y = near_dedup.superminhash([a, b])
    assert abs((x == y).mean() - 800 / 1200) < 0.12
    small = near_dedup.superminhash([pool[:3], pool[:3], pool[:0]])
    assert (small[0] == small[1]).all() and (small[2] == 0xFFFFFFFF).all() and (small[0] < 0xFFFFFFFF).all()
    alone = near_dedup.superminhash([a])[0]
    assert (alone == x).all()  # a set's signature doesn't depend on the sets beside it


def test_odd_sketches_never_exceed_the_difference():
    r = np.random.default_rng(2)
    pool = np.unique(r.integers(0, 2**63, 400, dtype=np.uint64))
    a, b = pool[:300], pool[50:]
    x, y = near_dedup.odd_sketches([a, b])
    assert np.unpackbits((x ^ y).view(np.uint8)).sum() <= 50 + len(pool) - 300


# Exact dedup


def brute_exact(pairs):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in pairs}
    group = defaultdict(list)
    for i, t in norm.items():
        group[t].append(i)
    return {i: (min(group[t]), len(group[t]), min(group[t]) == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items()}


@pytest.mark.parametrize("seed", [0, 1])
def test_exact_dedup_is_brute_force(spark, seed):
    pairs = awkward(seed)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(documents(spark, pairs)).collect()}
    assert got == brute_exact(pairs)


def test_grace_spills_to_the_same_result():
    r = random.Random(3)
    texts = [f"{r.randrange(300)} " * r.randrange(1, 40) for _ in range(3000)]
    records = [(hashlib.sha256(t.encode()).digest(), t, i, 1) for i, t in enumerate(texts)]
    whole = sorted(map(tuple, exact_dedup.grace(records)))
    assert sorted(map(tuple, exact_dedup.grace(records, budget=2000))) == whole and len(whole) == len(set(texts))
    same = [(b"x" * 32, "a", 1, 1), (b"x" * 32, "b", 2, 1), (b"x" * 32, "b", 1, 1)]  # contents decide, not digests
    assert sorted(map(tuple, exact_dedup.grace(same))) == [(b"x" * 32, "a", 1, 1), (b"x" * 32, "b", 1, 2)]


def test_drop_copies_keeps_columns_and_one_row(spark):
    docs = documents(spark, [(3, "a  b"), (1, "a b"), (1, "a b"), (None, None), (7, " ")])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 1), (False, 7), (True, 0)]
    assert exact_dedup.drop_copies(docs.limit(0)).count() == 0


# Substring dedup


def brute_substrings(pairs, window=20):
    seen, out = set(), {}
    for i, t in sorted(pairs):
        w = SPACE.findall(t or "")
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            gone |= set(range(s, s + window)) if key in seen else set()
            seen.add(key)
        kept = [x for j, x in enumerate(w) if j not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_substring_dedup_is_brute_force(spark, seed):
    pairs = awkward(seed)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.substring_dedup(documents(spark, pairs).repartition(3)).collect()}
    assert got == brute_substrings(pairs)


def test_windows_of_a_split_bucket():
    r = random.Random(4)
    strings = [" ".join(r.choice("abc") for _ in range(30)).encode() for _ in range(200)]
    doc, start = np.arange(200), np.zeros(200, np.int64)
    whole = sorted(substring_dedup.later_windows(doc, start, strings, window=5))
    seen, want = set(), []
    for i, s in enumerate(strings):
        w = s.split()
        for j in range(26):
            want += [(i, j)] if tuple(w[j : j + 5]) in seen else []
            seen.add(tuple(w[j : j + 5]))
    assert whole == want
    assert sorted(substring_dedup.later_windows(doc, start, strings, window=5, at_once=3000, keys=np.zeros(200, np.uint64))) == want


def test_spilled_windows_are_those_of_memory():
    r = random.Random(4)
    strings = [" ".join(r.choice("abc") for _ in range(30)).encode() for _ in range(200)]
    doc, start = np.arange(200), np.zeros(200, np.int64)
    spilled = substring_dedup.Spilled(window=5, files=3)
    for part in (slice(100, 200), slice(0, 100)):
        spilled.add(doc[part], start[part], strings[part])
    assert sorted(spilled.later()) == sorted(substring_dedup.later_windows(doc, start, strings, window=5))


def test_substring_dedup_of_repeated_and_null_ids(spark):
    """Rows are documents of their own: marks of one row never fall on another, whatever their ids."""
    r = random.Random(22)
    a, b = (" ".join(f"{x}{r.randrange(10**6)}" for _ in range(60)) for x in "ab")
    rows_ = [(5, a), (5, "short text of few"), (7, a), (5, a), (None, b), (None, b), (None, None), (6, "x " * 3000)]
    got = substring_dedup.substring_dedup(documents(spark, rows_).withColumns({"key": F.lit("k"), "marks": F.lit("m")}), with_text=True).collect()
    found = sorted((x["doc_id"] or 0, x["n_words"], x["n_removed"]) for x in got)
    assert found == sorted([(5, 60, 0), (5, 60, 60), (5, 4, 0), (7, 60, 60), (0, 60, 0), (0, 60, 60), (0, 0, 0), (6, 3000, 2999)])
    assert {x["kept_text"] for x in got if x["n_removed"] == 0} == {a, b, "short text of few", ""}


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.substring_dedup(documents(spark, [])).count() == 0


# Mixing


def test_targets_cap_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    want, weights, caps, left = {}, {"a": 3.0, "b": 1.0, "c": 2.0, None: 3.0}, {"a": 200, "b": 2000, "c": 20, None: 1000}, 1.5 * 1610
    while True:
        share = {s: left * w / sum(weights.values()) for s, w in weights.items()}
        over = [s for s in share if share[s] > caps[s]]
        if not over:
            want |= share
            break
        for s in over:
            want[s], left = caps[s], left - caps[s]
            del weights[s]
    assert got == pytest.approx(want)


def test_fit_is_nearest():
    r = random.Random(6)
    for _ in range(60):
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(4)}
        wanted = r.randrange(0, sum(s * n for s, n in counts.items()) + 1)
        sums = {0}
        for s, n in counts.items():
            sums = {x + s * k for x in sums for k in range(n + 1)}
        take = mixing.fit(counts, wanted)
        got = sum(s * n for s, n in take.items())
        assert all(0 <= take[s] <= counts[s] for s in take) and abs(got - wanted) == min(abs(x - wanted) for x in sums)


def test_fit_spreads_over_lengths_at_every_size():
    r = random.Random(20)
    counts = Counter(max(1, min(20_000, int(r.lognormvariate(5.5, 0.9)))) for _ in range(9000))
    mean = sum(s * n for s, n in counts.items()) / 9000
    for wanted in (10_000, 32_767, 32_768, 200_000, 2_000_000):
        take = mixing.fit(dict(counts), wanted)
        assert sum(s * n for s, n in take.items()) == wanted and all(0 <= take[s] <= counts[s] for s in take)
        assert 0.6 * mean < wanted / sum(take.values()) < 1.4 * mean and max(s for s in take if take[s]) > 2 * mean


def test_mix_takes_rows_by_themselves(spark):
    """Null and repeated ids, very long texts, and columns whose names are those of the operator or hold dots."""
    pairs = [(None, "w " * 7)] * 30 + [(5, "w " * 7)] * 30 + [(i, "w " * (i % 9)) for i in range(100, 300)] + [(400, "w " * 30_000)]
    docs = documents(spark, pairs).withColumns({"key": F.lit("k"), "row": F.lit("r"), "copies": F.lit("c"), "a.b": F.lit("d"), "__id": F.lit("e")})
    times = mixing.mix_counts(docs).toPandas()
    assert len(times) == len(pairs)
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    rows_ = got.toPandas()
    assert len(rows_) == times["times"].sum() and set(rows_["a.b"]) == {"d"} and set(rows_["__id"]) == {"e"} and set(rows_["row"]) == {"r"}
    taken = (times["size"] * times["times"]).groupby(times["target"]).sum()
    assert all(abs(t - target) <= 9 or t == 0 for target, t in taken.items() if target < 30_000)


def test_mix_comes_near_targets_and_agrees(spark):
    pairs = [(i, "w " * (i % 17)) for i in range(400)] + [(None, None), (900, "")]
    docs = documents(spark, pairs)
    got = mixing.mix_counts(docs).toPandas()
    assert len(got) == 402 and got["times"].max() <= 2
    taken = (got["size"] * got["times"]).groupby(got["target"]).sum()
    assert all(abs(t - target) <= 17 for target, t in taken.items())
    again = mixing.mix_counts(docs.repartition(5)).toPandas()
    key = lambda df: sorted(map(str, df.itertuples(index=False)))
    assert key(got) == key(again)
    assert mixing.mix(docs).columns == docs.columns and mixing.mix_counts(documents(spark, [])).count() == 0


# Tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary.vocabulary_path(vocabulary.BYTE_BPE))


def strange(n=150, seed=7):
    r = random.Random(seed)
    parts = [" ", "  ", "\n", "a", "é", "'s", "'re", "12", "!", "<|endoftext|>", "<|", "漢", " ", " word", "'", "\t", "́", "🙂", "the of "]
    return ["".join(r.choice(parts) for _ in range(r.choice([0, 3, 50, 5000]))) for _ in range(n)] + ["a" * 20000, " " * 9000, "ab " * 9000, "漢字" * 5000]


def test_chunked_encoding_is_the_library(library):
    coder = bpe.ChunkCoder(vocabulary.byte_encoding(vocabulary.vocabulary_path(vocabulary.BYTE_BPE)))
    texts = strange() * 2
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        ids = coder.encode(text)
        assert ids.tolist() == want.ids
        assert coder.decode(ids) == text == library.decode(want.ids, skip_special_tokens=False)
    assert coder.reused > 0


def test_every_code_point_splits_as_in_the_library(library):
    fast = vocabulary.byte_encoding(vocabulary.vocabulary_path(vocabulary.BYTE_BPE))
    texts = [f"a{c}1{c}! {c}{c} b{c}\n{c} 's{c}" for c in map(chr, [*range(0, 0xD800, 7), *range(0xE000, 0x30000, 11)])]
    assert all(a.ids == b for a, b in zip(library.encode_batch_fast(texts, add_special_tokens=False), fast.encode_ordinary_batch(texts, num_threads=4)))


def test_bpe_query_columns(spark, library):
    got = bpe.encode_decode(documents(spark, [(1, None), (2, "x y"), (2, "x y"), (None, "z")]), vocabulary.vocabulary_path(vocabulary.BYTE_BPE), with_ids=True).collect()
    assert sorted(((r["doc_id"] or 0), r["n_tokens"], list(r["ids"])) for r in got) == [(0, 1, library.encode("z").ids), (1, 0, []), (2, 2, library.encode("x y").ids), (2, 2, library.encode("x y").ids)]


def test_token_cache_is_filled_once(spark, library, tmp_path):
    path = vocabulary.vocabulary_path(vocabulary.BYTE_BPE)
    texts = [None, "", "a b", "a b", "q " * 2000, *strange(20)]
    docs = documents(spark, list(enumerate(texts)))
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    for turn in range(2):
        got = token_counts.token_counts(docs, str(tmp_path / "cache"), path).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want and {r["doc_id"] for r in got if r["over_limit"]} == {i for i in want if want[i][1] > 1024}
        stored = spark.read.parquet(str(tmp_path / "cache")).count()
        assert stored == len({t or "" for t in texts})
    more = documents(spark, [(1, "a b"), (2, "new")])
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(more, str(tmp_path / "cache"), path).collect()} == {1: 2, 2: len(library.encode("new").ids)}
    assert spark.read.parquet(str(tmp_path / "cache")).count() == stored + 1


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_vocabularies_use_their_library(name):
    path = vocabulary.vocabulary_path(name)
    assert vocabulary.byte_encoding(path) is None and vocabulary.counter(path)(["Hello there", ""])[1] == 0


# Top k


def brute_top_k(vectors, k=20):
    ints = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints[i] = min(ints.get(i, v), v)
    ints = {i: [top_k.whole(float(x)) for x in v] for i, v in ints.items()}
    want = set()
    for q in (i for i in ints if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        want |= {(q, n + 1, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored[:k])}
    return want


@pytest.mark.parametrize("scale", [1.0, 1e10, 1e15, 1e300])
def test_top_k_is_brute_force(spark, scale, monkeypatch):
    """Also of large components, of repeated ids, of ties, and with one vector much longer than all others; over many blocks."""
    monkeypatch.setattr(top_k, "ROWS", 50)
    r = random.Random(8)
    vectors = [(i, [r.gauss(0, 1) * (1 + i % 5) * (scale if i % 2 else 1) for _ in range(8)]) for i in range(200)]
    vectors += [(200 + i, [1.0] * 8) for i in range(30)] + [(300, None), (301, [float("nan")] * 8), (302, [None, 1.0]), (303, [float("inf")] * 8), (None, [1.0] * 8), (304, [2.0]), (320, [])]
    vectors += [(305, [0.5] * 5000), (40, [9.0] * 8), (40, [9.0] * 8), (310, [1e308] * 8), (340, [-0.0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns({"id": F.lit("clash"), "v": F.lit("clash"), "a.b": F.lit("clash")})
    assert {tuple(x) for x in top_k.top_k(df, F.col("id") % 20 == 0).collect()} == brute_top_k(vectors)


def test_top_k_prunes_and_floors_rise():
    r = np.random.default_rng(9)
    rows_ = list(r.normal(0, 1, (600, 16)) * r.uniform(0.1, 3, (600, 1)))
    rows_.sort(key=lambda v: -top_k.length(v))
    gram = np.array(rows_).T @ np.array(rows_)
    turn = np.linalg.eigh(gram)[1][:, ::-1]
    q = top_k.by_kind(list(range(40)), rows_[:40], [top_k.length(np.floor(64 * v)) for v in rows_[:40]], turn)[0]
    best, computed = top_k.Best(40, 5), []
    for at in range(0, 600, 100):
        part = rows_[at : at + 100]
        (c,) = top_k.by_kind(list(range(at, at + 100)), part, [top_k.length(np.floor(64 * v)) for v in part], turn)
        computed.append(top_k.meet(q, c, best))
    assert computed[0] > 10 * computed[-1] and {(i, n + 1, j, -s) for i, x in enumerate(best.rows) for n, (s, j) in enumerate(x) if i % 20 == 0} == brute_top_k([(i, v.tolist()) for i, v in enumerate(rows_)], 5) - {
        x for x in brute_top_k([(i, v.tolist()) for i, v in enumerate(rows_)], 5) if x[0] >= 40
    }


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k.top_k(df, F.col("id") % 20 == 0).collect()] == [(0, 1, 1, 64 * 128)]
    assert top_k.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


# WARC


def pages(n=30, seed=10):
    r = random.Random(seed)
    body = [bytes(r.randrange(256) for _ in range(r.choice([0, 5, 3000]))) for _ in range(n)]
    return [(i, f"http://x/{i}", body[i % 20]) for i in range(n)]


def archive(plain=False):
    out = [warc.record(i, u, b, i % 20 if i >= 20 else i) for i, u, b in pages()]
    return out if plain else [warc.member(x) for x in out]


@pytest.mark.parametrize("plain", [False, True])
def test_salvage_of_damage(plain):
    good = archive(plain)
    whole = list(warc.salvage(io.BytesIO(b"".join(good))))
    assert len(whole) == 30 and all(x[0] == "record" for x in whole)
    bad = list(good)
    bad[4] = bad[4][:-10] + b"\0\0\0" + bad[4][-7:]
    bad[10] = bad[10][:-9]
    bad.insert(20, b"junk\r\nWARC/1.1\r\nno header" * 9)
    data = b"".join(bad)
    found = list(warc.salvage(io.BytesIO(data)))
    # A record whose own checks hold stays, though its member's checksum is wrong.
    assert sum(x[0] == "record" for x in found) == (28 if plain else 29)
    gaps = [(x[1], x[2]) for x in found if x[0] == "gap"]
    lengths = [len(x) for x in bad]
    starts = np.cumsum([0, *lengths])
    assert gaps == [(starts[4], lengths[4]), (starts[10], lengths[10]), (starts[20], lengths[20])]


def test_salvage_of_a_member_of_many_records():
    """One damaged record, a cut tail or a wrong checksum of a whole-file member costs what it covers alone."""
    good = archive(plain=True)
    whole = warc.member(b"".join(good))
    ids = lambda data: [int(x[2]["warc-page-id"]) for x in warc.salvage(io.BytesIO(data)) if x[0] == "record"]
    gaps = lambda data: [x[1:3] for x in warc.salvage(io.BytesIO(data)) if x[0] == "gap"]
    assert ids(whole) == list(range(30)) and gaps(whole) == []
    bad = list(good)
    bad[4] = bad[4][:-8] + b"#" + bad[4][-7:]
    bad[29] = bad[29][:-9]
    damaged = warc.member(b"".join(bad))
    assert ids(damaged) == [i for i in range(30) if i not in (4, 29)] and gaps(damaged) == [(0, len(bad[4])), (0, len(bad[29]))]
    cut = whole[: len(whole) * 2 // 3] + warc.member(good[7])
    found = ids(cut)
    assert found[-1] == 7 and found[:-1] == list(range(len(found) - 1)) and len(found) > 10
    (gap,) = gaps(cut)
    assert gap == (0, len(whole) * 2 // 3)
    wrong = bytearray(whole)
    wrong[-6] ^= 1
    assert ids(bytes(wrong)) == list(range(30)) and gaps(bytes(wrong)) == [(0, len(whole))]
    huge = warc.record(1, "u", b"x" * 3_000_000, 1)
    assert ids(warc.member(huge + good[3] + huge)) == [1, 3, 1] and ids(huge + good[3] + huge) == [1, 3, 1]


def test_salvage_of_nothing_and_of_noise():
    assert list(warc.salvage(io.BytesIO(b""))) == []
    noise = random.Random(11).randbytes(700_000)
    assert [x[:3] for x in warc.salvage(io.BytesIO(noise))] == [("gap", 0, 700_000)]


def test_archives_round_trip(spark):
    rows_ = [(1, "u", "<p>é</p>"), (2, "u\r\nx", "<p>é</p>"), (3, None, None), (4, "v", ""), (None, "w", "<p>é</p>"), (1, "u", "<p>é</p>"), (9, "z", "y" * 2_000_000)]
    df = spark.createDataFrame(rows_, "page_id long, url string, html string").withColumns({"content": F.lit("clash"), "first": F.lit("clash"), "a.b": F.lit("clash")})
    manifest = warc.write_archives(df, common.new_folder(spark, "t"))
    assert warc.read_archives(manifest).count() == 7
    got = {r["id"]: (r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.read_archives(manifest).collect()}
    d, empty = warc.digest("<p>é</p>".encode()), warc.digest(b"")
    assert got == {1: ("response", None, 9, d), 2: ("revisit", 1, 9, d), 3: ("response", None, 0, empty), 4: ("revisit", 3, 0, empty), 9: ("response", None, 2_000_000, warc.digest(b"y" * 2_000_000)), common.NULL_ID: ("revisit", 1, 9, d)}
    assert warc.read_archives(warc.write_archives(df.limit(0), common.new_folder(spark, "t"))).count() == 0


# Chat


def test_templates_read_back():
    r = random.Random(12)
    bits = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "a", "<\\|", "assistant\n", "|>"]
    for _ in range(300):
        messages = [("".join(r.choice(bits) for _ in range(r.randrange(4))), "".join(r.choice(bits) for _ in range(r.randrange(12)))) for _ in range(r.randrange(4))]
        messages += [("assistant", "".join(r.choice(bits) for _ in range(6)))]
        formatted, spans = chat.render(messages)
        assert chat.parse(formatted) == messages
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for role, t in messages if role == "assistant"]


def test_events_fold_to_messages(spark):
    e = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "he"), (1, 1, 2, "delta", None, "llo"), (1, 1, 3, "delta", None, None),
        (1, 2, 4, "message", "user", "again"), (1, 1, 5, "regenerate", None, None), (1, 1, 6, "delta", None, "good "), (1, 1, 7, "delta", None, "day"),
        (1, 2, 8, "edit", None, "once more"), (1, 3, 9, "message", "assistant", "x"), (1, 3, 10, "delete", None, None), (2, None, None, "message", None, None),
    ]
    random.Random(13).shuffle(e)
    df = spark.createDataFrame(e, "conv_id long, turn long, seq long, kind string, role string, text string")
    got = {r["conv_id"]: chat.parse(r["formatted"]) for r in chat.format_events(df).collect()}
    assert got == {1: [("user", "hi"), ("assistant", "good day"), ("user", "once more")], 2: [("", "")]}
    assert chat.format_events(df.limit(0)).count() == 0


def test_conversations_with_ties_and_extra_columns(spark):
    """Repeated rows are messages of their own; ties of turn and sequence follow kind, role and text; a very long text is a text."""
    e = [(1, 0, 0, "message", "user", "b"), (1, 0, 0, "message", "user", "a"), (1, 0, 0, "message", "user", "a"), (None, 0, 0, "message", "x", "n"), (2, 0, 0, "message", "assistant", "y" * 3_000_000)]
    df = spark.createDataFrame(e, "conv_id long, turn long, seq long, kind string, role string, text string").withColumns({"formatted": F.lit("clash"), "a.b": F.lit("clash")})
    got = {r["conv_id"]: chat.parse(r["formatted"]) for r in chat.format_events(df.repartition(3)).collect()}
    assert got == {1: [("user", "a"), ("user", "a"), ("user", "b")], None: [("x", "n")], 2: [("assistant", "y" * 3_000_000)]}


# Quality


def clean_and_junk(n=240):
    r = random.Random(14)
    words = "the of and river mountain people walk slowly under old trees while light falls on water near small houses".split()
    good = [" ".join(r.choice(words) for _ in range(60)) + "." for _ in range(n)]
    junk = [" ".join(w.upper() + "###" for w in t.split()) for t in good[: n // 6]]
    return [(i, t) for i, t in enumerate(good)], [(10_000 + i, t) for i, t in enumerate(junk)]


def test_quality_held_out_and_shards_agree(spark):
    good, junk = clean_and_junk()
    docs = documents(spark, good + junk + [(20_000, None), (20_001, ""), (3, good[3][1]), (None, good[1][1]), (30_000, good[5][1] * 3000)])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[::2]] + [(i, 0, 0) for i, _ in junk[::2]] + [(None, 1, 0), (20_000, None, None)], "doc_id long, quality int, toxic int")
    key = lambda df: sorted(map(str, df.collect()))
    found = quality.scored(docs, labels, sample=60)
    a = found.toPandas()
    assert len(a) == docs.count() and a["doc_id"].isna().sum() == 1 and (a["doc_id"] == 3).sum() == 2
    assert key(found) == key(quality.scored(docs, labels, sample=60, most=0))
    a = a.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    unlabelled = [i for i, _ in good[1::2]]
    assert a.loc[unlabelled, "kept"].mean() >= 0.95 and not a.loc[[i for i, _ in junk], "kept"].any()
    assert not a.loc[[20_000, 20_001], "kept"].any()
    odd = docs.withColumns({"key": F.lit("k"), "a.b": F.lit("d"), "__id": F.lit("e"), "perplexity": F.lit("p")})
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and {(r["key"], r["a.b"], r["__id"]) for r in kept.collect()} == {("k", "d", "e")}


def test_quality_of_other_scripts(spark):
    """Each of very many characters counts: text of a script of its own stays, characters in random order go."""
    r = random.Random(21)
    signs = [chr(0x4E00 + i) for i in range(3000)]
    words = ["".join(r.choice(signs) for _ in range(3)) for _ in range(150)]
    good = [(i, "".join(r.choice(words) for _ in range(60))) for i in range(200)]
    junk = [(1000 + i, "".join(r.choice(signs) for _ in range(180))) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:150]], "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x["kept"] for x in quality.scored(documents(spark, good + junk), labels, sample=90).collect()}
    assert sum(got[i] for i, _ in good[150:]) >= 48 and not any(got[i] for i, _ in junk)


def brute_kneser_ney(texts):
    """A function from (context, byte) to its probability, of plain dictionaries."""
    order, counts = quality.ORDER, {}
    counts[order] = Counter(t[i : i + order] for t in (b"\xff" * (order - 1) + t.encode() for t in texts) for i in range(len(t) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: quality.discounts([sum(n == i for n in c.values()) for i in range(1, 5)]) for k, c in counts.items()}
    by_context = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            by_context[k][g[:-1]].append(n)

    def p(context, byte):
        k = len(context) + 1
        lower = p(context[1:], byte) if k > 1 else 1 / 256
        seen = by_context[k].get(context)
        if not seen:
            return lower
        total, n = sum(seen), counts[k].get(context + byte, 0)
        return (n - (d[k][min(n, 3) - 1] if n else 0)) / total + sum(d[k][min(x, 3) - 1] for x in seen) / total * lower

    return p


def test_quality_is_kneser_ney(spark):
    texts = ["the cat sat on the mat", "a cat ate the rat", "Ärger über Öl", "the the the the rat"]
    trained = quality.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    model, p = quality.Model(*quality.in_memory(trained)), brute_kneser_ney(texts)
    asked = ["the rat sat on a cat", "Öl", "zzz", "", "the" * 200_000]
    data, offsets = common.text_buffer(pa.array(asked))
    for text, total in zip(asked[:4], model.totals(data, offsets)):
        x = b"\xff" * (quality.ORDER - 1) + text.encode()
        want = sum(np.log(p(x[i : i + quality.ORDER - 1], x[i + quality.ORDER - 1 : i + quality.ORDER])) for i in range(len(text.encode())))
        assert total / quality.UNIT == pytest.approx(want, abs=1e-4)
    long = quality.padded(asked[4].encode())
    assert model.totals(data, offsets)[4] == model.log_probabilities(quality.grams(long)).sum()
    for context in (b"\xff" * 5, b"he ca", b"zzzzz"):
        assert sum(p(context, bytes([c])) for c in range(256)) == pytest.approx(1)


def test_quality_without_labels_keeps_texts(spark):
    docs = documents(spark, [(1, "abc"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["kept"] for r in quality.scored(docs, none).collect()} == {1: True, 2: False}


def test_quality_counts_all_trusted_texts(spark):
    """The model has the counts of each trusted text, and each sets limits by the model of the other folds."""
    good, junk = clean_and_junk(40)
    texts, held = dict(good + junk), dict(good[:24])
    docs = documents(spark, good + junk)
    labels = spark.createDataFrame([(i, 1, 0) for i in held], "doc_id long, quality int, toxic int")
    assert {r["doc_id"] for r in quality.sampled(docs, quality.trusted(labels)).collect()} == set(held)
    fold = {r["doc_id"]: r["fold"] for r in docs.select("doc_id", F.pmod(F.xxhash64(F.lit(quality.SEED + 1), "doc_id"), F.lit(quality.FOLDS)).alias("fold")).collect()}
    assert {len(t) // 256 for t in held.values()} == {1} and {fold[i] for i in held} == set(range(quality.FOLDS))

    def log_perplexity(p, text):
        x = b"\xff" * (quality.ORDER - 1) + text.encode()
        return -sum(np.log(p(x[i : i + quality.ORDER - 1], x[i + quality.ORDER - 1 : i + quality.ORDER])) for i in range(len(x) - quality.ORDER + 1)) / len(text.encode())

    whole, others = brute_kneser_ney(held.values()), [brute_kneser_ney([t for i, t in held.items() if fold[i] != f]) for f in range(quality.FOLDS)]
    steps = [np.ceil(log_perplexity(others[fold[i]], t) / quality.STEP) for i, t in held.items()]
    limit = np.exp(np.percentile(steps, 100 * quality.QUANTILE) * quality.STEP) * quality.MARGIN
    got = {r["doc_id"]: r for r in quality.scored(docs, labels).collect()}
    for i in (0, 7, 23, 30, 10_000):
        assert got[i]["perplexity"] == pytest.approx(np.exp(log_perplexity(whole, texts[i])), rel=1e-5)
        if got[i]["n_bytes"] < 512:
            assert got[i]["limit"] == pytest.approx(limit, rel=2 * quality.STEP)


def test_pipeline_quality_learns_every_trusted_text(spark):
    """Trusted texts of a word of their own are too few to set the limit; they stay because the model counts each."""
    r = random.Random(32)
    words = "the of and river mountain people walk slowly under old trees while light falls on water near small houses".split()
    rare = {5: "漢字仮名", 25: "한국어문", 45: "ещёслово", 65: "λόγοςἐστ"}
    good = [(i, " ".join(rare.get(i, r.choice(words)) for _ in range(30))) for i in range(900)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    kept = {x["doc_id"] for x in quality.keep_good(documents(spark, good), labels).collect()}
    assert set(rare) <= kept and len(kept) >= 890


def test_quality_writes_few_tables(spark):
    """Small models are computed from one table of counts; each table that tasks write costs processes and memory."""
    good, junk = clean_and_junk(40)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    before = set(os.listdir(common.shared_dir(spark)))
    assert len(quality.keep_good(documents(spark, good + junk), labels).collect()) >= 38
    made = Counter(x.split("-")[1] for x in set(os.listdir(common.shared_dir(spark))) - before)
    assert made["grams"] == 1 and made.total() <= 8


@pytest.mark.parametrize("n", [0, 1, 40])
def test_quality_trains_alike_in_both_ways(spark, n):
    good, junk = clean_and_junk(40)
    texts = spark.createDataFrame([(i % 2, t) for i, t in (good + junk)[:n]], "fold int, text string")
    small, joined = quality.train_folds(texts, 2), quality.train_folds(texts, 2, -1)
    for a, b in zip(small, joined, strict=True):
        assert "arrays" in a and (a["entries"], a["unseen"]) == (b["entries"], b["unseen"])
        for x, y in zip(sum(quality.in_memory(a)[1:3], []), sum(quality.in_memory(b)[1:3], []), strict=True):
            assert (x[0] == y[0]).all() and (x[1] == y[1]).all()


@pytest.mark.parametrize("bits", [32, 1])
def test_quality_texts_of_ids(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "ID_BITS", bits)
    r = random.Random(31)
    ids = [r.randrange(-(2**40), 2**40) for _ in range(600)]
    docs, chosen = documents(spark, [(i, f"t{i}") for i in [*ids, *ids[:9], None]]), set(ids[::3])
    got = quality._of_ids(docs, spark.createDataFrame([(i,) for i in chosen], "doc_id long"), len(chosen))
    assert got.columns == docs.columns and sorted(x["text"] for x in got.collect()) == sorted(f"t{i}" for i in ids + ids[:9] if i in chosen)


# Shared


def test_words_are_those_of_the_pattern():
    texts = ["a b c", "", " \x0b\x1c x", None, "é ü y", "end"]
    data, offsets = common.text_buffer(pa.array(texts))
    s, e = common.word_spans(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(s, e)] == [w for t in texts for w in SPACE.findall(t or "")]
    h = common.word_hashes(data, s, e)
    assert len(set(h.tolist())) == len({bytes(data[a:b]) for a, b in zip(s, e)})


def test_pieces_hash_like_the_whole(monkeypatch):
    text = " ".join(f"word{i % 50}" for i in range(5000))
    data, offsets = common.text_buffer(pa.array([text]))
    s, e = common.word_spans(data, offsets)
    whole = common.word_hashes(data, s, e)
    monkeypatch.setattr(common, "PIECE", 1000)
    assert (common.word_hashes(data, s, e) == whole).all() and len(set(whole.tolist())) == 50


@pytest.mark.parametrize("name", sorted(registered.ORACLE_SQL))
def test_query_is_its_sql(spark, name):
    got, want = registered.QUERIES[name](spark, FOLDER).toPandas(), connect(FOLDER).sql(registered.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_registered_counts_and_ids_are_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    coded = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    want = {i: (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()) for i, ids in coded.items()}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in registered.QUERIES["op9_bpe"](spark, FOLDER).collect()} == want
    counted = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in registered.QUERIES["op4_token_counts"](spark, FOLDER).collect()}
    assert counted == {i: (len(texts[i].encode()), len(ids), len(ids) > 1024) for i, ids in coded.items()}


def test_registered_mix_is_brute_force(spark):
    """Sizes, sources and targets by hand; taken words near targets, and no document more than twice."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    size = {r["doc_id"]: len(SPACE.findall(r["text"] or "")) for r in docs}
    source = {r["doc_id"]: r["source"] for r in docs}
    totals = Counter()
    for i, s in source.items():
        totals[s] += size[i]
    names = sorted(totals, key=lambda s: (s is None, s))
    weights, want, budget = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}, 1.5 * sum(totals.values())
    while len(want) < len(names):
        open_ = [s for s in names if s not in want]
        share = {s: (budget - sum(want.values())) * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * totals[s]]
        want |= {s: 2.0 * totals[s] for s in over} if over else share
    got, taken = registered.QUERIES["op3_mix"](spark, FOLDER).collect(), Counter()
    assert {r["doc_id"]: r["size"] for r in got} == size
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == totals[s] and r["target"] == pytest.approx(want[s]) and r["taken"] <= 2 * r["size"]
    for s in names:  # the words taken are the nearest that whole documents allow
        sums = {0}
        for i in (i for i in source if source[i] == s):
            sums |= {x + size[i] for x in sums}
        whole = int(want[s] // totals[s]) * totals[s]
        assert abs(taken[s] - want[s]) <= min(abs(whole + x - want[s]) for x in sums) + 1


def test_registered_quality_is_kneser_ney(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{x}.parquet") for x in ("documents", "labels"))
    texts = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    chosen = {r["doc_id"] for r in quality.sampled(texts, quality.trusted(labels)).collect()}
    by_id = {r["doc_id"]: r["text"] for r in texts.collect()}
    p = brute_kneser_ney([by_id[i] for i in chosen])
    got = {r["doc_id"]: r for r in registered.QUERIES["op8_quality"](spark, FOLDER).collect()}
    assert set(got) == set(by_id)
    for i in sorted(by_id, key=lambda i: (len(by_id[i]), i))[20:60:8]:
        data = by_id[i].encode()
        x = b"\xff" * (quality.ORDER - 1) + data
        total = sum(np.log(p(x[j : j + quality.ORDER - 1], x[j + quality.ORDER - 1 : j + quality.ORDER])) for j in range(len(data)))
        assert got[i]["perplexity"] == pytest.approx(np.exp(-total / len(data)), rel=1e-5)
        assert got[i]["kept"] == (got[i]["limit"] is None or got[i]["perplexity"] <= got[i]["limit"])


def test_pipeline_stages_are_brute_force(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs.toPandas()]
    for i, (_, stage) in enumerate(p.STAGES):
        docs = common.written(stage(spark, docs, FOLDER), "stage")
        tables.append(docs.toPandas())
        assert i == len(p.STAGES) - 1 or list(tables[-1].columns) == list(tables[0].columns)
    start, good, exact, near, mixed, coded = tables
    scored = quality.scored(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")).toPandas()
    assert sorted(good["doc_id"]) == sorted(scored[scored["kept"]]["doc_id"])
    assert sorted(exact["doc_id"]) == sorted(i for i, v in brute_exact(list(zip(good["doc_id"], good["text"]))).items() if v[2])
    assert sorted(near["doc_id"]) == sorted(i for i, v in brute_groups(list(zip(exact["doc_id"], exact["text"]))).items() if v[1] == i)
    assert set(Counter(mixed["doc_id"]).values()) <= {1, 2} and set(mixed["doc_id"]) <= set(near["doc_id"])
    assert sorted(coded["doc_id"]) == sorted(mixed["doc_id"]) and len(start) > 0
