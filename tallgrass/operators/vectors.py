"""Sparse and dense vectors: document frequencies, TF-IDF, centroids, cosine candidates, medoids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallgrass.sources.landed import settled


def tokens(text: Column, least: int = 2) -> Column:
    """Lower-case runs of letters and digits of at least `least` characters; the default tokenizer, any other may take its place."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) >= least)


def term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, n) in long form, the form that joins and aggregates spread over tasks; texts are shuffled by key, which takes less than their tokens do."""
    return docs.select(key, text).repartition(key).select(key, F.explode(tokens(F.col(text))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("n"))


def token_totals(docs: DataFrame, cluster: str, text: str) -> DataFrame:
    """(cluster, token, n): how often the texts of a cluster hold a token; one shuffle of partial sums, and neither texts nor terms of a document travel."""
    return docs.select(cluster, F.explode(tokens(F.col(text))).alias("token")).groupBy(cluster, "token").agg(F.count("*").alias("n"))


def document_frequencies(terms: DataFrame, field: str) -> DataFrame:
    """(field, token, df) of terms (key, token, n)."""
    return terms.groupBy("token").agg(F.count("*").alias("df")).select(F.lit(field).alias("field"), "token", "df")


def token_frequencies(docs: DataFrame, text: str, field: str) -> DataFrame:
    """(field, token, df) of texts: each text's distinct tokens, counted with one shuffle of partial sums."""
    tokens_ = docs.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    return tokens_.groupBy("token").agg(F.count("*").alias("df")).select(F.lit(field).alias("field"), "token", "df")


def inverse(df: Column, n: Column) -> Column:
    return F.ln((1 + n) / (1 + df)) + 1


def tf_idf(terms: DataFrame, frequencies: DataFrame, documents: int, key: str) -> DataFrame:
    """(key, token, weight): log1p(n) * idf, each key's vector of length 1; unseen tokens count as df 0."""
    x = terms.join(frequencies.select("token", "df"), "token", "left").withColumn("w", F.log1p("n") * inverse(F.coalesce("df", F.lit(0)), F.lit(documents)))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))
    return x.select(key, "token", (F.col("w") / norm).alias("weight"))


#: Bytes of the texts that meet in one block, and so share one copy of their vocabulary.
BLOCK = 32 << 20


def block_counts(docs: DataFrame, text: str, cluster: str | None = None) -> DataFrame:
    """(_group, _parts): the number of blocks of each cluster, or of all texts, as a written table, so that Spark knows its size before it joins texts."""
    group = F.col(cluster) if cluster else F.lit(0)
    return settled(docs.groupBy(group.alias("_group")).agg(F.greatest(F.lit(1), F.coalesce(F.ceil(F.sum(F.octet_length(text)) / BLOCK), F.lit(1))).cast("long").alias("_parts")))


def blocked(docs: DataFrame, key: str, text: str, counts: DataFrame, cluster: str | None = None) -> DataFrame:
    """docs (key, text, cluster) with their block, a long: texts of one cluster and about BLOCK bytes. Rows that repeat a key are one text."""
    names = [key] + ([cluster] if cluster else [])
    docs = docs.select(*names, text)
    if not docs.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        docs = docs.groupBy(*names).agg(F.array_join(F.collect_list(text), "\n").alias(text))
    group = F.col(cluster) if cluster else F.lit(0)
    x = docs.join(counts, group.eqNullSafe(F.col("_group")))
    return x.select(F.xxhash64(group, F.pmod(F.xxhash64(key), "_parts")).alias("block"), *names, text)


def block_frequencies(docs: DataFrame, text: str) -> DataFrame:
    """(block, token, df) of blocked() texts: each block's vocabulary with the number of all texts that hold a token."""
    x = docs.select("block", text).repartition("block").select("block", F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    own = x.groupBy("block", "token").agg(F.count("*").alias("n"))
    return own.select("block", "token", F.sum("n").over(W.partitionBy("token")).alias("df"))


def _with_vocabulary(docs: DataFrame, facts: DataFrame, key: str, text: str, values: tuple[str, ...], fold, schema: str) -> DataFrame:
    """fold(vocabulary, keys, place, id, n) for texts of each block, after its facts (block, token and the values, doubles).

    vocabulary is (tokens, values of each); place, id and n tell which text has which token how often, in order. What fold yields are
    columns of the result; at a block's end it is called without texts. A task holds the vocabulary of one block and some texts.
    """
    x = facts.select("block", "token", *values).unionByName(docs.select("block", key, text), allowMissingColumns=True)
    x = x.repartition("block").sortWithinPartitions("block", F.col("token").isNull(), key).select("block", "token", *values, key, F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")).alias("words"))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        block, known, learnt = None, None, []

        def closed():
            if known is not None:
                yield from fold(block, known, None, None, None, None)

        for batch in batches:
            at = batch.column("block").to_numpy()
            fact = batch.column("token").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (fact[1:] != fact[:-1])) + 1
            for i, j in zip([0, *cuts], [*cuts, len(at)]):
                part = batch.slice(i, j - i)
                if at[i] != block:
                    for out in closed():
                        yield pa.RecordBatch.from_arrays(out, names)
                    block, known, learnt = at[i], None, []
                if fact[i]:
                    learnt.append(part.select(["token", *values]))
                    continue
                if known is None:
                    t = pa.Table.from_batches(learnt) if learnt else None
                    known = (t.column("token").combine_chunks(), *(t.column(v).to_numpy().astype(float) for v in values)) if t is not None else (pa.array([], pa.string()), *(np.zeros(0) for _ in values))
                    learnt = []
                words = part.column("words")
                lengths = np.diff(words.offsets.to_numpy())
                ids = pc.index_in(words.flatten(), value_set=known[0]).to_numpy(zero_copy_only=False).astype(np.int64)
                size = max(1, len(known[0]))
                pairs, n = np.unique(np.repeat(np.arange(len(lengths)), lengths) * size + ids, return_counts=True)
                for out in fold(block, known, part.column(key), pairs // size, pairs % size, n):
                    yield pa.RecordBatch.from_arrays(out, names)
        for out in closed():
            yield pa.RecordBatch.from_arrays(out, names)

    return x.mapInArrow(run, schema)


def _unit_weights(place: np.ndarray, ids: np.ndarray, n: np.ndarray, df: np.ndarray, documents: int, texts: int) -> np.ndarray:
    """log1p(n) * idf, each text's vector of length 1."""
    w = np.log1p(n) * (np.log((1 + documents) / (1 + df[ids])) + 1)
    return w / np.sqrt(np.bincount(place, w * w, texts))[place]


def vector_sums(docs: DataFrame, key: str, text: str, documents: int) -> DataFrame:
    """(key, l1, largest, tokens) of the unit TF-IDF vectors of whole texts that have tokens; terms don't travel, only texts and vocabularies of blocks."""
    x = blocked(docs, key, text, block_counts(docs, text))

    def fold(block, known, keys, place, ids, n):
        if keys is None or not len(place):
            return
        w = _unit_weights(place, ids, n, known[1], documents, len(keys))
        rows, starts, tokens_ = np.unique(place, return_index=True, return_counts=True)
        yield [keys.take(pa.array(rows)), pa.array(np.add.reduceat(w, starts)), pa.array(np.maximum.reduceat(w, starts)), pa.array(tokens_.astype(np.int64))]

    return _with_vocabulary(x, block_frequencies(x, text), key, text, ("df",), fold, f"{key} {docs.schema[key].dataType.simpleString()}, l1 double, largest double, tokens long")


def text_medoids(docs: DataFrame, members: DataFrame, key: str, text: str, cluster: str, documents: int) -> DataFrame:
    """medoids() of whole texts, by members, rows of docs: first each block's sums of weights, then each member's product with its cluster's sum."""
    counts = block_counts(docs, text, cluster)
    every, x = blocked(docs, key, text, counts, cluster), blocked(members, key, text, counts, cluster)

    def summed(block, known, keys, place, ids, n):
        if keys is None:
            total = sums.pop(block, np.zeros(len(known[1])))
            at = np.flatnonzero(total)
            for i in range(0, len(at), 50_000):
                part = at[i : i + 50_000]
                yield [pa.array(np.full(len(part), block)), known[0].take(pa.array(part)), pa.array(known[1][part]), pa.array(total[part])]
            return
        if block not in sums:
            sums[block] = np.zeros(len(known[1]))
        sums[block] += np.bincount(ids, _unit_weights(place, ids, n, known[1], documents, len(keys)), len(known[1]))

    def scored(block, known, keys, place, ids, n):
        if keys is None:
            return
        w = _unit_weights(place, ids, n, known[1], documents, len(keys))
        yield [keys, pa.array(np.bincount(place, w * (known[2][ids] - w), len(keys)))]

    sums: dict = {}
    own = settled(_with_vocabulary(x, block_frequencies(every, text), key, text, ("df",), summed, "block long, token string, df double, own double"))
    groups = x.select("block", F.col(cluster).alias("_cluster")).distinct()
    total = F.sum("own").over(W.partitionBy("_cluster", "token"))
    facts = own.join(groups, "block").select("block", "token", "df", total.alias("total"))
    score = _with_vocabulary(x, facts, key, text, ("df", "total"), scored, f"{key} {docs.schema[key].dataType.simpleString()}, score double")
    return _nearest(members, score.select(key, F.round("score", 9).alias("score")), key, cluster)


def centroids(terms: DataFrame, members: DataFrame, key: str, cluster: str) -> DataFrame:
    """(cluster, token, total, mean): summed counts of the members' terms; members without terms count in the mean."""
    sizes = members.groupBy(cluster).agg(F.count("*").alias("size"))
    return terms.join(members, key).groupBy(cluster, "token").agg(F.sum("n").alias("total")).join(sizes, cluster).select(cluster, "token", "total", (F.col("total") / F.col("size")).alias("mean"))


def text_centroids(docs: DataFrame, cluster: str, text: str) -> DataFrame:
    """centroids() of whole texts, by cluster, without a table of terms."""
    sizes = docs.groupBy(cluster).agg(F.count("*").alias("size"))
    return token_totals(docs, cluster, text).join(sizes, cluster).select(cluster, "token", F.col("n").alias("total"), (F.col("n") / F.col("size")).alias("mean"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normed(column: str) -> Column:
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: F.try_divide(x, length))


def earlier_candidates(vectors: DataFrame, key: str, block: str, vector: str, least: float, lookback: int, k: int) -> DataFrame:
    """(key, candidate, cosine, rank): for each row, the k most similar earlier rows of its block within the look-back, least cosine and over.

    Blocks are further cut into spans of the look-back, and a row meets its own span and the one before: no block is paired in full.
    """
    v = vectors.select(key, block, normed(vector).alias("v"), F.floor(F.col(key) / lookback).alias("span"))
    a = v.withColumn("span", F.explode(F.array("span", F.col("span") - 1)))
    b = v.select(F.col(key).alias("candidate"), F.col(block).alias("b_block"), F.col("v").alias("b_v"), F.col("span").alias("b_span"))
    pairs = a.join(b, (F.col(block) == F.col("b_block")) & (F.col("span") == F.col("b_span")) & (F.col("candidate") < F.col(key)) & (F.col("candidate") >= F.col(key) - lookback))
    x = pairs.select(key, "candidate", F.round(dot(F.col("v"), F.col("b_v")), 6).alias("cosine")).filter(F.col("cosine") >= least)
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc("cosine"), F.desc("candidate")))
    return x.withColumn("rank", rank).filter(F.col("rank") <= k)


def best_cosines(rows: DataFrame, key: str, group: str, vector: str, size: int = 2048) -> DataFrame:
    """(a_group, b_group, key, cosine): for each row of long key, the best cosine to any row of each other (long) group; null where no pair has one.

    All pairs are scored, as products of blocks of about `size` vectors; only each block pair's maxima leave its task.
    """
    v = rows.select(F.col(key).cast("long").alias("key"), F.col(group).cast("long").alias("label"), normed(vector).alias("v")).filter("label IS NOT NULL AND v IS NOT NULL")
    v = v.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(max(1, -(-v.count() // size)))))
    blocks = v.groupBy("block").agg(F.collect_list(F.struct("label", "key", "v")).alias("m"))
    pairs = blocks.select(F.col("m").alias("a")).crossJoin(blocks.select(F.col("m").alias("b")))

    def parts(members):
        label, keys, vs = (members.field(n) for n in ("label", "key", "v"))
        return label.to_numpy(), keys.to_numpy(), vs.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vs), -1)

    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                (al, _, av), (bl, bk, bv) = parts(a.values), parts(b.values)
                order = np.argsort(al, kind="stable")
                labels, starts = np.unique(al[order], return_index=True)
                for at in range(0, len(bk), 512):
                    best = np.fmax.reduceat(bv[at : at + 512] @ av[order].T, starts, axis=1)  # NaN, of zero vectors, counts as none
                    i, j = np.nonzero(bl[at : at + 512, None] != labels)
                    yield pa.RecordBatch.from_arrays([pa.array(labels[j]), pa.array(bl[at + i]), pa.array(bk[at + i]), pa.array(best[i, j], from_pandas=True)], names=["a_group", "b_group", "key", "cosine"])

    x = pairs.mapInArrow(run, "a_group long, b_group long, key long, cosine double")
    return x.groupBy("a_group", "b_group", "key").agg(F.max("cosine").alias("cosine"))


def eligible(members: DataFrame, cluster: str, length: str, least: int) -> DataFrame:
    """The members that may stand for their cluster: those of the least length, or all that have any where none is so long."""
    longest = settled(members.groupBy(F.col(cluster).alias("_cluster")).agg(F.max(length).alias("_longest")))
    x = members.filter(F.col(length) > 0).join(longest, F.col(cluster).eqNullSafe(F.col("_cluster")))
    return x.filter((F.col(length) >= least) | (F.col("_longest") < least)).drop("_cluster", "_longest")


def medoids(weights: DataFrame, members: DataFrame, key: str, cluster: str) -> DataFrame:
    """(cluster, medoid): the member with the largest summed cosine to the others of its cluster, ties to the smallest key; one without tokens sums to 0.

    The sum over members of a dot product is the product with the members' sum, so no pairs are formed.
    """
    x = weights.join(members.select(key, cluster), key)
    total = x.groupBy(F.col(cluster).alias("_cluster"), "token").agg(F.sum("weight").alias("total"))
    others = F.col("weight") * (F.col("total") - F.col("weight"))
    score = x.join(total, (x["token"] == total["token"]) & x[cluster].eqNullSafe(total["_cluster"])).groupBy(key).agg(F.round(F.sum(others), 9).alias("score"))
    return _nearest(members, score, key, cluster)


def _nearest(members: DataFrame, score: DataFrame, key: str, cluster: str) -> DataFrame:
    ranked = members.select(key, cluster).join(score, key, "left")
    return ranked.groupBy(cluster).agg(F.max_by(key, F.struct(F.coalesce("score", F.lit(0.0)), -F.col(key))).alias("medoid"))
