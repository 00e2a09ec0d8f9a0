"""Online clustering: documents in order of time join the most similar live cluster or begin one.

The fold is sequential, since each assignment changes a centroid. Documents of different blocks never meet; a block is folded in
one task, so blocks are what scales. Blocks that are connected components of shared tokens give the unblocked result as long
as the threshold exceeds what time alone can score, which is checked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.operators import vectors

FIELDS = ("title", "body", "all", "entities")
DAY, HOUR = 86_400.0, 3_600.0


@dataclass(frozen=True)
class Options:
    text_weights: tuple[float, float, float, float] = (1.0, 1.0, 1.0, 1.0)
    time_weights: tuple[float, float, float] = (0.1, 0.1, 0.1)
    sigma_hours: float = 72.0
    threshold: float = 1.0
    candidate_days: float = 10.0
    span_days: float = 10.0

    def __post_init__(self) -> None:
        if self.sigma_hours <= 0 or self.threshold <= sum(self.time_weights):
            raise ValueError("sigma must be positive and the threshold above the time weights' sum")


@dataclass
class _Cluster:
    number: int
    first: float
    last: float
    seconds: float = 0.0
    size: int = 0
    sums: dict = field(default_factory=lambda: {"title": {}, "body": {}, "entities": {}})
    vectors: dict = field(default_factory=dict)


def _whole(doc: dict) -> dict:
    both = dict(doc["title"])
    for t, w in doc["body"].items():
        both[t] = both.get(t, 0.0) + w
    return {"title": doc["title"], "body": doc["body"], "all": both, "entities": doc["entities"]}


def _unit(terms: dict, idf: dict, unseen: float) -> dict:
    v = {t: math.log1p(w) * idf.get(t, unseen) for t, w in terms.items() if w > 0}
    length = math.sqrt(sum(x * x for x in v.values()))
    return {t: x / length for t, x in v.items()} if length else {}


def _cosine(a: dict, b: dict) -> float:
    if len(a) > len(b):
        a, b = b, a
    return sum(x * b[t] for t, x in a.items() if t in b)


def fold(docs: list[tuple], idf: dict[str, dict], documents: int, options: Options) -> list[tuple]:
    """(key, cluster, score) for docs (key, epoch, title, body, entities); a cluster is named by its first document's key, whose score is None."""
    return fold_from([], docs, idf, documents, options)[0]


def fold_from(seeds: list[tuple], docs: list[tuple], idf: dict[str, dict], documents: int, options: Options) -> tuple[list[tuple], list[tuple]]:
    """fold() that begins with stored clusters, and all clusters as they are after it: seeds (number, first, last, seconds, size, title, body, entities).

    seconds is the sum of the members' times. A cluster that a document finds too old, or begun more than candidate_days after it, takes no
    further document of the run. Running parts of the documents one after the other, in order of time, gives what one run gives.
    """
    unseen = math.log(1 + documents) + 1
    vectorise = lambda d: {f: _unit(t, idf.get(f, {}), unseen) for f, t in _whole(d).items()}
    centroid = lambda c: vectorise({f: {t: w / c.size for t, w in s.items()} for f, s in c.sums.items()})
    every = [_Cluster(*s[:5], sums={f: dict(m or {}) for f, m in zip(("title", "body", "entities"), s[5:])}) for s in seeds]
    for c in every:
        c.vectors = centroid(c)
    live, out = list(every), []
    for key, epoch, title, body, entities in sorted(docs, key=lambda x: (x[1], x[0])):
        doc = {"title": title or {}, "body": body or {}, "entities": entities or {}}
        mine = vectorise(doc)
        reach = options.candidate_days * DAY
        live = [c for c in live if c.last >= epoch - reach and c.first <= epoch + reach and c.first >= epoch - options.span_days * DAY]
        best, top = None, -math.inf
        for c in live:
            marks = (c.last, c.seconds / c.size, c.first)
            score = sum(w * _cosine(mine[f], c.vectors[f]) for f, w in zip(FIELDS, options.text_weights))
            score += sum(w * math.exp(-(((epoch - m) / HOUR) ** 2) / (2 * options.sigma_hours**2)) for m, w in zip(marks, options.time_weights))
            if score > top:  # ties stay with the earlier cluster
                best, top = c, score
        if best is None or top <= options.threshold:
            best, top = _Cluster(key, epoch, epoch), None
            live.append(best)
            every.append(best)
        best.first, best.last, best.seconds, best.size = min(best.first, epoch), max(best.last, epoch), best.seconds + epoch, best.size + 1
        for f, sums in best.sums.items():
            for t, w in doc[f].items():
                sums[t] = sums.get(t, 0.0) + w
        best.vectors = centroid(best)
        out.append((key, best.number, top))
    return out, [(c.number, c.first, c.last, c.seconds, c.size, c.sums["title"], c.sums["body"], c.sums["entities"]) for c in every]


_SEED = "number long, first double, last double, seconds double, size long, title map<string,double>, body map<string,double>, entities map<string,double>"


def _document_rows(group: pd.DataFrame) -> list[tuple]:
    return [(r.key, r.epoch, *(dict(m) if m is not None else {} for m in (r.title, r.body, r.entities))) for r in group.itertuples()]


def online_clusters(docs: DataFrame, block: str, idf: dict[str, dict], documents: int, options: Options = Options()) -> DataFrame:
    """(key, cluster, score) of docs (key long, epoch double, title, body, entities: map<string,double>, and the block column).

    idf, from field to token to weight, is the run's frozen dictionary; its vocabulary is bounded by the caller.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(fold(_document_rows(group), idf, documents, options), columns=["key", "cluster", "score"])

    return docs.groupBy(block).applyInPandas(run, "key long, cluster long, score double")


def online_step(docs: DataFrame, seeds: DataFrame | None, block: str, idf: dict[str, dict], documents: int, options: Options = Options()) -> DataFrame:
    """One incremental run: rows of docs with their clusters (key, cluster, score), and stored clusters as they are afterwards (the columns of seeds), together.

    seeds has the block column, number, first, last, seconds, size, and sums of terms as maps; None where nothing is stored yet. Rows of the
    stored clusters have a NULL key; assigned(), and stored() of the written result part the two.
    """
    spark, kind = docs.sparkSession, docs.schema[block].dataType.simpleString()
    seeds = spark.createDataFrame([], f"`{block}` {kind}, {_SEED}") if seeds is None else seeds
    names = [f.split()[0] for f in _SEED.split(", ")]

    def run(key: tuple, group: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        old = [(r.number, r.first, r.last, r.seconds, r.size_, *(dict(m) if m is not None else {} for m in (r.title, r.body, r.entities))) for r in kept.rename(columns={"size": "size_"}).itertuples()]
        old.sort(key=lambda r: (r[1], r[0]))
        found, clusters = fold_from(old, _document_rows(group), idf, documents, options)
        rows = [(*f, key[0], *[None] * len(names)) for f in found] + [(None, None, None, key[0], *c) for c in clusters]
        return pd.DataFrame(rows, columns=["key", "cluster", "score", block, *names], dtype=object)

    both = docs.groupBy(block).cogroup(seeds.groupBy(block))
    return both.applyInPandas(run, f"key long, cluster long, score double, `{block}` {kind}, {_SEED}")


def assigned(step: DataFrame) -> DataFrame:
    return step.filter("key IS NOT NULL").select("key", "cluster", "score")


def stored(step: DataFrame) -> DataFrame:
    return step.filter("key IS NULL").drop("key", "cluster", "score")


def _words(docs: DataFrame) -> DataFrame:
    words = lambda c: F.coalesce(vectors.tokens(F.col(c)), F.array().cast("array<string>")).alias(c)
    return docs.select("block", "epoch", "key", words("title"), words("body"))


def block_weights(docs: DataFrame, documents: int) -> DataFrame:
    """(block, token, i_t, i_b, i_a) of docs (title, body: string, and block): the inverse frequencies of each block's tokens in title,
    body and both, over the documents of all blocks. Frequencies are summed and joined by token; no vocabulary is gathered or cut."""
    marked = lambda tokens, *n: F.transform(tokens, lambda x: F.struct(x.alias("token"), *(F.lit(v).alias(c) for c, v in zip("tba", n))))
    each = F.concat(marked(F.array_distinct("title"), 1, 0, 0), marked(F.array_distinct("body"), 0, 1, 0), marked(F.array_union("title", "body"), 0, 0, 1))
    x = _words(docs).select("block", F.explode(each).alias("x")).groupBy("block", "x.token").agg(*(F.sum(f"x.{c}").alias(c) for c in "tba"))
    df = x.groupBy("token").agg(*(F.sum(c).alias(f"df_{c}") for c in "tba"))
    return x.select("block", "token").join(df, "token").select("block", "token", *(vectors.inverse(F.col(f"df_{c}"), F.lit(documents)).alias(f"i_{c}") for c in "tba"))


class _Fold:
    """fold() on arrays, a document at a time, with the weights of a block's tokens learnt before its documents.

    The vectors of all live clusters lie one after another in `entry`, with their tokens in `at` and their places in `owner`
    (place 0: given up), so a document meets all of them in one pass; given-up entries are dropped once they are the larger part.
    """

    def __init__(self, options: Options) -> None:
        self.o, self.ids, self.idf, self.dense = options, {}, np.zeros((1024, 3)), np.zeros((1024, 3))
        self.at, self.owner, self.entry, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros((1024, 3)), 0
        self.dead, self.free, self.made = 0, [], 0
        self.live, self.state, self.sums = np.zeros(1, bool), np.zeros((1, 5)), [None]  # by place: first, last, seconds, size, turn
        self.number = [None]

    def learn(self, token: str, idf: np.ndarray) -> None:
        i = self.ids.setdefault(token, len(self.ids))
        if i >= len(self.idf):
            self.idf, self.dense = np.concatenate([self.idf, np.zeros_like(self.idf)]), np.concatenate([self.dense, np.zeros_like(self.dense)])
        self.idf[i] = idf

    def counts(self, *fields: list) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a document and their counts in title and body."""
        n = sum(map(len, fields))
        at, where = np.unique(np.fromiter((self.ids[t] for f in fields for t in f), np.int64, n), return_inverse=True)
        return at, np.column_stack([np.bincount(x, minlength=len(at)) for x in np.split(where, [len(fields[0])])]).astype(float)

    def unit(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(np.column_stack([counts, counts.sum(axis=1)])) * self.idf[at]
        length = np.sqrt((v * v).sum(axis=0))
        return v / np.where(length > 0, length, 1.0)

    def drop(self, places: np.ndarray) -> None:
        gone = np.zeros(len(self.live), bool)
        gone[places] = True
        hit = gone[self.owner[: self.used]]
        self.dead += int(hit.sum())
        self.owner[: self.used][hit] = 0
        if self.dead * 2 > self.used:
            keep = np.flatnonzero(self.owner[: self.used])
            for a in (self.at, self.owner, self.entry):
                a[: len(keep)] = a[keep]
            self.used, self.dead = len(keep), 0

    def put(self, place: int, at: np.ndarray, v: np.ndarray) -> None:
        while self.used + len(at) > len(self.at):
            self.at, self.owner, self.entry = (np.concatenate([a, np.zeros_like(a)]) for a in (self.at, self.owner, self.entry))
        span = slice(self.used, self.used + len(at))
        self.at[span], self.owner[span], self.entry[span] = at, place, v
        self.used += len(at)

    def place(self, key: int, epoch: float) -> int:
        if not self.free:
            self.free = list(range(2 * len(self.live) - 1, len(self.live) - 1, -1))
            self.live, self.state = np.concatenate([self.live, np.zeros_like(self.live)]), np.concatenate([self.state, np.zeros_like(self.state)])
            self.sums, self.number = self.sums + [None] * len(self.sums), self.number + [None] * len(self.number)
        p, self.made = self.free.pop(), self.made + 1
        self.live[p], self.state[p], self.number[p] = True, (epoch, epoch, 0.0, 0, self.made), key
        self.sums[p] = (np.zeros(0, np.int64), np.zeros((0, 2)))
        return p

    def add(self, key: int, epoch: float, at: np.ndarray, counts: np.ndarray) -> tuple:
        o = self.o
        old = np.flatnonzero(self.live & ((self.state[:, 1] < epoch - o.candidate_days * DAY) | (self.state[:, 0] < epoch - o.span_days * DAY)))
        if len(old):
            self.live[old] = False
            self.drop(old)
            self.free += old.tolist()
            for p in old:
                self.sums[p] = None
        v, best, top = self.unit(at, counts), None, None
        live = np.flatnonzero(self.live)
        if len(live):
            self.dense[at] = v * o.text_weights[:3]
            text = np.einsum("ij,ij->i", self.dense[self.at[: self.used]], self.entry[: self.used])
            self.dense[at] = 0.0
            s = self.state[live]
            score = np.bincount(self.owner[: self.used], weights=text, minlength=len(self.live))[live]
            for m, w in zip((s[:, 1], s[:, 2] / s[:, 3], s[:, 0]), o.time_weights):
                score = score + w * np.exp(-(((epoch - m) / HOUR) ** 2) / (2 * o.sigma_hours**2))
            if score.max() > o.threshold:
                most = np.flatnonzero(score == score.max())
                most = most[np.argmin(s[most, 4])]  # ties stay with the earlier cluster
                best, top = int(live[most]), float(score[most])
        if best is None:
            best = self.place(key, epoch)
        else:
            self.drop(np.array([best]))
        s = self.state[best]
        s[0], s[1], s[2], s[3] = min(s[0], epoch), max(s[1], epoch), s[2] + epoch, s[3] + 1
        known, sums = self.sums[best]
        both, inverse = np.unique(np.concatenate([known, at]), return_inverse=True)
        total = np.zeros((len(both), 2))
        total[inverse[: len(known)]] = sums
        total[inverse[len(known) :]] += counts
        self.sums[best] = (both, total)
        self.put(best, both, self.unit(both, total / s[3]))
        return key, self.number[best], top


def online_clusters_of_texts(docs: DataFrame, documents: int, options: Options = Options()) -> DataFrame:
    """(key, cluster, score) of docs (key long, epoch double, title string, body string, block); what fold() gives with the frequencies of all tokens.

    A block's weights and then its documents in order of time come to its task, which reads them one batch at a time: what stays is its
    live clusters and vocabulary.
    """

    def run(batches):
        block, state = None, None
        for batch in batches:
            blocks, epochs, keys, tokens = (batch.column(c).to_pylist() for c in ("block", "epoch", "key", "token"))
            title, body = batch.column("title"), batch.column("body")
            idf = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("i_t", "i_b", "i_a")])
            out = []
            for i, (b, epoch, key, token) in enumerate(zip(blocks, epochs, keys, tokens)):
                if state is None or b != block:
                    block, state = b, _Fold(options)
                if token is not None:
                    state.learn(token, idf[i])
                else:
                    out.append(state.add(key, epoch, *state.counts(title[i].as_py(), body[i].as_py())))
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["key", "cluster", "score"])

    first = block_weights(docs, documents).withColumn("epoch", F.lit(-math.inf))
    x = first.unionByName(_words(docs), allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "epoch", "key")
    return x.mapInArrow(run, "key long, cluster long, score double")
