"""Quality classifier: an interpolated modified Kneser-Ney model of the bytes of UTF-8, trained on trusted text.

Training counts n-grams of all trusted labelled rows (quality 1, toxic 0), whole texts, into a table keyed by n-gram. While its rows are few (below),
the driver computes continuation counts, context totals and interpolated probabilities from it; else these are tables too, joined shard by shard.
Bytes leave no character of any script without counts of its own.
Scoring gives each document its perplexity per byte over its whole text.

A document is kept when its perplexity is at most its limit: the QUANTILE of the perplexities of all trusted labelled documents of its
language and length class, times MARGIN. No document sets limits by a model that has seen it: a hash of its id puts it into one of FOLDS folds,
and the model of all other folds scores it. These models come from the same counts, less their fold's. Few documents tell little, so a class's
logarithm is averaged with its language's, which weighs CLASS_PRIOR documents, and a language's with that of all, which weighs LANGUAGE_PRIOR.
So limits move smoothly with the number of documents, and one without a trusted document has the limit of all.

A model grows with the distinct n-grams of the trusted text, and its entries are counted before use: up to IN_MEMORY of them go to every
task as hash tables, one model at a time; a larger model is joined with the documents' n-grams instead, shard by shard. Both add up whole numbers,
logarithms in millionths, and agree to the last bit on one model. The two ways of training do the same arithmetic in the same order.

Null or empty text: perplexity null, not kept. Without any trusted document there is no limit, and all others stay.
Very long texts are scored whole, in pieces. Repeated rows, ids or null ids give a row each. A null language is one of its own. Labels that repeat or
contradict count as trusted only if all of an id's rows are. Empty tables give no rows. Extra columns are not read; keep_good()
returns the columns of its input, whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import ID_BITS, among, keyed, pieces, text_buffer, written

ORDER, FOLDS, QUANTILE, MARGIN, SEED = 6, 2, 0.995, 1.05, 11
#: Entries of a model that tasks hold, and n-grams from which the driver computes models.
IN_MEMORY, ON_DRIVER = 8_000_000, 2_500_000
#: Documents that a language's limit weighs beside its length class, and that the limit of all weighs beside a language.
CLASS_PRIOR, LANGUAGE_PRIOR = 100, 10
#: Lengths count by powers of two, from 2**6 or less to 2**11 or more bytes: short texts vary more.
CLASSES = (6, 11)
#: Perplexities are compared in steps of this relative size when quantiles are taken.
STEP = 0.002
#: Bytes that are scored or counted at once.
PIECE = 1 << 18
#: Different n-grams whose counts a task holds before it hands them on.
HELD = 1 << 20
#: Stands before a text; no byte of UTF-8 has this value.
PAD = 0xFF
#: Logarithms are whole numbers of this fraction.
UNIT = 1_000_000


def grams(data: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte from the place order - 1 on, it and the order - 1 before it, eight bits each, the byte lowest."""
    n = max(0, len(data) - order + 1)
    out = np.zeros(n, dtype=np.int64)
    for k in range(order):
        out |= data[order - 1 - k : order - 1 - k + n].astype(np.int64) << 8 * k
    return out


def padded(text: bytes) -> np.ndarray:
    return np.frombuffer(b"\xff" * (ORDER - 1) + text, dtype=np.uint8)


def _joined(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts i to j (exclusive), each behind its padding, and the first and last (exclusive) place of each."""
    begin = offsets[i : j + 1] - offsets[i]
    room = np.full(int(begin[-1]) + (ORDER - 1) * (j - i), PAD, dtype=np.uint8)
    shift = np.arange(1, j - i + 1) * (ORDER - 1)
    room[np.arange(begin[-1]) + np.repeat(shift, np.diff(begin))] = data[offsets[i] : offsets[j]]
    return room, begin[:-1] + shift, begin[1:] + shift


def _merged(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their sums, of such pairs."""
    x = np.concatenate([k for k, _ in counts])
    order = np.argsort(x, kind="stable")
    x = x[order]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return x[first], np.add.reduceat(np.concatenate([n for _, n in counts])[order], first)


def _count_grams(folds: int):
    """(gram, and for each fold its count) of texts (fold, text); a gram may come more than once."""

    def run(batches):
        import pyarrow as pa

        def wide():
            x, n = _merged(held)
            gram = x // folds
            new = np.concatenate(([True], gram[1:] != gram[:-1]))
            out = np.zeros((folds, int(new.sum())), dtype=np.int64)
            out[x % folds, np.cumsum(new) - 1] = n
            return pa.RecordBatch.from_arrays([pa.array(gram[new]), *map(pa.array, out)], ["gram", *(f"n{f}" for f in range(folds))])

        held, loose = [], 0
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = text_buffer(batch.column(1))
            for i, j in pieces(offsets, PIECE):
                room, first, last = _joined(data, offsets, i, j)
                whose = np.repeat(fold[i:j], last - first + ORDER - 1)
                for at in range(ORDER - 1, len(room), PIECE):
                    g = grams(room[at - ORDER + 1 : at + PIECE])
                    g = (g * folds + whose[at : at + PIECE])[g & 0xFF != PAD]
                    if len(g):
                        held.append(np.unique(g, return_counts=True))
                        loose += len(held[-1][0])
                    if 2 * loose > HELD:
                        held, loose = [_merged(held)], 0
                        if len(held[0][0]) > HELD:
                            yield wide()
                            held = []
        if held:
            yield wide()

    return run


class Model:
    """Hash tables of n-grams of each order with log probabilities and, as contexts, log weights of the shorter context."""

    def __init__(self, token: str, tables: list[tuple[np.ndarray, np.ndarray]], weights: list[tuple[np.ndarray, np.ndarray]], unseen: int) -> None:
        self.token, self.unseen = token, unseen
        self.tables = [_hashed(*t) for t in tables]  # of order 1, 2 ...
        self.weights = [_hashed(*w) for w in weights]  # of contexts of 1, 2 ... bytes

    def log_probabilities(self, g: np.ndarray) -> np.ndarray:
        """Of the last byte of each n-gram, given those before it, in UNITs."""
        out = np.zeros(len(g), dtype=np.int64)
        left = np.arange(len(g))
        for order in range(len(self.tables), 0, -1):
            x = g[left]
            value, found = _look_up(self.tables[order - 1], x & (1 << 8 * order) - 1)
            out[left[found]] += value[found]
            left = left[~found]
            if not len(left):
                break
            if order > 1:
                weight, known = _look_up(self.weights[order - 2], (g[left] >> 8) & (1 << 8 * (order - 1)) - 1)
                out[left] += np.where(known, weight, 0)
        out[left] += self.unseen
        return out

    def totals(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The sum over each of the texts whose bytes lie between offsets; all texts together, in pieces, each text with its own beginning."""
        n = len(offsets) - 1
        out = np.zeros(n, dtype=np.int64)
        for i, j in pieces(offsets, PIECE):
            room, first, last = _joined(data, offsets, i, j)
            for at in range(ORDER - 1, len(room), PIECE):
                g = grams(room[at - ORDER + 1 : at + PIECE])
                upto = np.concatenate(([0], np.cumsum(self.log_probabilities(g))))
                a, b = (np.clip(x - at, 0, len(g)) for x in (first, last))
                out[i:j] += upto[b] - upto[a]
        return out


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _hashed(keys: np.ndarray, values: np.ndarray) -> tuple:
    """An open-addressing table of keys (at least 0) and values."""
    bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 1.5))))
    held, out = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
    left, step = np.arange(len(keys)), 0
    while len(left):
        at = (_slot(keys[left], bits) + step) & (1 << bits) - 1
        free = held[at] < 0
        held[at[free]] = keys[left[free]]
        won = held[at] == keys[left]
        out[at[won]] = values[left[won]]
        left, step = left[~won], step + 1
    return bits, step, held, out


def _look_up(table: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits, steps, held, values = table
    at = _slot(keys, bits)
    there = held[at]
    found = there == keys
    left = np.flatnonzero(~found & (there >= 0))
    for _ in range(1, steps):
        if not len(left):
            break
        at[left] = (at[left] + 1) & (1 << bits) - 1
        there = held[at[left]]
        found[left] = there == keys[left]
        left = left[(there != keys[left]) & (there >= 0)]
    return values[at], found


def train(texts: DataFrame, most: int = IN_MEMORY) -> dict:
    """A model from texts (text): the number of its entries, the log probability of unseen bytes, and log probabilities (kind 0) and weights (1) as arrays of each order or as a DataFrame (kind, n, key, value)."""
    return train_folds(texts.select(F.lit(0).alias("fold"), "text"), 0, most)[-1]


def train_folds(texts: DataFrame, folds: int, most: int = IN_MEMORY) -> list[dict]:
    """Models as of train() from texts (fold, text): for each fold that of all other folds, and at the end that of all texts.

    Models of up to `most` entries are computed by the driver, from counts of at most half as many n-grams and at most ON_DRIVER, and are arrays; larger ones are joined tables.
    """
    names = [f"n{f}" for f in range(max(folds, 1))]
    sums = texts.select("fold", "text").mapInArrow(_count_grams(len(names)), "gram long, " + ", ".join(f"{c} long" for c in names)).groupBy("gram").agg(*(F.sum(c).alias(c) for c in names))
    sums = written(sums, "grams")
    if sums.count() <= min(most // 2, ON_DRIVER):
        found = _small_models(sums, folds)
        if max(m["entries"] for m in found) <= most:
            return found
    return _joined_models(sums, folds)


def _small_models(sums: DataFrame, folds: int) -> list[dict]:
    x = sums.toArrow()
    gram = x.column("gram").to_numpy()
    order = np.argsort(gram)
    gram, of_fold = gram[order], [c.to_numpy()[order] for c in x.columns[1:]]
    del x, order
    out = []
    for m in range(folds + 1):
        n = sum(c for f, c in enumerate(of_fold) if f != m or m == folds)
        tables, weights, unseen = _kneser_ney(gram[n > 0], n[n > 0])
        out.append({"arrays": (tables, weights), "entries": sum(len(k) for k, _ in tables + weights), "unseen": unseen})
    return out


def _kneser_ney(gram: np.ndarray, n: np.ndarray) -> tuple[list, list, int]:
    """What Model() takes, from the sorted n-grams of the highest order, of which each is there, and their counts."""
    in_units = lambda p: np.rint(np.log(p) * UNIT).astype(np.int32)
    counts = {ORDER: (gram, n)}
    for k in range(ORDER - 1, 0, -1):  # how many bytes stand before each shorter one
        counts[k] = np.unique(counts[k + 1][0] & (1 << 8 * k) - 1, return_counts=True)
    tables, weights, weight = [], [], 1 / 256
    for k in range(1, ORDER + 1):
        gram, n = counts.pop(k)
        kind = np.minimum(n, 3)
        d = np.array([0, *discounts([int(np.count_nonzero(n == i)) for i in range(1, 5)])])
        context = gram >> 8
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))[: len(gram)])
        each = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(gram))))
        total = np.bincount(each, n, len(first))
        held = [np.bincount(each[kind == i], minlength=len(first)) * d[i] for i in (1, 2, 3)]
        left = (held[0] + held[1] + held[2]) / total
        own = (n - d[kind]) / total[each]
        if k == 1:
            weight = float(left[0]) / 256 if len(left) else weight
            p = own + weight
        else:
            p = own + left[each] * lower[np.searchsorted(shorter, gram & (1 << 8 * (k - 1)) - 1)]
            weights.append((context[first], in_units(left)))
        tables.append((gram, in_units(p)))
        shorter, lower = gram, p
    return tables, weights, round(float(np.log(weight)) * UNIT)


def _joined_models(sums: DataFrame, folds: int) -> list[dict]:
    names, models = sums.columns[1:], range(folds + 1)
    low = lambda bytes_: F.col("gram").bitwiseAND(F.lit((1 << 8 * bytes_) - 1))
    of_model = lambda values: F.element_at(F.array(*(F.lit(float(x)) for x in values)), F.col("model") + 1)
    in_units = lambda p: F.round(F.ln(p) * UNIT).cast("int").alias("value")
    whole = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    each = [whole - F.col(names[m]) if m < folds else whole for m in models]
    each = F.array(*(F.struct(F.lit(m).alias("model"), n.alias("n")) for m, n in zip(models, each)))
    counts = {ORDER: sums.select("gram", F.inline(each)).filter("n > 0")}
    for k in range(ORDER - 1, 0, -1):  # how many bytes stand before each shorter one
        counts[k] = written(counts[k + 1].groupBy("model", low(k).alias("gram")).agg(F.count("*").alias("n")), "grams")
    below, tables, unseen = None, [], []
    for k in range(1, ORDER + 1):
        ones = {r["model"]: r for r in counts[k].groupBy("model").agg(*(F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5))).collect()}
        d = [of_model(x) for x in zip(*(discounts([ones[m][f"n{i}"] if m in ones else 0 for i in range(1, 5)]) for m in models))]
        held = [F.count_if(x) * y for x, y in zip((F.col("n") == 1, F.col("n") == 2, F.col("n") > 2), d)]
        context = counts[k].groupBy("model", F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("total"), (held[0] + held[1] + held[2]).alias("held"))
        context = written(context, "contexts")
        x = counts[k].withColumn("context", F.shiftright("gram", 8)).join(context, ["model", "context"])
        own = (F.col("n") - F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])) / F.col("total")
        if k == 1:
            first = {r["model"]: r["held"] / r["total"] for r in context.collect()}
            weights = [first.get(m, 1.0) / 256 for m in models]
            unseen = [float(np.log(w)) for w in weights]
            x = x.select("model", "gram", (own + of_model(weights)).alias("p"))
        else:
            shorter = below.select("model", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            x = x.withColumn("suffix", low(k - 1)).join(shorter, ["model", "suffix"]).select("model", "gram", (own + F.col("held") / F.col("total") * F.col("lower")).alias("p"))
            tables.append(context.select("model", F.lit(1).alias("kind"), F.lit(k - 1).alias("n"), F.col("context").alias("key"), in_units(F.col("held") / F.col("total"))))
        below = written(x, "kneser-ney")
        tables.append(below.select("model", F.lit(0).alias("kind"), F.lit(k).alias("n"), F.col("gram").alias("key"), in_units(F.col("p"))))
    table = tables[0]
    for t in tables[1:]:
        table = table.unionByName(t)
    entries = {r["model"]: r["count"] for r in table.groupBy("model").count().collect()}
    return [{"table": table.filter(F.col("model") == m).drop("model"), "entries": entries.get(m, 0), "unseen": round(unseen[m] * UNIT)} for m in models]


def discounts(n: list[int]) -> list[float]:
    """The discounts of counts 1, 2 and 3 or more, from how many n-grams occur once, twice, three and four times; each is kept between a tenth and its count."""
    n1, n2, n3, n4 = (max(1, x) for x in n)
    y = n1 / (n1 + 2 * n2)
    return [min(max(x, 0.1), most) for most, x in ((0.9, 1 - 2 * y * n2 / n1), (1.8, 2 - 3 * y * n3 / n2), (2.7, 3 - 4 * y * n4 / n3))]


def in_memory(trained: dict) -> tuple:
    """What Model() takes, as sorted arrays."""
    if "arrays" in trained:
        return uuid.uuid4().hex, *trained["arrays"], trained["unseen"]
    x = trained["table"].select(F.col("kind").cast("byte"), F.col("n").cast("byte"), "key", "value").toArrow()
    kind, n, key, value = (x.column(c).to_numpy() for c in ("kind", "n", "key", "value"))

    def part(k, order):
        at = np.flatnonzero((kind == k) & (n == order))
        at = at[np.argsort(key[at])]
        return key[at].astype(np.int64), value[at].astype(np.int32)

    return uuid.uuid4().hex, [part(0, i) for i in range(1, ORDER + 1)], [part(1, i) for i in range(1, ORDER)], trained["unseen"]


_built: list[Model] = []


def _model(token: str, arrays) -> Model:
    """The worker's model; only the latest is held, and not the arrays that it was built from (a broadcast loads them again when asked)."""
    if not _built or _built[0].token != token:
        _built[:] = []
        _built.append(Model(*arrays.value))
        vars(arrays).pop("_value", None)
    return _built[0]


def _score(token: str, model):
    def run(batches):
        import pyarrow as pa

        m = _model(token, model)
        for batch in batches:
            data, offsets = text_buffer(batch.column(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(offsets), pa.int64()), pa.array(m.totals(data, offsets), pa.int64())], ["key", "doc_id", "lang", "n_bytes", "log_p"])

    return run


def _doc_grams(batches):
    import pyarrow as pa

    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, n = np.unique(grams(padded(text.encode())), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(x), pa.int64()), pa.array(x, pa.int64()), pa.array(n, pa.int64())], ["row", "gram", "times"])


def log_likelihoods(docs: DataFrame, trained: dict, most: int = IN_MEMORY) -> DataFrame:
    """(key, doc_id, lang, n_bytes, log_p) of docs (key, doc_id, lang, text), a row for each; log_p in UNITs. most: as it was given to train()."""
    spark = docs.sparkSession
    docs = docs.select("key", "doc_id", "lang", "text")
    if trained["entries"] <= most:
        arrays = in_memory(trained)
        return docs.mapInArrow(_score(arrays[0], spark.sparkContext.broadcast(arrays)), "key long, doc_id long, lang string, n_bytes long, log_p long")
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    # Shard by shard: each order of n-grams is joined with what the documents still lack.
    left = rows.select("row", "text").mapInArrow(_doc_grams, "row long, gram long, times long").withColumn("log_p", F.lit(0).cast("long"))
    done = None
    for k in range(ORDER, 0, -1):
        own = trained["table"].filter((F.col("kind") == 0) & (F.col("n") == k)).select(F.col("key").alias("k"), "value")
        x = left.join(own, F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)) == F.col("k"), "left")
        hit = x.filter("value is not null").select("row", "times", (F.col("log_p") + F.col("value")).alias("log_p"))
        done = hit if done is None else done.unionByName(hit)
        left = x.filter("value is null").select("row", "gram", "times", "log_p")
        if k > 1:
            weight = trained["table"].filter((F.col("kind") == 1) & (F.col("n") == k - 1)).select(F.col("key").alias("k"), "value")
            left = left.join(weight, F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) == F.col("k"), "left").select("row", "gram", "times", (F.col("log_p") + F.coalesce("value", F.lit(0))).alias("log_p"))
    done = done.unionByName(left.select("row", "times", (F.col("log_p") + F.lit(trained["unseen"])).alias("log_p")))
    sums = done.groupBy("row").agg(F.sum(F.col("times") * F.col("log_p")).alias("log_p"))
    sizes = rows.select("row", "key", "doc_id", "lang", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(sums, "row", "left").select("key", "doc_id", "lang", "n_bytes", F.coalesce("log_p", F.lit(0).cast("long")).alias("log_p"))


def trusted(labels: DataFrame) -> DataFrame:
    """The ids whose labels all say quality and none says toxic."""
    good = F.min(F.expr("coalesce(quality, 0) = 1 and coalesce(toxic, 0) = 0"))
    return labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(good.alias("good")).filter("good").select("doc_id")


def sampled(docs: DataFrame, good: DataFrame, sample: int | None = None) -> DataFrame:
    """(doc_id) of the documents that train the model: all trusted ones, or, for a caller who gives `sample`, each with the chance that makes this the expected number of a language."""
    near = docs.select("doc_id", "lang").join(good, "doc_id", "left_semi").distinct()
    if sample is None:
        return near.select("doc_id").distinct()
    counts = near.groupBy(F.col("lang").alias("its")).agg(F.count("*").alias("n"))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) * F.col("n")
    return near.join(counts, F.col("lang").eqNullSafe(F.col("its"))).filter(drawn < sample * (1 << 30)).select("doc_id").distinct()


def _of_ids(texts: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of texts whose doc_id is among the n of ids; texts aren't shuffled."""
    return among(texts, ids, "doc_id", n, ID_BITS, written)


def _scored(texts: DataFrame, labels: DataFrame, sample: int | None, quantile: float, margin: float, most: int) -> DataFrame:
    """(key, doc_id, lang, n_bytes, perplexity, limit, kept) for each row of texts (key, doc_id, lang, text)."""
    good = written(trusted(labels), "trusted")
    chosen = written(sampled(texts, good, sample), "chosen")
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    training = _of_ids(texts, chosen, chosen.count()).select("key", "doc_id", "lang", "text", fold)
    *others, trained = train_folds(training, FOLDS, most)
    perplexity = F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_p") / UNIT / F.col("n_bytes"))).alias("perplexity")
    length_class = F.greatest(F.lit(CLASSES[0]), F.least(F.lit(CLASSES[1]), F.floor(F.log2(F.greatest("n_bytes", F.lit(1)))).cast("int"))).alias("length_class")
    judged = lambda rows, model: log_likelihoods(rows, model, most).select("key", "doc_id", "lang", "n_bytes", perplexity, length_class)
    found = written(judged(texts, trained), "perplexities")
    sure = found.join(good, "doc_id", "left_semi").join(chosen, "doc_id", "left_anti").select(found.columns)
    for f, model in enumerate(others):
        sure = sure.unionByName(judged(training.filter(F.col("fold") == f), model))
    sure = written(sure.filter("perplexity is not null").select("lang", "length_class", F.ceil(F.ln("perplexity") / STEP).alias("step")), "sure")
    of_all = sure.agg(F.expr(f"percentile(step, {quantile})")).first()[0]
    if of_all is None:
        limits = found.withColumn("limit", F.lit(None).cast("double"))
    else:
        by_lang = _pulled(sure, quantile, ["lang"], F.lit(float(of_all)), LANGUAGE_PRIOR)
        by_lang = by_lang.select(F.col("lang").alias("l_lang"), F.col("at").alias("l_at"))
        beside = sure.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")))
        by_class = _pulled(beside, quantile, ["lang", "length_class"], F.min("l_at"), CLASS_PRIOR).select(F.col("lang").alias("c_lang"), F.col("length_class").alias("c_class"), F.col("at").alias("c_at"))
        limits = found.join(by_class, F.col("lang").eqNullSafe(F.col("c_lang")) & (F.col("length_class") == F.col("c_class")), "left").join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
        limits = limits.withColumn("limit", F.exp(F.coalesce("c_at", "l_at", F.lit(float(of_all))) * STEP) * margin)
    kept = F.col("perplexity").isNotNull() & (F.col("limit").isNull() | (F.col("perplexity") <= F.col("limit")))
    return limits.select("key", "doc_id", "lang", "n_bytes", "perplexity", "limit", kept.alias("kept"))


def _pulled(sure: DataFrame, quantile: float, by: list[str], towards, prior: int) -> DataFrame:
    """(by, at): of each group's steps the quantile, averaged with `towards`, which weighs prior rows."""
    own, n = F.expr(f"percentile(step, {quantile})"), F.count("*")
    return sure.groupBy(*by).agg(((own * n + towards * prior) / (n + prior)).alias("at"))


def scored(docs: DataFrame, labels: DataFrame, sample: int | None = None, quantile: float = QUANTILE, margin: float = MARGIN, most: int = IN_MEMORY) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, limit, kept) for each row of docs."""
    texts = docs.select(F.lit(0).cast("long").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return _scored(texts, labels, sample, quantile, margin, most).drop("key")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """The perplexity of all documents and whether they stay."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that stay, each judged by itself."""
    rows = keyed(docs)
    texts = rows.select("key", F.col("id").alias("doc_id"), F.col("row")["lang"].cast("string").alias("lang"), "text")
    stay = _scored(texts, labels, None, QUANTILE, MARGIN, IN_MEMORY).filter("kept").select("key")
    return among(rows.select("key", "row"), stay, "key").select("row.*")
