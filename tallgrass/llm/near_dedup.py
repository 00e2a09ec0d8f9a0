"""Near duplicates by SuperMinHash signatures, banding, verification on full sets and union-find grouping.

Documents are linked when the Jaccard similarity of their shingle sets is at least num / den; groups are the connected
components of these links. Texts with the same sequence of words are one class and count once in the search, so a group of
copies of any size costs one row. Signatures are made of hashes, but links are confirmed on the words themselves.

Candidates: a signature has SLOTS values, banded as BANDS keys of ROWS values. Each bucket first offers its members to three
hubs, which joins groups of true near copies in a linear number of pairs. What is still apart in a bucket is then paired
across components, where sizes and odd sketches allow the similarity, so no link between different texts goes missing beyond
what banding misses: about 5 in a million at 0.75, fewer above. The odd sketch, which has the parity of the number of shingles
at each of its bits, never rejects a link: two sketches differ in at most as many bits as the sets have elements apart.
There, members meet by classes of set size and, in large buckets, by pieces, so no task sees all pairs of a bucket.

Null text, empty text: an empty set, linked with nothing. Rows that share an id count as one document, that of the least text in byte order.
All null ids are one id, which comes after all others. Columns besides id and text are not read. An empty table gives no rows.
drop_near() judges each row by itself, also where ids repeat or are null, and returns the columns of its input, whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import among, id_back, id_key, join_groups, keyed, mix, quoted, written
from tallgrass.llm.components import components
from tallgrass.llm.shingles import WordSets, normalised, shingle_sets

SLOTS, BANDS, ROWS = 128, 32, 4
#: Bits of the odd sketch.
ODD_BITS = 1024
#: Members of a bucket, of one class of sizes, that meet in one piece.
PIECE = 512
_RANK = np.uint64(24)
_EMPTY = np.uint32(0xFFFFFFFF)
#: Elements that are ranked together.
_BLOCK = 100_000


def _draw(elements: np.ndarray, level: int) -> np.ndarray:
    return mix(elements + np.uint64((0xD1B54A32D192ED03 * (level + 1)) % 2**64))


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """A row of `slots` 32-bit values for each set of 64-bit hashes.

    At level j, each element draws a fraction and, by a Fisher-Yates step of its own, the slot of rank j in its
    permutation; a slot keeps the smallest rank + fraction. A set whose slots all hold ranks up to j is done after level j.
    All sets go through a level together. An empty set has the largest value everywhere.
    """
    out = np.full((len(sets), slots), _EMPTY, dtype=np.uint32)
    i = 0
    while i < len(sets):
        j, n = i + 1, len(sets[i])
        while j < len(sets) and n + len(sets[j]) <= _BLOCK:
            n += len(sets[j])
            j += 1
        _rank_block(sets[i:j], out[i:j], slots)
        i = j
    return out


def _rank_block(sets: list[np.ndarray], out: np.ndarray, slots: int) -> None:
    flat = out.reshape(-1)
    elements = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    first = second = order = None
    for level in range(slots):
        if not len(elements):
            return
        draw = _draw(elements, level)
        value = ((draw >> np.uint64(40)) | (np.uint64(level) << _RANK)).astype(np.uint32)
        pick = level + (draw & np.uint64(0xFFFFFF)).astype(np.int64) * (slots - level) // 2**24
        if level == 0:
            slot = first = pick
        elif level == 1:
            slot = np.where(pick == first, 0, pick)
        else:
            rows = np.arange(len(elements))
            if order is None:  # few sets come this far; their permutations so far are played again
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                for step in range(2):
                    again = first if step == 0 else second
                    held = order[rows, again].copy()
                    order[rows, again] = order[:, step]
                    order[:, step] = held
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, level]
            order[:, level] = slot
        if level == 1:
            second = pick
        np.minimum.at(flat, doc * slots + slot, value)
        open_ = out.max(axis=1) >= (np.uint32(level + 1) << np.uint32(24))
        live = open_[doc]
        if not live.all():
            elements, doc, first = elements[live], doc[live], first[live]
            second = second[live] if second is not None else None
            if order is not None:
                order = order[live]


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    x = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(signatures), 1))
    for i in range(ROWS):
        key = mix(key ^ x[:, :, i])
    return key


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ODD_BITS / 64 words for each set."""
    out = np.empty((len(sets), ODD_BITS // 64), dtype=np.int64)
    for i in range(0, len(sets), 256):
        part = sets[i : i + 256]
        at = np.repeat(np.arange(len(part)), [len(x) for x in part]) * ODD_BITS + (np.concatenate(part) % np.uint64(ODD_BITS)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(part) * ODD_BITS) & 1).astype(np.uint8).reshape(len(part), ODD_BITS)
        out[i : i + 256] = np.packbits(odd, axis=1).view(np.int64)
    return out


def _sign(k: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            sets = list(shingle_sets(batch.column(1), k))
            signatures = superminhash(sets)
            digest = [hashlib.blake2b(x, digest_size=16).digest() for x in normalised(batch.column(1))]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(band_keys(signatures).view(np.int64).reshape(-1)))
            words = ODD_BITS // 64
            odd = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * words, words, dtype=np.int32)), pa.array(odd_sketches(sets).reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), odd, bands], ["id", "n", "digest", "odd", "bands"])

    return run


def _verify(k: int, num: int, den: int):
    """Keeps the pairs whose sets have the similarity, compared word by word; the second text is held while it stays the same."""

    def run(batches):
        import pyarrow as pa

        sets = WordSets(k)
        held: tuple = (None, None, None)
        for batch in batches:
            keep = []
            hubs = batch.column(1).to_pylist()
            new = pa.array([i for i, x in enumerate(hubs) if i == 0 or x != hubs[i - 1]], pa.int64())
            fresh = dict(zip(new.to_pylist(), normalised(batch.column(3).take(new))))
            for i, left in enumerate(normalised(batch.column(2))):
                sets.renew()
                if i in fresh:
                    held = (None, fresh[i], None)
                if held[0] != sets.epoch:
                    held = (sets.epoch, held[1], sets.of(held[1]))
                left, right = sets.of(left), held[2]
                both = len(left & right)
                if left and den * both >= num * (len(left) + len(right) - both):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    return run


def single_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with each id_key() once; of rows that share an id, the least text stays, null being empty."""
    texts = docs.select(id_key(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    repeated = written(texts.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "repeated")
    if repeated.isEmpty():
        return texts
    least = texts.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return written(texts.join(repeated, "id", "left_anti").unionByName(least), "single")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """(id, n_shingles, component_id) for each distinct id of docs; component_id is the smallest id reachable by links."""
    texts = single_texts(docs, id_col, text_col)
    signed = written(texts.mapInArrow(_sign(k), "id long, n long, digest binary, odd array<long>, bands array<long>"), "signatures")

    # Equal sequences of words are one class, named by its smallest id.
    classes = written(signed.filter("n > 0").groupBy("digest").agg(F.min("id").alias("class")), "classes")
    narrow = written(join_groups(signed.filter("n > 0").select("id", "n", "digest"), classes, "digest").select("id", "class", "n"), "narrow")
    firsts = signed.join(classes.select(F.col("class").alias("id")), "id", "left_semi")
    heads = written(firsts.select("id", F.explode(F.array_distinct("bands")).alias("band")), "bands")
    meta = written(firsts.select("id", "n", "odd"), "meta")

    mixed = [0x5DEECE66D, 0x2545F4914F6CDD1D]
    hubs = [F.min("id"), *(F.min(F.col("id").bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)) for m in mixed)]
    buckets = heads.groupBy("band").agg(F.count("*").alias("members"), F.array(*hubs).alias("hubs")).filter("members > 1").select("band", "hubs")
    shared = written(heads.join(buckets, "band"), "shared")
    offered = shared.select("id", F.explode(F.array_distinct("hubs")).alias("hub")).filter("id <> hub")
    first = written(_plausible(offered.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), meta, num, den), "pairs")

    asked = written(first.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "asked")
    links = written(_linked(first, texts, asked, k, num, den), "links")
    labels = written(components(links), "components")

    late = written(_apart(shared, labels, meta, num, den).join(first, ["a", "b"], "left_anti"), "late")
    if not late.isEmpty():
        more = written(_linked(late, texts, written(late.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "asked"), k, num, den), "links")
        if not more.isEmpty():
            labels = written(components(links.unionByName(more)), "components")

    found = narrow.join(labels.select(F.col("node").alias("class"), "label"), "class", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("label", "class").alias("component_id"))
    empty = signed.filter("n = 0").select("id", F.lit(0).cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    return found.unionByName(empty)


def _apart(shared: DataFrame, labels: DataFrame, meta: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a, b) that share a bucket but no component and may be linked: all but a bucket's largest component against the whole bucket.

    Sets at the similarity have sizes whose logarithms to the base den / num differ by at most one, so that a member meets
    its own class of sizes and the two beside it; of each class, the members are dealt into pieces of about PIECE.
    """
    placed = shared.select("band", "id").join(labels.select(F.col("node").alias("id"), "label"), "id", "left").select("band", "id", F.coalesce("label", "id").alias("label"))
    per_label = placed.groupBy("band", "label").agg(F.count("*").alias("members"))
    apart = per_label.groupBy("band").agg(F.count("*").alias("labels"), F.max(F.struct("members", "label"))["label"].alias("core")).filter("labels > 1").select("band", "core")
    size_class = F.floor(F.log("n") / math.log(den / num)).cast("int")
    open_ = written(placed.join(apart, "band").join(meta, "id").withColumn("class", size_class), "apart")
    pieces = open_.groupBy("band", "class").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    y = open_.join(pieces, ["band", "class"]).withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")).withColumn("is_core", F.expr("label = core"))
    x = open_.filter("label <> core").withColumn("class", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1))).join(pieces, ["band", "class"])
    x = x.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select("band", "class", "piece", *(F.col(c).alias(f"x_{c}") for c in ("id", "label", "n", "odd")))
    close = (F.col("x_label") != F.col("label")) & (F.col("is_core") | (F.col("x_id") < F.col("id"))) & _may_link("x_", "", num, den)
    return x.join(y, ["band", "class", "piece"]).filter(close).select(F.least("x_id", "id").alias("a"), F.greatest("x_id", "id").alias("b")).distinct()


def _may_link(a: str, b: str, num: int, den: int):
    """Whether sizes and odd sketches of two sets, whose columns begin with a and b, allow the similarity."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    odd = [F.bit_count(F.col(f"{a}odd")[i].bitwiseXOR(F.col(f"{b}odd")[i])) for i in range(ODD_BITS // 64)]
    # At the similarity num / den, the sets have (n + m) * (den - num) / (den + num) elements apart.
    sizes = F.least(n, m) * den >= F.greatest(n, m) * num
    return sizes & (sum(odd[1:], odd[0]) * (den + num) <= (n + m) * (den - num))


def _plausible(pairs: DataFrame, meta: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose set sizes and sketches allow the similarity."""
    a = meta.select(*(F.col(c).alias(f"a_{c}") for c in ("id", "n", "odd")))
    b = meta.select(*(F.col(c).alias(f"b_{c}") for c in ("id", "n", "odd")))
    both = pairs.join(a, F.col("a") == F.col("a_id")).join(b, F.col("b") == F.col("b_id"))
    return both.filter(_may_link("a_", "b_", num, den)).select("a", "b")


def _linked(pairs: DataFrame, texts: DataFrame, asked: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity; texts travel to the pairs, and a pair's two texts meet in its task."""
    wanted = written(texts.join(asked, "id", "left_semi"), "texts")
    a = wanted.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    b = wanted.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    return pairs.join(b, "b").join(a, "a").select("b", "a", "b_text", "a_text").mapInArrow(_verify(k, num, den), "b long, a long").select("a", "b")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """near_groups() with the ids as the table has them and kept: whether the row is the smallest id of its group."""
    found = near_groups(docs, id_col, text_col, k, num, den)
    return found.select(id_back("id").alias("doc_id"), "n_shingles", id_back("component_id").alias("component_id"), (F.col("id") == F.col("component_id")).alias("kept"))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that come first, by id, of their groups, with the columns of docs."""
    rows = keyed(docs, id_col, text_col)
    stay = near_groups(rows, "key", "text").filter("id = component_id").select(F.col("id").alias("key"))
    return among(rows.select("key", "row"), written(stay, "stay"), "key").select("row.*")
