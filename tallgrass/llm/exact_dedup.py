"""Exact duplicates by Grace hash partitioning and open-addressing tables that compare complete contents.

Texts are equal when identical after each run of white space becomes one space. Each task first folds its own copies, so that
a group of any size sends one record a task; then records are dealt by digest, and each task partitions its share to spill
files, again and again with other bits of the digest, until a bucket's distinct contents fit the table's budget. Tasks grow
in number with the bytes of text, so that few shares need spill files, which would take the disk of all texts once more.

Members find their group through its digest; frequent digests are dealt to many tasks, so a group of copies of any size is
spread. Contents whose digests are equal and that differ would stay apart in the table.

Null text counts as empty text, and all empty texts are equal. Rows that repeat an id with the same text are one document:
they give one row, while group_size counts every row. All null ids are one id, which sorts after all others. Very long texts are
records like others; one that exceeds the budget is held alone. An empty table gives no rows. Other columns are not read.
drop_copies() keeps one row of each group, the first by id, with the columns of its input, whatever their names.
"""

from __future__ import annotations

import pickle
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import among, id_back, id_key, join_groups, keyed, quoted, written

#: Bytes of distinct contents that a table holds, and of texts for each task that groups them: with both, only what hashes unevenly goes to spill files.
BUDGET, SHARE = 48 << 20, 16 << 20
_WAYS = 16


class Table:
    """Open addressing with linear probing. An entry is [digest, content, least id, rows]; contents are compared in full."""

    def __init__(self) -> None:
        self.slots: list = [None] * 1024
        self.used = 0
        self.bytes = 0

    def add(self, digest: bytes, content: str, least: int, rows: int) -> None:
        mask = len(self.slots) - 1
        i = int.from_bytes(digest[:8], "little") & mask
        while (entry := self.slots[i]) is not None:
            if entry[0] == digest and entry[1] == content:
                entry[2] = min(entry[2], least)
                entry[3] += rows
                return
            i = (i + 1) & mask
        self.slots[i] = [digest, content, least, rows]
        self.used += 1
        self.bytes += len(content) + 200
        if 3 * self.used > 2 * len(self.slots):
            held = [x for x in self.slots if x is not None]
            self.slots, mask = [None] * (2 * len(self.slots)), 2 * len(self.slots) - 1
            for entry in held:
                i = int.from_bytes(entry[0][:8], "little") & mask
                while self.slots[i] is not None:
                    i = (i + 1) & mask
                self.slots[i] = entry

    def entries(self):
        return (x for x in self.slots if x is not None)


def grace(records, budget: int = BUDGET, level: int = 0):
    """The distinct entries of records (digest, content, least id, rows), each once."""
    table = Table()
    records = iter(records)
    for record in records:
        table.add(*record)
        if table.bytes > budget and table.used > 1 and level < 48:
            break
    else:
        yield from table.entries()
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files = [open(f"{folder}/{i}", "wb") for i in range(_WAYS)]  # noqa: SIM115
        nibble = lambda d: d[8 + level // 2] >> 4 * (level % 2) & 15
        for source in (table.entries(), records):
            for record in source:
                pickle.dump(tuple(record), files[nibble(record[0])], protocol=5)
        del table
        for f in files:
            f.close()
        for i in range(_WAYS):
            yield from grace(_spilled(f"{folder}/{i}"), budget, level + 1)


def _spilled(path: str):
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _batches(entries, most: int = 4 << 20):
    import pyarrow as pa

    part: list = []
    size = 0
    for entry in entries:
        part.append(entry)
        size += len(entry[1]) + 64
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part), (pa.binary(), pa.string(), pa.int64(), pa.int64()))], ["digest", "content", "id", "rows"])
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part), (pa.binary(), pa.string(), pa.int64(), pa.int64()))], ["digest", "content", "id", "rows"])


def _rows(batch):
    return zip(*(batch.column(i).to_pylist() for i in range(4)))


def _fold(batches):
    """Copies within a task become one record; a full table is sent on and begun anew."""
    table = Table()
    for batch in batches:
        for record in _rows(batch):
            table.add(*record)
        if table.bytes > BUDGET:
            yield from _batches(table.entries())
            table = Table()
    yield from _batches(table.entries())


def _grace(batches):
    import pyarrow as pa

    for batch in _batches(grace(record for batch in batches for record in _rows(batch))):
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3)], ["digest", "keep", "group_size"])


def normalised(text_col: str):
    return F.regexp_replace(F.coalesce(quoted(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, keep, group_size) for each distinct normalised text of docs; keep is an id_key()."""
    content = normalised(text_col)
    records = docs.select(F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content"), id_key(id_col).alias("id"), F.lit(1).cast("long").alias("rows"))
    schema = "digest binary, content string, id long, rows long"
    size = docs.agg(F.sum(F.octet_length(quoted(text_col)).cast("long"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // SHARE))
    return records.mapInArrow(_fold, schema).repartition(parts, "digest").mapInArrow(_grace, "digest binary, keep long, group_size long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each document."""
    groups = written(exact_groups(docs, id_col, text_col), "groups")
    members = docs.select(id_key(id_col).alias("id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("digest")).groupBy("id", "digest").agg(F.count("*").alias("copies"))
    found = join_groups(written(members.select("id", "digest"), "members"), groups, "digest")
    return found.select(id_back("id").alias("doc_id"), id_back("keep").alias("keep_id"), "group_size", (F.col("id") == F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, the first of each distinct normalised text, with the columns of docs."""
    rows = keyed(docs, id_col, text_col)
    stay = exact_groups(rows, "key", "text").select(F.col("keep").alias("key"))
    return among(rows.select("key", "row"), written(stay, "stay"), "key").select("row.*")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Exact-duplicate groups of all documents."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
