"""Token counts through a cache that is keyed by content and tokenizer version.

A text's key is the SHA-256 of its content, null normalised to the empty text; the tokenizer's is the digest of its file.
Digests without a stored count are found first, on narrow rows; then their texts travel, once each from every task, are encoded
once each, and their counts are appended to the cache, a Parquet folder that later calls may share. Rows find their counts through their
digests; frequent digests are dealt to many tasks, so a group of copies of any size is spread.

Repeated rows give a row each. Null text is the empty text. Very long texts are encoded whole. An empty table gives no rows.
Columns besides id and text are not read. A null id stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import join_groups, new_folder, quoted, written
from tallgrass.llm.vocabulary import BYTE_BPE, counter, version, vocabulary_path

#: Digests that a task remembers while it drops copies; beyond, it forgets them all and copies may travel again.
REMEMBERED = 500_000


def _first_seen(batches):
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for i, digest in enumerate(batch.column(0).to_pylist()):
            if digest not in seen:
                seen.add(digest)
                keep.append(i)
        if len(seen) > REMEMBERED:
            seen.clear()
        yield batch.take(keep) if len(keep) < batch.num_rows else batch


def _count(path: str):
    def run(batches):
        import pyarrow as pa

        count = counter(path)
        done: set[bytes] = set()
        for batch in batches:
            digests = batch.column(0).to_pylist()
            keep = []
            for i, digest in enumerate(digests):
                if digest not in done:
                    done.add(digest)
                    keep.append(i)
            for at in range(0, len(keep), 256):
                part = keep[at : at + 256]
                texts = batch.column(1).take(pa.array(part)).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in part], pa.binary()), pa.array(count(texts), pa.int64())], ["digest", "n_tokens"])

    return run


def token_counts(docs: DataFrame, cache: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs; cache is the folder of the cache, vocabulary a file's path on every machine."""
    spark = docs.sparkSession
    tokenizer = version(vocabulary)
    text = F.coalesce(quoted(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    folder = f"{cache}/tokenizer={tokenizer}"
    schema = "digest binary, n_tokens long"
    rows = written(docs.select(quoted(id_col).alias("doc_id"), digest, F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    texts = docs.select(digest, text.alias("text")).mapInArrow(_first_seen, "digest binary, text string")
    if _exists(spark, folder):
        known = spark.read.schema(schema).parquet(folder).select("digest")
        texts = texts.join(rows.select("digest").distinct().join(known, "digest", "left_anti"), "digest", "left_semi")
    else:
        texts = texts.repartition("digest")
    texts.mapInArrow(_count(vocabulary), schema).write.mode("append").parquet(folder)
    stored = spark.read.schema(schema).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return join_groups(rows, stored, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _exists(spark, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents from a cache that starts empty."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), new_folder(spark, "token-cache"), vocabulary_path(BYTE_BPE))
