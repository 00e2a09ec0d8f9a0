"""Structured Streaming forms of the incremental paths; each gives on a finished input what the batch form gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.operators import merge


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of a landed table's files; times without zone become timestamps, which watermarks need."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}*.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def weekly(ticks: DataFrame, delay: str = "7 days") -> DataFrame:
    """Weeks from Monday of ticks (id, ts, value), kept open until the delay has passed."""
    w = F.window("ts", "7 days", startTime="4 days")
    x = ticks.withWatermark("ts", delay).groupBy("id", w.alias("w")).agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.count("*").alias("volume"))
    return x.select("id", F.col("w.start").cast("date").alias("base_date"), "open", "high", "low", "close", "volume")


def sessions(ticks: DataFrame, gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    """Runs of an entity's ticks with less than the gap between them."""
    x = ticks.withWatermark("ts", delay).groupBy("id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("ticks"), F.sum("value").alias("total"))
    return x.select("id", F.col("s.start").alias("start"), "ticks", "total")


def drained(stream: DataFrame, mode: str, checkpoint: str) -> DataFrame:
    """What a stream with complete output yields on all input there is: each batch replaces a table below the checkpoint folder, and no rows come to the driver."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{checkpoint}/out/version={number:012d}")

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{checkpoint}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    found = _complete(spark, f"{checkpoint}/out")
    return spark.read.schema(stream.schema).parquet(found[max(found)]) if found else spark.createDataFrame([], stream.schema)


#: Parts of an upserted table; a batch rewrites those that its keys fall into.
PARTS = 64


def upserting(path: str, keys: list[str], policy: dict[str, str], parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that merges each batch into a table below path; a batch that comes again changes nothing.

    Keys are dealt to parts. A batch's folder holds only the parts that it touched, each as a whole; readers take
    the newest of each part. Versions of a part that two later batches have replaced are removed.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).alias("part")
        rows = merge.last_wins(batch, keys, F.struct(*batch.columns))
        touched = {str(r["part"]) for r in rows.select(part).distinct().collect()}  # numbers of parts
        stored = _parts(spark, path, number)
        old = [versions[-1] for p, versions in stored.items() if p in touched]
        merged = merge.upsert(spark.read.schema(batch.schema).parquet(*old), rows, keys, policy) if old else rows
        merged.withColumn("part", part).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/version={number:012d}")
        for p in touched & set(stored):
            for gone in stored[p][:-1]:
                _path, fs = _file_system(spark, gone)
                fs.delete(_path, True)

    return write


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[str]:
    p, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _complete(spark: SparkSession, path: str, before: int | None = None) -> dict[int, str]:
    """The folders of complete versions, by number."""
    names = [n for n in _listed(spark, path) if n.startswith("version=") and "_SUCCESS" in _listed(spark, f"{path}/{n}")]
    return {int(n[8:]): f"{path}/{n}" for n in names if before is None or int(n[8:]) < before}


def _parts(spark: SparkSession, path: str, before: int | None = None) -> dict[str, list[str]]:
    """The folders of each part, oldest first."""
    out: dict[str, list[str]] = {}
    for _, folder in sorted(_complete(spark, path, before).items()):
        for name in _listed(spark, folder):
            if name.startswith("part="):
                out.setdefault(name[5:], []).append(f"{folder}/{name}")
    return out


def newest_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that upserting() has written: the newest folder of each part."""
    newest = [versions[-1] for versions in _parts(spark, path).values()]
    return spark.read.parquet(*newest) if newest else None
