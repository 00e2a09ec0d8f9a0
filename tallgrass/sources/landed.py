"""Readers of landed files: fixed-width masters, dated folders, filing windows, strict and lenient JSON."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed_width(lines: DataFrame, widths: dict[str, int], column: str = "value") -> DataFrame:
    """Lines cut by widths, in order, trimmed; lines shorter than all widths together are left out."""
    out, at = [], 1
    for name, width in widths.items():
        out.append(F.trim(F.substring(column, at, width)).alias(name))
        at += width
    return lines.filter(F.length(column) >= at - 1).select(*out)


def fixed_tail(lines: DataFrame, head: dict[str, int], middle: str, tail: dict[str, int], column: str = "value") -> DataFrame:
    """Lines whose middle field takes what fixed-width heads and tails leave over."""
    front, back = sum(head.values()), sum(tail.values())
    ok = lines.filter(F.length(column) >= front + back)
    body = F.length(column) - front - back
    out, at = [], 1
    for name, width in head.items():
        out.append(F.trim(F.substring(column, at, width)).alias(name))
        at += width
    out.append(F.trim(F.substring(F.col(column), F.lit(at), body)).alias(middle))
    gone = 0
    for name, width in tail.items():
        out.append(F.trim(F.substring(F.col(column), F.lit(at + gone) + body, F.lit(width))).alias(name))
        gone += width
    return ok.select(*out)


def text_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files in an encoding. Spark reads UTF-8; lines of other encodings are read byte for byte, by a separator that never occurs, and decoded in batches."""
    if encoding.upper() == "UTF-8":
        return spark.read.text(path)
    lines = _bytewise(spark.read).schema("value string").csv(path)
    return lines.select(F.pandas_udf(lambda x: x.map(lambda t: t.encode("latin-1").decode(encoding), na_action="ignore"), "string", F.PandasUDFType.SCALAR)("value").alias("value"))


def write_lines(lines: DataFrame, path: str, encoding: str) -> None:
    """Lines (value) as text files in an encoding of Python's."""
    coded = F.pandas_udf(lambda x: x.map(lambda t: t.encode(encoding).decode("latin-1"), na_action="ignore"), "string", F.PandasUDFType.SCALAR)
    _bytewise(lines.select(coded("value").alias("value")).write.mode("overwrite")).csv(path)


def _bytewise(io):
    return io.option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "").option("escape", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def newest_folder(spark: SparkSession, root: str, required: tuple[str, ...] = ()) -> str | None:
    """The newest folder YYYYMMDD below root that holds all required files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []
    for name in sorted((n for n in names if re.fullmatch(r"\d{8}", n)), reverse=True):
        if all(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{r}")) for r in required):
            return f"{root}/{name}"
    return None


def strict_json(column: Column, schema: str) -> Column:
    """JSON by schema; a row that can't be read stops the job."""
    return F.from_json(column, schema, {"mode": "FAILFAST"})


def paged_rows(pages: DataFrame, key: list[str], page: str) -> DataFrame:
    """Rows of overlapping pages, newest page first: of repeated keys the row of the smallest page stays."""
    from tallgrass.operators.merge import first_by

    return first_by(pages, key, F.col(page).asc())


def collectible(kind: Column, preferred: Column, spac: Column) -> Column:
    """Common stock that is neither preferred nor a blank-cheque company."""
    return (kind == "ST") & ~F.coalesce(preferred, F.lit(False)) & ~F.coalesce(spac, F.lit(False))


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder for landed files below the shared folder; a local session without one gets its own."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        shared = tempfile.mkdtemp(prefix="landed-")
    return f"{shared.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def settled(df: DataFrame, tag: str = "settled") -> DataFrame:
    """df as a table below the shared folder: its lineage ends here, and a lost executor costs no more than a reread."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stock_master(lines: DataFrame, column: str, tail: dict[str, int]) -> DataFrame:
    """Rows of a master file: nine characters of code, twelve of standard code, a name, and fields of fixed widths at the end, kept as a map as well.

    Rows shorter than the fields and codes, or without code or name, stop the job. Shares are in thousands; a flag is Y.
    """
    width = sum(tail.values())
    row = F.rtrim(F.col(column)) if not tail else F.col(column)
    x = lines.filter(F.trim(F.col(column)) != "").select(row.alias("line"), (F.length(row) - width).alias("at"))
    x = x.withColumn("line", F.when(F.col("at") >= 21, F.col("line")).otherwise(F.raise_error(F.concat(F.lit("a master row is too short: "), F.length("line").cast("string")))))
    fields, gone = {}, 0
    for name, n in tail.items():
        fields[name] = F.substring(F.col("line"), F.col("at") + 1 + gone, F.lit(n))
        gone += n
    ticker = F.trim(F.substring("line", 1, 9))
    out = [F.when(F.length(ticker) < 6, F.lpad(ticker, 6, "0")).otherwise(ticker).alias("ticker"), F.trim(F.substring("line", 10, 12)).alias("standard_code"), F.trim(F.substring(F.col("line"), F.lit(22), F.col("at") - 21)).alias("name")]
    raw = F.create_map(*(y for name, value in fields.items() for y in (F.lit(name), value)))
    x = x.select(*out, raw.alias("raw"))
    sound = (F.col("ticker") != "") & (F.col("standard_code") != "") & (F.col("name") != "")
    x = x.withColumn("name", F.when(sound, F.col("name")).otherwise(F.raise_error(F.lit("a master row lacks code or name"))))
    return x.select("ticker", "standard_code", "name", F.nullif(F.upper(F.trim(F.col("raw")["group"])), F.lit("")).alias("group"), (F.trim(F.col("raw")["suspended"]) == "Y").alias("suspended"), (F.col("raw")["shares"].try_cast("long") * 1000).alias("listed_shares"), "raw")
