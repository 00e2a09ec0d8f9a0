"""What the operators of this subpackage share: the shared folder, written tables that cut lineage, keys of rows, and hashing of words."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Internal ids stand in for a null id, so that null ids keep a place in the order: after all others.
NULL_ID = 2**63 - 1


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or else the checkpoint folder that the session was given.

    Where neither is set, a local session gets a folder of its own; a cluster, whose machines would not see it, raises.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tallgrass-"))
    return _own[0]


def new_folder(spark: SparkSession, tag: str) -> str:
    """The name of a folder of its own under the shared folder."""
    return f"{shared_dir(spark)}/tallgrass-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends here, and a lost executor costs no more than a reread."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_key(column: str = "doc_id"):
    """The id as a long without nulls."""
    return F.coalesce(quoted(column).cast("long"), F.lit(NULL_ID))


def id_back(column):
    """The id as the table has it, from id_key()."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != F.lit(NULL_ID), column)


def quoted(name: str):
    """The top-level column of this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, text, row): a key of its own for each row of docs, in the order of ids; text without nulls; row holds all columns.

    While ids don't repeat (null being one), the key is id_key() and nothing is written. Else rows are ordered by id and by the
    hash of their text, numbered and written. Since all columns travel inside row, none can clash with those of an operator.
    """
    packed = docs.select(id_key(id_col).alias("key"), quoted(id_col).cast("long").alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"), F.struct(*map(quoted, docs.columns)).alias("row"))
    if docs.groupBy(id_key(id_col).alias("key")).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return packed
    order = ("key", F.xxhash64("text"), "place")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = packed.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(ordered.drop("place").withColumn("key", F.monotonically_increasing_id()), "keyed")


def join_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """rows, a written table, joined with groups, which has one row for each value of key; no task sees all rows of a frequent value.

    Values with over 1 / 2048 of the rows, so 2048 at most, are broadcast with a number of pieces; their rows are dealt to the
    pieces by place, and their groups go to each piece.
    """
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count("*").alias("n")).filter((F.col("n") * 2048 > total) & (F.col("n") > 64))
    frequent = F.broadcast(written(counts.select(key, F.ceil(F.col("n") * 512 / total).cast("long").alias("pieces")), "frequent"))
    dealt = rows.join(frequent, key, "left").withColumn("piece", F.pmod(F.monotonically_increasing_id(), F.coalesce("pieces", F.lit(1)))).drop("pieces")
    spread = groups.join(frequent, key, "left").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("pieces", F.lit(1)) - 1))).drop("pieces")
    return dealt.join(spread, [key, "piece"]).drop("piece")


#: Bits for each id of a set that rows are filtered by, and for all of it; they change what is broadcast, not the result.
ID_BITS, MOST_BITS, ID_SEED = 32, 1 << 27, 13


def among(rows: DataFrame, ids: DataFrame, column: str, n: int | None = None, bits: int | None = None, cut=lambda df, tag: df) -> DataFrame:
    """The rows whose column, a long, is among ids, a table of n distinct values of the same column that is read twice; rows aren't shuffled.

    Ids are looked up by hash in a broadcast bitmap of bounded size, whose false hits, few, are found on the column alone and left out.
    cut is written() where the result is used more than once.
    """
    n, names = ids.count() if n is None else n, [quoted(c) for c in rows.columns]
    place = F.pmod(F.xxhash64(F.lit(ID_SEED), column), F.lit(min(MOST_BITS, 1 << ((ID_BITS if bits is None else bits) * n).bit_length())))
    its = {"bucket": F.shiftright(place, 15), "bit": place.bitwiseAND(F.lit((1 << 15) - 1)).cast("int")}
    maps = cut(ids.select(*(x.alias(c) for c, x in its.items())).groupBy("bucket").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("map")), "bitmap")
    hit = F.expr("getbit(cast(conv(hex(substring(map, bit div 8 + 1, 1)), 16, 10) as int), bit % 8) = 1")
    near = lambda x: x.filter(F.col(column).isNotNull()).withColumns(its).join(F.broadcast(maps), "bucket").filter(hit).select(x.columns)
    return near(rows).join(written(near(rows.select(column)).join(ids, column, "left_anti").distinct(), "false-hits"), column, "left_anti").select(*names)


def open_shared(path: str, mode: str):
    """A file below the shared folder, for reading from any place (r) or for writing (w)."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    if mode == "r":
        return system.open_input_file(inner)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


# Words are the runs of bytes other than space and \x09-\x0D; in UTF-8 no byte of a longer code point is one of these.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes hashed at once; larger texts are cut at white space, so that memory doesn't follow the longest text.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: What a byte at each of the first places of a word adds to the word's hash; later places are computed as they come.
_PLACES = 64
_ADDS = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each word in data, the UTF-8 bytes of texts that begin and end at offsets; no word crosses texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each word: the sum of a random number for each byte and its place in the word."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + PIECE, "right")))
        piece = data[at : ends[j - 1]]
        s, e = starts[i:j] - at, ends[i:j] - at
        begin = np.zeros(len(piece), dtype=np.int64)
        begin[s[1:]] = np.diff(s)
        place = np.arange(len(piece)) - np.cumsum(begin)
        place = (place << 8) | (LOWER[piece] if lower else piece)
        x = _ADDS[np.minimum(place, len(_ADDS) - 1)]
        late = np.flatnonzero(place >= len(_ADDS))
        if len(late):
            x[late] = mix((place[late].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(x, out=total[1:])
        out[i:j] = mix((total[e] - total[s]) ^ (e - s).astype(np.uint64))
        i = j
    return out


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its texts (one more than rows); a null is an empty text."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    return data, offsets


def pieces(offsets: np.ndarray, most: int = PIECE):
    """Ranges of rows whose texts have about `most` bytes together; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j
