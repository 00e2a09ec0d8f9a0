"""Exact top-k by inner product: candidates in order of length, SVD-rotated partial sums and Cauchy-Schwarz bounds.

Components are scaled and floored to integers. All vectors are rotated by the singular vectors of the table's directions, from
the Gram matrix of its first ROTATED components, so that the leading dimensions hold most of every length. Candidates are
written below the shared folder in falling order of length, in files of blocks. Each task takes a group of queries and
streams the blocks past it: the product of the leading dimensions plus the product of the residual lengths bounds each
score, only pairs whose bound reaches the query's k-th best score so far are scored in full, on the integers, and that
score rises with every block. The task ends when the length of what follows can't reach any query's k-th best score. It returns k rows a query;
no block of candidates is shuffled.

Vectors that are null or hold null or non-finite components take no part, nor do rows without id. Rows that share an id are
one vector, the least of theirs. Shorter vectors count as padded with zeros, and vectors of any length may stand together.
Scores are exact whatever the size of components; one outside 64 bits is returned as the nearest 64-bit number, in its exact place in the
order. Ties go to the smaller id. A query never meets its own id. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import new_folder, open_shared, quoted, written

SCALE, TOP, EVERY = 64, 20, 20
#: Rows and bytes of a block, and blocks of a file.
ROWS, BYTES, BLOCKS = 8192, 4 << 20, 16
#: Queries of a group, at least and at most.
GROUP = (128, 4096)
#: Components that are rotated; what a vector has beyond them counts to its residual.
ROTATED = 1024
#: Leading dimensions whose product is taken before the residual bound.
LEADING = 16
#: Components up to this size have products that add up exactly in doubles.
SMALL = 2.0**20
MOST = 2**63 - 1


def whole(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), exactly."""
    return int(x) * scale if abs(x) >= 2**53 else math.floor(scale * x)


def length(v: np.ndarray) -> float:
    """The Euclidean length, which only a sum beyond all doubles makes infinite."""
    most = np.abs(v).max(initial=0)
    with np.errstate(over="ignore"):
        return float(most * np.sqrt(((v / most) ** 2).sum())) if 0 < most < np.inf else float(most)


def _measure(scale: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [np.asarray(v, dtype=np.float64) for v in batch.column(1).to_pylist()]
            lengths = []
            for v in rows:
                with np.errstate(over="ignore"):
                    big = np.abs(v).max(initial=0) >= 2**53
                    lengths.append(length(v * scale if big else np.floor(scale * v)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(lengths, pa.float64())], ["id", "v", "norm"])

    return run


class Vectors:
    """Rows of one number of components: ids, values, lengths, directions' leading dimensions, residuals, and exact integers on demand."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, norms: np.ndarray, turn: np.ndarray, scale: int) -> None:
        self.ids, self.norms, self.scale, self.raw = ids, norms, scale, values
        with np.errstate(over="ignore", invalid="ignore"):
            self.floors = np.where(np.abs(values) < 2**53, np.floor(scale * values), scale * values)
        self.small = np.abs(self.floors).max(initial=0) <= SMALL
        unit = self.floors if np.isfinite(self.floors).all() else values  # lengths and directions only bound
        unit = unit / np.maximum(np.abs(unit).max(axis=1, initial=0), 1e-300)[:, None]
        self.unit = unit = unit / np.maximum(np.sqrt((unit * unit).sum(axis=1)), 1e-300)[:, None]
        d = min(values.shape[1], len(turn))
        self.lead = unit[:, :d] @ turn[:d, :LEADING]
        self.rest = np.sqrt(np.maximum(0, (unit * unit).sum(axis=1) - (self.lead * self.lead).sum(axis=1)))

    def row(self, i: int) -> list[int]:
        return [whole(x, self.scale) for x in self.raw[i].tolist()]


def by_kind(ids: list[int], rows: list[np.ndarray], norms: list[float], turn: np.ndarray, scale: int = SCALE) -> list[Vectors]:
    """Vectors of the rows, those of one number of components and one class of sizes together."""
    kinds: dict[tuple, list[int]] = {}
    for i, r in enumerate(rows):
        kinds.setdefault((len(r), bool(np.abs(r).max(initial=0) * scale + 1 <= SMALL)), []).append(i)
    out = []
    for (d, _), at in kinds.items():
        out.append(Vectors(np.array([ids[i] for i in at], np.int64), np.stack([rows[i] for i in at]).reshape(len(at), d), np.array([norms[i] for i in at]), turn, scale))
    return out


class Best:
    """The k best (score, id) of each query so far, and the score that another must reach."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.rows = k, [[] for _ in range(n)]
        self.floor = np.full(n, -np.inf)

    def add(self, i: int, scores: list[int], ids: list[int]) -> None:
        rows = self.rows[i] + list(zip([-s for s in scores], ids))
        rows.sort()
        self.rows[i] = rows[: self.k]
        if len(rows) >= self.k:
            least = -self.rows[i][-1][0]
            try:
                self.floor[i] = np.nextafter(float(least), -np.inf) if abs(least) > 2**53 else float(least)
            except OverflowError:
                self.floor[i] = -np.inf if least < 0 else np.finfo(float).max


def meet(q: Vectors, c: Vectors, best: Best, first: int = 0) -> int:
    """Takes the candidates that reach the queries' floors into best, whose queries begin at first; returns how many scores were computed in full."""
    d, k, computed = min(q.unit.shape[1], c.unit.shape[1]), best.k, 0
    for at in range(0, len(q.ids), 128):
        part = slice(at, at + 128)
        floor = best.floor[first + at : first + at + len(q.ids[part]), None]
        with np.errstate(over="ignore", invalid="ignore"):
            room = q.norms[part, None] * c.norms[None, :]
            bound = room * (q.lead[part] @ c.lead.T + q.rest[part, None] * c.rest[None, :] + 1e-9)
        open_ = ~(bound < floor) | np.isinf(room)
        columns = np.flatnonzero(open_.any(axis=0))
        if not len(columns):
            continue
        small = q.small and c.small and d <= 8192
        if small:
            scores = q.floors[part, :d] @ c.floors[columns, :d].T
        else:  # near enough to leave out what can't reach the floor
            with np.errstate(over="ignore", invalid="ignore"):
                scores = room[:, columns] * (q.unit[part, :d] @ c.unit[columns, :d].T)
                error = room[:, columns] * 1e-9
        ids = c.ids[columns]
        for i in range(scores.shape[0]):
            low, mine = best.floor[first + at + i], q.ids[at + i]
            if small:
                here = np.flatnonzero(open_[i, columns] & (ids != mine) & (scores[i] >= low))
                computed += len(columns)
                if len(here) > k:  # the k best, and all that tie with the last of them
                    kth = np.partition(scores[i, here], len(here) - k)[len(here) - k]
                    here = here[scores[i, here] >= kth]
                    here = here[np.lexsort((ids[here], -scores[i, here]))[:k]]
                if len(here):
                    best.add(first + at + i, [int(x) for x in scores[i, here]], ids[here].tolist())
            else:
                with np.errstate(invalid="ignore"):
                    top, under = scores[i] + error[i], scores[i] - error[i]
                    here = np.flatnonzero(open_[i, columns] & (ids != mine) & ~(top < low))
                    sure = under[here][np.isfinite(under[here])]
                    if len(sure) > k:
                        here = here[~(top[here] < np.partition(sure, len(sure) - k)[len(sure) - k])]
                row = q.row(at + i)
                for j in here.tolist():
                    computed += 1
                    score = sum(x * y for x, y in zip(row, c.row(int(columns[j]))))
                    best.add(first + at + i, [score], [int(ids[j])])
    return computed


def _write(folder: str):
    """The rows of a task, in its order, as files of blocks; a block is its ids, lengths, numbers of components, and components."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        made: list[tuple] = []  # path, place, rows, longest
        held: list[tuple] = []
        out = path = None
        place = size = 0

        def close_block():
            nonlocal out, path, place, size
            if out is None:
                path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):06d}"
                out, place = open_shared(path, "w"), 0
            data = b"".join([np.array([h[0] for h in held], np.int64).tobytes(), np.array([h[2] for h in held]).tobytes(), np.array([len(h[1]) // 8 for h in held], np.int64).tobytes(), *(h[1] for h in held)])
            out.write(data)
            made.append((path, place, len(data), len(held), max(h[2] for h in held)))
            place += len(data)
            held.clear()
            size = 0
            if len(made) % BLOCKS == 0:
                out.close()
                out = None

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held.append(row)
                size += len(row[1]) + 24
                if len(held) >= ROWS or size >= BYTES:
                    close_block()
        if held:
            close_block()
        if out is not None:
            out.close()
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(types)], ["path", "place", "bytes", "n", "norm"])

    return run


def _read(path: str, place: int, size: int, n: int) -> tuple[list[int], list[np.ndarray], list[float]]:
    with open_shared(path, "r") as file:
        file.seek(place)
        data = file.read(size)
    ids, norms, sizes = (np.frombuffer(data, dtype, n, 8 * n * i) for i, dtype in enumerate((np.int64, np.float64, np.int64)))
    flat = np.frombuffer(data, np.float64, offset=24 * n)
    return ids.tolist(), np.split(flat, np.cumsum(sizes)[:-1]), norms.tolist()


def _blocks(manifest: str) -> list[tuple]:
    """(path, place, bytes, n, norm) of all blocks, the longest first."""
    from pyarrow import dataset, fs

    system, inner = fs.FileSystem.from_uri(manifest if "://" in manifest else f"file://{manifest}")
    table = dataset.dataset(inner, filesystem=system, format="parquet").to_table(columns=["path", "place", "bytes", "n", "norm"])
    rows = list(zip(*(table.column(c).to_pylist() for c in ("path", "place", "bytes", "n", "norm"))))
    return sorted(rows, key=lambda r: (-r[4], r[0], r[1]))


def _search(manifest: str, turn: np.ndarray, k: int, scale: int):
    """A task's queries meet the blocks of the manifest in falling order of length."""

    def run(batches):
        import pyarrow as pa

        ids, rows, norms = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += [np.frombuffer(x, np.float64) for x in batch.column(1).to_pylist()]
            norms += batch.column(2).to_pylist()
        if not ids:
            return
        groups = by_kind(ids, rows, norms, turn, scale)
        firsts = np.cumsum([0, *(len(g.ids) for g in groups)])
        best = Best(len(ids), k)
        lengths = np.concatenate([g.norms for g in groups])
        for path, place, size, n, norm in _blocks(manifest):
            with np.errstate(over="ignore", invalid="ignore"):
                if (lengths * norm * (1 + 1e-9) + 1e-6 < best.floor).all():
                    break
            for c in by_kind(*_read(path, place, size, n), turn, scale):
                for g, first in zip(groups, firsts):
                    meet(g, c, best, int(first))
        found = [(int(q), rank, i, max(-MOST - 1, min(MOST, -s))) for q, rows_ in zip(np.concatenate([g.ids for g in groups]), best.rows) for rank, (s, i) in enumerate(rows_, 1)]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        for at in range(0, len(found), 20_000):
            part = found[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate(types)], ["query_id", "rank", "vec_id", "score"])

    return run


def _gram(d: int):
    def run(batches):
        import pyarrow as pa

        total = np.zeros((d, d))
        for batch in batches:
            m = np.zeros((batch.num_rows, d))
            for i, v in enumerate(batch.column(0).to_pylist()):
                x = np.frombuffer(v, np.float64)
                x = x / max(np.abs(x).max(initial=0), 1e-300)
                x = x / max(float(np.sqrt((x * x).sum())), 1e-300)
                m[i, : min(d, len(x))] = x[:d]
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(list(total), pa.list_(pa.float64()))], ["at", "row"])

    return run


def rotation(rows: DataFrame, d: int) -> np.ndarray:
    """The eigenvectors of the Gram matrix of all directions, the largest first; d rows of d numbers come to the driver, d being ROTATED at most."""
    sums = rows.select("v").mapInArrow(_gram(d), "at long, row array<double>").groupBy("at").agg(*(F.sum(F.col("row")[i]).alias(f"x{i}") for i in range(d)))
    gram = np.zeros((d, d))
    for r in sums.collect():
        gram[r["at"]] = r[1:]
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each vector for which the condition is_query on `id` holds."""
    spark = vectors.sparkSession
    v = F.transform(quoted(vector_col), lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(quoted(id_col).isNotNull() & quoted(vector_col).isNotNull()).select(quoted(id_col).cast("long").alias("id"), v.alias("v")).filter(F.coalesce(sound, F.lit(False)))
    repeated = written(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "repeated")
    if not repeated.isEmpty():
        rows = rows.join(repeated, "id", "left_anti").unionByName(rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v")))
    measured = written(rows.mapInArrow(_measure(scale), "id long, v binary, norm double"), "vectors")
    facts = measured.agg(F.max(F.octet_length("v")).alias("longest"), F.sum(F.octet_length("v")).alias("bytes"), F.count("*").alias("n")).first()
    asked = measured.filter(is_query)
    n_asked = asked.count()
    turn = rotation(measured, max(1, min(ROTATED, (facts["longest"] or 8) // 8)))

    folder = new_folder(spark, "candidates")
    order = (F.col("norm").desc(), F.col("id"))
    blocks, tasks = max(facts["n"] // ROWS, (facts["bytes"] or 0) // BYTES) + 1, spark.sparkContext.defaultParallelism
    parts = max(min(blocks, 2 * tasks), blocks // BLOCKS)
    written_blocks = measured.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_write(folder), "path string, place long, bytes long, n long, norm double")
    manifest = f"{folder}-manifest"
    written_blocks.write.parquet(manifest)
    groups = max(1, -(-n_asked // max(GROUP[0], min(GROUP[1], n_asked // (2 * tasks) + 1))))
    queries = asked.repartitionByRange(groups, *order).sortWithinPartitions(*order)
    return queries.mapInArrow(_search(manifest, turn, k, scale), "query_id long, rank int, vec_id long, score long")


def op6_top_k(spark, sf_dir: str) -> DataFrame:
    """The best candidates of every vector whose id is divisible by EVERY."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % EVERY == 0)
