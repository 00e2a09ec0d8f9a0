"""Substring duplicates: windows of WINDOW words that start earlier elsewhere, by super-k-mers.

Each window belongs to its minimiser, the MINIMISER-word group with the least hash in it, leftmost first. Consecutive windows
with one minimiser travel as one packed string to the bucket of its hash; equal windows have equal minimisers, so a bucket
holds all of them. There, windows are sorted by hash, equal hashes are confirmed on the words themselves, and all but the
first of each run of equal windows are reported. Documents then drop the words that reported windows cover.

A super-k-mer that a task meets again isn't sent: its later windows are reported on the spot. So a passage that very many
documents share costs a task one string. Strings of one task and bucket are compressed together.
Buckets are as many as the bytes of all texts ask for. One that is still larger than SPILL, as of a very frequent minimiser, is dealt window by
window, by their hashes, to files of the task, each of which is gone through once; a bucket below it is split in memory.

Null or empty text: no words, the digest of the empty text. Rows that share an id are documents of their own, in the order of
their texts' hashes, and equal rows come one after the other, so that all but the first lose what they repeat. All null ids come
after all others. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import keyed, mix, pieces, text_buffer, word_hashes, word_spans

WINDOW, MINIMISER = 20, 4
#: Bytes of text for each shuffle partition, and buckets in a partition; a bucket is sorted at once.
SHARE, FINENESS = 32 << 20, 16
#: Partitions at most; larger buckets spill.
MOST_PARTS = 100_000
#: Bytes of strings that a bucket holds in memory; beyond, its windows are dealt to files.
SPILL, FILES = 64 << 20, 64
#: Bytes of strings that a bucket sorts at once; larger buckets are split.
AT_ONCE = 16 << 20
#: Bytes of strings, with what Python adds to each, that a map task collects before it sends them.
COLLECT = 160 << 20
#: Of zstandard: strings are most of what travels.
LEVEL = 3
_ODD = np.random.default_rng(0x5EED).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sums(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * _ODD[i]
    return mix(out)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost least of each `width` consecutive values is."""
    n = len(x) - width + 1
    best, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(x[right] < x[left], right, left)
        have += step
    return best[:n]


def super_kmers(hashes: np.ndarray, bounds: np.ndarray, window: int = WINDOW, minimiser: int = MINIMISER):
    """(first window, windows, minimiser's hash) of each super-k-mer; hashes are the words' of texts that begin at bounds (one more than texts)."""
    small = _sums(hashes, minimiser)
    width = window - minimiser + 1
    if len(small) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = _least(small, width)
    n = len(at)
    text = np.searchsorted(bounds, np.arange(n), "right")
    whole = np.arange(n) + window <= bounds[np.minimum(text, len(bounds) - 1)]
    new = np.ones(n, dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    stops = np.flatnonzero(np.append(new | ~whole, True))
    count = stops[np.searchsorted(stops, first, "right")] - first
    return first, count, small[at[first]]


def _split(buckets: int):
    def run(batches):
        import pyarrow as pa
        import zstandard

        packer = zstandard.ZstdCompressor(level=LEVEL)
        sent: dict[bytes, tuple[int, int]] = {}  # where each string first occurred
        strings: list = []
        reports: list = []
        size = 0

        def flush():
            nonlocal size
            bucket = np.array([s[2] for s in strings], dtype=np.uint64) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else []
            for a, b in zip(edges, [*edges[1:], len(order)]):
                part = [strings[i] for i in order[a:b].tolist()]
                places = np.diff(np.array([s[0] for s in part], np.int64), prepend=0).tobytes() + np.array([s[1] for s in part], np.int64).tobytes()
                yield int(bucket[order[a]]), len(part), packer.compress(places + b"\n".join(s[3] for s in part))
            strings.clear()
            sent.clear()
            size = 0

        def packed(rows):
            held, bytes_ = [], 0
            for row in rows:
                held.append(row)
                bytes_ += len(row[2])
                if bytes_ > 2 << 20:
                    yield _rows_of(held)
                    held, bytes_ = [], 0
            yield _rows_of(held)
            if reports:
                ids, marks = _by_document(*(np.array(x, np.int64) for x in zip(*reports)))
                reports.clear()
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(-1 - ids % buckets, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(ids, pa.int64()), marks], ["bucket", "n", "blob", "id", "marks"])

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy()
            for i, j in pieces(offsets):
                lo = int(offsets[i])
                raw = data[lo : offsets[j]]
                starts, ends = word_spans(raw, offsets[i : j + 1] - lo)
                hashes = word_hashes(raw, starts, ends)
                bounds = np.searchsorted(starts, offsets[i : j + 1] - lo)
                first, count, key = super_kmers(hashes, bounds)
                text = np.searchsorted(bounds, first, "right") - 1
                begins = first - bounds[text]
                del raw
                view = data[lo : offsets[j]].tobytes()
                for doc, start, f, n, k, s, e in zip(ids[i + text].tolist(), begins.tolist(), first.tolist(), count.tolist(), key.tolist(), starts[first].tolist(), ends[first + count + WINDOW - 2].tolist()):
                    string = view[s:e]
                    if not string.isascii() or b"\n" in string or b"\t" in string or b"  " in string or b"\r" in string or b"\x0b" in string or b"\x0c" in string:
                        string = b" ".join(string.split())
                    seen = sent.get(string)
                    if seen is None:
                        sent[string] = (doc, start)
                        strings.append((doc, start, k, string))
                        size += len(string) + 250
                    elif seen <= (doc, start):
                        if seen < (doc, start):
                            reports.append((doc, start, n))
                    else:  # the earlier place travels as well, since the later one has been kept already
                        sent[string] = (doc, start)
                        strings.append((doc, start, k, string))
                        size += len(string) + 250
                if size > COLLECT:
                    yield from packed(flush())
        yield from packed(flush())

    return run


def _rows_of(part: list):
    import pyarrow as pa

    n = len(part)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], ["bucket", "n", "blob", "id", "marks"])


def _by_document(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray):
    """The distinct ids, and for each an Arrow list of start, count, start, count ... of windows."""
    import pyarrow as pa

    order = np.lexsort((starts, ids))
    ids, starts, counts = ids[order], starts[order], counts[order]
    edges = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
    flat = np.stack([starts, counts], axis=1).reshape(-1)
    return ids[edges], pa.ListArray.from_arrays(pa.array(np.append(edges, len(ids)).astype(np.int32) * 2), pa.array(flat))


def _words(strings: list[bytes]) -> tuple[np.ndarray, ...]:
    """Start and end of each word of all strings joined, where each string begins in them and its first word's number (one more than strings), and hashes of words."""
    raw = np.frombuffer(b"\n".join(strings), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(s) + 1 for s in strings])))
    offsets[-1] -= 1
    starts, ends = word_spans(raw, offsets)
    return starts, ends, offsets[:-1], np.searchsorted(starts, offsets), word_hashes(raw, starts, ends)


def _keys(strings: list[bytes], window: int, minimiser: int = MINIMISER) -> np.ndarray:
    """The hash of each super-k-mer's minimiser."""
    out = []
    for a, b in _runs(strings, AT_ONCE):
        *_, base, hashes = _words(strings[a:b])
        small = _sums(hashes, minimiser)
        width = window - minimiser + 1
        out.append(small[base[:-1, None] + np.arange(width)].min(axis=1))
    return np.concatenate(out)


def later_windows(doc: np.ndarray, start: np.ndarray, strings: list[bytes], window: int = WINDOW, at_once: int = AT_ONCE, keys: np.ndarray | None = None, level: int = 0):
    """(doc, start) of each window of the super-k-mers that equals one with a smaller (doc, start)."""
    total = sum(map(len, strings))
    if total > at_once and level < 8:
        keys = _keys(strings, window) if keys is None else keys
        part = (keys >> np.uint64(32 + 4 * level)) & np.uint64(15)
        for p in np.unique(part):
            at = np.flatnonzero(part == p)
            yield from later_windows(doc[at], start[at], [strings[i] for i in at.tolist()], window, at_once, keys[at], level + 1)
        return
    passes = max(1, -(-total // at_once))  # of one minimiser: each pass sorts the windows of some hashes
    for p in range(passes):
        held = []
        for a, b in _runs(strings, at_once):
            s, e, offsets, base, hashes = _words(strings[a:b])
            hashes = _sums(hashes, window)
            n = np.diff(base) - window + 1
            which = np.repeat(np.arange(b - a), n)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            word = base[which] + inner
            h = hashes[word]
            take = np.flatnonzero(h % np.uint64(passes) == p) if passes > 1 else slice(None)
            held.append((h[take], which[take] + a, inner[take], (s[word] - offsets[which])[take], (e[word + window - 1] - offsets[which])[take]))
        h, which, inner, begin, end = (np.concatenate(x) for x in zip(*held))
        d, at = doc[which], start[which] + inner
        order = np.argsort(h, kind="stable")
        twice = np.append(False, h[order][1:] == h[order][:-1])
        twice[:-1] |= twice[1:]
        order = order[twice]  # windows whose hash occurs once are done
        order = order[np.lexsort((at[order], d[order], h[order]))]
        h_, d_, at_ = h[order], d[order], at[order]
        same = np.append(False, h_[1:] == h_[:-1])[: len(order)]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        for i in np.flatnonzero(same).tolist():
            x, first = order[i], head[i]
            y = order[first]
            mine = strings[which[x]][begin[x] : end[x]]
            if mine != strings[which[y]][begin[y] : end[y]]:
                # Two sequences share a hash: look for the first place of this one.
                first = next(z for z in range(first, i + 1) if strings[which[order[z]]][begin[order[z]] : end[order[z]]] == mine)
            if (d_[first], at_[first]) < (d_[i], at_[i]):
                yield int(d_[i]), int(at_[i])


def _runs(strings: list[bytes], most: int):
    a, size = 0, 0
    for b, s in enumerate(strings):
        if size > most:
            yield a, b
            a, size = b, 0
        size += len(s)
    yield a, len(strings)


class Spilled:
    """Windows of a bucket in files, by their hashes."""

    def __init__(self, window: int = WINDOW, files: int = FILES) -> None:
        self.window, self.folder = window, tempfile.TemporaryDirectory(prefix="windows-")
        self.files = [open(f"{self.folder.name}/{i}", "wb") for i in range(files)]  # noqa: SIM115

    def add(self, doc: np.ndarray, start: np.ndarray, strings: list[bytes]) -> None:
        for a, b in _runs(strings, AT_ONCE):
            parts: list[list] = [[] for _ in self.files]
            s, e, _, base, hashes = _words(strings[a:b])
            raw = b"\n".join(strings[a:b])
            to = (_sums(hashes, self.window) % np.uint64(len(self.files))).tolist()
            for i in range(b - a):
                for inner, word in enumerate(range(int(base[i]), int(base[i + 1]) - self.window + 1)):
                    parts[to[word]].append((int(doc[a + i]), int(start[a + i]) + inner, raw[s[word] : e[word + self.window - 1]]))
            for part, file in zip(parts, self.files):
                if part:
                    pickle.dump(part, file, protocol=5)

    def later(self):
        """(doc, start) of each window that equals one with a smaller (doc, start); a file's distinct windows are in memory."""
        for i, file in enumerate(self.files):
            file.close()
            first: dict[bytes, tuple[int, int]] = {}
            with open(f"{self.folder.name}/{i}", "rb") as f:
                while True:
                    try:
                        part = pickle.load(f)
                    except EOFError:
                        break
                    for doc, at, words in part:
                        place = (doc, at)
                        known = first.setdefault(words, place)
                        if known < place:
                            yield place
                        elif place < known:
                            first[words] = place
                            yield known
        self.folder.cleanup()


def _sort_buckets(batches):
    import pyarrow as pa
    import pyarrow.compute
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    held: list = []
    bucket, size, spilled = None, 0, None

    def spill():
        nonlocal spilled, size
        spilled = spilled or Spilled()
        for doc, start, strings in held:
            spilled.add(doc, start, strings)
        held.clear()
        size = 0

    def close():
        nonlocal spilled, size
        if spilled:
            spill()
            found, spilled = spilled.later(), None
        elif held:
            doc, start = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            found = later_windows(doc, start, [s for h in held for s in h[2]])
            held.clear()
            size = 0
        else:
            return
        part: list = []
        for place in found:
            part.append(place)
            if len(part) >= 1_000_000:
                yield marked(part)
                part = []
        if part:
            yield marked(part)

    def marked(found):
        ids, at = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)
        order = np.lexsort((at, ids))
        ids, at = ids[order], at[order]
        new = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (at[1:] != at[:-1] + 1)))
        ids, marks = _by_document(ids[new], at[new], np.diff(np.append(new, len(at))))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), marks], ["key", "marks"])

    for batch in batches:
        reported = batch.filter(pa.compute.is_valid(batch.column(3)))
        if reported.num_rows:
            yield pa.RecordBatch.from_arrays([reported.column(3), reported.column(4)], ["key", "marks"])
        for b, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if blob is None:
                continue
            if b != bucket:
                yield from close()
                bucket = b
            raw = unpacker.decompress(blob)
            places = np.frombuffer(raw, dtype=np.int64, count=2 * n)
            held.append((np.cumsum(places[:n]), places[n:], raw[16 * n :].split(b"\n")))
            size += len(raw)
            if size > SPILL:
                spill()
    yield from close()


def _cover(with_text: bool):
    def run(batches):
        import pyarrow as pa

        out: list = []
        current, marks = None, []

        def batch_of(rows):
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array([r[4] for r in rows], pa.string())], [*names, "kept_text"]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            lists = batch.column(1)
            for i, (key, text, doc) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if key != current:
                    current, marks = key, []
                if lists[i].is_valid:
                    marks.append(np.asarray(lists[i].values.to_numpy(), dtype=np.int64).reshape(-1, 2))
                    continue
                words = text.encode().split()
                removed = 0
                if marks:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    spans = np.concatenate(marks)
                    np.add.at(change, spans[:, 0], 1)
                    np.add.at(change, np.minimum(spans[:, 0] + spans[:, 1] + WINDOW - 1, len(words)), -1)
                    stay = np.cumsum(change)[: len(words)] == 0
                    removed = len(words) - int(stay.sum())
                    kept = [words[k] for k in np.flatnonzero(stay).tolist()]
                else:
                    kept = words
                kept_text = b" ".join(kept)
                out.append((doc, len(words), removed, hashlib.sha256(kept_text).hexdigest(), kept_text.decode() if with_text else None))
                if len(out) >= 256:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, and kept_text on demand) for each row of docs."""
    texts = keyed(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2 * docs.sparkSession.sparkContext.defaultParallelism, min(MOST_PARTS, -(-size // SHARE)))
    split = texts.select("key", "text").mapInArrow(_split(parts * FINENESS), "bucket long, n long, blob binary, id long, marks array<long>")
    marks = split.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_sort_buckets, "key long, marks array<long>")
    both = marks.select("key", "marks", F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("id"), F.lit(0).alias("kind"))
    both = both.unionByName(texts.select("key", F.lit(None).cast("array<long>").alias("marks"), "text", "id", F.lit(1).alias("kind")))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return both.repartition("key").sortWithinPartitions("key", "kind").select("key", "marks", "text", "id").mapInArrow(_cover(with_text), schema)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Removed words of all documents."""
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
