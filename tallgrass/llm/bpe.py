"""Byte-pair encoding of whole texts by content-defined chunks, and decoding.

A rolling hash over the last WINDOW bytes cuts each text where the content says so; equal chunks, in whichever document of a
task, are encoded once. A cut may fall anywhere, so each join is repaired: the stretch between two safe points around it is
encoded anew, with the next stretch on each side as witness, and grows until both witnesses get the ids they have already.
A safe point is a single space between two characters that aren't white space: no split of the pattern crosses it, and no
special string holds one. A text without safe points is one stretch, that is, it is encoded whole.

Chunks are shared within a task, not between tasks: to gather all chunks and to send the ids back would move several times
the input. Null text is the empty text, which has no ids. Repeated rows give a row each. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.vocabulary import BYTE_BPE, byte_encoding, vocabulary_path

WINDOW, MASK_BITS = 32, 11
#: Bytes of chunks whose ids a task keeps; beyond, it forgets them all.
KEPT = 24 << 20
_GEAR = np.random.default_rng(0xBEE).integers(1, 2**63, 256, dtype=np.uint64)


def cuts(data: bytes) -> list[int]:
    """Where content says to cut: ends of chunks, the last being the end of data. Every cut is between two characters."""
    if len(data) <= WINDOW:
        return [len(data)] if data else []
    out: list[int] = []
    step = 1 << 20
    for at in range(0, len(data) - WINDOW, step):
        part = np.frombuffer(data, dtype=np.uint8, count=min(step + WINDOW, len(data) - at), offset=at)
        x = _GEAR[part]
        rolled = np.zeros(len(part) - WINDOW, dtype=np.uint64)
        # Of the last WINDOW bytes, the byte i back is shifted by i bits: doubling steps add up 1, 2, 4 ... bytes.
        width = 1
        while width < WINDOW:
            x = x[width:] + (x[:-width] << np.uint64(width))
            width *= 2
        rolled = x[: len(part) - WINDOW]
        hit = np.flatnonzero((rolled >> np.uint64(64 - MASK_BITS)) == 0)
        out += (hit + at + WINDOW).tolist()
    ends = []
    for p in out:
        while p < len(data) and data[p] & 0xC0 == 0x80:
            p += 1
        if p < len(data) and (not ends or p > ends[-1]):
            ends.append(p)
    return [*ends, len(data)]


def safe_points(data: np.ndarray) -> np.ndarray:
    """Offsets of single spaces between two ASCII characters that aren't white space or controls, where no split crosses."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    plain = (data > 0x20) & (data < 0x7F)
    return np.flatnonzero(plain[:-2] & (data[1:-1] == 0x20) & plain[2:]) + 1


class ChunkCoder:
    """Encodes whole texts with one Encoding; chunks are kept from text to text."""

    def __init__(self, encoding) -> None:
        self.encoding = encoding
        self.lengths = np.zeros(encoding.n_vocab, dtype=np.int64)
        for i in range(encoding.n_vocab):
            try:
                self.lengths[i] = len(encoding.decode_single_token_bytes(i))
            except KeyError:
                continue
        self.kept: dict[bytes, tuple] = {}
        self.bytes = 0
        self.reused = self.encoded = 0

    def plain(self, data: bytes) -> np.ndarray:
        return self.encoding.encode_to_numpy(data.decode("utf-8", "surrogatepass"), allowed_special="all").astype(np.uint32, copy=False)

    def chunk(self, data: bytes) -> tuple:
        """(ids, offset of each id's end, safe points) of a chunk by itself."""
        if (found := self.kept.get(data)) is not None:
            self.reused += 1
            return found
        self.encoded += 1
        ids = self.plain(data)
        found = ids, np.cumsum(self.lengths[ids]), safe_points(np.frombuffer(data, dtype=np.uint8))
        self.bytes += 12 * len(ids) + len(data) + 400
        if self.bytes > KEPT:
            self.kept.clear()
            self.bytes = 0
        self.kept[data] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        data = text.encode("utf-8", "surrogatepass")
        ends = cuts(data)
        if len(ends) < 2:
            return self.plain(data)
        parts: list[tuple] = []
        pieces: list[np.ndarray] = []
        begin = 0
        for end in ends:
            parts.append((begin, *self.chunk(data[begin:end])))
            begin = end
        points = np.concatenate([p[3] + p[0] for p in parts])
        stretch = np.concatenate(([0], points, [len(data)]))  # bounds of stretches; no split crosses one of these
        done = 0  # all before this offset has its ids in pieces
        for (begin, ids, offsets, _), end in zip(parts, ends):
            if end <= done:
                continue
            last = end == len(data)
            if not last:
                at = int(np.searchsorted(points, end))  # points[at - 1] < end <= points[at]
                left, right = at, at + 1  # the join's stretch is stretch[left] to stretch[right]
                left = max(left, int(np.searchsorted(stretch, done, "right")) - 1)
            upto = end if last else max(int(stretch[left]), done)
            if upto > max(done, begin):
                pieces.append(ids[self._index(offsets, max(done, begin) - begin) : self._index(offsets, upto - begin)])
                done = upto
            if last:
                break
            while True:
                ids_, new_done, agreed = self._repair(data, parts, ends, stretch, left, right, done)
                if agreed:
                    pieces.append(ids_)
                    done = new_done
                    break
                right += 1
        return np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)

    @staticmethod
    def _index(offsets: np.ndarray, at: int) -> int:
        """How many ids end at or before offset at; at is an id's end or 0."""
        return int(np.searchsorted(offsets, at, "right")) if at else 0

    def _repair(self, data, parts, ends, stretch, left, right, done) -> tuple:
        """The ids of stretch[left] to stretch[right], and whether the stretch after it, encoded along, has the ids that its chunk gave."""
        start, stop = done, int(stretch[right])
        witness = int(stretch[min(right + 1, len(stretch) - 1)])
        ids = self.plain(data[start:witness])
        offsets = np.cumsum(self.lengths[ids]) + start
        if stop == len(data):
            return ids, stop, True
        k = int(np.searchsorted(offsets, stop))
        if k >= len(ids) or offsets[k] != stop:
            return None, None, False
        at = int(np.searchsorted(ends, stop, "right"))
        begin, own, own_offsets, _ = parts[at]
        if witness <= ends[at] and begin <= stop:
            i, j = self._index(own_offsets, stop - begin), self._index(own_offsets, witness - begin)
            if witness < ends[at] and not np.array_equal(own[i:j], ids[k + 1 :]):
                return None, None, False
        return ids[: k + 1], stop, True

    def decode(self, ids) -> str:
        return self.encoding.decode(ids.tolist() if isinstance(ids, np.ndarray) else ids)


def _code(path: str, texts_out: bool):
    def run(batches):
        import pyarrow as pa

        encoding = byte_encoding(path)
        if encoding is None:
            raise ValueError(f"{path} isn't a byte-level BPE file")
        coder = ChunkCoder(encoding)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n, ids_sha, decoded_sha, all_ids = [], [], [], []
                for text in part.column(1).to_pylist():
                    ids = coder.encode(text)
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    decoded_sha.append(hashlib.sha256(coder.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                    if texts_out:
                        all_ids.append(ids.astype(np.int32))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if texts_out:
                    columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids on demand) for each row; vocabulary is a byte-level BPE file's path on every machine."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts.mapInArrow(_code(vocabulary, with_ids), schema + ", ids array<int>" * with_ids)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as digests."""
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path(BYTE_BPE))
