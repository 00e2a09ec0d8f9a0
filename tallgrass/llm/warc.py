"""WARC archives: a writer with deduplicating revisits, and a salvage reader.

The writer gives each page a record, in archives of gzip members under a folder that all machines see. Of pages with equal
payloads of at least MIN_BYTES bytes, that with the smallest id becomes a response and the others revisit it. A page's payload is
its HTML in UTF-8, null being empty. Archives are named by task and attempt, and only those of the attempts that Spark
accepted are in the manifest, so a repeated task leaves no double records.

The reader goes from member to member (or record to record in plain archives), many archives at once. Where a check fails (checksum,
version line, headers, lengths, digests), it looks for the next place that begins a valid member or version line, reads on from
there, and logs the bytes between as a gap. In a member of several records, it keeps those before the damage, looks
for the next version line in what can be unpacked, and logs the stretch between as a gap inside the member; of a member whose end is damaged, it keeps
the records that were whole before. Members are unpacked in pieces; a record is held in memory, an archive never.

A null id is written as such and comes back as null; it sorts after all others. Rows that share an id give a record each. Null
HTML is an empty payload, and a very long one is a record like others. Of pages with equal payloads and equal ids, all are responses.
An empty table gives no archives and no rows. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import NULL_ID, id_back, id_key, join_groups, new_folder, open_shared, quoted, written

MIN_BYTES = 0
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
_MAGIC, _VERSION = b"\x1f\x8b\x08", re.compile(rb"WARC/1\.[01]\r\n")
#: A version line as far as the data go.
_BEGIN = re.compile(rb"(?:WARC/1\.[01]\r\n|(?:W|WA|WAR|WARC|WARC/|WARC/1|WARC/1\.|WARC/1\.[01]|WARC/1\.[01]\r)?\Z)")
_PIECE = 1 << 18
_SPACE = uuid.UUID("6f0c2a52-4a5e-4b0e-9a57-1f0c5a1d7b11")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def record(page_id: int, url: str | None, payload: bytes, first: int) -> bytes:
    """The bytes of a page's record; it is a revisit if first, the id of the response with this payload, isn't page_id."""
    revisit = first != page_id
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank"),
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response", f"WARC-Page-Id: {page_id if page_id != NULL_ID else ''}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(first)}", f"WARC-Refers-To-Page-Id: {first}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """data as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        made: list[tuple[str, int, int]] = []
        out, size, n = None, 0, 0

        for batch in batches:
            ids, firsts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for at in range(0, batch.num_rows, 64):
                for i, (url, html) in enumerate(zip(batch.column(1).slice(at, 64).to_pylist(), batch.column(2).slice(at, 64).to_pylist()), at):
                    if out is None:
                        path = f"{name}-{len(made):04d}.warc.gz"
                        out, size, n = open_shared(path, "w"), 0, 0
                    data = member(record(ids[i], url, html.encode(), firsts[i]))
                    out.write(data)
                    size, n = size + len(data), n + 1
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        made.append((path, n, size))
                        out = None
        if out is not None:
            out.close()
            made.append((path, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], ["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the archives of pages below folder and returns their manifest (path, records, bytes).

    Which page is whose response is found on narrow rows; only revisits are joined with the pages, by id and content, so a group of copies
    of any size doesn't meet in a task.
    """
    html = F.coalesce(quoted(html_col), F.lit(""))
    rows = pages.select(id_key(id_col).alias("id"), quoted(url_col).alias("url"), html.alias("html"), F.unhex(F.sha2(html, 256)).alias("content"))
    narrow = written(rows.filter(F.octet_length("html") >= min_bytes).groupBy("id", "content").agg(F.count("*").alias("n")).select("id", "content"), "contents")
    firsts = narrow.groupBy("content").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("content", "first")
    revisits = written(join_groups(narrow, firsts, "content").filter("id <> first").select("id", "content", "first"), "revisits")
    linked = rows.join(revisits, ["id", "content"], "left").select("id", "url", "html", F.coalesce("first", "id").alias("first"))
    return written(linked.mapInArrow(_write(folder), "path string, records long, bytes long"), "manifest")


class Damage(Exception):
    """A check that failed."""


class Source:
    """Pieces of an open file from any offset."""

    def __init__(self, file) -> None:
        self.file = file
        self.size = file.size() if hasattr(file, "size") else file.seek(0, 2)

    def read(self, at: int, n: int) -> bytes:
        if at >= self.size:
            return b""
        self.file.seek(at)
        return self.file.read(min(n, self.size - at))


class Member:
    """The contents of the gzip member at an offset, in pieces; end is where it ends, once all is unpacked and its checksum is right."""

    def __init__(self, source: Source, at: int) -> None:
        self.source, self.at, self.end, self.unpacker, self.rest, self.broken = source, at, None, zlib.decompressobj(31), b"", False

    def pull(self) -> bytes:
        """The next piece, or nothing at the end."""
        while self.end is None:
            if self.broken:
                raise Damage("bad member")
            piece = self.rest or self.source.read(self.at, _PIECE)
            if not piece:
                raise Damage("truncated member")
            self.at += 0 if self.rest else len(piece)
            before = self.unpacker.copy()
            try:
                out = self.unpacker.decompress(piece, _PIECE)
            except zlib.error as e:
                self.broken = True
                if out := self._salvaged(before, piece):
                    return out
                raise Damage(f"bad member: {e}") from e
            self.rest = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.end = self.at - len(self.unpacker.unused_data)
            if out:
                return out
        return b""


    @staticmethod
    def _salvaged(unpacker, piece: bytes) -> bytes:
        """What comes out of a piece, byte by byte, before it fails."""
        out = []
        try:
            for i in range(len(piece)):
                out.append(unpacker.decompress(piece[i : i + 1]))
        except zlib.error:
            pass
        return b"".join(out)


def member_events(member: Member, at: int):
    """("record", at, headers, block) for each whole record of a member that begins at offset at, and ("gap", at, length, reason) for stretches
    of its contents between them; raises Damage, after all that could be read, where the member itself is damaged."""
    data, place, gap, reason, broken, over = b"", 0, 0, "", None, False  # place and gap: offsets in data

    def more() -> bool:
        nonlocal data, broken, over
        try:
            piece = member.pull()
        except Damage as e:
            broken, piece = e, b""
        over = over or not piece
        data += piece
        return bool(piece)

    while True:
        if place > 1 << 20:
            cut = min(place, gap)
            data, place, gap = data[cut:], place - cut, gap - cut
        try:
            while not over and (need := record_end(data, place)) > len(data) and more():
                pass
            if place >= len(data):
                break
            headers, block, end = parse_record(data, place)
        except Damage as e:
            reason = reason or str(e)
            while (line := _VERSION.search(data, place + 1)) is None and not over:
                place = max(place, len(data) - 16)
                more()
            place = line.start() if line else len(data)
            continue
        if place > gap:
            yield "gap", at, place - gap, f"inside a member: {reason}"
        yield "record", at, headers, block
        place = gap = end
        reason = ""
    if broken:
        raise broken
    if len(data) > gap:
        yield "gap", at, len(data) - gap, f"inside a member: {reason}"


def record_end(data: bytes, at: int) -> int:
    """Where the record at an offset of data ends by its own words; one more than data has, while its headers haven't ended; a megabyte of them is Damage."""
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        if len(data) - at > 1 << 20 or not _BEGIN.match(data, at):
            raise Damage("headers don't end" if _BEGIN.match(data, at) else "no version line")
        return len(data) + 1
    length = re.search(rb"\r\ncontent-length:\s*(\d{1,18})\s*\r\n", data[at : stop + 4], re.IGNORECASE)
    return stop + 8 + int(length[1]) if length else stop + 4


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block and end of the record at an offset of data; every check holds."""
    line = _VERSION.match(data, at)
    if not line:
        raise Damage("no version line")
    stop = data.find(b"\r\n\r\n", line.end() - 2)
    if stop < 0:
        raise Damage("headers don't end")
    headers: dict[str, str] = {}
    for x in data[line.end() : stop].split(b"\r\n"):
        name, colon, value = x.partition(b":")
        if not colon:
            raise Damage("a header without colon")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length) or "warc-type" not in headers:
        raise Damage("no content length or type")
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damage("the record doesn't end where its length says")
    block = data[begin:end]
    kind, _, value = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and value.upper() != digest(block):
        raise Damage("wrong block digest")
    if headers["warc-type"] == "response" and (payload := headers.get("warc-payload-digest", "")).startswith("sha1:"):
        if payload[5:].upper() != digest(block.partition(b"\r\n\r\n")[2]):
            raise Damage("wrong payload digest")
    return headers, block, end + 4


def plain_record(source: Source, at: int) -> tuple[dict[str, str], bytes, int]:
    """parse_record() for a record that isn't compressed."""
    data, need = source.read(at, _PIECE), _PIECE
    while True:
        stop = data.find(b"\r\n\r\n")
        length = re.search(rb"\r\ncontent-length:\s*(\d{1,18})\s*\r\n", data[: stop + 4], re.IGNORECASE) if stop >= 0 else None
        need = stop + 8 + int(length[1]) if length else need
        if (stop >= 0 and len(data) >= need) or len(data) >= source.size - at or (stop < 0 and len(data) > 1 << 20):
            break
        data += source.read(at + len(data), max(_PIECE, need - len(data)))
    headers, block, end = parse_record(data[:need] if length else data)
    return headers, block, at + end


def _next(source: Source, at: int) -> int:
    """The next offset that begins a member whose contents begin with a version line, or a version line."""
    while at < source.size:
        piece = source.read(at, _PIECE + 16)
        for m in re.finditer(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n", piece):
            if m.start() >= _PIECE:
                break
            if m[0][:1] == b"W":
                return at + m.start()
            try:
                if zlib.decompressobj(31).decompress(source.read(at + m.start(), 4096), 16).startswith(b"WARC/1."):
                    return at + m.start()
            except zlib.error:
                continue
        at += _PIECE
    return source.size


def salvage(file):
    """("record", offset, headers, block) for each whole record of an archive and ("gap", offset, length, reason) for all bytes between."""
    source = Source(file)
    at = gap = 0
    reason = ""
    while at < source.size:
        events: list = []
        try:
            if source.read(at, 3) == _MAGIC:
                member = Member(source, at)
                for event in member_events(member, at):
                    if at > gap:  # the member proves to be one
                        yield "gap", gap, at - gap, reason
                        gap, reason = at, ""
                    yield event
                end = member.end
            else:
                headers, block, end = plain_record(source, at)
                events = [("record", at, headers, block)]
        except Damage as e:
            reason = reason or str(e)
            at = _next(source, at + 1)
            continue
        if at > gap:
            yield "gap", gap, at - gap, reason
        yield from events
        at = gap = end
        reason = ""
    if source.size > gap:
        yield "gap", gap, source.size - gap, reason


def _read(batches):
    import pyarrow as pa

    names = ["kind", "path", "at", "id", "payload_bytes", "payload_digest", "record_type", "refers_to", "length", "reason", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    out: list[tuple] = []
    size = 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open_shared(path, "r") as file:
                for kind, at, x, y in salvage(file):
                    if kind == "gap":
                        out.append((kind, path, at, None, None, None, None, None, x, y, None))
                    else:
                        http, _, payload = y.partition(b"\r\n\r\n")
                        length = re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)
                        page, refers = x.get("warc-page-id", ""), x.get("warc-refers-to-page-id")
                        response = x["warc-type"] == "response"
                        out.append((kind, path, at, int(page) if page else NULL_ID, len(payload) if response else int(length[1]) if length else None, x.get("warc-payload-digest", "").removeprefix("sha1:"), x["warc-type"], int(refers) if refers else None, None, None, payload if response else None))
                        size += len(payload)
                    if len(out) >= 256 or size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def read_archives(manifest: DataFrame) -> DataFrame:
    """All records and gaps of the archives at manifest's paths; kind is record or gap."""
    schema = "kind string, path string, at long, id long, payload_bytes long, payload_digest string, record_type string, refers_to long, length long, reason string, payload binary"
    size = manifest.agg(F.count("*").alias("archives"), F.sum("bytes").alias("bytes")).first()
    tasks = max(1, min(size["archives"], max(4 * manifest.sparkSession.sparkContext.defaultParallelism, (size["bytes"] or 0) // (4 * ARCHIVE_BYTES))))
    return manifest.select("path").repartition(tasks).mapInArrow(_read, schema)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    """The records of all pages, read back from their archives."""
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), new_folder(spark, "warc"))
    records = read_archives(manifest).filter("kind = 'record'")
    return records.select(id_back("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", id_back("refers_to").alias("refers_to"))
