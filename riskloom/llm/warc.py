"""WARC archives: a writer with revisit records and a reader that salvages damaged files."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.base import table
from riskloom.session import new_path

#: Payloads below this many bytes are never revisits.
MIN_BYTES = 100
#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 8 << 20
#: Between members: gzip readers take zero bytes as padding.
PADDING = "\0"
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
NEXT = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(kind: str, page_id, url, digest: str, size: int, payload: bytes, refers_to=None, date: str = DATE) -> bytes:
    """One WARC record. A revisit has the HTTP head only; its full payload's size is a header."""
    block = HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines.append(f"WARC-Refers-To: {_urn(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member of its own."""
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
        digests, members, sizes = [], [], []
        for page_id, url, payload in zip(ids, urls, batch.column("payload").cast(pa.binary()).to_pylist()):
            digest = hashlib.sha256(payload).hexdigest()
            digests.append(digest)
            sizes.append(len(payload))
            members.append(member(record("response", page_id, url, digest, len(payload), payload)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(members, pa.binary())],
            ["page_id", "url", "size", "digest", "member"],
        )


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members joined into archives, each one row."""
    parts, held = [], 0
    for batch in batches:
        for r in batch.to_pylist():
            data = r["member"]
            if r["revisit"]:
                data = member(record("revisit", r["page_id"], r["url"], r["digest"], r["size"], b"", r["first_id"]))
            parts.append(data)
            held += len(data)
            if held >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([PADDING.encode().join(parts)], pa.binary())], ["archive"])
                parts, held = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([PADDING.encode().join(parts)], pa.binary())], ["archive"])


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into archives below ``path``.

    Records are compressed one by one before anything is shuffled, so the join that finds
    revisits moves compressed pages. Of equal payloads of ``min_bytes`` or more the one with
    the smallest page_id is the response. Spark's own writer commits the files, so a lost
    executor leaves none behind, and any file system that Spark reaches will do.

    A null html is an empty payload, a null url leaves out the target, a null page_id gives
    an empty record id and sorts after all others (of equal payloads without any id, all
    are responses). Rows that repeat the smallest id are responses too.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("payload")
    )
    members = rows.mapInArrow(_responses, "page_id long, url string, size long, digest string, member binary")
    firsts = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy(F.sha2("payload", 256).alias("_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND first_id IS NOT NULL")
        .drop("_n")
    )
    typed = members.join(firsts, (members["digest"] == firsts["_digest"]) & (members["size"] >= min_bytes), "left").select(
        "page_id", "url", "size", "digest", "first_id",
        F.expr("first_id IS NOT NULL AND NOT (page_id <=> first_id)").alias("revisit"),
        F.expr("CASE WHEN first_id IS NULL OR page_id <=> first_id THEN member END").alias("member"),
    )
    archives = typed.mapInArrow(_archives, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", PADDING).option("maxRecordsPerFile", 1).text(path)


def _parse(data: bytes, at: int) -> tuple[dict, bytes, int] | str:
    """The record at ``at``: headers, block and end; or what is wrong with it."""
    if not VERSION.match(data, at):
        return "no version line"
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return "header without end"
    head: dict[str, str] = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "broken header line"
        head[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        return "no content length"
    start, end = stop + 4, stop + 4 + int(head["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "no end after the block"
    block = data[start:end]
    said = head.get("warc-block-digest", "")
    if said.startswith("sha256:") and hashlib.sha256(block).hexdigest() != said[7:]:
        return "block digest differs"
    return head, block, end + 4


def _feed(engine, piece: bytes, step: int, out: list[bytes]) -> None:
    """Add to ``out`` all that ``piece`` yields before its damage, in ever smaller steps."""
    for low in range(0, len(piece), step):
        spare, part = engine.copy(), piece[low : low + step]
        try:
            out.append(engine.decompress(part))
        except zlib.error:
            if step > 1:
                return _feed(spare, part, step // 64, out)
            try:
                while got := spare.decompress(part, 1):
                    out.append(got)
                    part = spare.unconsumed_tail
            except zlib.error:
                return None


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The gzip member at ``at``: its bytes up to its end or damage, where that is, and what is
    wrong. It is fed in small pieces so that no rest is copied."""
    engine, out, pos = zlib.decompressobj(31), [], at
    while not engine.eof:
        piece = data[pos : pos + 65536]
        if not piece:
            return b"".join(out), pos, "member without end"
        try:
            out.append(engine.decompress(piece))
        except zlib.error:
            # The bytes of the piece before the damage: once more from the start.
            engine = zlib.decompressobj(31)
            for low in range(at, pos, 65536):
                engine.decompress(data[low : low + 65536])
            _feed(engine, piece, 4096, out)
            return b"".join(out), pos, "broken member"
        pos += len(piece)
    return b"".join(out), pos - len(engine.unused_data), ""


def _used(data: bytes, at: int, size: int) -> int:
    """How many bytes of the member at ``at`` yield its first ``size`` bytes."""
    engine, made, pos, step = zlib.decompressobj(31), 0, at, 4096
    while made < size:
        spare = engine.copy()
        try:
            got = engine.decompress(data[pos : pos + step])
        except zlib.error:
            got = None
        if step > 1 and (got is None or made + len(got) >= size):
            engine, step = spare, 1
            continue
        if got is None:
            return pos + 1 - at
        made, pos = made + len(got), pos + step
    return pos - at


def _inside(inner: bytes, broken: bool) -> tuple[list[tuple], list[tuple], int]:
    """Records in a member's bytes, gaps (offset, length, reason), and the end of the last record.

    Where the compressed bytes are ``broken`` only a digest shows that a record is whole.
    """
    found, gaps, at, bad, reason, last = [], [], 0, None, "", 0
    while at < len(inner):
        if bad is None and inner[at] in b"\0\r\n":
            at += 1
            continue
        one = _parse(inner, at)
        if not isinstance(one, str) and broken and not one[0].get("warc-block-digest", "").startswith("sha256:"):
            one = "no digest in a broken member"
        if isinstance(one, str):
            if bad is None:
                bad, reason = at, one
            nxt = VERSION.search(inner, at + 1)
            at = nxt.start() if nxt else len(inner)
            continue
        if bad is not None:
            gaps.append((bad, at - bad, reason))
            bad = None
        found.append(one[:2])
        at = last = one[2]
    if bad is not None:
        gaps.append((bad, len(inner) - bad, reason))
    return found, gaps, last


def salvage(data: bytes) -> Iterator[tuple]:
    """Records and gaps of an archive: ("record", offset, length, head, block) or
    ("gap", offset, length, reason, None), and for a gap between the records of a member
    ("gap", offset, length, reason, None, inner offset, inner length).

    Plain records and gzip members may be mixed. Where a check fails, the search goes on at
    the next member magic or version line behind, inside a member at the next version line of its
    bytes. Every byte of the archive that no valid record's member covers is in exactly one
    gap without inner offset. Line ends and zero padding between records are no gap.

    A member that is damaged or cut off yields the valid records before the damage and ends
    with the last of them. One with nothing but a single record up to the damage is a gap.
    """
    pos, bad, reason, size = 0, None, "", len(data)
    while pos < size:
        if bad is None and data[pos] in b"\0\r\n":
            pos += 1
            continue
        found, inner_gaps, wrong, cut = [], [], "", False
        if data.startswith(GZIP, pos):
            inner, end, wrong = _inflate(data, pos)
            found, inner_gaps, last = _inside(inner, wrong == "broken member")
            cut = wrong != ""
            if cut:
                if len(found) == 1 and not inner_gaps and last == len(inner):
                    found = []
                inner_gaps = [g for g in inner_gaps if g[0] < last]
                end = pos + _used(data, pos, last) if found else pos
            elif not found and inner_gaps:
                wrong = inner_gaps[0][2]
        else:
            one = _parse(data, pos)
            if isinstance(one, str):
                wrong = one
            else:
                found, end = [one[:2]], one[2]
        if wrong and not found:
            if bad is None:
                bad, reason = pos, wrong
            nxt = NEXT.search(data, pos + 1)
            pos = nxt.start() if nxt else size
            continue
        if bad is not None:
            yield "gap", bad, pos - bad, reason, None
            bad = None
        for head, block in found:
            yield "record", pos, end - pos, head, block
        for at, length, why in inner_gaps:
            yield "gap", pos, end - pos, why, None, at, length
        pos = end
        if cut:
            bad, reason = pos, wrong
            nxt = NEXT.search(data, pos)
            pos = nxt.start() if nxt else size
    if bad is not None:
        yield "gap", bad, size - bad, reason, None


READ_SCHEMA = (
    "archive string, kind string, offset long, length long, reason string, page_id long, url string, "
    "payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, "
    "inner_offset long, inner_length long"
)


def _id(text: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(m[1]) if m else None


def _row(path: str, item: tuple, keep: bool) -> dict:
    kind, offset, length, head, block, *inner = item
    row = {"archive": path, "kind": kind, "offset": offset, "length": length}
    if kind == "gap":
        return row | {"reason": head} | dict(zip(("inner_offset", "inner_length"), inner))
    payload = block.partition(b"\r\n\r\n")[2]
    kind_of = head.get("warc-type")
    full = kind_of != "revisit"
    digest = hashlib.sha256(payload).hexdigest() if full else head.get("warc-payload-digest", "").removeprefix("sha256:")
    said = head.get("warc-payload-digest", "")
    length_of = head.get("x-payload-length", "")
    return row | {
        "reason": "payload digest differs" if full and said.startswith("sha256:") and said[7:] != digest else None,
        "page_id": _id(head.get("warc-record-id")),
        "url": head.get("warc-target-uri"),
        "payload_bytes": len(payload) if full else int(length_of) if length_of.isdigit() else None,
        "payload_digest": digest,
        "record_type": kind_of,
        "refers_to": _id(head.get("warc-refers-to")),
        "payload": payload if keep else None,
    }


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of all archives below ``path``, one row each.

    ``kind`` is record or gap; a gap has offset, length and the reason of the first failed
    check. Offsets count bytes of the file; records of one member share them, and so do gaps
    between them, which have inner_offset and inner_length in the member's bytes. An archive is
    one value in memory: the writer closes archives at 8 MB.
    """
    schema = pa.schema([("archive", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("inner_offset", pa.int64()), ("inner_length", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                rows = []
                for item in salvage(content.as_py()):
                    rows.append(_row(name.as_py(), item, payload))
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(scan, READ_SCHEMA)


def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back; a gap would be missing rows."""
    path = new_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read_warc(spark, path, payload=False).where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {MIN_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
