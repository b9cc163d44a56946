"""WARC archives: one gzip member per record, a splittable reader.

``write`` puts a record for each page into archive files of the shared folder. Of records with equal payloads of at
least ``MIN_REVISIT`` bytes the one with the smallest page_id is a response, the others are revisits that refer to it;
the response of each payload comes from an aggregate by digest, of which only digests that occur again are joined back.
Each task writes its own files under fresh names; only files named in the returned manifest count, so a repeated task
leaves no duplicates.

``read`` deals byte ranges of the archives out to tasks. A task looks for gzip magic from its range's start, validates
each candidate by decoding the member's first bytes to a WARC header, and owns the records that start inside its range,
reading past the range's end where the last one goes on. Candidates inside other members' compressed data do not decode
to a header and are skipped. A range is read front to back, each byte once: what a record leaves of a chunk is the next one's. (A stored member could hold a whole other archive only as binary payload; payloads here
are UTF-8, in which the magic's second byte cannot follow the first.)

Files are opened through ``pyarrow.fs`` by URI, so the shared folder can be any store it reads.

Rows: null html is an empty payload. Repeated rows are records of their own; rows with a null page_id are responses. Of equal
payloads the least page_id is the response, also where several rows have it. A record is held whole while it is written or read;
batches of records are handed on as they fill. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, materialise, table
from millrace.session import shared_dir, ship

MIN_REVISIT, LEVEL = 100, 1
RANGE, CHUNK, STEP, FILE_BYTES = 4 << 20, 256 << 10, 32 << 10, 256 << 20
MAGIC = b"\x1f\x8b\x08"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if not urlsplit(uri).scheme:
        uri = "file://" + uri
    return fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """A WARC/1.1 record; a revisit has the payload's digest and size but no payload."""
    name = "null" if page_id is None else page_id
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def member(raw: bytes, level: int = LEVEL) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def judged(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, response): response is the page that a revisit refers to, else null."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n_bytes"))
    again = rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("c"))
    # written, so that both sides of the join are plain shuffles, of which Spark splits a hot digest
    again, _ = materialise(again.where("c > 1 AND least IS NOT NULL").select(F.col("digest").alias("again"), "least"), "again")
    rows = rows.join(again, rows["digest"] == again["again"], "left")
    return rows.select("page_id", "url", "html", "digest", F.when(F.col("page_id") != F.col("least"), F.col("least")).alias("response"))


MANIFEST = "path string, n_bytes long, n_records long"


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write archives under ``folder`` and return their manifest (a table in the shared folder)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        out, name, size, count, done = None, "", 0, 0, []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", size, count))
                out = None

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for page_id, url, html, digest, response in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    if out is None:
                        name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    raw = member(record(page_id, url, html, digest, "response" if response is None else "revisit", response))
                    out.write(raw)
                    size += len(raw)
                    count += 1
                    if size >= FILE_BYTES:
                        close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["path", "n_bytes", "n_records"])

    manifest, _ = materialise(judged(pages, min_bytes).mapInArrow(run, MANIFEST), "manifest")
    return manifest


def _header(text: bytes) -> dict[str, str] | None:
    """Fields of a WARC header, None where it isn't one (or isn't whole)."""
    end = text.find(b"\r\n\r\n")
    if end < 0 or not text.startswith(b"WARC/"):
        return None
    lines = text[:end].decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    fields[""] = str(end + 4)
    return fields


class Range:
    """Records of one file that start in [start, end), read front to back in chunks; ``n_read`` counts the bytes."""

    def __init__(self, file, size: int, start: int, end: int):
        self.file, self.size, self.end, self.n_read = file, size, end, 0
        self._go(start)

    def _go(self, at: int) -> None:
        self.file.seek(at)
        self.buf, self.low, self.base = b"", 0, at  # bytes from base on, of which those before low are done with

    def _more(self) -> bool:
        raw = self.file.read(min(CHUNK, self.size - self.base - len(self.buf)))
        self.n_read += len(raw)
        self.buf, self.base, self.low = self.buf[self.low :] + raw, self.base + self.low, 0
        return bool(raw)

    def _member(self) -> tuple[dict[str, str], bytes] | None:
        """Header and block of the member at ``low``, which moves to its end; None if none starts there. Bytes stay in the buffer until a
        WARC header is seen; a member that breaks off after that is looked into again from its second byte."""
        z, at, start = zlib.decompressobj(31), self.low, self.base + self.low
        head, pieces, fields = bytearray(), [], None
        while not z.eof:
            if at == len(self.buf):
                if fields is not None:
                    self.low = at
                here = self.base + at
                if not self._more():
                    break
                at = here - self.base
            raw = memoryview(self.buf)[at : at + STEP]
            at += len(raw)
            try:
                got = z.decompress(raw)
            except zlib.error:
                break
            pieces.append(got)
            if fields is None:
                seen = max(0, len(head) - 3)
                head += got
                if not b"WARC/".startswith(head[:5]):
                    break
                if head.find(b"\r\n\r\n", seen) >= 0:
                    fields = _header(bytes(head))
        if z.eof and fields is not None:
            whole, first, n = b"".join(pieces), int(fields[""]), int(fields.get("content-length", "-1"))
            if n >= 0 and whole[first + n : first + n + 4] == b"\r\n\r\n":
                self.low = at - len(z.unused_data)
                return fields, whole[first : first + n]
        if self.base + self.low <= start + 1 <= self.base + len(self.buf):
            self.low = start + 1 - self.base
        else:
            self._go(start + 1)
        return None

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            k = self.buf.find(MAGIC, self.low)
            if k < 0:
                self.low = max(self.low, len(self.buf) - len(MAGIC) + 1)
                if self.base + self.low >= self.end or not self._more():
                    return
                continue
            self.low = k
            if self.base + k >= self.end:
                return
            if (got := self._member()) is not None:
                yield got


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, intact boolean"


def _page(urn: str | None) -> int | None:
    name = (urn or "")[len("<urn:page:") : -1]
    return int(name) if name not in ("", "null") else None


def read(manifest: DataFrame, step: int = RANGE, keep_payload: bool = False) -> DataFrame:
    """Records of the archives named in ``manifest`` (path, n_bytes). intact: a response's payload has its digest."""
    spark = manifest.sparkSession
    parts = manifest.select("path", F.col("n_bytes").alias("size"), F.explode(F.expr(f"sequence(0L, greatest(n_bytes - 1, 0L), {step}L)")).alias("start"))
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            store, where = _store(path)
            rows: list[tuple] = []
            held = 0
            with store.open_input_file(where) as file:
                for fields, block in Range(file, size, start, min(size, start + step)).records():
                    kind, said = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:")
                    digest = hashlib.sha256(block).hexdigest() if kind == "response" else said
                    n = len(block) if kind == "response" else int(fields.get("x-payload-length", "0"))
                    rows.append((_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, n, digest, _page(fields.get("warc-refers-to")), block if keep_payload else None, digest == said))
                    held += len(block) if keep_payload else 200
                    if held > 8 << 20:
                        yield rows
                        rows, held = [], 0
            if rows:
                yield rows

    names = [x.split()[0] for x in RECORDS.split(", ")]
    return map_arrow(parts, lambda batch: (dict(zip(names, zip(*rows, strict=True), strict=True)) for rows in run(batch)), RECORDS)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS one FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> one THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> one THEN one END AS refers_to, true AS intact
FROM f
"""
