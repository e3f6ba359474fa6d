"""WARC archives: a writer of one gzip member per record and a sequential reader.

The reader inflates an archive piece by piece, frames each record by its
Content-Length, hashes block and payload on the way and compares them with
the record's digests; it never holds more than one record, whatever the size
of the archive.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import written
from basketlab.session import scratch_path

CHUNK = 1 << 16
ARCHIVE_BYTES = 256 << 20  # compressed size at which a task starts another archive
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"  # the pages have no time of their own


def base32_sha1(digest: bytes) -> str:
    import base64
    return base64.b32encode(digest).decode()


def open_folder(path: str):
    """File system and path of a folder that all executors reach (local mount, object store, HDFS)."""
    import re

    from pyarrow import fs
    path = re.sub(r"^file:/+", "file:///", path).replace("s3a://", "s3://")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


# ---------------------------------------------------------------- records
def record(page_id, url: str | None, payload: bytes, refers_to=None, refers_url: str | None = None,
           revisit: bool = False, date: str = DATE) -> bytes:
    """One WARC record as a gzip member; a revisit has the HTTP header but no payload."""
    import gzip
    import hashlib
    import re
    import uuid

    name = lambda p, u: f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{p} {u}').urn}>"
    safe = lambda u, p: re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", u or f"urn:page:{p}")
    http = HTTP.format(len(payload)).encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id, url)),
            ("WARC-Date", date), ("WARC-Target-URI", safe(url, page_id)),
            ("WARC-Payload-Digest", "sha1:" + base32_sha1(hashlib.sha1(payload).digest())),
            ("WARC-Block-Digest", "sha1:" + base32_sha1(hashlib.sha1(block).digest())),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
            ("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to, refers_url)),
                 ("WARC-Refers-To-Target-URI", safe(refers_url, refers_to)),
                 ("X-Refers-To-Page-Id", "" if refers_to is None else str(refers_to))]
    text = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", 6, mtime=0)


class Inflated:
    """Bytes of an archive, inflated as they are asked for; members follow each other without a seam."""

    def __init__(self, source):
        self.source, self.data, self.engine, self.rest = source, b"", None, b""

    def fill(self) -> bool:
        """Inflate one more chunk; False at the end of the archive."""
        import zlib
        while True:
            raw = self.rest or self.source.read(CHUNK)
            if not raw:
                if self.engine is not None:
                    raise ValueError("archive ends inside a gzip member")
                return False
            self.engine = self.engine or zlib.decompressobj(31)
            more = self.engine.decompress(raw, CHUNK)
            self.rest = self.engine.unconsumed_tail
            if self.engine.eof:
                self.rest, self.engine = self.engine.unused_data, None
            if more:
                self.data += more
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end."""
        while (at := self.data.find(mark)) < 0:
            if not self.fill():
                if self.data:
                    raise ValueError("archive ends inside a record header")
                return None
        out, self.data = self.data[:at + len(mark)], self.data[at + len(mark):]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.data and not self.fill():
                raise ValueError("archive ends inside a record block")
            own, self.data = self.data[:size], self.data[size:]
            size -= len(own)
            yield own


def read_records(source, keep_payload: bool = False) -> Iterator[dict]:
    """The records of one archive in order; raises ValueError where framing or a digest is wrong.

    Each is its header fields (names in lower case), and of responses
    ``payload_bytes``, ``payload_digest`` and, if asked for, ``payload``.
    """
    import hashlib
    stream = Inflated(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}
        block, payload, http, kept, size = hashlib.sha1(), hashlib.sha1(), b"", [], 0
        in_payload = False
        for piece in stream.take(int(fields["content-length"])):
            block.update(piece)
            if not in_payload:
                http += piece
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                in_payload, piece = True, http[at + 4:]
            payload.update(piece)
            size += len(piece)
            if keep_payload:
                kept.append(piece)
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} isn't framed by its Content-Length")
        whole = fields["warc-type"] == "response"
        for name, found in (("warc-block-digest", block), *([("warc-payload-digest", payload)] if whole else [])):
            if name in fields and fields[name] != "sha1:" + base32_sha1(found.digest()):
                raise ValueError(f"{name} of record {fields.get('warc-record-id')} doesn't match")
        if whole:
            fields |= {"payload_bytes": size, "payload_digest": base32_sha1(payload.digest())}
        yield fields | ({"payload": b"".join(kept)} if keep_payload else {})


# ---------------------------------------------------------------- Spark
def with_first_copies(pages: DataFrame, min_payload: int) -> DataFrame:
    """``page_id, url, html, revisit, first_id, first_url``: which rows repeat an earlier payload."""
    rows = pages.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    copies = (rows.select("sha", "size", "page_id", "url").filter(F.col("size") >= min_payload)
              .groupBy(F.col("sha").alias("of"))
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("first"),
                   F.count(F.lit(1)).alias("n")).filter("n > 1"))
    own = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    return (rows.join(copies, F.col("sha") == F.col("of"), "left")
            .select("page_id", "url", "html", (F.col("first").isNotNull() & ~own).alias("revisit"),
                    F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_payload: int = 0) -> DataFrame:
    """Write a record per page below ``folder``; returns ``path, records`` of the archives.

    Of pages with equal payloads of at least ``min_payload`` bytes the one with
    the smallest id (null ids last, then by url) is a response and the others
    revisit it; rows that repeat that id and url are responses too.  A null
    html is an empty payload.  Every task attempt writes files of its own and
    the returned table, which is written when all tasks have ended, names
    those of the attempts that counted: a lost executor leaves unread files only.
    """
    rows = with_first_copies(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                                          F.coalesce(F.col(html_col), F.lit("")).alias("html")), min_payload)

    def write(batches):
        import uuid

        import pyarrow as pa
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        out, path, count, size = None, "", 0, 0
        done = []
        for b in batches:
            for page, url, html, revisit, first, first_url in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path = f"{base}/part-{uuid.uuid4().hex}.warc.gz"
                    out, count, size = files.open_output_stream(path, compression=None), 0, 0
                raw = record(page, url, html.encode(), first, first_url, revisit)
                out.write(raw)
                count, size = count + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((path, count))
        if out is not None:
            out.close()
            done.append((path, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p.rsplit("/", 1)[1] for p, _ in done]), pa.array([n for _, n in done], pa.int64())],
                                             names=["path", "records"])

    return written(rows.mapInArrow(write, "path string, records long"), "archives")


def read_warc(archives: DataFrame, folder: str, keep_payload: bool = False) -> DataFrame:
    """A row per record of the archives named in ``path`` (an archive is read by one task, in order).

    ``page_id, target_uri, record_type, payload_bytes, payload_digest,
    refers_to`` and, if asked for, ``payload`` (null for revisits).
    """
    schema = ("page_id long, target_uri string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to long" + ", payload binary" * keep_payload)

    def read(batches):
        import pyarrow as pa
        files, base = open_folder(folder)
        number = lambda s: int(s) if s else None
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in schema.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for path in b.column("path").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{base}/{path}", compression=None) as source:
                    for f in read_records(source, keep_payload):
                        row = [number(f["x-page-id"]), f["warc-target-uri"], f["warc-type"],
                               f.get("payload_bytes", number(f["x-payload-length"])),
                               f.get("payload_digest", f["warc-payload-digest"].removeprefix("sha1:")),
                               number(f.get("x-refers-to-page-id"))]
                        if keep_payload:
                            row.append(f["payload"] if f["warc-type"] == "response" else None)
                            size += len(f["payload"])
                        rows.append(row)
                        if len(rows) >= 5000 or size >= 16 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the pages to archives (below ``spark.checkpoint.dir`` by default) and read them back."""
    import uuid
    folder = folder or scratch_path(pages.sparkSession, f"warc_{uuid.uuid4().hex[:12]}")
    return read_warc(write_warc(pages, folder, **options), folder)
