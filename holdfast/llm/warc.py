"""WARC archives: written from pages, read back by byte ranges.

Writing gives one gzip member per record, many records per file. Tasks write files
under names of their own into the shared folder and return a manifest; only files of
the written manifest are read, so files of lost or repeated tasks are never seen.

Reading splits files into byte ranges, each a task of its own. A task looks for the
gzip magic from the start of its range, and takes a place as a record only if the
member decodes to a WARC header, ends well, and is followed by another member or the
end of the file. It owns the records that start inside its range, and reads past its
end to finish the last one.

Payloads that repeat are stored once: later records of the same payload are revisits
that name the first. The file system is found from the folder's address by pyarrow.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.words import map_rows
from holdfast.session import materialize, shared_folder

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 << 20
FILE_BYTES = 256 << 20
REVISIT_BYTES = 100
DATE = "2000-01-01T00:00:00Z"
_READ = 1 << 20


def file_system(address: str):
    """(pyarrow file system, path) of an address; a bare path is a local one."""
    from pyarrow import fs

    if "://" not in address:
        address = "file://" + (address.removeprefix("file:") if address.startswith("file:") else address)
    return fs.FileSystem.from_uri(address)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _line(value: str) -> str:
    """A header value on one line: line ends and percent signs are escaped."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def encode(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    """One record as a gzip member of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    data = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def decode(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC fields in lower case, HTTP header, HTTP body) of a decoded member."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.removeprefix(" ")
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return fields, http, body


class Buffer:
    """Bytes of an open file by place, through one buffer."""

    def __init__(self, file, size: int):
        self.file, self.size, self.low, self.held = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if not self.low <= at <= at + n <= self.low + len(self.held):
            self.file.seek(at)
            self.low, self.held = at, self.file.read(min(max(n, _READ), self.size - at))
        return self.held[at - self.low : at - self.low + n]


def member_at(window: Buffer, at: int) -> tuple[bytes, int] | None:
    """Decoded bytes and end of the record that starts at ``at``; None if none does."""
    z, out, pos, known, step = zlib.decompressobj(31), [], at, False, 1 << 13
    try:
        while not z.eof:
            chunk = window.get(pos, step)
            if not chunk:
                return None
            pos, step = pos + len(chunk), min(2 * step, _READ)
            out.append(z.decompress(chunk))
            if not known and (len(out) > 1 or len(out[0]) >= 7):
                if not b"".join(out).startswith(b"WARC/1.") and sum(map(len, out)) >= 7:
                    return None
                known = sum(map(len, out)) >= 7
    except zlib.error:
        return None
    end = pos - len(z.unused_data)
    if not known or (end < window.size and window.get(end, 3) != MAGIC):
        return None
    return b"".join(out), end


def records_in(file, size: int, low: int, high: int):
    """Decoded records that start in [low, high)."""
    window, at = Buffer(file, size), low
    while at < high:
        part = window.get(at, 1 << 13)
        hit = part.find(MAGIC)
        if hit < 0:
            if len(part) < 3:
                return
            at += len(part) - 2
            continue
        at += hit
        if at >= high:
            return
        found = member_at(window, at)
        if found is None:
            at += 1
            continue
        yield found[0]
        at = found[1]


def prepared(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, and what each refers to (null unless a revisit)."""
    typed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    typed = typed.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html"))
    long = typed.where(F.col("bytes") >= REVISIT_BYTES).select("page_id", "digest")
    leaders = materialize(
        long.groupBy("digest").agg(F.min("page_id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    later = materialize(
        long.join(leaders, "digest").where("leader is not null and not page_id <=> leader").distinct()
    )
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    met = typed.withColumn("_key", key).join(
        later.select(key.alias("_key"), "digest", "leader"), ["_key", "digest"], "left"
    )
    # rows equal in id and payload: the first of them stands for all
    turn = F.row_number().over(Window.partitionBy("_key", "digest").orderBy("url"))
    again = (turn > 1) & (F.col("bytes") >= REVISIT_BYTES)
    return met.withColumn("revisit", F.col("leader").isNotNull() | again).withColumn(
        "refers_to", F.when(F.col("revisit"), F.coalesce("leader", "page_id"))
    ).select("page_id", "url", "html", "digest", "revisit", "refers_to")


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as archives into ``folder``; the written manifest (path, size)."""

    def run(rows):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out, path, size = None, None, 0
        for page_id, url, html, digest, revisit, refers_to in rows:
            if out is None:
                path, size = f"{base}/part-{uuid.uuid4().hex}.warc.gz", 0
                out = fs.open_output_stream(path, compression=None)
            member = encode(page_id, url, html.encode("utf-8", "surrogatepass"), digest, revisit, refers_to)
            out.write(member)
            size += len(member)
            if size >= FILE_BYTES:
                out.close()
                yield path, size
                out = None
        if out is not None:
            out.close()
            yield path, size

    return materialize(map_rows(prepared(pages), run, "path string, size long"))


def read(manifest: DataFrame, folder: str, payload: bool = True, split: int = SPLIT_BYTES) -> DataFrame:
    """Records of the files listed in ``manifest``, wherever their bytes are split.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to, and with
    ``payload`` the body (null for revisits). Size and digest of a response are worked out
    from its body, those of a revisit are what its header says of the full payload.
    """
    lows = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long"))
    ranges = manifest.select("path", "size", F.explode(lows).alias("low"))

    def run(rows):
        fs, _ = file_system(folder)
        for path, size, low in rows:
            with fs.open_input_file(path) as file:
                for data in records_in(file, size, low, min(size, low + split)):
                    fields, http, body = decode(data)
                    revisit = fields["warc-type"] == "revisit"
                    if revisit:
                        n = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        digest = fields["warc-payload-digest"].partition(":")[2]
                    else:
                        n, digest = len(body), hashlib.sha256(body).hexdigest()
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    url = fields.get("warc-target-uri")
                    yield (
                        int(page) if page else None,
                        _unline(url) if url is not None else None,
                        n,
                        digest,
                        fields["warc-type"],
                        int(refers) if refers else None,
                    ) + ((None if revisit else body,) if payload else ())

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    parts = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return map_rows(ranges.repartition(parts, "path", "low"), run, schema + (", payload binary" if payload else ""))


def round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """Write pages as archives and read the archives back; one row per page.

    Missing html is an empty payload. Of equal payloads of at least 100 bytes the
    smallest page_id is the response; a missing page_id is largest, and among rows equal
    in id and payload one stands for the others. No pages give no files and no rows.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read(write(pages, folder), folder, payload)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p
), f AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS turn,
         min(page_id) OVER (PARTITION BY payload_digest) AS leader FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN turn > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN turn > 1 AND payload_bytes >= 100 THEN leader END AS refers_to
FROM f
"""
