"""WARC archives compressed record by record with Zstandard and a shared dictionary.

An archive is an optional skippable frame (magic number 0x184D2A5D) with the dictionary, itself
plain or a Zstandard frame, and then one frame per record. A record is a header block, an empty
line, `Content-Length` bytes and two line ends.

Writing: pages of equal payload (by SHA-1 and length, `least` bytes or more) are one response, that
of the smallest page_id, and revisits that refer to it. Each task writes archives of about
`ARCHIVE_BYTES`, under a name of its own first, and renames them when they are whole, so a repeated
task replaces them. The dictionary is trained on the driver on a bounded sample: the first
`SAMPLE_CHARS` characters of about `SAMPLE_PAGES` payloads; if that is too little there is none.

Reading: Spark lists the archives; each is decoded frame by frame. Bad magic numbers, torn frames,
headers that are not WARC, missing or wrong lengths, wrong digests and missing ends raise ValueError.

Results in special cases: a null html is empty; of equal payloads rows without page_id come last,
and if no row has one all are responses; rows repeated with the smallest page_id are responses too;
a null url is left out of the header; an empty table writes no archives.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelake.llm import tables

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
ARCHIVE_BYTES = 16 << 20
SAMPLE_PAGES = 512
SAMPLE_CHARS = 4096
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
MANIFEST = "/_manifest"
DATE = "1970-01-01T00:00:00Z"       # pages carry no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; with refers_to it is a revisit, which has no payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; ValueError if it is not a whole WARC record."""
    head, end, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not end or not version.startswith(b"WARC/1."):
        raise ValueError("no WARC header")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"bad header line {line[:80]!r}")
        headers[name.decode().strip().lower()] = value.decode().strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"no {name}")
    if not headers["content-length"].isdigit():
        raise ValueError("bad content-length")
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("the block is not of its content-length")
    return headers, rest[:length]


def described(headers: dict[str, str], block: bytes) -> tuple:
    """The RECORDS columns of a response or revisit, its lengths and digest checked."""
    http, end, payload = block.partition(b"\r\n\r\n")
    lines = dict(line.lower().split(b": ", 1) for line in http.split(b"\r\n")[1:] if b": " in line)
    if not end or not lines.get(b"content-length", b"").isdigit():
        raise ValueError("no payload length")
    size, kind = int(lines[b"content-length"]), headers["warc-type"]
    own = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != own):
        raise ValueError("the payload does not have its length or digest")
    if kind == "revisit" and payload:
        raise ValueError("a revisit has a payload")
    return (page_of(headers["warc-record-id"]), size, own, kind,
            page_of(headers["warc-refers-to"]) if kind == "revisit" else None)


def page_of(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded records of an archive, one at a time."""
    at, dictionary, view = 0, None, memoryview(data)
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        own = bytes(view[8:8 + size])
        if len(own) != size:
            raise ValueError("torn dictionary frame")
        if own.startswith(FRAME_MAGIC):
            own = zstandard.ZstdDecompressor().decompress(own)
        dictionary, at = zstandard.ZstdCompressionDict(own), 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        if bytes(view[at:at + 4]) != FRAME_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            chunk = view[at:at + (16 << 10)]
            if not len(chunk):
                raise ValueError("torn frame")
            try:
                out.append(frame.decompress(chunk))
            except zstandard.ZstdError as error:
                raise ValueError(f"bad frame: {error}") from error
            at += len(chunk)
        at -= len(frame.unused_data)
        yield b"".join(out)


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of payloads; empty if there are too few."""
    count = pages.count()
    if not count:
        return b""
    grain = 1 << 30
    sample = (pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(grain))
                           < min(grain, -(-grain * SAMPLE_PAGES // count)))
              .select(F.substring("html", 1, SAMPLE_CHARS).alias("part")).filter("part <> ''")
              .limit(2 * SAMPLE_PAGES))
    parts = sorted(r["part"].encode() for r in sample.collect())
    if sum(map(len, parts)) < 8 * DICTIONARY_BYTES or len(parts) < 16:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()


def with_references(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the smallest page_id of equal payloads, for all others."""
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                          F.coalesce("html", F.lit("")).alias("html"))
    keyed = chosen.select("*", F.sha1("html").alias("payload"), F.octet_length("html").alias("size"))
    firsts = (keyed.filter(F.col("size") >= least).groupBy("payload", "size")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .filter(F.col("n") > 1).drop("n"))
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return (keyed.join(firsts, ["payload", "size"], "left")
            .select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to")))


def write(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write all pages as archives in `folder`, a place that Arrow and Spark both reach."""
    plain = train_dictionary(pages)
    where = tables.qualified(pages.sparkSession, folder)
    packed = zstandard.ZstdCompressor().compress(plain) if plain else b""
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed if plain else b""

    def run(batches):
        place, base = pafs.FileSystem.from_uri(where)
        place.create_dir(base)
        task = TaskContext.get()
        compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(plain) if plain else None)
        now, size, part = None, 0, 0

        def close():
            now.close()
            place.move(f"{base}/.{name()}", f"{base}/{name()}")
            return name()

        def name():
            return f"part-{task.taskAttemptId():08d}-{part:06d}.warc.zst"

        def listed(names):
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

        for batch in tables.slices(batches):
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "refers_to"))):
                if now is None:
                    now, size = place.open_output_stream(f"{base}/.{name()}", compression=None), len(lead)
                    now.write(lead)
                frame = compressor.compress(record(page, url, html.encode(), refers))
                now.write(frame)
                size += len(frame)
                if size >= ARCHIVE_BYTES:
                    yield listed([close()])
                    now, part = None, part + 1
        if now is not None:
            yield listed([close()])

    names = tables.map_arrow(with_references(pages, least), run, "name string")
    names.write.parquet(folder + MANIFEST)


def read(spark: SparkSession, folder: str, manifest: bool = True) -> DataFrame:
    """The RECORDS columns of all records of the archives in `folder`: those of its manifest (one
    short name per archive), or for archives from elsewhere all."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    target = tables.arrow_schema(RECORDS)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for data in frames(content.as_py()):
                    rows.append(described(*parse(data)))
                    if len(rows) == 10_000:
                        yield tables.as_batch(dict(zip(names, zip(*rows))), target)
                        rows = []
                if rows:
                    yield tables.as_batch(dict(zip(names, zip(*rows))), target)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    if manifest:
        listed = spark.read.schema("name string").parquet(folder + MANIFEST)
        archives = archives.join(tables.small(listed, 128), F.element_at(F.split("path", "/"), -1)
                                 == F.col("name"), "left_semi")
    return tables.map_arrow(archives.select("content"), run, RECORDS)
