"""A deterministic sharded WARC writer, and the reader of its archives.

Pages are dealt to shards by ranges of their id (cells of a grid; cells with too many bytes are cut
again), so names, order and bytes of the archives follow from the data alone. A task writes
its shards in id order, one gzip member a record, and begins a new file once the current one
has ``file_bytes``. A file is written under a temporary name and renamed when complete; the
manifest, one row per file, is committed by Spark when all tasks are done, and the reader
follows it alone. A task that runs again writes the same bytes under the same names.

Of records with equal payloads the one with the smallest id is the response, the others revisit
it. Only ids and digests are shuffled to find them.

Defined cases: a null payload is empty; a null url leaves out its header; pages without an id
are in shards of their own behind the others, by their digest, and such a page is a response unless a page with an id has its payload; of repeated
ids with equal payloads the first in the order of url is the response; an empty table gives no
archive and an empty result. Ids are whole numbers. A payload of any length is one record, held
in memory whole; columns of the caller other than id, url and payload are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.llm.common import filled, quoted
from tideload.operators.ranged import interval_of
from tideload.session import staged

# Names and forms of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-record:"
HTTP_TYPE = "application/http;msgtype=response"

CELLS = 4096
# Tasks that read archives back.
MOST_TASKS = 20_000
MANIFEST = "file string, shard long, n_records long, n_bytes long, first_id long, last_id long, sha1 string"
RECORDS = (
    "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, date: str, fields: list[tuple[str, str]], content_type: str, block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *fields]
    head += [
        ("WARC-Block-Digest", "sha1:" + payload_digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """The record of one page; a revisit keeps the headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = []
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    if refers_to is None:
        return _record("response", f"{RECORD_URN}{page_id}", date, fields, HTTP_TYPE, http + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_URN}{refers_to}>")]
    return _record("revisit", f"{RECORD_URN}{page_id}", date, fields, HTTP_TYPE, http)


class _Archive:
    """One archive file being written under a temporary name."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, number: int, date: str, level: int):
        self.store, self.folder, self.shard, self.level = store, folder, shard, level
        self.name = f"shard-{shard:08d}-{number:05d}.warc.gz"
        self.temporary = f"{folder}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(self.temporary, compression=None)
        self.records, self.bytes, self.ids, self.sha1 = 0, 0, [], hashlib.sha1()
        info = f"software: tideload\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        self._put(_record("warcinfo", f"{RECORD_URN}info:{self.name}", date, [], "application/warc-fields", info))

    def _put(self, record: bytes) -> None:
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.out.write(member)
        self.sha1.update(member)
        self.bytes += len(member)

    def add(self, page_id: int | None, record: bytes) -> None:
        self._put(record)
        self.records += 1
        if page_id is not None:
            self.ids = [self.ids[0] if self.ids else page_id, page_id]

    def commit(self) -> tuple:
        """Give the file its name; its row of the manifest."""
        self.out.close()
        final = f"{self.folder}/{self.name}"
        if self.store.get_file_info(final).type != fs.FileType.NotFound:
            self.store.delete_file(final)  # left by a run of this task that was lost; the bytes are the same
        self.store.move(self.temporary, final)
        first, last = self.ids or (None, None)
        return self.name, self.shard, self.records, self.bytes, first, last, self.sha1.hexdigest()


def _cuts(rows: DataFrame, shard_bytes: int) -> list[int]:
    """The ids, ascending, at which shards after the first begin, so that each has about ``shard_bytes``.

    The range of ids is cut into a grid; cells with more bytes than a shard are cut again, so that it
    matters not how the ids lie. What follows from the data alone is the same in every run.
    """
    span = rows.agg(F.min("id"), F.max("id"), F.sum("size")).first()
    if span[0] is None:
        return []
    open_ranges, cells = [(span[0], span[1] + 1, span[2])], []
    while open_ranges:
        # First id and width of the cells of each open range: in all no more than a few per shard, at least CELLS.
        grids = []
        for low, end, size in open_ranges:
            count = max(CELLS // len(open_ranges), 16 * -(-size // shard_bytes))
            grids.append((low, end, max(1, -(-(end - low) // count))))
        bounds = F.array(*[F.lit(g[0]) for g in grids])
        at = interval_of(F.col("id"), bounds, len(grids)) - 1
        cell = [F.get(F.array(*[F.lit(g[i]) for g in grids]), at) for i in range(3)]
        number = F.floor((F.col("id") - cell[0]) / cell[2])
        inside = rows.where((at >= 0) & (F.col("id") < cell[1])).groupBy(at.alias("grid"), number.alias("cell"))
        open_ranges = []
        for r in inside.agg(F.sum("size").alias("size")).collect():
            low, end, width = grids[r.grid]
            begin = low + r.cell * width
            found = (begin, min(begin + width, end), r["size"])
            if r["size"] > shard_bytes and found[1] - begin > 1:
                open_ranges.append(found)
            else:
                cells.append(found)
        open_ranges.sort()
    cuts, filled_bytes = [], 0
    for low, _, size in sorted(cells):
        if filled_bytes and filled_bytes + size > shard_bytes:
            cuts.append(low)
            filled_bytes = 0
        filled_bytes += size
    return cuts


def _with_shards(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """Add ``shard``, ascending with ``id``, rows without an id last, by their digest; and the number of shards."""
    sizes = staged(rows.select("id", "size"), "sizes")
    cuts = _cuts(sizes.where("id IS NOT NULL"), shard_bytes)
    nameless = sizes.where("id IS NULL").agg(F.sum("size"), F.count(F.lit(1))).first()
    # One row: a cut per shard.
    bounds = rows.sparkSession.createDataFrame([(cuts,)], "cuts array<long>").scalar()
    by_id = interval_of(F.col("id"), F.col("__llm_cuts"), max(len(cuts), 1))
    shards, extra = len(cuts) + 1, -(-(nameless[0] or 0) // shard_bytes) or min(nameless[1], 1)
    by_digest = F.lit(shards) + F.pmod(F.xxhash64("digest"), F.lit(max(extra, 1)))
    dealt = rows.withColumn("__llm_cuts", bounds)
    dealt = dealt.withColumn("shard", F.when(F.col("id").isNull(), by_digest).otherwise(by_id.cast("long")))
    return dealt.drop("__llm_cuts"), shards + extra


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    shard_bytes: int = 16 << 20,
    file_bytes: int = 8 << 20,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 6,
) -> DataFrame:
    """Write one record per page below ``path`` (a store all executors reach) and return the manifest.

    ``min_bytes``: smaller payloads are always responses. ``shard_bytes``: payload bytes of a
    shard, about; ``file_bytes``: compressed bytes after which a shard begins a new file.
    """
    spark = pages.sparkSession
    rows = pages.select(
        quoted(id_col).cast("long").alias("id"), quoted(url_col).cast("string").alias("url"), filled(quoted(payload_col)).alias("payload")
    ).withColumns({"size": F.octet_length("payload"), "digest": F.sha1(F.col("payload").cast("binary"))})
    repeated = (
        rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("id").alias("holder"), F.count(F.lit(1)).alias("n"))
    )
    # Written, so that its size is known when the join with the payloads is planned.
    repeated = staged(repeated.where("n > 1").select("digest", "holder"), "repeated-payloads")
    rows = rows.join(repeated, "digest", "left")
    dealt, shards = _with_shards(rows, shard_bytes)
    ordered = dealt.repartitionByRange(shards, "shard").sortWithinPartitions(
        "shard", F.col("id").asc_nulls_last(), F.col("url").asc_nulls_first(), "payload"
    )
    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(f"{folder}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        archive, number = None, 0
        last_id, seen = None, set()

        def manifest(rows: list[tuple]) -> pa.RecordBatch:
            names = [f.split()[0] for f in MANIFEST.split(", ")]
            kinds = [pa.string() if f.endswith(" string") else pa.int64() for f in MANIFEST.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "url", "payload", "holder", "shard")]
            for scalars in zip(*columns, strict=True):
                page_id, url, payload, holder, shard = (x.as_py() for x in scalars)
                payload = payload.encode()
                if page_id != last_id:
                    last_id, seen = page_id, set()
                refers = holder
                if holder is not None and page_id == holder:
                    # The response itself, and after it rows that repeat it.
                    mark = payload_digest(payload)
                    refers = holder if mark in seen else None
                    seen.add(mark)
                if archive and (archive.shard != shard or archive.bytes >= file_bytes):
                    number = number + 1 if archive.shard == shard else 0
                    yield manifest([archive.commit()])
                    archive = None
                if archive is None:
                    archive = _Archive(store, folder, shard, number, date, level)
                archive.add(page_id, page_record(page_id, url, payload, refers, date))
        if archive:
            yield manifest([archive.commit()])

    ordered.select("id", "url", "payload", "holder", "shard").mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(
        f"{path}/_manifest"
    )
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line != VERSION:
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name.lower()] = value
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        if head["warc-block-digest"] != "sha1:" + payload_digest(block):
            raise ValueError(f"digest of {head['warc-record-id']} differs")
        yield head, block


def _id_of(urn: str) -> int | None:
    text = urn.strip("<>").removeprefix(RECORD_URN)
    return None if text == "None" else int(text)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per page record of the archives the manifest names, digests checked."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").select("file")
    count = files.count()
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.string(), pa.binary(), pa.int64()]
    kinds = [kinds[0] if f.endswith("string") else kinds[1] if f.endswith("binary") else kinds[2] for f in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            for name in batch.column(0):
                rows, held = [], 0
                with store.open_input_stream(f"{folder}/{name.as_py()}", compression=None) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw))
                    for head, block in records(stream):
                        if head["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if head["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
                            raise ValueError(f"payload of {head['warc-record-id']} differs")
                        refers = _id_of(head["warc-refers-to"]) if "warc-refers-to" in head else None
                        kept = payload if with_payload and head["warc-type"] == "response" else None
                        rows.append(
                            (_id_of(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], refers, size, digest, kept)
                        )
                        held += len(kept or b"") + 200
                        if held > 8 << 20:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    # A task a file: the names are few bytes, so the session would put them all into one.
    return files.repartition(min(max(count, 1), MOST_TASKS)).mapInArrow(run, RECORDS)
