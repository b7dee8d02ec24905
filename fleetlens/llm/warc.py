"""WARC archives: written by partition, read back record by record, segments put together.

A page is a response record, or a revisit of the response with the same payload. A block longer than a
segment is cut: the first record has segment number 1, continuation records name it as their origin,
the last one gives the total length. On reading, continuation records are grouped by origin, ordered by
segment number, checked for gaps and against the total length; then the chunked transfer framing
of the HTTP block is decoded. Records that were never cut need no grouping and no shuffle.

Archives are gzip files of one member a record, of bounded size, under names that follow from the partition,
moved into place when whole: a task that runs again writes the same files again.

Defined results: a null page is an empty payload; payloads of under 100 bytes are never revisits; of
equal pages the least page_id (then the least place) is the response; a null page_id comes last;
a record with a missing segment or a wrong length comes back with ``complete`` false and without
payload; an empty table gives no archives and no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import shared_folder, ship, stored, with_locator

#: Bytes of a block in one record; bytes of a chunk; bytes of records in one archive.
SEGMENT, CHUNK, ARCHIVE = 16_384, 4_096, 32_000_000
#: Bytes of an archive that are opened at a time.
STEP = 8_192
#: Payloads from this size on are written once.
REVISIT_FROM = 100

_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD = (
    "record_id string, type string, target string, page_id long, digest string, refers_to string, "
    "origin string, segment int, total long, block binary"
)


def _record(kind: str, record_id: str, block: bytes, **fields: str | None) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}"]
    head += [f"WARC-{name.replace('_', '-')}: {value}" for name, value in fields.items() if value is not None]
    head.append(f"Content-Length: {len(block)}")
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def chunked(payload: bytes) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[i : i + CHUNK] for i in range(0, len(payload), CHUNK)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of chunked framing; None if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        at = line + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP block."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _page_records(page_id, tag, url, payload, digest, first_id, first_tag) -> list[bytes]:
    record_id = f"urn:page:{'' if page_id is None else page_id}:{tag}"
    target = None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")
    named = f"sha256:{digest}"
    if first_tag is not None and (first_id, first_tag) != (page_id, tag):
        origin = f"<urn:page:{first_id}:{first_tag}>"
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [
            _record(
                "revisit", record_id, b"", Target_URI=target, Payload_Digest=named, Refers_To=origin, Profile=profile
            )
        ]
    block = _HTTP + chunked(payload)
    if len(block) <= SEGMENT:
        return [_record("response", record_id, block, Target_URI=target, Payload_Digest=named)]
    cuts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    records = [
        _record("response", record_id, cuts[0], Target_URI=target, Payload_Digest=named, Segment_Number="1")
    ]
    for k, part in enumerate(cuts[1:], 2):
        total = str(len(block)) if k == len(cuts) else None
        records.append(
            _record(
                "continuation",
                f"{record_id}:{k}",
                part,
                Target_URI=target,
                Segment_Number=str(k),
                Segment_Origin_ID=f"<{record_id}>",
                Segment_Total_Length=total,
            )
        )
    return records


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; returns name, records, bytes of each."""
    spark = pages.sparkSession
    ship(spark)
    located = with_locator(pages, f"{folder}-pages")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = located.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.hex(F.xxhash64("_file", "_row")).alias("tag"),
        "url",
        payload.alias("html"),
        F.sha2(payload, 256).alias("digest"),
    )
    groups = (
        rows.filter(F.octet_length("html") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "tag")).alias("first"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter("n > 1")
    )
    # Of payloads that occur once nothing has to be known; the groups of copies are few or joined by shuffle.
    copies = stored(
        groups.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.tag").alias("first_tag")),
        f"{folder}-copies",
    )

    def write(batches):
        part, k, size, records = TaskContext.get().partitionId(), 0, 0, 0
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out = None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                page_id, tag, url, html, digest, first_id, first_tag = row
                for record in _page_records(page_id, tag, url, html.encode(), digest, first_id, first_tag):
                    if out is None:
                        name = f"part-{part:05d}-{k:04d}.warc.gz"
                        draft = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}"
                        out, size, records = store.open_output_stream(draft), 0, 0
                    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                    out.write(packer.compress(record) + packer.flush())
                    size += len(record)
                    records += 1
                if size >= ARCHIVE:
                    out.close()
                    store.move(draft, f"{root}/{name}")
                    yield _made(name, records, size)
                    out, k = None, k + 1
        if out is not None:
            out.close()
            store.move(draft, f"{root}/{name}")
            yield _made(name, records, size)

    joined = rows.join(copies, "digest", "left").select(
        "page_id", "tag", "url", "html", "digest", "first_id", "first_tag"
    )
    return stored(joined.mapInArrow(write, "name string, records long, bytes long"), f"{folder}-written")


def _made(name: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())],
        names=["name", "records", "bytes"],
    )


def _members(content: memoryview):
    """The gzip members of an archive, one after the other."""
    at, size = 0, len(content)
    while at < size:
        opener, parts = zlib.decompressobj(31), []
        # A small step at a time: what a member leaves unread is copied by the library.
        while not opener.eof and at < size:
            step = content[at : at + STEP]
            parts.append(opener.decompress(step))
            at += len(step) - len(opener.unused_data)
        yield b"".join(parts)


def parse_record(raw: bytes) -> tuple:
    """The fields of RECORD of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    record_id = fields["warc-record-id"].strip("<>")
    digest = fields.get("warc-payload-digest")
    origin, refers = fields.get("warc-segment-origin-id"), fields.get("warc-refers-to")
    page = record_id.split(":")[2] if record_id.startswith("urn:page:") else ""
    number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
    return (
        record_id,
        fields["warc-type"],
        fields.get("warc-target-uri"),
        int(page) if page else None,
        digest.partition(":")[2] if digest else None,
        refers.strip("<>") if refers else None,
        origin.strip("<>") if origin else None,
        int(number) if number else None,
        int(total) if total else None,
        rest[: int(fields["content-length"])],
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives of a folder, see RECORD."""
    ship(spark)

    def read(batches):
        kinds = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 3 + [pa.int32(), pa.int64(), pa.binary()]
        names = [part.split()[0] for part in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                found, size = [], 0
                for raw in _members(memoryview(content.as_buffer())):
                    found.append(parse_record(raw))
                    size += len(raw)
                    if size >= 4_000_000:
                        yield _batch(found, kinds, names)
                        found, size = [], 0
                if found:
                    yield _batch(found, kinds, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInArrow(read, RECORD)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def assemble(records: DataFrame) -> DataFrame:
    """(record_id, type, target, page_id, digest, refers_to, complete, payload) of every whole record.

    ``records`` is read twice, once for the records that were never cut and once for the segments.
    """

    def decode(batches):
        for batch in batches:
            payloads = [None if b is None else payload_of(b) for b in batch.column(6).to_pylist()]
            kept = [batch.column(i) for i in range(6)]
            known = [p is not None or t == "revisit" for p, t in zip(payloads, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(known, pa.bool_()), pa.array(payloads, pa.binary())],
                names=["record_id", "type", "target", "page_id", "digest", "refers_to", "complete", "payload"],
            )

    fields = ["record_id", "type", "target", "page_id", "digest", "refers_to"]
    whole = records.filter("segment is null").select(*fields, "block")
    parts = records.filter("segment is not null").withColumn("origin", F.coalesce("origin", "record_id"))
    grouped = parts.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name) for name in fields[1:]],
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    block = F.aggregate("parts", F.unhex(F.lit("")), lambda done, p: F.concat(done, p["block"]))
    sound = (numbers == F.sequence(F.lit(1), F.size("parts"))) & F.col("total").isNotNull()
    joined = grouped.withColumn("block", F.when(sound, block)).select(
        F.col("origin").alias("record_id"),
        *fields[1:],
        F.when(F.octet_length("block") == F.col("total"), F.col("block")).alias("block"),
    )
    schema = (
        "record_id string, type string, target string, page_id long, digest string, refers_to string, "
        "complete boolean, payload binary"
    )
    return whole.unionByName(joined).mapInArrow(decode, schema)


def page_records(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives and read them back, one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to. The digest of a response is taken of
    the payload that was read; a revisit has the digest of its record and the length of the response it names.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write_archives(pages, f"{folder}/archives")
    whole = stored(
        assemble(read_records(spark, f"{folder}/archives")).select(
            "record_id",
            "page_id",
            "type",
            "refers_to",
            F.octet_length("payload").cast("long").alias("n"),
            F.when(F.col("type") == "revisit", F.col("digest")).otherwise(F.sha2("payload", 256)).alias("digest"),
        ),
        f"{folder}/read",
    )
    responses = whole.filter("type <> 'revisit'")
    named = responses.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("response"), F.col("n").alias("length")
    )
    revisits = whole.filter("type = 'revisit'").join(named, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(
        "page_id", "n", "digest", "type", F.lit(None).cast("long")
    ).toDF(*columns).unionAll(revisits.select("page_id", "length", "digest", "type", "response").toDF(*columns))
