"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame for each record.

Writing: each task packs its pages into archives of bounded size. An archive begins with a skippable frame that holds
a dictionary, trained on the first ``sample`` payloads of that archive, then has a frame with checksum and size for each
record. Of records with equal payloads of at least ``least`` bytes the one with the smallest page id is a response and
the others revisit it; smaller ones are responses. Reading: the dictionary is loaded from the leading frame, frames are
decoded one by one, and each record's version, mandatory headers, block length, digests and end are held against what
it says; a frame must hold exactly one record.

Archives are written in the shared folder, each attempt's under names of its own and renamed when whole; the list, which is
committed with one attempt of each task, names what is read, so retried and doubled tasks do no harm.
The first page of a payload is found by an aggregate on digests, so a payload that very many pages share is one row; the
join back is one that adaptive execution can split.

Defined results: a null html is an empty payload; pages with equal ids are records of their own, and equal payloads
under one id don't revisit one another; a null id is written as an empty header and read back as null, is never
referred to while there is another, and a null url is written as ``urn:page``. An empty table has no archive.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexsite.llm._shared import open_fs, partitions, shared_dir

DICTIONARY, SKIPPABLE = 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class DamagedArchive(ValueError):
    pass


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC 1.1 record, response or revisit, with an HTTP block."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    safe = "".join(c for c in (url or "urn:page") if c not in "\r\n")
    name = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {safe}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-ID: {name}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes], samples: list[bytes], *, level: int = 3, dictionary_bytes: int = 32 << 10) -> bytes:
    import zstandard

    try:
        trained = zstandard.train_dictionary(dictionary_bytes, samples)
    except (zstandard.ZstdError, ValueError):  # too few or too small samples
        trained = None
    out = []
    if trained is not None:
        raw = trained.as_bytes()
        out.append(struct.pack("<II", DICTIONARY, len(raw)) + raw)
    press = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
    return b"".join([*out, *map(press.compress, records)])


def frames(raw: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive."""
    import zstandard

    view, at, trained = memoryview(raw), 0, None
    while at + 8 <= len(raw):
        magic, size = struct.unpack_from("<II", raw, at)
        if magic not in SKIPPABLE:
            break
        if at + 8 + size > len(raw):
            raise DamagedArchive("a skippable frame is cut off")
        if magic == DICTIONARY and at == 0:
            body = raw[8 : 8 + size]
            if body[:4] == b"\x28\xb5\x2f\xfd":  # a dictionary may itself be compressed
                body = zstandard.ZstdDecompressor().decompress(body)
            trained = zstandard.ZstdCompressionDict(body)
        at += 8 + size
    press = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(raw):
        one, out = press.decompressobj(), []
        try:
            while not one.eof:
                if at >= len(raw):
                    raise DamagedArchive("a frame is cut off")
                step = min(len(raw) - at, 16 << 10)
                out.append(one.decompress(view[at : at + step]))
                at += step
            at -= len(one.unused_data)
        except zstandard.ZstdError as e:
            raise DamagedArchive(str(e)) from e
        yield b"".join(out)


def parse(raw: bytes) -> dict:
    """Headers and payload facts of one record; DamagedArchive if it isn't what it says."""
    head, split, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not split or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise DamagedArchive("no WARC version")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise DamagedArchive(f"a header without colon: {line[:40]}")
        fields[name.strip().lower()] = value.strip()
    missing = [x for x in ("warc-type", "warc-record-id", "warc-date", "content-length") if x not in fields]
    if missing:
        raise DamagedArchive(f"no {missing[0]}")
    if not fields["content-length"].isdigit() or len(rest) != (n := int(fields["content-length"])) + 4 or rest[n:] != b"\r\n\r\n":
        raise DamagedArchive("the length differs")
    block = rest[:n]
    if fields.get("warc-block-digest", "").removeprefix("sha256:") != hashlib.sha256(block).hexdigest():
        raise DamagedArchive("the block's digest differs")
    http, split, payload = block.partition(b"\r\n\r\n")
    lengths = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not split or len(lengths) != 1 or not lengths[0].isdigit():
        raise DamagedArchive("no HTTP length")
    size, digest, kind = int(lengths[0]), fields.get("warc-payload-digest", "").removeprefix("sha256:"), fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise DamagedArchive("the payload differs")
    if kind == "revisit" and (payload or "x-refers-to-page-id" not in fields):
        raise DamagedArchive("a revisit without target")
    if kind not in ("response", "revisit"):
        raise DamagedArchive(f"type {kind}")
    number = lambda x: int(x) if x else None
    return {"page_id": number(fields.get("x-page-id")), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number(fields.get("x-refers-to-page-id")), "url": fields.get("warc-target-uri"), "payload": payload}


def write_archives(pages: DataFrame, folder: str, *, page: str = "page_id", url: str = "url", html: str = "html", least: int = 100, archive_bytes: int = 24 << 20, sample: int = 200) -> DataFrame:
    """Write the archives and give their list: file, records."""
    source = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    keyed = source.withColumn("digest", F.sha2("payload", 256))
    first = keyed.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    marked = keyed.join(first, "digest", "left").select("page_id", "url", "payload", F.when(F.col("first") != F.col("page_id"), F.col("first")).when(F.col("page_id").isNull(), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, at = open_fs(folder)
        fs.create_dir(at, recursive=True)
        part, made = TaskContext.get().partitionId(), 0
        records: list[bytes] = []
        samples: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal records, samples, size, made
            name = f"pages-{part:07d}-{made:05d}-{uuid.uuid4().hex[:12]}.warc.zst"
            own = f"{at}/.{name}"
            with fs.open_output_stream(own, compression=None) as out:
                out.write(archive(records, samples))
            fs.move(own, f"{at}/{name}")
            n = len(records)
            records, samples, size, made = [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "records"])

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for page_id, address, payload, refers in zip(*[c.slice(a, 256).to_pylist() for c in batch.columns], strict=True):
                    records.append(record(page_id, address, payload, refers))
                    size += len(records[-1])
                    if len(samples) < sample and payload:
                        samples.append(payload[: 64 << 10])
                    if size >= archive_bytes:
                        yield flush()
        if records:
            yield flush()

    from hexsite.llm._shared import stored

    return stored(marked.mapInArrow(run, "file string, records long"), "warc-list")


def read_archives(listed: DataFrame, folder: str, *, payloads: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (and url, payload) of each record of the archives."""
    fields = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if payloads:
        fields |= {"url": pa.string(), "payload": pa.binary()}
        ddl += ", url string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = open_fs(folder)
        for batch in batches:
            for file, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_stream(f"{at}/{file}", compression=None) as f:
                    raw = f.read()
                out, seen = [], 0
                for one in frames(raw):
                    out.append(parse(one))
                    seen += 1
                    if len(out) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in fields.items()], names=list(fields))
                        out = []
                if seen != n:
                    raise DamagedArchive(f"{file} has {seen} of {n} records")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in fields.items()], names=list(fields))

    return listed.select("file", "records").repartition(partitions(listed.count())).mapInArrow(run, ddl)


def op4(pages: DataFrame) -> DataFrame:
    folder = shared_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
