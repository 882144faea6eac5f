"""WARC archives: written in deterministic sorted shards, read back with digests checked.

Records are dealt into key ranges and sorted; a task writes one range as gzip
members, one per record, and begins a new file once the compressed size passes
``roll_bytes``.  Headers, record ids and digests are made from the payload, so
the same rows give the same bytes.  Files are written under temporary names,
listed, moved and published by a manifest (see ``shards``).

Which records are responses and which revisit an earlier equal payload is
decided on digests alone: only (page, digest) pairs are grouped and joined, and
what they say meets the payload where both are sorted by key, so payloads are
shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import col, materialise
from snaplake.llm.shards import commit, in_shards, open_store, qualified, read_files, split_points, temporary_name
from snaplake.session import scratch_path

#: Compressed bytes after which a file is closed, and the WARC-Date of all records (a parameter: no clock is read).
ROLL_BYTES, DATE = 64 << 20, "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-record")


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, is_response: bool, date: str = DATE) -> bytes:
    """One record's bytes: a response with an HTTP block, or a revisit without a payload."""
    digest = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_response else http
    # a header value is one line: anything that could end it is percent-encoded
    target = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")
    name = uuid.uuid5(_SPACE, f"{page} {digest} {'response' if is_response else 'revisit'}")
    head = ["WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target or 'about:blank'}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{digest32(block)}", f"Page-ID: {'' if page is None else page}", f"Payload-Length: {len(payload)}"]
    if not is_response:
        first = uuid.uuid5(_SPACE, f"{refers_to} {digest} response")
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{first}>",
                 f"Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without a time stamp."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def members(stream, block: int = 1 << 18) -> Iterator[bytes]:
    """The members of a gzip stream, one at a time."""
    rest, unpack, parts = b"", zlib.decompressobj(31), []
    while chunk := rest or stream.read(block):
        parts.append(unpack.decompress(chunk))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("a gzip member is cut off")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; lengths and digests must hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = rest[:int(fields["Content-Length"])]
    if first != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest32(block)}":
        raise ValueError("a record does not match its headers")
    return fields, block


def _first_of_equals(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page, digest, first): for payloads that occur more than once, the smallest page that has them."""
    keys = materialise(pages.select("page", F.unhex(F.sha1("payload")).alias("digest"), F.octet_length("payload").alias("size")),
                       "warc-digests").filter(F.col("size") >= min_bytes)
    # a NULL id comes first in the files, so it is the smallest
    groups = materialise(keys.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page")).alias("first"))
                         .filter("n > 1").select("digest", F.col("first.page").alias("first")), "warc-equals")
    return (keys.join(groups, "digest")
            .select("page", "digest", "first").distinct())


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, roll_bytes: int = ROLL_BYTES, records_per_shard: int = 4096, level: int = 6,
               date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` under ``root`` (a folder that all executors share); gives the manifest.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with
    the smallest id is a response, the others revisit it; of rows with that
    very id, the first.  NULL payloads are empty, NULL ids come first, a NULL
    URL is ``about:blank``.  Repeated rows have a record each.  An empty table
    gives a manifest without rows.
    """
    root = qualified(pages.sparkSession, root)
    payload = F.coalesce(col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(col(id_col).cast("long").alias("page"), col(url_col).cast("string").alias("url"), payload.alias("payload"))
    points = split_points(rows, "page", max(1, -(-rows.count() // records_per_shard)))
    known = _first_of_equals(rows, min_bytes).select(
        "page", F.lit(0).alias("kind"), "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "first")
    both = known.unionByName(rows.select("page", F.lit(1).alias("kind"), F.unhex(F.sha1("payload")).alias("digest"), "url", "payload",
                                         F.lit(None).cast("long").alias("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(root)
        out, listed, now, first, done = None, [], None, {}, set()
        part, size, n, begun, shard = 0, 0, 0, None, 0

        def close():
            out.close()
            listed.append((*names, shard, part, n, size, begun, now))

        for batch in batches:
            for page, kind, digest, url, payload, at, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if (page,) != now:
                    first, done, now = {}, set(), (page,)  # what is known of this page's payloads
                if kind == 0:
                    first[digest] = at
                    continue
                repeats = digest in first and (first[digest] != page or digest in done)
                done.add(digest)
                data = member(record(page, url, payload, first.get(digest), not repeats, date), level)
                if out is None or size >= roll_bytes:
                    if out is not None:
                        close()
                        part += 1
                    names = temporary_name(root, shard, part, "warc.gz")
                    store.create_dir(f"{top}/{names[0].rpartition('/')[0]}", recursive=True)
                    out, size, n, begun = store.open_output_stream(f"{top}/{names[0]}", compression=None), 0, 0, now
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            close()
        kinds = [pa.string()] * 2 + [pa.int64()] * 6
        columns = zip(*[(*x[:6], x[6][0], x[7][0]) for x in listed]) if listed else [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)],
                                         ["temporary", "file", "shard", "part", "records", "bytes", "first_page", "last_page"])

    dealt = in_shards(both, "page", points, "kind", "digest", "url").select("page", "kind", "digest", "url", "payload", "first", "shard")
    return commit(dealt.mapInArrow(run, "temporary string, file string, shard long, part long, records long, bytes long, "
                                        "first_page long, last_page long"), root)


def read_warc(manifest: DataFrame, root: str) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) per record of the listed files.

    A response's payload must have the length and digest of its headers; a
    revisit has those of the payload it stands for, and a NULL payload.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(store, path, row) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        with store.open_input_stream(path, compression=None) as f:
            for data in members(f):
                fields, block = parse(data)
                payload, kind = block.partition(b"\r\n\r\n")[2], fields["WARC-Type"]
                digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["Payload-Length"])
                if kind == "response" and (len(payload), digest32(payload)) != (size, digest):
                    raise ValueError("a payload does not match its headers")
                number = lambda x: int(x) if x else None
                held.append((number(fields["Page-ID"]), fields["WARC-Target-URI"], kind, size, digest,
                             number(fields.get("Refers-To-Page-ID")), payload if kind == "response" else None))
                weight += len(payload)
                if weight > 8 << 20 or len(held) >= 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)
                    held, weight = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)

    return read_files(manifest, root, read, "page_id long, url string, record_type string, payload_bytes long, "
                                            "payload_digest string, refers_to long, payload binary")


def archive(pages: DataFrame, root: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives under ``root`` (default: a new folder of the shared one) and read them back."""
    root = root or scratch_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, root, **options), root)
