"""Token ids on disk: one array of ids a shard, document boundaries in Elias-Fano code.

File: the ids of all documents of a shard, one after the other, in 2 or 4 bytes
each; the boundaries (n + 1 ascending positions) and the document ids in
Elias-Fano code; a fixed footer.  Elias-Fano keeps n numbers up to u in about
2 + log2(u / n) bits each: the low bits packed, the high bits as unary gaps,
with the place of every ``SAMPLE``-th one for ``select``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import col
from snaplake.llm.shards import commit, in_shards, open_store, qualified, read_files, split_points, temporary_name
from snaplake.llm.tokens import Encoder
from snaplake.session import scratch_path

SAMPLE = 256
#: Documents that are read at a time.
READ = 512
_HEAD = struct.Struct("<QQQB")  # numbers, largest, bytes of low bits, low bits
_FOOT = struct.Struct("<8sBQQQQQ")  # magic, bytes an id, documents, NULL ids first, ids, boundary bytes, doc-id bytes
_MAGIC = b"snaptok1"


class EliasFano:
    """Ascending numbers (repeats allowed) in near-minimal space; ``select(i)`` reads one, ``values()`` all."""

    def __init__(self, data: bytes | memoryview):
        self.n, self.largest, low_bytes, self.low_bits = _HEAD.unpack_from(data)
        at = _HEAD.size
        self.low = np.frombuffer(data, np.uint8, low_bytes, at)
        at += low_bytes
        samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", samples, at)
        self.high = np.frombuffer(data, np.uint8, -1, at + 4 * samples)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return _HEAD.pack(0, 0, 0, 0)
        if np.any(values[1:] < values[:-1]):
            raise ValueError("values must ascend")
        largest = int(values[-1])
        low_bits = max(0, (largest // n).bit_length() - 1)
        low = b""
        if low_bits:
            low = np.packbits((values[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8),
                              bitorder="little").tobytes()
        places = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places.astype(np.int64)] = 1
        return (_HEAD.pack(n, largest, len(low), low_bits) + low + places[::SAMPLE].astype("<u4").tobytes()
                + np.packbits(bits, bitorder="little").tobytes())

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        a, b = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a]
        return (bits.reshape(count, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th number: from the sample before it, count ones byte by byte."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        at, word = place // 8, int(self.high[place // 8]) >> place % 8 << place % 8
        while (ones := word.bit_count()) <= left:
            left, at = left - ones, at + 1
            word = int(self.high[at])
        for _ in range(left):
            word &= word - 1
        high = at * 8 + (word & -word).bit_length() - 1 - i
        return high << self.low_bits | int(self._lows(i, 1)[0])

    def run(self, first: int, count: int) -> np.ndarray:
        """``count`` numbers from the ``first`` on, selected together: from the sample before it to the one after the last."""
        if not 0 <= first <= first + count <= self.n:
            raise IndexError((first, count))
        if not count:
            return np.array([], np.uint64)
        begin = int(self.samples[first // SAMPLE]) // 8
        after = (first + count - 1) // SAMPLE + 1
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        places = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")).astype(np.uint64) + np.uint64(begin * 8)
        # ones of the sample's byte that come before it are not counted
        skip = int(np.searchsorted(places, np.uint64(self.samples[first // SAMPLE]))) + first % SAMPLE
        places = places[skip:skip + count]
        return (places - np.arange(first, first + count, dtype=np.uint64) << np.uint64(self.low_bits)) | self._lows(first, count)

    def values(self) -> np.ndarray:
        """All numbers as unsigned 64-bit."""
        return self.run(0, self.n)


class TokenFile:
    """A shard's file, opened at its footer; ids are read where they are asked for.

    ``read(n, at)`` gives ``n`` bytes from ``at`` on (by default of ``data``)."""

    def __init__(self, data: bytes | memoryview | None = None, read: Callable[[int, int], bytes] | None = None, size: int | None = None):
        self._read = read or (lambda n, at: data[at:at + n])
        size = len(data) if size is None else size
        magic, width, self.documents, self.nulls, self.ids, bounds, names = _FOOT.unpack(self._read(_FOOT.size, size - _FOOT.size))
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.dtype = np.dtype(f"<u{width}")
        tail = self._read(bounds + names, self.ids * width)
        self.bounds = EliasFano(tail[:bounds])
        (self.base,) = struct.unpack_from("<q", tail, bounds)
        self.names = EliasFano(tail[bounds + 8:])

    def tokens(self, low: int, high: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self._read((high - low) * width, low * width), self.dtype)

    def document(self, i: int) -> np.ndarray:
        return self.tokens(self.bounds.select(i), self.bounds.select(i + 1))

    def doc_ids(self, first: int = 0, count: int | None = None) -> list[int | None]:
        """Ids of ``count`` documents from the ``first`` on; NULL ids come first."""
        last = self.documents if count is None else first + count
        unnamed = max(0, min(last, self.nulls) - first)
        known = self.names.run(first + unnamed - self.nulls, last - first - unnamed) if last > self.nulls else np.array([], np.uint64)
        return [None] * unnamed + (known + np.uint64(self.base % (1 << 64))).view(np.int64).tolist()


def finish(lengths: list[int], doc_ids: list[int | None], width: int) -> bytes:
    """What follows the ids in a file."""
    bounds = EliasFano.encode(np.concatenate(([0], np.cumsum(lengths, dtype=np.uint64))).astype(np.uint64))
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    names = struct.pack("<q", base) + EliasFano.encode(known.view(np.uint64) - np.uint64(base % (1 << 64)))
    return bounds + names + _FOOT.pack(_MAGIC, width, len(lengths), len(lengths) - len(known), sum(lengths), len(bounds), len(names))


def write_tokens(docs: DataFrame, root: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", docs_per_shard: int = 4096) -> DataFrame:
    """Write every document's ids and its end id in ascending doc_id order; gives the manifest.

    ``root`` is a folder that executors and driver share.  NULL ids come first;
    repeated rows stay, ordered by their text's hash; NULL and empty texts are their end id alone; an
    empty table gives a manifest without rows.
    """
    root = qualified(docs.sparkSession, root)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    shards = max(1, -(-rows.count() // docs_per_shard))
    points = split_points(rows, "doc_id", shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = Encoder.of(tokenizer), None
        width, end = encoder.dtype.itemsize, encoder.pack([end_id])
        store, top = open_store(root)
        for batch in batches:
            if batch.num_rows and out is None:
                shard = batch.column(2)[0].as_py()
                temporary, final = temporary_name(root, shard, 0, "tok")
                store.create_dir(f"{top}/{temporary.rpartition('/')[0]}", recursive=True)
                out, lengths, doc_ids = store.open_output_stream(f"{top}/{temporary}", compression=None), [], []
            for doc, blob in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                out.write(blob + end)
                lengths.append(len(blob) // width + 1)
                doc_ids.append(doc)
        if out is not None:
            out.write(finish(lengths, doc_ids, width))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (temporary, final)] + [pa.array([x], pa.int64()) for x in (shard, len(lengths), sum(lengths))],
                ["temporary", "file", "shard", "documents", "ids"])

    sorted_rows = in_shards(rows.withColumn("tie", F.xxhash64("text")), "doc_id", points, "tie")
    files = sorted_rows.select("doc_id", "text", "shard").mapInArrow(
        run, "temporary string, file string, shard long, documents long, ids long")
    return commit(files, root)


def read_tokens(manifest: DataFrame, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) per document of the files; ``ids`` as in the file, ``start`` over all shards."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(store, path, row) -> Iterator[pa.RecordBatch]:
        with store.open_input_file(path) as f:
            shard = TokenFile(read=lambda n, at: f.read_at(n, at), size=f.size())
            width = shard.dtype.itemsize
            for at in range(0, shard.documents, READ):
                some = min(READ, shard.documents - at)
                cut = shard.bounds.run(at, some + 1).astype(np.int64)  # where these documents begin, by select
                raw = shard.tokens(int(cut[0]), int(cut[-1])).tobytes()
                places = ((cut - cut[0]) * width).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids(at, some), pa.int64()), pa.array(cut[:-1] + row["start"]), pa.array(np.diff(cut)),
                     pa.array([raw[a:b] for a, b in zip(places, places[1:])], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return read_files(placed, root, read, "doc_id long, start long, n_tokens long, ids binary")


def store_tokens(docs: DataFrame, tokenizer: str, root: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token files under ``root`` (default: a new folder of the shared one) and read them back."""
    root = root or scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, root, tokenizer, **options), root)


def crc32_of_ids(n_ids: str, ids: str):
    """CRC-32 of ids as little-endian unsigned 32-bit numbers, from bytes of either width."""
    @F.arrow_udf("long")
    def run(n: pa.Array, blobs: pa.Array) -> pa.Array:
        out = []
        for k, b in zip(n.to_pylist(), blobs.to_pylist()):
            wide = b if len(b) == 4 * k else np.frombuffer(b, "<u2").astype("<u4").tobytes()
            out.append(zlib.crc32(wide))
        return pa.array(out, pa.int64())
    return run(F.col(n_ids), F.col(ids))
