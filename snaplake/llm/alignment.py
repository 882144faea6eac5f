"""Alignment of two tokenizers over the bytes of each text.

A is a byte-level BPE, B a sentencepiece model.  A part of a text (cut in front
of a space, where neither tokenizer joins both sides) gives two incidence
matrices over its bytes, with a row for each token.  Row products of A with
the transpose of B are the overlap links.  Places where both tokenizers end a
token cut the bytes into groups; the product of the incidences of ids and
groups gives the links inside groups, counted per pair of ids.

Parts repeat, so a worker aligns each one once; a document is a row of part
numbers.  Documents travel in chunks of about ``CHUNK`` characters, each with
its own parts and pairs of ids: documents times parts times pairs is again a
product of such matrices.  Spark counts the documents of each pair over all
chunks, one row per chunk and pair, finds each A id's highest count, and
brings both back to the chunks, whose rows hold numbers only (in as few bytes
as they need); the alignment is written out as text at the very end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.bpe import Bpe, cut_at_spaces
from snaplake.llm.common import col, materialise
from snaplake.llm.ragged import Csr, Rows, counted, give_back, offsets, take_rows

#: Characters of text in a chunk (one longer text is a chunk of its own).
CHUNK = 3 << 20
#: Characters of parts that one worker keeps aligned (some 300,000 parts, 60 MB); beyond them it starts anew.
CACHE = 3 << 20
#: Characters of parts that are aligned in one go.
SLICE = 1 << 17
#: Tokens that are written out in one go, and characters of alignments that go back to Spark as one batch.
TOKENS, BATCH = 1 << 16, 1 << 20
#: Chunks (some 3 MB each) in a row group: Parquet writes and reads a row group's rows at once, and looks at their size
#: only after a hundred.
GROUP = 4
#: A pair of ids as one number: A's id times this, plus B's.
PAIR = 1 << 31
_SPACE = "▁"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
_WORKER: dict[tuple[str, str], Aligner] = {}


class Aligner:
    """Two tokenizer files and what the worker knows about parts so far."""

    def __init__(self, a_path: str, b_path: str, cache: int = CACHE):
        import sentencepiece

        self.a = Bpe(a_path, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError(f"{b_path}: a piece with a space inside joins what is cut here")
        self._bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                       for i, p in enumerate(pieces)]
        self._b_length = np.array([len(b) for b in self._bytes], np.int64)
        self._a_length = np.array([len(b) for b in self.a.token_bytes], np.int64)
        self._lone = self.b.piece_to_id(_SPACE)
        self.cache = cache
        self.forget()

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in _WORKER:
            _WORKER[a_path, b_path] = cls(a_path, b_path)
        return _WORKER[a_path, b_path]

    @classmethod
    def drop(cls) -> None:
        """Forget the worker's tokenizers, for a stage that needs none."""
        if _WORKER:
            _WORKER.clear()
            give_back()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self._held = 0
        self.same = np.zeros(0, bool)  # parts whose bytes both tokenizers give back
        none = np.zeros(0, np.int64)
        self.counts = Rows(none, count=none)
        # a part's tokens in the order of its alignment, and its pairs of ids as places among them
        self.tokens = Rows(none, id=none, mark=none)
        self.pairs = Rows(none, a=none, b=none, links=none)

    def room(self, parts: set[str]) -> None:
        """Start anew if the new ones of ``parts`` would be too many."""
        if self._held and self._held + sum(map(len, parts.difference(self.number))) > self.cache:
            self.forget()

    def know(self, parts: set[str]) -> None:
        """Align the parts (each without the space it begins with) that are not known yet."""
        some, size = [], 0
        for p in parts.difference(self.number):
            some.append(p)
            size += len(p) + 1
            if size >= SLICE:
                self._add(some)
                some, size = [], 0
        if some:
            self._add(some)

    def _add(self, parts: list[str]) -> None:
        same, *tables = self.align(parts)
        known = len(self.same)
        self.number.update((p, known + i) for i, p in enumerate(parts))
        self._held += sum(map(len, parts))
        self.same = np.concatenate((self.same, same))
        for held, more in zip((self.counts, self.tokens, self.pairs), tables):
            held.append(more)

    def align(self, parts: list[str]) -> tuple[np.ndarray, Rows, Rows, Rows]:
        """For each " " + part: whether its bytes come back, the numbers of ``_COUNTS``, its tokens (A's before B's
        in each group, with what follows the id in the text of the alignment), and its pairs of ids (as the places
        of two of its tokens) with their links."""
        a_ids, a_per = self.a.encode_parts([" " + p for p in parts])
        b_lists = self.b.encode(parts, num_threads=1)
        b_lists = [b if p else [self._lone] for p, b in zip(parts, b_lists)]
        whole = [(" " + p).encode() for p in parts]
        same = np.array([b"".join(map(self._bytes.__getitem__, b)) == w for b, w in zip(b_lists, whole)], bool)
        a_part = np.repeat(np.arange(len(parts)), a_per)
        keep = same[a_part]
        a_ids, a_part = a_ids[keep], a_part[keep]
        b_lists = [b if ok else [] for b, ok in zip(b_lists, same)]
        b_per = np.array([len(b) for b in b_lists], np.int64)
        b_ids = np.fromiter(chain.from_iterable(b_lists), np.int64, int(b_per.sum()))
        b_part = np.repeat(np.arange(len(parts)), b_per)
        # token-byte incidence over the bytes of all these parts, and the overlap links
        a_starts, b_starts = offsets(self._a_length[a_ids]), offsets(self._b_length[b_ids])
        n_bytes = int(a_starts[-1])
        one = np.ones(n_bytes, np.int64)
        a_bytes = Csr(a_starts, np.arange(n_bytes), one, n_bytes)
        b_bytes = Csr(b_starts, np.arange(n_bytes), one, n_bytes)
        overlaps = a_bytes.product(b_bytes.transposed())
        # a group ends where both end
        ends = np.intersect1d(a_starts[1:], b_starts[1:], assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_starts[1:]), np.searchsorted(ends, b_starts[1:])
        part_of_group = np.zeros(len(ends), np.int64)
        part_of_group[a_group] = a_part
        a_rows, b_rows = (counted(part * PAIR + ids)[0] for part, ids in ((a_part, a_ids), (b_part, b_ids)))
        shape = len(ends)
        a_in = Csr.of(np.searchsorted(a_rows, a_part * PAIR + a_ids), a_group, (len(a_rows), shape))
        b_in = Csr.of(np.searchsorted(b_rows, b_part * PAIR + b_ids), b_group, (len(b_rows), shape))
        links = a_in.product(b_in.transposed())
        part = (a_rows // PAIR)[links.rows()]
        counts = np.zeros((len(parts), len(_COUNTS)), np.int64)
        for i, at in enumerate((a_part, b_part, part_of_group)):
            counts[:, i] = np.bincount(at, minlength=len(parts))
        np.add.at(counts[:, 3], part, links.values)
        counts[:, 4] = np.bincount(a_part[overlaps.rows()], minlength=len(parts))
        # the tokens of both in the order of the text: by group, then side; the last one of a side ends it
        group = np.concatenate((a_group, b_group))
        side = np.repeat([0, 1], [len(a_group), len(b_group)])
        order = np.argsort(group * 2 + side, kind="stable")
        ids, group, side = np.concatenate((a_ids, b_ids))[order], group[order], side[order]
        ends = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[:len(group)]
        mark = np.where(ends, np.where(side == 0, ord("|"), ord(";")), ord(","))
        own = part_of_group[group]
        tokens = Rows(np.bincount(own, minlength=len(parts)), id=ids, mark=mark)
        within = np.arange(len(ids)) - tokens.starts[own]
        # where each id of a part first stands
        a_first, b_first = (within[side == k][np.unique(own[side == k] * PAIR + ids[side == k], return_index=True)[1]] for k in (0, 1))
        pairs = Rows(np.bincount(part, minlength=len(parts)), a=a_first[links.rows()], b=b_first[links.columns], links=links.values)
        return same, Rows(np.full(len(parts), len(_COUNTS)), count=counts.ravel()), tokens, pairs

    def chunk(self, texts: list[str]) -> dict:
        """A chunk of texts: their parts by number, the parts' pairs, and in how many texts each pair is linked."""
        cut = [cut_at_spaces(" " + t) if t else [] for t in texts]
        for c in cut:
            if c:  # what the text's own space begins
                c[0] = c[0][1:]
                if not c[0] and len(c) > 1:
                    del c[0]
        distinct = set(chain.from_iterable(cut))
        self.room(distinct)
        self.know(distinct)
        numbers = [list(map(self.number.__getitem__, c)) for c in cut]
        broken = {i for i in map(self.number.__getitem__, distinct) if not self.same[i]}
        if broken:
            numbers = [[] if broken.intersection(own) else own for own in numbers]
        per_text = np.array([len(own) for own in numbers], np.int64)
        flat = np.fromiter(chain.from_iterable(numbers), np.int64, int(per_text.sum()))
        used, part = np.unique(flat, return_inverse=True)
        tokens, pairs = self.tokens.take(used), self.pairs.take(used)
        ids, linked = pair_matrix(tokens, pairs)
        documents = Csr.of(np.repeat(np.arange(len(texts)), per_text), part, (len(texts), len(used)))
        held = documents.product(linked)
        return {"data": [packed(x) for x in (per_text, part, self.counts.take(used).of("count"), tokens.lengths, tokens.of("id"),
                                             tokens.of("mark"), pairs.lengths, pairs.of("a"), pairs.of("b"), pairs.of("links"))],
                "ids": ids, "documents": np.bincount(held.columns, minlength=len(ids))}


def pair_matrix(tokens: Rows, pairs: Rows) -> tuple[np.ndarray, Csr]:
    """(the distinct pairs of ids in ascending order, parts x pairs with the number of links)."""
    first = np.repeat(tokens.starts[:-1], pairs.lengths)
    ids = tokens.of("id")
    distinct, pair = np.unique(ids[first + pairs.of("a")] * PAIR + ids[first + pairs.of("b")], return_inverse=True)
    return distinct, Csr(pairs.starts, pair, pairs.of("links"), len(distinct))


def packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on as bytes: the width that the largest needs, how many, and the numbers, compressed."""
    width = np.min_scalar_type(int(x.max()) if len(x) else 0).itemsize
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(x.astype(f"<u{width}").tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    return np.frombuffer(pa.decompress(data[9:], decompressed_size=n * width, codec="zstd", asbytes=True),
                         f"<u{width}").astype(np.int64)


def _chunks(docs: DataFrame, a_path: str, b_path: str, key_type: str) -> DataFrame:
    """One row per chunk; ``ids`` and ``documents`` are the chunk's pairs of ids and how many of its texts hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(a_path, b_path)
        keys, texts, size = [], [], 0

        def finished() -> pa.RecordBatch:
            row = aligner.chunk(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().hex]),
                pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), pa.concat_arrays(keys)),
                pa.array([row["data"]], pa.list_(pa.binary())), pa.array([row["ids"]], pa.list_(pa.int64())),
                pa.array([row["documents"]], pa.list_(pa.int64()))], ["chunk", "keys", "data", "ids", "documents"])

        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                keys.append(batch.column("key").slice(i, 1))
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK:
                    yield finished()
                    keys, texts, size = [], [], 0
        if texts:
            yield finished()
        aligner.forget()  # the worker may wait beside other stages
        give_back()

    return docs.mapInArrow(run, f"chunk string, keys array<{key_type}>, data array<binary>, ids array<long>, documents array<long>")


def written(ids: np.ndarray, marks: np.ndarray, lengths: np.ndarray) -> list[str]:
    """The text of each row of tokens: every id in decimals, then its mark."""
    top = int(ids.max()) + 1 if len(ids) else 0
    names = [str(i).encode() + b"," for i in range(top)]
    starts = offsets(np.fromiter(map(len, names), np.int64, top))
    names = np.frombuffer(b"".join(names), np.uint8)
    width = np.diff(starts)[ids]
    blocks = []
    for low in range(0, len(ids), TOKENS):
        own = slice(low, low + TOKENS)
        text = names[take_rows(starts[ids[own]], width[own])]
        text[np.cumsum(width[own]) - 1] = marks[own]
        blocks.append(text.tobytes())
    whole = b"".join(blocks).decode("ascii")
    cuts = offsets(width)[offsets(lengths)].tolist()
    return [whole[low:high] for low, high in zip(cuts, cuts[1:])]


def _totals(data: list[pa.Scalar], count: np.ndarray, best: np.ndarray) -> list[np.ndarray]:
    """Of each text the numbers of ``_COUNTS``, ``n_best`` and ``count_sum``: one array a number."""
    per_text, parts, counts, n_tokens, ids, _, n_pairs, a, b, links = [unpacked(x.as_py()) for x in data]
    linked = pair_matrix(Rows(n_tokens, id=ids), Rows(n_pairs, a=a, b=b, links=links))[1]
    del ids, a, b, links
    counts, starts = counts.reshape(-1, len(_COUNTS)), offsets(per_text)

    def total(per_part: np.ndarray) -> np.ndarray:
        return np.diff(offsets(per_part[parts])[starts])

    return [*[total(counts[:, i]) for i in range(len(_COUNTS))], total(linked.times_vector(best)), total(linked.times_vector(count))]


def _texts(data: list[pa.Scalar]) -> pa.ChunkedArray:
    """The alignment of each text as text, about ``BATCH`` characters in an array."""
    per_text, parts, _, n_tokens, ids, marks, *_ = data
    spelled = written(*[unpacked(x.as_py()) for x in (ids, marks, n_tokens)])
    starts, parts = offsets(unpacked(per_text.as_py())).tolist(), unpacked(parts.as_py())
    done, some, size = [], [], 0
    for low, high in zip(starts, starts[1:]):
        some.append("".join([spelled[p] for p in parts[low:high].tolist()])[:-1])
        size += len(some[-1])
        if size >= BATCH:
            done.append(pa.array(some, pa.string()))
            some, size = [], 0
    return pa.chunked_array([*done, pa.array(some, pa.string())], pa.string())


def _documents(chunk: pa.Table, counted_pairs: pa.Table, key: str) -> pa.Table:
    """The rows of one chunk's texts, with the corpus-wide counts of its pairs.

    Two of these run beside a JVM that uses all of its heap by then, so they
    hold one step's arrays at a time, and no tokenizer.
    """
    Aligner.drop()
    order = np.argsort(counted_pairs.column("place").to_numpy())
    count, best = (counted_pairs.column(n).to_numpy()[order].astype(np.int64) for n in ("count", "best"))
    data = list(chunk.column("data")[0].values)
    totals = _totals(data, count, best)
    keys = chunk.column("keys").combine_chunks().flatten()
    return pa.Table.from_arrays([keys, *map(pa.array, totals), _texts(data)],
                                [key, *_COUNTS, "n_best", "count_sum", "groups"])


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups), one row per row of ``docs``.

    A encodes a space and the text, B the text, both without special tokens
    (their names are plain text).  ``groups`` is the alignment as text
    (``a1,a2|b1;a3|b2,b3``); ``n_links`` are pairs of an A and a B token in one
    group, ``n_overlaps`` pairs that share a byte.  A pair of ids counts the
    rows of ``docs`` that hold it linked; ``count_sum`` adds the counts of a
    row's links, and ``n_best`` are links whose pair has the highest count of
    its A id, ties included.

    A NULL or empty text, or one whose bytes a tokenizer does not give back,
    has no tokens: zeros and an empty ``groups``.  Repeated rows are rows, NULL
    keys keys like any other; other columns are not read; an empty table gives
    no rows.  Both files must be at the same place on all executors.
    """
    key_type = docs.schema[key].dataType.simpleString()
    chunks = materialise(_chunks(docs.select(col(key).alias("key"), col(text).cast("string").alias("text")),
                                 a_path, b_path, key_type), "alignment", GROUP)
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "documents")).alias("place", "pair")).select(
        "chunk", "place", F.col("pair.ids").alias("pair"), F.col("pair.documents").alias("documents"))
    counts = pairs.groupBy("pair").agg(F.sum("documents").alias("count"))
    # the pairs of an A id are at most as many as B has ids
    of_a = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(((1 << 63) - 1) ^ (PAIR - 1))))
    counts = materialise(counts.withColumn("best", F.col("count") == F.max("count").over(of_a)), "alignment-counts")
    placed = pairs.drop("documents").join(counts, "pair").select(F.col("chunk").alias("of_chunk"), "place", "count", "best")
    schema = f"`{key.replace('`', '``')}` {key_type}, {', '.join(f'{c} long' for c in (*_COUNTS, 'n_best', 'count_sum'))}, groups string"

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        return _documents(own, found, key)

    return (chunks.drop("ids", "documents").groupBy("chunk").cogroup(placed.groupBy("of_chunk"))
            .applyInArrow(run, schema))
