"""Packing token sequences into windows by minimum bin slack.

A document's ids are cut into full windows and one remainder.  How many pieces
there are of each length is a table of at most ``window`` rows whatever the
corpus, and the plan is made on it: the longest length left must go somewhere,
and a subset-sum over a bitset of reachable fillings finds the multiset of
lengths left that fills its window closest to capacity (minimum bin slack,
Gupta and Ho 1999).  The multiset is backtracked as a count per length and
used as often as the counts left allow.  Every piece then finds its sequence
and offset from its rank within its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import col, materialise
from snaplake.llm.tokens import Encoder

WINDOW = 2048


def fill(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset with the longest length left and the least slack, as a count per length.

    ``reach`` has bit s set if some multiset of the lengths tried so far sums
    to s.  Lengths are tried from the longest, copies by binary splitting, and
    the search ends as soon as the window can be filled to the brim.
    """
    longest = max(counts)
    room = window - longest
    reach, trail, mask = 1, [], (1 << room + 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        n, step = min(counts[length] - (length == longest), room // length), 1
        while n > 0:
            take = min(step, n)
            wider = (reach | reach << take * length) & mask
            if wider != reach:
                trail.append((length, take, reach))
                reach = wider
            n, step = n - take, step * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(trail):
        if not before >> at & 1:
            at -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows (length, first rank, end rank, per sequence, first sequence, offset) covering every piece once."""
    left, rows, sequence = {x: n for x, n in counts.items() if n > 0}, [], 0
    taken = dict.fromkeys(left, 0)
    while left:
        chosen = fill(left, window)
        times, offset = min(left[x] // n for x, n in chosen.items()), 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, taken[length], taken[length] + n * times, n, sequence, offset))
            taken[length] += n * times
            offset += n * length
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def padding(length: int, window: int = WINDOW) -> int:
    """Padding of a sequence: none at a power of two, else up to the window."""
    return 0 if length & (length - 1) == 0 else window - length


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """(row, doc_id, start, length, doc_tokens, ids): each document's ids, with its end id, cut into windows.

    ``ids`` are little-endian, 2 bytes each if the vocabulary allows, else 4.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        width, end = encoder.dtype.itemsize, encoder.pack([end_id])
        for batch in batches:
            out = [[], [], [], [], [], []]
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, doc, blob in zip(rows, ids, encoder.encode(batch.column(2))):
                blob += end
                total = len(blob) // width
                for start in range(0, total, window):
                    length = min(window, total - start)
                    for x, v in zip(out, (row, doc, start, length, total, blob[start * width:(start + length) * width])):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:5]), pa.array(out[5], pa.binary())],
                                             ["row", "doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).cast("long").alias("doc_id"),
                       col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "row long, doc_id long, start long, length long, doc_tokens long, ids binary")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, salts: int = 256) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset), one row per piece.

    Every id of every row of ``docs`` is in exactly one piece, a sequence holds
    at most ``window`` ids without gaps from offset 0.  NULL and empty texts
    are their end id alone; repeated rows and rows with a NULL id are packed
    like any other; ties go by id, then by row.  An empty table gives none.

    One length may hold a third of all pieces, so ranks within a length are
    counted in ``salts`` parts, each after the sums of the parts before it.
    """
    pieces = materialise(token_pieces(docs, tokenizer, end_id, id_col, text_col, window), "pack-pieces")
    brief = pieces.select("row", "doc_id", "start", "length",
                          F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int").alias("salt"))
    parts = materialise(brief.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "pack-parts")
    # at most one row per length: bounded by the window, not by the corpus
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan(counts, window)
    before = parts.select("length", "salt", F.coalesce(
        F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    ranked = (brief.join(before, ["length", "salt"])
              .withColumn("rank", F.col("before") - 1 + F.row_number().over(
                  Window.partitionBy("length", "salt").orderBy("doc_id", "start", "row")))
              .select("row", "start", "length", "rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of the plan in order of (length, first rank); both fit one key as ranks are under 2**40
        keys = steps[:, 0] * (1 << 40) + steps[:, 1]
        for batch in batches:
            row, start, length, rank = (c.to_numpy() for c in batch.columns)
            step = steps[np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1]
            own = rank - step[:, 1]
            sequence, offset = step[:, 4] + own // step[:, 3], step[:, 5] + own % step[:, 3] * length
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sequence), pa.array(offset)],
                                             ["row", "start", "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, "row long, start long, sequence_id long, offset long")
    return pieces.join(placed, ["row", "start"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
