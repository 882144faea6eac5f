"""SimHash near-duplicates through an inverted index over byte positions.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints within
``max_bits`` differing bits differ in at most ``max_bits`` bytes, so they share
at least ``8 - max_bits`` positional bytes.  Posting lists of single bytes
would each hold 1/256 of the corpus; the index therefore keeps the lists of
every combination of that guaranteed number of positions with their values
(the intersections that count filtering needs), whose expected length at
random is N / 2**32 for the default of four.  The lists stand in for the tally:
all entries of a list share its positions, so no count is left to filter by.
The bit distance is verified, and each pair is handled in the first list that
holds it.

Copies with one fingerprint are one index entry.  A list is handled in bounded
blocks inside a task and yields a spanning forest of its verified links, never
all pairs.  Lists over ``list_limit`` entries take an exact linear way instead:
two fingerprints within d bits share a point at most ceil(d/2) bits from
either, so such points tie entries together without any pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import col, materialise
from snaplake.llm.components import connected_components

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FIRST = 42  # the hash seed of the contract


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """SimHash of a UTF-8 text as an unsigned 64-bit number: a bit is set when
    over half of the shingle hashes have it; a text without a word gives 0."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], _FIRST) for s, e in zip(starts[:n].tolist(), ends.tolist())], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, tie: bool = False) -> DataFrame:
    """(doc_id, fp[, tie]) with the fingerprint's bits as a signed long; ``tie`` is the text's hash."""
    names = ["doc_id", "fp", *(["tie"] if tie else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            marks = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64)), *batch.columns[2:]], names)

    text = col(text_col).cast("string")
    return docs.select(col(id_col).cast("long").alias("doc_id"), text.alias("text"), *([F.xxhash64(text).alias("tie")] if tie else [])) \
        .mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _masks(shared: int) -> list[tuple[int, ...]]:
    return list(combinations(range(8), shared))


def _list_rules(max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each set of equal bytes (as 8 bits): its size, and the first list that holds a pair with it."""
    masks = _masks(8 - max_bits)
    size = np.array([bin(m).count("1") for m in range(256)])
    first = np.full(256, -1)
    for m in range(256):
        held = [p for p in range(8) if m >> p & 1][: 8 - max_bits]
        if len(held) == 8 - max_bits:
            first[m] = masks.index(tuple(held))
    return size, first


def _linked(x: np.ndarray, y: np.ndarray, at: int, max_bits: int, rules) -> np.ndarray:
    """Which pairs of two broadcast arrays of fingerprints this list answers for."""
    diff = x ^ y
    near = np.bitwise_count(diff) <= max_bits
    if near.any():
        found = np.ascontiguousarray(diff[near])
        equal = np.packbits(found.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
        size, first = rules
        near[near] = (size[equal] >= 8 - max_bits) & (first[equal] == at)
    return near


def _forest(fps: np.ndarray, ids: np.ndarray, at: int, max_bits: int, rules, tile: int = 1024) -> list[tuple[int, int]]:
    """A spanning forest of one list's links, found tile by tile."""
    n, label, out = len(fps), np.arange(len(fps)), []
    for i in range(0, n, tile):
        for j in range(i, n, tile):
            a, b = np.nonzero(_linked(fps[i:i + tile, None], fps[None, j:j + tile], at, max_bits, rules))
            a, b = a + i, b + j
            a, b = a[a < b], b[a < b]
            while len(a):
                la, lb = label[a], label[b]
                a, b, la, lb = a[la != lb], b[la != lb], la[la != lb], lb[la != lb]
                if not len(a):
                    break
                low, high = np.minimum(la, lb), np.maximum(la, lb)
                _, pick = np.unique(high, return_index=True)  # one link for each larger label: no cycle
                out += zip(ids[a[pick]].tolist(), ids[b[pick]].tolist())
                to = np.arange(n)
                to[high[pick]] = low[pick]
                while not np.array_equal(to, to[to]):
                    to = to[to]
                label = to[label]
    return out


def _list_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, rest = _list_rules(max_bits), None
        kind = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

        def links(at, fps, ids, cuts):
            src, dst = [], []
            sizes = np.diff(cuts)
            for m in np.unique(sizes[sizes > 1]):
                starts = cuts[:-1][sizes == m]
                if m <= 4:  # short lists, all at once
                    rows = starts[:, None] + np.arange(m)
                    for i, j in combinations(range(m), 2):
                        for s in np.unique(at[rows[:, 0]]):
                            own = rows[at[rows[:, 0]] == s]
                            hit = _linked(fps[own[:, i]], fps[own[:, j]], s, max_bits, rules)
                            src += ids[own[hit, i]].tolist()
                            dst += ids[own[hit, j]].tolist()
                else:
                    for p in starts:
                        for a, b in _forest(fps[p:p + m], ids[p:p + m], at[p], max_bits, rules):
                            src.append(a)
                            dst.append(b)
            return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], schema=kind)

        for batch in batches:  # sorted by (at, part): lists follow one another
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            at, part, fps, ids = now
            if not len(at):
                continue
            new = np.flatnonzero((np.diff(at) != 0) | (np.diff(part) != 0)) + 1
            done = new[-1] if len(new) else 0  # the last list may go on
            rest = [x[done:].copy() for x in now]
            if done:
                yield links(at, fps.view(np.uint64), ids, np.concatenate(([0], new)))
        if rest is not None and len(rest[0]):
            at, part, fps, ids = rest
            yield links(at, fps.view(np.uint64), ids, np.array([0, len(at)]))
    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(reps: DataFrame, max_bits: int = 4, list_limit: int = 32768) -> DataFrame:
    """(src, dst) ids whose fingerprints (fp, rep) link them, enough to connect all that are within ``max_bits``."""
    if not 0 <= max_bits < 8:
        raise ValueError("max_bits must be 0 to 7")
    masks = _masks(8 - max_bits)
    bits = [sum(255 << 8 * p for p in m) for m in masks]
    lists = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.lit(_signed(b))).alias("part"))
                                for i, b in enumerate(bits)]))
    index = reps.select("fp", "rep", lists.alias("k")).select("k.at", "k.part", "fp", "rep")
    sized = index.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("at", "part"))).filter("n > 1")
    held = materialise(sized, "simhash-lists")
    short = (held.filter(F.col("n") <= list_limit).select("at", "part", "fp", "rep")
             .repartition("at", "part").sortWithinPartitions("at", "part")
             .mapInArrow(_list_links(max_bits), "src long, dst long"))
    # long lists: every point within half the distance, over the bits that the list leaves open; an entry
    # within the smaller half is within max_bits of every entry of the point
    near, far = max_bits // 2, -(-max_bits // 2)
    flips = held.sparkSession.createDataFrame(
        [(i, [(_signed(sum(1 << p for p in c)), r <= near) for r in range(far + 1)
              for c in combinations([8 * q + o for q in range(8) if q not in m for o in range(8)], r)])
         for i, m in enumerate(masks)], "at int, flips array<struct<flip: long, near: boolean>>")
    points = (held.filter(F.col("n") > list_limit).join(flips, "at")
              .select("fp", "rep", F.explode("flips").alias("f"))
              .groupBy(F.col("fp").bitwiseXOR(F.col("f.flip")).alias("point"), "rep")
              .agg(F.max("f.near").alias("near")))
    hubs = (points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("rep"))).alias("dst"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 AND dst IS NOT NULL"))
    return short.unionByName(points.join(hubs, "point").select(F.col("rep").alias("src"), "dst"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = 4, list_limit: int = 32768) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, itself included.  NULL and blank texts have
    fingerprint 0 and link like any other; a NULL doc_id keeps its row with its
    group's component (NULL when the group has no id); repeated rows stay, and
    groups with the same smallest doc_id are one.
    """
    marks = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    reps = marks.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = connected_components(fingerprint_links(reps.filter("rep IS NOT NULL"), max_bits, list_limit))
    label = (reps.join(found, F.col("rep") == F.col("node"), "left")
             .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return marks.join(label, "fp").select("doc_id", "fp", "component_id")


def group_leaders(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = 4, list_limit: int = 32768) -> DataFrame:
    """(doc_id, tie) of one document of each near-duplicate group: the smallest id, then the smallest hash of the text.

    Groups are of fingerprints, so an id with several texts may be in several
    groups, and leads those where it is the smallest.  NULL ids are in no group.
    """
    marks = materialise(fingerprints(docs.filter(col(id_col).isNotNull()), id_col, text_col, shingle, tie=True), "simhash-texts")
    reps = marks.select("fp", F.col("fp").alias("rep")).distinct()
    found = connected_components(fingerprint_links(reps, max_bits, list_limit))
    return (marks.join(found, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("component", "fp"))
            .agg(F.min(F.struct("doc_id", "tie")).alias("first")).select("first.*"))
