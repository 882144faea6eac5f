"""Embedding near-duplicates as an exact metric range join.

On unit vectors, cosine >= t is Euclidean distance <= r with r^2 = 2 - 2t.
Pivots partition the vectors: each is at home in the cell of its nearest pivot.
A partner of a vector y at home in cell i is within r of y and no farther from
pivot i than from y's own pivot h, so y is at most r beyond the plane midway
between the two: |y - i|^2 - |y - h|^2 <= 2 r |i - h|, which by the triangle
inequality implies |y - i| - |y - h| <= 2 r.  y is copied to such cells only.

Equal vectors are one entry with a count.  A cell's home vectors are dealt into
units of a bounded number; a task holds one unit and streams the copies sent to
it past it, so neither a crowded cell nor a hot group of copies grows a task's
memory.  Of two units one sends its vectors to the other, half of the others to
each, so every pair meets once and is counted for both.  Units yield counts and
a spanning forest of their links, never pairs.

Scores are first taken in single precision.  Only the rows and columns of a tile
with a score within the rounding bound of the threshold are computed in double.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import col, materialise
from snaplake.llm.components import connected_components

THRESHOLD = 0.9
#: Scores this near the threshold are computed again, vector by vector.
_CLOSE = 1e-9
#: Rows and columns of a tile of scores, so that it stays in a core's cache.
_TILE = 512
#: Bytes of vectors in a batch of copies, links gathered before they are tied.
_BATCH, _PAIRS = 1 << 24, 1 << 20


def _keyed(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, mark, dim, vec): ``vec`` are numbers times a power of two, ``mark`` their digest; both NULL for vectors that link with nothing.

    ``vec`` holds single-precision numbers where they are exact, else doubles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).cast(pa.list_(pa.float64()))
            starts = lists.offsets.to_numpy()
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(starts))
            flat = lists.values.to_numpy(zero_copy_only=False)  # a NULL is a NaN here
            marks, vecs, dims = [None] * len(lists), [None] * len(lists), np.zeros(len(lists), np.int32)
            for dim in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == dim)
                v = flat[starts[rows][:, None] + np.arange(dim)]
                ok = np.isfinite(v).all(axis=1) & v.any(axis=1)
                rows, v = rows[ok], v[ok]
                # a power of two brings the largest component near 1: exact, and no square over- or underflows
                v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
                short = v.astype(np.float32)
                exact = (short == v).all(axis=1)
                dims[rows] = dim
                for i, row in enumerate(rows):
                    marks[row] = hashlib.blake2b(v[i].tobytes(), digest_size=16).digest()
                    vecs[row] = (short if exact[i] else v)[i].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary()), pa.array(dims, pa.int32()),
                                              pa.array(vecs, pa.binary())], ["vec_id", "mark", "dim", "vec"])

    return embeddings.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("v")) \
        .mapInArrow(run, "vec_id long, mark binary, dim int, vec binary")


def _matrix(blobs: pa.Array, dim: int) -> np.ndarray:
    """The doubles of ``vec`` values of one dimension."""
    blobs = blobs.cast(pa.binary())
    ends = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset:blobs.offset + len(blobs) + 1]
    data = np.frombuffer(blobs.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    for kind in (np.float32, np.float64):
        if (np.diff(ends) == dim * kind().itemsize).all():
            return data.view(kind).reshape(-1, dim).astype(np.float64)
    return np.array([np.frombuffer(b, np.float32 if len(b) == 4 * dim else np.float64) for b in blobs.to_pylist()], np.float64)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(reps: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Per dimension, the unit pivots: ``count`` vectors in all at most, those with the smallest hash."""
    found: dict[int, list] = {}
    for row in reps.orderBy(F.xxhash64("mark"), "mark").limit(count).select("dim", "vec").collect():
        found.setdefault(row.dim, []).append(bytes(row.vec))
    return {d: _units(_matrix(pa.array(v, pa.binary()), d)) for d, v in found.items()}


def _by_dim(batch: pa.RecordBatch, pivots: dict[int, np.ndarray]):
    """Per dimension in a batch with ``dim`` and ``vec``: (dim, rows, nearness to the pivots, home cells)."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        near = np.zeros((len(rows), 1))
        if dim in pivots:
            near = _units(_matrix(batch.column("vec").take(pa.array(rows)), dim)) @ pivots[dim].T
        yield dim, rows, near, near.argmax(axis=1)


def _homes(pivots: dict[int, np.ndarray]):
    """(dim, cell, count) of a batch's home vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, _, home in _by_dim(batch, pivots):
                cells, counts = np.unique(home, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(cells), pa.int32()), pa.array(cells, pa.int32()),
                                                  pa.array(counts, pa.int64())], ["dim", "cell", "count"])
    return run


def _deal(pivots: dict[int, np.ndarray], radius: float, groups: dict[int, np.ndarray]):
    """Each vector's rows for all units it takes part in; ``groups`` has the number of units per cell, one at least."""
    plans = {}
    for dim, many in groups.items():
        units = int(many.sum())
        ahead = np.subtract.outer(np.arange(units), np.arange(units)) % units  # of a home unit before another one
        sends = (0 < ahead) & (2 * ahead < units) | (2 * ahead == units) & np.tri(units, k=-1, dtype=bool)
        p = pivots.get(dim, np.zeros((1, 1)))
        gap = radius * np.stack([np.linalg.norm(p - q, axis=1) for q in p]) + 1e-6  # per home cell and cell, with room for rounding
        plans[dim] = many, np.cumsum(many) - many, np.repeat(np.arange(len(many)), many), sends, gap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("rep").to_numpy()
            for dim, rows, near, home in _by_dim(batch, pivots):
                many, first, cell, sends, gap = plans[dim]
                unit = first[home] + ids[rows] % many[home]
                step = max(1, _BATCH // (8 * dim * len(cell)))
                for at in range(0, len(rows), step):
                    cut = slice(at, at + step)
                    beyond = near[cut][np.arange(len(rows[cut])), home[cut]][:, None] - near[cut]
                    takes = (beyond <= gap[home[cut]])[:, cell] & sends[unit[cut]]
                    takes[np.arange(len(takes)), unit[cut]] = True
                    i, to = np.nonzero(takes)
                    part = batch.take(pa.array(rows[cut][i]))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("dim"), pa.array(to, pa.int32()), pa.array(to != unit[cut][i]).cast(pa.int32()),
                         part.column("rep"), part.column("n"), part.column("vec")], ["dim", "unit", "role", "rep", "n", "vec"])
    return run


class _Vectors:
    """Vectors of one dimension with their ids and counts, and their unit vectors for a first look."""

    def __init__(self, dim: int, parts: list[pa.RecordBatch]):
        self.ids = np.concatenate([p.column("rep").to_numpy() for p in parts])
        self.n = np.concatenate([p.column("n").to_numpy() for p in parts])
        self.x = np.concatenate([_matrix(p.column("vec"), dim) for p in parts])
        self.norm = np.linalg.norm(self.x, axis=1, keepdims=True)
        # a sum of d single-precision products of unit vectors is off by (d + 2) / 2^24 at most
        self.slack = (dim + 8) / 2 ** 23
        self.first = (self.x / self.norm).astype(np.float32 if self.slack < 1e-3 else np.float64)
        self.links = np.zeros(len(self.ids), np.int64)


class _Unit:
    """The home vectors of one unit; others are streamed past them."""

    def __init__(self, dim: int, parts: list[pa.RecordBatch], threshold: float):
        self.home, self.threshold = _Vectors(dim, parts), threshold
        self.label = np.arange(len(self.home.ids))
        self.score = np.empty(_TILE * _TILE, self.home.first.dtype)
        self.src, self.dst = [], []

    def _hits(self, a: slice, b: slice, other: _Vectors):
        """(rows, columns, hit) of a tile: home vectors against others, those rows and columns with a hit or nearly so; or None."""
        home = self.home
        p, q = home.first[a], other.first[b]
        score = np.matmul(p, q.T, out=self.score[:len(p) * len(q)].reshape(len(p), len(q)))
        maybe = score >= self.threshold - home.slack
        if not maybe.any():
            return None
        i, j = a.start + np.flatnonzero(maybe.any(axis=1)), b.start + np.flatnonzero(maybe.any(axis=0))
        score = (home.x[i] / home.norm[i]) @ (other.x[j] / other.norm[j]).T
        hit = score >= self.threshold
        for r, c in zip(*np.nonzero(np.abs(score - self.threshold) < _CLOSE)):
            p, q = home.x[i[r]], other.x[j[c]]
            hit[r, c] = float(np.dot(p, q) / (math.sqrt(np.dot(p, p)) * math.sqrt(np.dot(q, q)))) >= self.threshold
        if other is home:
            hit &= i[:, None] < j
        return i, j, hit

    def meet(self, other: _Vectors) -> None:
        """Count the links with these vectors (the home vectors: among themselves), for both, and tie what they link together."""
        inside, pairs, size = other is self.home, [], 0
        for b in range(0, len(other.ids), _TILE):
            for a in range(0, min(len(self.home.ids), b + 1) if inside else len(self.home.ids), _TILE):
                found = self._hits(slice(a, a + _TILE), slice(b, b + _TILE), other)
                if found is None:
                    continue
                i, j, hit = found
                self.home.links[i] += hit @ other.n[j]
                other.links[j] += self.home.n[i] @ hit
                r, c = np.nonzero(hit)
                pairs.append((i[r], j[c]))
                size += len(r)
                if size > _PAIRS:
                    self._tied(pairs, other)
                    pairs, size = [], 0
        self._tied(pairs, other)

    def _tied(self, pairs: list[tuple[np.ndarray, np.ndarray]], other: _Vectors) -> None:
        if not pairs:
            return
        a, b = (np.concatenate(x) for x in zip(*pairs))
        if other is self.home:
            self._tie(a, b)
            return
        partner = np.full(len(other.ids), -1)
        partner[b] = a
        linked = np.flatnonzero(partner >= 0)
        self._link(other.ids[linked], self.home.ids[partner[linked]])  # one home partner of each streamed vector
        self._tie(a, partner[b])

    def _tie(self, a: np.ndarray, b: np.ndarray) -> None:
        """Home vectors that share a partner are connected; each merger is one link."""
        while True:
            la, lb = self.label[a], self.label[b]
            a, b, la, lb = a[la != lb], b[la != lb], la[la != lb], lb[la != lb]
            if not len(a):
                return
            low, high = np.minimum(la, lb), np.maximum(la, lb)
            _, pick = np.unique(high, return_index=True)
            self._link(self.home.ids[a[pick]], self.home.ids[b[pick]])
            to = np.arange(len(self.label))
            to[high[pick]] = low[pick]
            while not np.array_equal(to, to[to]):
                to = to[to]
            self.label = to[self.label]

    def _link(self, src: np.ndarray, dst: np.ndarray) -> None:
        self.src.append(src)
        self.dst.append(dst)

    def rows(self, vectors: _Vectors) -> pa.RecordBatch:
        """The counts of these vectors and the links found since the last call."""
        some = np.ones(len(vectors.ids), bool) if vectors is self.home else vectors.links > 0
        ids, links = vectors.ids[some], vectors.links[some]
        src, dst = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (self.src, self.dst))
        self.src, self.dst = [], []
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids, src])), pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(dst)]),
             pa.concat_arrays([pa.array(links), pa.nulls(len(src), pa.int64())])], ["src", "dst", "links"])


def _join(threshold: float):
    """Rows sorted by (dim, unit, role): counts to add up (src, links) and links (src, dst)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, unit = None, [], None

        def ready():
            made = _Unit(key[0], home, threshold)
            made.meet(made.home)
            return made

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "unit", "role")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if at == to:
                    continue
                dim, number, role = keys[:, at].tolist()
                if (dim, number) != key:
                    if home:
                        unit = unit or ready()
                        yield unit.rows(unit.home)
                    key, home, unit = (dim, number), [], None
                part = batch.slice(at, to - at)
                if role == 0:
                    home.append(part)
                elif home:
                    unit = unit or ready()
                    others = _Vectors(dim, [part])
                    unit.meet(others)
                    yield unit.rows(others)
        if home:
            unit = unit or ready()
            yield unit.rows(unit.home)
    return run


def embedding_dedup(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    group_size: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: links at cosine >= ``threshold`` in double precision.

    Vectors that are NULL, empty, zero or hold NULL or non-finite numbers link
    with nothing, nor do vectors of different lengths.  A NULL id has links but
    no part in components (its component is its group's).  Repeated rows are
    vectors of their own and link.  ``group_size`` home vectors are held by a
    task; by default 32 times the root of the number of different vectors, so
    copies per vector and memory per task both grow with the root.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    rows = materialise(_keyed(embeddings, id_col, vector_col), "vec-rows")
    reps = materialise(rows.filter("mark IS NOT NULL").groupBy("mark").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
        .withColumn("rep", F.monotonically_increasing_id()), "vec-reps")
    count = reps.count()
    size = group_size or max(1024, int(32 * math.sqrt(count)))
    pivots = _pivots(reps, max(1, -(-count // size)))
    brief = reps.select("rep", "n", "dim", "vec")
    groups = {d: np.ones(len(p), np.int64) for d, p in pivots.items()}
    for r in brief.mapInArrow(_homes(pivots), "dim int, cell int, count long").groupBy("dim", "cell").sum("count").collect():  # a row per pivot
        groups.setdefault(r.dim, np.ones(1, np.int64))[r.cell] = -(-r["sum(count)"] // size)
    dealt = brief.mapInArrow(_deal(pivots, math.sqrt(2 - 2 * threshold), groups), "dim int, unit int, role int, rep long, n long, vec binary")
    tasks = max(1, int(sum(g.sum() for g in groups.values())))
    found = materialise(dealt.repartition(tasks, "dim", "unit").sortWithinPartitions("dim", "unit", "role")
                        .mapInArrow(_join(threshold), "src long, dst long, links long"), "vec-links")
    stars = connected_components(found.filter("dst IS NOT NULL").select("src", "dst"))
    label = (reps.select("rep", "mark", "n", "least")
             .join(found.filter("dst IS NULL").groupBy(F.col("src").alias("rep")).agg(F.sum("links").alias("links")), "rep")
             .join(stars.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("component", "rep")))
    label = materialise(label, "vec-labels")
    least = materialise(label.groupBy("root").agg(F.min("least").alias("component_id")), "vec-components")
    label = label.join(least, "root").select("mark", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    return rows.join(label, "mark", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))
