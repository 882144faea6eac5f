"""Sorted shards of files: range split, temporary names, manifest, commit.

Split points are keys picked by their own hash, so the same rows give the same
shards whatever the partitions were.  A task writes under a name of its own
attempt and reports the file as a row; only the rows of tasks that succeeded
reach the list, and the files on the list are then given their final names.
Both steps may be repeated after a lost executor.  What a failed attempt left
is on no list and is never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm.common import materialise

#: Keys that come to the driver to cut the rows by, at any size (8 bytes each).
KEYS = 1 << 20
TEMPORARY = "_temporary"
MANIFEST = "_manifest"


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with its scheme, as Spark itself takes it: executors open the very folder Spark writes to."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path in it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def split_points(rows: DataFrame, key: str, shards: int, per_shard: int = 16) -> np.ndarray:
    """At most ``shards - 1`` long keys that cut ``rows`` into ranges of about equal row counts.

    About ``per_shard`` keys a shard, picked by hash, come to the driver, and
    about ``KEYS`` in all: shards are at most ``KEYS // per_shard``, each then
    with more rows.
    """
    shards = min(shards, KEYS // per_shard)
    if shards <= 1:
        return np.array([], np.int64)
    n = rows.count()
    share = min(1.0, shards * per_shard / max(n, 1))
    keys = (rows.filter(F.col(key).isNotNull()).select(key).distinct()
            .filter(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1))
    held = np.sort(np.array([r[0] for r in keys.collect()], np.int64))
    at = (np.arange(1, shards) * len(held) // shards)
    return np.unique(held[at]) if len(held) else held


def shard_of(key: Column, points: np.ndarray) -> Column:
    """How many split points are at or below the key: its shard, 0 for NULL."""
    @F.arrow_udf("int")
    def run(keys: pa.Array) -> pa.Array:
        known = keys.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(points, known, side="right").astype(np.int32))
    return run(key)


def in_shards(rows: DataFrame, key: str, points: np.ndarray, *order: str) -> DataFrame:
    """``rows`` with a column ``shard``, each shard whole in one partition and sorted by key, then ``order``."""
    dealt = rows.withColumn("shard", shard_of(F.col(key), points))
    return dealt.repartitionById(len(points) + 1, F.col("shard")).sortWithinPartitions("shard", key, *order)


def temporary_name(root: str, shard: int, part: int, kind: str) -> tuple[str, str]:
    """(temporary name of this attempt, final name) of a file under ``root``."""
    final = f"shard-{shard:06d}-{part:04d}.{kind}"
    return f"{TEMPORARY}/{uuid.uuid4().hex}-{final}", final


def commit(files: DataFrame, root: str) -> DataFrame:
    """Run the writer ``files`` (columns temporary, file, ...) once, then move what it lists to final names.

    Gives the manifest as a table: the rows of ``files`` without ``temporary``.
    """
    root = qualified(files.sparkSession, root)
    listed = materialise(files, "shard-files")
    names = [c for c in listed.columns if c != "temporary"]

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(root)
        for batch in batches:
            for src, dst in zip(batch.column("temporary").to_pylist(), batch.column("file").to_pylist()):
                if store.get_file_info(f"{top}/{src}").type != fs.FileType.NotFound:
                    store.move(f"{top}/{src}", f"{top}/{dst}")
                elif store.get_file_info(f"{top}/{dst}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{dst}: neither written nor moved")
            yield batch.select(names)

    moved = listed.mapInArrow(move, listed.select(names).schema)
    moved.write.mode("overwrite").parquet(f"{root}/{MANIFEST}")  # its own commit marks the set of shards complete
    return listed.sparkSession.read.schema(moved.schema).parquet(f"{root}/{MANIFEST}")


def read_files(manifest: DataFrame, root: str, read: Callable[[fs.FileSystem, str, dict], Iterator[pa.RecordBatch]],
               schema: str) -> DataFrame:
    """One task per file of the manifest: ``read(store, path, manifest row)``."""
    root = qualified(manifest.sparkSession, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(root)
        for batch in batches:
            for row in batch.to_pylist():
                yield from read(store, f"{top}/{row['file']}", row)

    n = max(1, manifest.count())
    return manifest.repartition(n, "file").mapInArrow(run, schema)
