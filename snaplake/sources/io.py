"""Sources and sinks.

Tables are addressed either by catalog name (``db.table``) or by a path
(anything containing ``/``).  ``fmt`` is ``parquet`` by default; ``delta``
is used when the Delta package is on the classpath; with reader and writer
``options`` any other Spark format (``jdbc`` among them) is reachable.

A refresh may read the table it replaces.  Nothing tries to find that out
from the plan: new data is always complete, in a folder of its own, before
anything old is touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snaplake.schemas import CONTROL_TABLES, LAKE_TABLES, LANDING, PARTITION_COLUMNS
from snaplake.session import staged

#: Formats whose tables are folders of files; others replace their data in a transaction of their own.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


def _is_path(target: str) -> bool:
    return "/" in target or target.startswith("file:")


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path, by the session's Hadoop settings."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def table_exists(spark: SparkSession, target: str) -> bool:
    """True when the catalog table is there, or the path holds any visible entry."""
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    fs, hpath = _hadoop(spark, target)
    if not fs.exists(hpath):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(hpath))


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", schema: StructType | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Table scan by catalog name or path (filters/projections applied later
    are pushed into the scan by Catalyst).  For a source without a path, such
    as ``fmt='jdbc'``, ``target`` may be ``''`` and ``options`` say the rest."""
    if target and not _is_path(target):
        return spark.table(target)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(target) if target else reader.load()


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Columns of a landing read with ``quarantine``: the text of a record that could not be read whole, and its file.
CORRUPT, SOURCE_FILE = "corrupt_record", "source_file"


def read_landing(spark: SparkSession, path: str, fmt: str = "json", schema: StructType = LANDING,
                 quarantine: bool = False) -> DataFrame:
    """Landed API responses (one record per attempt) with an explicit schema
    - never inferred, so a new file cannot change the types.

    ``quarantine`` adds two columns in the same pass: the text of a record that
    is no JSON object, or whose fields do not have the schema's types, and the
    file of every record.  A run writes such records to the reject table
    instead of taking them for rows of NULLs."""
    reader = spark.read.schema(schema)
    if fmt != "json":
        df = reader.format(fmt).load(path)
        return df.withColumns({CORRUPT: F.lit(None).cast("string"), SOURCE_FILE: F.col("_metadata.file_path")}) if quarantine else df
    if not quarantine:
        return reader.option("mode", "PERMISSIVE").json(path)
    reader = spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
    df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def _clustered(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    """Rows of a partition in few tasks, so a write makes few files per
    partition instead of one per task and partition; AQE splits a large
    partition and joins small ones at its advisory size."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _writer(df: DataFrame, mode: str, fmt: str, partition_by: Sequence[str] | None, options: dict[str, str] | None = None):
    w = _clustered(df, partition_by).write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def append_table(df: DataFrame, target: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                 options: dict[str, str] | None = None) -> None:
    """Append-only sink (the raw snapshot log, the call registry, audit)."""
    w = _writer(df, "append", fmt, partition_by, options)
    if not target:
        w.save()
    elif _is_path(target):
        w.save(target)
    else:
        w.saveAsTable(target)


def _replace_folder(df: DataFrame, target: str, fmt: str, partition_by: Sequence[str] | None) -> None:
    """Write a complete new folder beside ``target``, then put it in its place.

    The old folder is moved aside before and removed after, so a failure at
    any point leaves one complete copy; nothing of the input is gone while
    the new data is computed."""
    spark = df.sparkSession
    base, mark = target.rstrip("/"), uuid.uuid4().hex[:12]
    new, old = f"{base}._new-{mark}", f"{base}._old-{mark}"
    _writer(df, "errorifexists", fmt, partition_by).save(new)
    fs, at = _hadoop(spark, base)
    _, new_path = _hadoop(spark, new)
    _, old_path = _hadoop(spark, old)
    had = fs.exists(at)
    if had and not fs.rename(at, old_path):
        raise OSError(f"could not move {base} aside; the new data is in {new}")
    if not fs.rename(new_path, at):
        raise OSError(f"could not put the new data of {base} in place; it is in {new}, the old in {old}")
    if had:
        fs.delete(old_path, True)
    spark.catalog.refreshByPath(base)


def _leaves(fs, top, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``top``, as paths relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{at}/{st.getPath().getName()}".lstrip("/") for at in found
                 for st in fs.listStatus(top.suffix(f"/{at}") if at else top)
                 if st.isDirectory() and "=" in st.getPath().getName()]
    return found


def _swap_slices(spark: SparkSession, base: str, mark: str, depth: int) -> None:
    """Put the partition folders of ``base._slices-mark`` in the place of those of
    ``base``, one by one.  Started again after a failure it goes on where it
    stopped: a folder that was moved is no longer there."""
    fs, new = _hadoop(spark, f"{base}._slices-{mark}")
    old = f"{base}._old-{mark}"

    def move(src, dst) -> None:
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {src} to {dst}; the new data of {base} is in {new}")

    for leaf in _leaves(fs, new, depth):
        _, at = _hadoop(spark, f"{base}/{leaf}")
        _, aside = _hadoop(spark, f"{old}/{leaf}")
        if fs.exists(at):
            fs.delete(aside, True)
            move(at, aside)
        move(new.suffix(f"/{leaf}"), at)
    fs.delete(_hadoop(spark, old)[1], True)
    fs.delete(new, True)
    spark.catalog.refreshByPath(base)


def _replace_slices(df: DataFrame, target: str, fmt: str, partition_by: Sequence[str], emptied: Sequence = ()) -> None:
    """Write the new partitions completely beside ``target``, then swap them in.

    Of the partitions with the values ``emptied`` those without new rows become
    empty folders, in the same swap.  The folder gets the name ``_slices-`` only once it is complete: that name
    is the record of what is to be done, and :func:`finish_refresh` does it
    after a failure."""
    spark = df.sparkSession
    base, mark = target.rstrip("/"), uuid.uuid4().hex[:12]
    partial, ready = f"{base}._part-{mark}", f"{base}._slices-{mark}"
    _writer(df, "errorifexists", fmt, partition_by).save(partial)
    fs, at = _hadoop(spark, partial)
    _, old = _hadoop(spark, base)
    for value in emptied:
        leaf = f"/{partition_by[0]}={_partition_text(value)}"
        if fs.exists(old.suffix(leaf)) and not fs.exists(at.suffix(leaf)):
            fs.mkdirs(at.suffix(leaf))
    if not fs.rename(at, _hadoop(spark, ready)[1]):
        raise OSError(f"could not name the complete slices {ready}; they are in {partial}")
    _swap_slices(spark, base, mark, len(partition_by))


def finish_refresh(spark: SparkSession, target: str) -> int:
    """Finish slice refreshes of a path that a failure cut off, oldest first,
    and clear what never became complete; how many were finished."""
    if not _is_path(target):
        return 0
    base = target.rstrip("/")
    fs, at = _hadoop(spark, base)
    if not fs.exists(at.getParent()):
        return 0
    done, name = 0, at.getName()
    beside = sorted(fs.listStatus(at.getParent()), key=lambda st: st.getModificationTime())
    for st in beside:
        own = st.getPath().getName()
        if own.startswith(f"{name}._slices-"):
            depth, below = 0, st.getPath()
            while True:  # as deep as its folders are partitions
                inner = [i for i in fs.listStatus(below) if i.isDirectory() and "=" in i.getPath().getName()]
                if not inner:
                    break
                depth, below = depth + 1, inner[0].getPath()
            _swap_slices(spark, base, own.rsplit("-", 1)[1], depth)
            done += 1
        elif own.startswith(f"{name}._part-"):
            fs.delete(st.getPath(), True)
    return done


def refresh_table(df: DataFrame, target: str, fmt: str = "parquet",
                  partition_by: Sequence[str] | None = None, replace: str = "slices",
                  bucket_by: tuple[int, Sequence[str]] | None = None, emptied: Sequence = ()) -> None:
    """Full-refresh sink.

    With ``partition_by`` and ``replace='slices'`` only the partitions
    (date slices) present in ``df`` are replaced - dynamic partition
    overwrite, the ``replaceWhere`` pattern; ``replace='all'`` replaces the
    whole table, so a partition missing from ``df`` disappears.  Without
    ``partition_by`` the whole table is replaced.

    ``df`` may read the target: new partitions, or the whole new folder, are
    written beside the old ones and moved in when they are complete, and data
    for a catalog table is staged first.  Into a catalog table columns go by
    name.  ``emptied`` are values of the (first) partition column that ``df``
    speaks for: a stored partition of theirs without rows in ``df`` is emptied.
    ``bucket_by`` (buckets, keys) lays a new one out by keys, so that what
    groups or windows by them reads it without a shuffle.  A failure while partitions are moved is made good by the next
    refresh of the path, or by :func:`finish_refresh`.
    """
    if replace not in ("slices", "all"):
        raise ValueError("replace must be 'slices' or 'all'")
    spark = df.sparkSession
    slices = bool(partition_by) and replace == "slices"
    mode = "dynamic" if slices else "static"
    if _is_path(target):
        if fmt not in FILE_FORMATS:
            _writer(df, "overwrite", fmt, partition_by, {"partitionOverwriteMode": mode}).save(target)
            return
        finish_refresh(spark, target)
        if slices and table_exists(spark, target):
            _replace_slices(df, target, fmt, partition_by, emptied)
        else:
            _replace_folder(df, target, fmt, partition_by)
    elif spark.catalog.tableExists(target):
        ready = staged(df, "refresh").select(*spark.table(target).columns)
        laid = ready.repartition(bucket_by[0], *bucket_by[1]) if bucket_by else _clustered(ready, partition_by)
        laid.write.mode("overwrite").option("partitionOverwriteMode", mode).insertInto(target)
        if emptied:
            held = {str(r[0]) for r in ready.select(F.col(partition_by[0]).cast("string")).distinct().collect()}
            drop_partitions(spark, target, [v for v in emptied if str(v) not in held], partition_by[0])
    elif bucket_by:  # a task holds a bucket, so each partition gets one file a bucket
        n, keys = bucket_by
        w = df.repartition(n, *keys).write.mode("overwrite").format(fmt).bucketBy(n, *keys).sortBy(*keys)
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(target)
    else:
        _writer(df, "overwrite", fmt, partition_by).saveAsTable(target)


def compact_table(spark: SparkSession, target: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                  max_files: int = 16, schema: StructType | None = None, fold=None) -> int:
    """Rewrite the partitions of a path that hold more than ``max_files`` files,
    each into as few as its size needs; how many were rewritten.

    Append-only logs gain a set of files per run.  Only file counts come to the
    driver; the rows stay, or are what ``fold`` (DataFrame -> DataFrame, of the
    whole table) makes of them.  The swap is that of a refresh, so a failure
    leaves one complete copy."""
    finish_refresh(spark, target)
    if not _is_path(target) or fmt not in FILE_FORMATS or not table_exists(spark, target):
        return 0
    base = target.rstrip("/")
    fs, at = _hadoop(spark, base)

    def files(leaf: str) -> int:
        return sum(st.isFile() and not st.getPath().getName().startswith(("_", "."))
                   for st in fs.listStatus(at.suffix(f"/{leaf}") if leaf else at))

    crowded = [leaf for leaf in _leaves(fs, at, len(partition_by)) if files(leaf) > max_files]
    if not crowded:
        return 0
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema is not None else reader
    if fold is not None or not partition_by:
        rows = fold(reader.load(base)) if fold else reader.load(base)
        _replace_folder(rows if partition_by else rows.hint("rebalance"), base, fmt, partition_by)
    else:
        _replace_slices(reader.option("basePath", base).load([f"{base}/{leaf}" for leaf in crowded]), base, fmt, partition_by)
    return len(crowded)


def drop_partitions(spark: SparkSession, target: str, values: Sequence, partition: str) -> None:
    """Remove whole partitions of a path or catalog table by their values."""
    for value in values:
        if _is_path(target):
            fs, hpath = _hadoop(spark, f"{target.rstrip('/')}/{partition}={_partition_text(value)}")
            fs.delete(hpath, True)
        else:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (`{partition}` = '{value}')")
    if _is_path(target):
        spark.catalog.refreshByPath(target)


def _partition_text(value) -> str:
    return str(value).replace(":", "%3A")


def _ddl(schema: StructType) -> str:
    cols = []
    for f in schema.fields:
        null = "" if f.nullable else " NOT NULL"
        cols.append(f"`{f.name}` {f.dataType.simpleString()}{null}")
    return ", ".join(cols)


def ensure_tables(spark: SparkSession, database: str, fmt: str = "parquet",
                  location: str | None = None, partitioned: bool = False,
                  tables: dict[str, StructType] | None = None) -> list[str]:
    """Idempotent bootstrap: ``CREATE DATABASE/TABLE IF NOT EXISTS``.

    Returns the fully qualified names.  ``partitioned`` partitions the
    Silver/Gold tables by their natural date column.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    todo = tables if tables is not None else {**LAKE_TABLES, **CONTROL_TABLES}
    names = []
    for name, schema in todo.items():
        fq = f"`{database}`.`{name}`"
        if not spark.catalog.tableExists(f"{database}.{name}"):
            parts = ""
            if partitioned and name in PARTITION_COLUMNS:
                parts = f" PARTITIONED BY (`{PARTITION_COLUMNS[name]}`)"
            loc = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
            # NOT NULL is kept in the schema docs; file formats do not enforce
            # it, constraint_violations checks it.
            ddl = _ddl(schema).replace(" NOT NULL", "")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {fq} ({ddl}) USING {fmt}{parts}{loc}")
        names.append(f"{database}.{name}")
    return names
