"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.session import scratch_path

#: A word is a run without ASCII white space; the class below is that white space.
WORD = r"[^\x20\x09-\x0D]+"


def materialise(df: DataFrame, name: str, group: int | None = None) -> DataFrame:
    """Write ``df`` once to the session's shared folder and read it back.

    Cuts the lineage at a reliable copy (a lost executor never recomputes
    what came before) and gives Catalyst the true size of the table, so a
    join is planned as a broadcast only when that size is under the threshold.
    ``group`` is the most rows a row group may hold, for rows of some MB.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")  # texts and ids are most of it
    if group is not None:
        writer = writer.option("parquet.block.row.count.limit", group)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores until no column of ``df`` has it (case-blind)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda body that names an expression evaluates it again for every
    element; bound as a lambda variable it is evaluated once.
    """
    return F.transform(F.array(value), lambda v: body(v))[0]


def unit_hash(key: Column, seed: int) -> Column:
    """A uniform double in (0, 1] from a key, the same on every run and engine (52 bits of MD5)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(2 ** 52))


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with, per column of ``sums``, its sum over all rows before the row in a global order.

    The rows are cut into ranges of the order and stored with their range; the
    ranges' totals (one row per range) are summed up, and rows are only ever
    ordered within a range.  Rows that tie in ``order`` come one after the
    other, in any order.
    """
    place = unused(df, "place")
    ranged = df.repartitionByRange(*order).withColumns({place: F.spark_partition_id(), **sums})
    ranged = materialise(ranged, name)
    before = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(place).agg(*[F.sum(c).alias(c) for c in sums])
    totals = totals.select(place, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_ahead") for c in sums])
    inside = Window.partitionBy(place).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    held = ranged.withColumns({c: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    return held.join(totals, place).withColumns({c: F.col(c) + F.col(f"{c}_ahead") for c in sums}) \
        .drop(place, *[f"{c}_ahead" for c in sums])
