"""Gold operators over keyed observations: daily aggregates, calendar
windows, per-day ranking, banded day counts and monthly correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snaplake.functions.bands import Band, band_of
from snaplake.functions.stats import safe_corr
from snaplake.functions.time import trunc_like
from snaplake.session import staged

_AGG_FNS = ("avg", "max", "min", "sum", "count")


def daily_metrics(df: DataFrame, keys: Sequence[str], date: str, value: str,
                  aggs: Sequence[str] = ("avg", "max", "count"),
                  names: dict[str, str] | None = None, out_date: str = "date") -> DataFrame:
    """Per (keys, date): avg -> DOUBLE, max/min in the value's type, count(1).

    Only published values count: rows with a NULL value or NULL date are
    dropped first (pushed to the scan).  The aggregate is partial
    (map-side combine), so a hot entity is pre-reduced before the shuffle.
    """
    names = {"avg": f"avg_{value}", "max": f"max_{value}", "min": f"min_{value}",
             "sum": f"sum_{value}", "count": "observations_cnt", **(names or {})}
    v = F.col(value)
    exprs = {
        "avg": F.avg(v).cast("double"),
        "max": F.max(v),
        "min": F.min(v),
        "sum": F.sum(v),
        "count": F.count(F.lit(1)),
    }
    unknown = set(aggs) - set(_AGG_FNS)
    if unknown:
        raise ValueError(f"unsupported daily aggregate(s): {sorted(unknown)}")
    return (
        df.filter(v.isNotNull() & F.col(date).isNotNull())
        .groupBy(*[F.col(k) for k in keys], F.col(date).alias(out_date))
        .agg(*[exprs[a].alias(names[a]) for a in aggs])
    )


def rolling_calendar(daily: DataFrame, keys: Sequence[str], date: str,
                     aggs: dict[str, tuple[str, str]], days: int = 7,
                     count_col: str | None = "days_in_window") -> DataFrame:
    """Rolling aggregates over the last ``days`` *calendar* days per entity.

    The frame is RANGE over the day number, [d - days + 1, d]: a gap in the
    data shortens the coverage, it never reaches further back (a ROWS frame
    would).  ``aggs`` maps output -> (fn, column), fn in avg/max/min/sum/count;
    ``count_col`` counts the days with data in the frame (1..days).

    The window holds one row per entity-day, so its per-entity state is
    bounded by the calendar span, not by the observation volume.
    """
    w = (Window.partitionBy(*[F.col(k) for k in keys])
         .orderBy(F.unix_date(F.col(date)))
         .rangeBetween(-(days - 1), 0))
    out = daily
    for name, (fn, colname) in aggs.items():
        c = F.col(colname)
        if fn == "avg":
            e = F.avg(c).over(w).cast("double")
        elif fn in ("max", "min", "sum"):
            e = getattr(F, fn)(c).over(w)
        elif fn == "count":
            e = F.count(c).over(w)
        else:
            raise ValueError(f"unsupported rolling aggregate {fn!r}")
        out = out.withColumn(name, e)
    if count_col:
        out = out.withColumn(count_col, F.count(F.lit(1)).over(w))
    return out


def rank_worst(df: DataFrame, date: str, metric: str, rank_col: str = "rank",
               flag_col: str | None = "is_worst", ndigits: int | None = 6,
               partition: Sequence[str] = (), strategy: str = "range",
               range_partitions: int | None = None) -> DataFrame:
    """Dense rank per date by ``metric`` descending, NULLs last; ties share.

    Every row of a date is ranked (no completeness gate).  ``ndigits``
    rounds the metric for ranking only, so float noise from a different
    partial-sum order does not split a tie; ``None`` ranks the raw value.

    ``strategy='range'`` never puts a whole date in one task: see
    :func:`dense_rank_desc`.  ``strategy='window'`` ranks each date in one
    window partition (one task per date; a spillable sort) without an action.
    """
    m = F.col(metric)
    key = F.round(m, ndigits) if ndigits is not None else m
    groups = [date, *partition]
    if strategy == "window":
        w = Window.partitionBy(*[F.col(g) for g in groups]).orderBy(key.desc_nulls_last())
        out = df.withColumn(rank_col, F.dense_rank().over(w))
    elif strategy == "range":
        out = dense_rank_desc(df, groups, key, rank_col, range_partitions)
    else:
        raise ValueError("strategy must be 'window' or 'range'")
    if flag_col:
        out = out.withColumn(flag_col, F.col(rank_col) == F.lit(1))
    return out


def dense_rank_desc(df: DataFrame, groups: Sequence[str], value: Column, rank_col: str,
                    num_partitions: int | None = None) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY groups ORDER BY value DESC NULLS LAST)``
    without holding any group in one task.

    1. distinct (groups, value) - a partial aggregate, so duplicates of a hot
       value are merged map-side;
    2. range-partition those by (groups, value desc): a wide group spans
       several partitions; number the values inside each (partition, group);
    3. per (partition, group) counts - at most partitions + groups rows -
       give each partition the number of values of its group that sort
       before it (running sum over partition ids);
    4. rank = offset + local number, joined back on (groups, value) with a
       null-safe key.  The rank side has one row per key, so AQE can split
       a skewed key on the big side.

    The frame itself and the values of step 2 are written to the shared
    folder once (two actions): the ranks are joined back on the values, so
    both sides must see the same evaluation - a double that comes out of a
    different partial-sum order would find no rank.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    gcols = [f"__sl_g{i}" for i in range(len(groups))]
    tagged = staged(df.withColumn("__sl_val", value), "ranked-rows")
    dv = tagged.select(*[F.col(g).alias(c) for g, c in zip(groups, gcols)], F.col("__sl_val").alias("__sl_v")) \
        .dropDuplicates([*gcols, "__sl_v"])
    # the range bounds come from a sample whose rows arrive in shuffle-fetch
    # order: counts and numbers below must see one and the same partitioning
    ranged = staged(dv.repartitionByRange(n, *[F.col(c) for c in gcols], F.col("__sl_v").desc_nulls_last())
                    .withColumn("__sl_p", F.spark_partition_id()), "ranked-values")
    local = ranged.withColumn("__sl_lr", F.row_number().over(
        Window.partitionBy("__sl_p", *gcols).orderBy(F.col("__sl_v").desc_nulls_last())))
    counts = local.groupBy("__sl_p", *gcols).agg(F.max("__sl_lr").alias("__sl_n"))
    offsets = counts.withColumn("__sl_off", F.coalesce(F.sum("__sl_n").over(
        Window.partitionBy(*gcols).orderBy("__sl_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranks = local.join(offsets.select("__sl_p", *gcols, "__sl_off"), on=["__sl_p", *gcols]) \
        .select(*gcols, "__sl_v", (F.col("__sl_off") + F.col("__sl_lr")).cast("int").alias(rank_col))
    cond = [tagged[g].eqNullSafe(ranks[c]) for g, c in zip(groups, gcols)] + \
        [tagged["__sl_val"].eqNullSafe(ranks["__sl_v"])]
    return tagged.join(ranks, on=cond, how="left").drop(*gcols, "__sl_v", "__sl_val")


def classify_bands(df: DataFrame, value: str, bands: Sequence[Band],
                   out: str = "category", drop_unmatched: bool = True) -> DataFrame:
    """Category of ``value`` by inclusive ranges; unmatched -> NULL (dropped)."""
    res = df.withColumn(out, band_of(F.col(value), bands))
    return res.filter(F.col(out).isNotNull()) if drop_unmatched else res


def band_days_by_month(daily: DataFrame, keys: Sequence[str], date: str, value: str,
                       bands: Sequence[Band], month_col: str = "month_start",
                       total_col: str = "days_with_data", value_cast: str | None = None) -> DataFrame:
    """Per (keys, month): how many days fall in each band, and their total.

    One aggregate with a ``count_if`` per band (a fixed-value ``pivot``
    would aggregate twice and shuffle twice).  Days outside every band are
    not counted anywhere; a month with only such days yields no row.
    ``value_cast`` casts first (bands are on integers: 50.5 must not fall
    into a gap).
    """
    v = F.col(value).cast(value_cast) if value_cast else F.col(value)
    cat = "__snaplake_band"
    tagged = classify_bands(daily.select(*keys, date, v.alias("__sl_v")), "__sl_v", bands, cat)
    tagged = tagged.withColumn(month_col, trunc_like(tagged, date, "month"))
    return tagged.groupBy(*keys, month_col).agg(
        *[F.count_if(F.col(cat) == F.lit(name)).alias(name) for name, _, _ in bands],
        F.count(F.lit(1)).alias(total_col),
    )


def monthly_correlation(pairs: DataFrame, keys: Sequence[str], left_ts: str, x: str,
                        ys: dict[str, str], count_col: str = "pairs_cnt",
                        month_col: str = "month_start") -> DataFrame:
    """Pearson correlation of ``x`` with each ``ys`` column per (keys, month).

    The month comes from the *left* timestamp.  ``count_col`` counts pairs
    even where a measure is NULL; each correlation uses only the pairs where
    both of its sides are present and is NULL (never an error) for fewer
    than two pairs or zero variance.
    """
    tagged = pairs.withColumn(month_col, trunc_like(pairs, left_ts, "month"))
    return tagged.groupBy(*keys, month_col).agg(
        F.count(F.lit(1)).alias(count_col),
        *[safe_corr(F.col(x), F.col(y)).alias(name) for name, y in ys.items()],
    )


def pair_moments(pairs: DataFrame, keys: Sequence[str], left_ts: str, x: str, ys: dict[str, str],
                 count_col: str = "pairs_cnt", date_col: str = "date") -> DataFrame:
    """Mergeable state of :func:`monthly_correlation` per (keys, day of the left timestamp).

    Per ``ys`` column one struct over the pairs with both sides: how many, both
    means, both sums of squares about the mean, the sum of products, and both
    ranges (a constant side is told by its range, not by rounded squares).
    """
    def moments(y: str) -> Column:
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
        n = F.count(a)
        return F.struct(n.alias("n"), F.avg(a).alias("mx"), F.avg(b).alias("my"), (F.var_pop(a) * n).alias("sxx"),
                        (F.var_pop(b) * n).alias("syy"), (F.covar_pop(a, b) * n).alias("sxy"), F.min(a).alias("lox"),
                        F.max(a).alias("hix"), F.min(b).alias("loy"), F.max(b).alias("hiy"))
    tagged = pairs.withColumn(date_col, F.to_date(left_ts))
    return tagged.groupBy(*keys, date_col).agg(F.count(F.lit(1)).alias(count_col),
                                               *[moments(y).alias(name) for name, y in ys.items()])


def correlation_of_moments(state: DataFrame, keys: Sequence[str], names: Sequence[str], count_col: str = "pairs_cnt",
                           date_col: str = "date", month_col: str = "month_start") -> DataFrame:
    """:func:`monthly_correlation` from the day states of :func:`pair_moments`.

    The states of a month (at most one per day) are merged two by two in date
    order with the update of pairwise means and co-moments, so a month is
    rebuilt from its days without reading a pair."""
    def merged(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy, both = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * b["n"] / n
        out = F.struct(n.alias("n"), (a["mx"] + dx * b["n"] / n).alias("mx"), (a["my"] + dy * b["n"] / n).alias("my"),
                       (a["sxx"] + b["sxx"] + dx * dx * both).alias("sxx"), (a["syy"] + b["syy"] + dy * dy * both).alias("syy"),
                       (a["sxy"] + b["sxy"] + dx * dy * both).alias("sxy"), F.least(a["lox"], b["lox"]).alias("lox"),
                       F.greatest(a["hix"], b["hix"]).alias("hix"), F.least(a["loy"], b["loy"]).alias("loy"),
                       F.greatest(a["hiy"], b["hiy"]).alias("hiy"))
        return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(out)

    def corr(name: str) -> Column:
        days = F.transform(F.col("__sl_days"), lambda d: d[name])
        whole = F.reduce(F.slice(days, 2, F.greatest(F.size(days), F.lit(1))), days[0], merged)
        varies = (whole["hix"] > whole["lox"]) & (whole["hiy"] > whole["loy"])
        return F.when(varies, F.try_divide(whole["sxy"], F.sqrt(whole["sxx"]) * F.sqrt(whole["syy"])))

    tagged = state.withColumn(month_col, F.date_trunc("month", F.col(date_col).cast("timestamp")))
    days = tagged.groupBy(*keys, month_col).agg(
        F.sum(count_col).alias(count_col), F.sort_array(F.collect_list(F.struct(date_col, *names))).alias("__sl_days"))
    return days.select(*keys, month_col, count_col, *[corr(n).alias(n) for n in names])


def with_constant(df: DataFrame, name: str, value, type_: str | None = None) -> DataFrame:
    c: Column = F.lit(value)
    return df.withColumn(name, c.cast(type_) if type_ else c)
