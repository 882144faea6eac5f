"""Silver operators: typed observations out of raw JSON payloads, latest wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snaplake.functions.casts import lenient_cast
from snaplake.functions.json import path_column, schema_for_paths
from snaplake.functions.time import ts_lit
from snaplake.schemas import RESULT_SUCCESS

_PARSED = "__snaplake_parsed"


def trusted_snapshots(bronze: DataFrame, result_col: str = "api_result",
                      payload_col: str = "raw_payload", ok: str = RESULT_SUCCESS) -> DataFrame:
    """Rows whose call succeeded and carry a payload (pushed to the scan)."""
    return bronze.filter((F.col(result_col) == F.lit(ok)) & F.col(payload_col).isNotNull())


def normalize_json(df: DataFrame, json_col: str, spec: dict[str, tuple[str, str]],
                   ts_col: str | None = None, date_col: str | None = None,
                   keep: Sequence[str] | None = None,
                   ts_formats: Sequence[str] | None = None) -> DataFrame:
    """JSON payload -> typed columns.

    ``spec`` maps output column -> (JSON path, type).  The payload is parsed
    once per row (one ``from_json`` against a schema covering every path,
    leaves read as STRING, then ANSI-safe lenient casts).  ``ts_col`` (an
    output of the spec or an existing column) must be non-NULL - rows whose
    observation time does not parse are dropped - and ``date_col`` is
    derived from it.  ``keep`` lists the input columns carried along
    (default: all but the payload).
    """
    keep = [c for c in df.columns if c != json_col] if keep is None else list(keep)
    schema = schema_for_paths([p for p, _ in spec.values()])
    # The parse sits in a Generate (inline of a one-element array): a later
    # filter on a parsed leaf (the NOT NULL observation time) cannot be
    # pushed below it, so Catalyst does not inline - and repeat - the
    # from_json inside that filter.  One parse per row.
    one = F.array(F.struct(F.from_json(F.col(json_col), schema, {"mode": "PERMISSIVE"}).alias(_PARSED)))
    parsed = df.select(*keep, F.inline(one))
    fmts = list(ts_formats) if ts_formats else None
    out = parsed.select(
        *keep,
        *[lenient_cast(path_column(F.col(_PARSED), path), typ, fmts).alias(name)
          for name, (path, typ) in spec.items()],
    )
    if ts_col is not None:
        out = out.filter(F.col(ts_col).isNotNull())
        if date_col is not None:
            out = out.withColumn(date_col, F.to_date(F.col(ts_col)))
    return out


#: Columns of :func:`shred_payload`.
VARIANT_COL, SHREDDED_COL = "payload", "is_shredded"


def shred_payload(df: DataFrame, json_col: str, spec: dict[str, tuple[str, str]], variant_col: str = VARIANT_COL,
                  flag_col: str = SHREDDED_COL) -> DataFrame:
    """``df`` with its JSON text parsed once more into a VARIANT, which the parquet
    writer stores as one column per leaf, and a flag that says whether the
    VARIANT gives the very values that the text gives.

    It does not where the text is no plain JSON (a repeated field, ``NaN``), or
    where a leaf that is read as text is a number or an object (its spelling is
    lost); such rows are parsed from their text again."""
    payload = F.try_parse_json(json_col)
    text = F.lit(True)
    for path, typ in spec.values():
        if typ == "string":
            kind = F.schema_of_variant(F.try_variant_get(F.col(variant_col), path, "variant"))
            text = text & (F.coalesce(kind, F.lit("VOID")).isin("STRING", "VOID"))
    return df.withColumn(variant_col, payload).withColumn(flag_col, F.col(variant_col).isNotNull() & F.coalesce(text, F.lit(False)))


def normalize_shredded(df: DataFrame, json_col: str, spec: dict[str, tuple[str, str]], keep: Sequence[str],
                       ts_formats: Sequence[str] | None = None, variant_col: str = VARIANT_COL,
                       flag_col: str = SHREDDED_COL) -> DataFrame:
    """:func:`normalize_json` of a table written with :func:`shred_payload`.

    Flagged rows come from the leaf columns that the scan reads, and no JSON is
    parsed; the others (a scan of their own, which the flag's statistics skip
    where there are none) from their text.  Results are equal; a NULL text has no row."""
    fmts = list(ts_formats) if ts_formats else None
    leaf = {name: F.try_variant_get(F.col(variant_col), path, "string") for name, (path, _) in spec.items()}
    # leaves first, casts above them: the scan takes over what is asked of the VARIANT alone
    read = df.filter(F.col(flag_col)).select(*keep, *[leaf[n].alias(n) for n in spec])
    fast = read.select(*keep, *[lenient_cast(F.col(n), typ, fmts).alias(n) for n, (_, typ) in spec.items()])
    rest = df.filter(~F.col(flag_col) & F.col(json_col).isNotNull()).select(*keep, json_col)
    return fast.unionByName(normalize_json(rest, json_col, spec, keep=keep, ts_formats=ts_formats))


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).desc_nulls_last() for c in cols]


def _content(df: DataFrame) -> Column:
    """A hash of a row's columns (those whose type Spark can hash)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                        if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))])


def latest_wins(df: DataFrame, keys: Sequence[str], ts: str | Column,
                version_cols: Sequence[str | Column]) -> DataFrame:
    """One row per (keys, ts): the one with the greatest version.

    ``version_cols`` are compared descending (NULLs last), left to right; the
    later ones break ties, and rows that tie in all of them go by a hash of
    their content, so the result never depends on the order of the input.  A
    Column is used as given (e.g. ``F.col('x').asc()``).

    Plan: ``row_number() = 1`` becomes a WindowGroupLimit that keeps only the
    first row per group *before* the shuffle as well as after it, so a hot
    (key, ts) group with many versions is reduced map-side.
    """
    ts_c = ts if isinstance(ts, Column) else F.col(ts)
    w = Window.partitionBy(*[F.col(k) for k in keys], ts_c).orderBy(*_order(version_cols), _content(df).desc())
    rn = "__snaplake_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def stamp_lineage(df: DataFrame, stamp_col: str, execution_id: str | None,
                  pipeline_run_id: str | None, now=None) -> DataFrame:
    """Add ``stamp_col`` (ingestion time), ``execution_id``, ``pipeline_run_id``."""
    ts = F.current_timestamp() if now is None else ts_lit(now)
    return (df.withColumn(stamp_col, ts)
              .withColumn("execution_id", F.lit(execution_id).cast("string"))
              .withColumn("pipeline_run_id", F.lit(pipeline_run_id).cast("string")))
