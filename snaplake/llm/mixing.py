"""Mixing sources to target weights by weighted sampling without replacement.

A document's key is ``-ln(u) / w`` for a uniform ``u`` of its id and its quality
weight ``w`` (Efraimidis and Spirakis, "Weighted random sampling with a
reservoir", 2006); within a source, the documents with the smallest keys are a
weighted sample.  A source whose target is several times its size takes every
document for each complete epoch; the rest of the target is filled by the
documents in key order, up to the token budget.

A source may hold most of the corpus: its keys are cut into ``BUCKETS`` ranges
of about equal numbers, the budget is first carried over the ranges' sums, and
only documents of one range are ever sorted together.  Sources may be many:
their order and the level of their targets come from sums over ranges too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import WORD, col, materialise, prefix_sums, unit_hash

#: Ranges of the key that one source's documents are dealt into.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """A quality weight: the share of letters among all characters but white space, 0.05 to 1."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(letters / F.nullif(solid, F.lit(0)), F.lit(0.05)))


def source_targets(sizes: DataFrame, weights: Sequence[float], total: float, limit: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Weights repeat over the sources in code point order (NULL last).  Handing
    an excess out again by weight until no target is over its limit ends at one
    level L with target = min(limit * size, weight * L): sources are full in
    the order of limit * size / weight.  The rows are one per source.
    """
    rate = F.array(*[F.lit(float(w)) for w in weights])
    named = [F.col("source").isNull(), F.col("source")]
    ranked = prefix_sums(sizes, named, {"rank": F.lit(1)}, "mix-source-ranks")
    ranked = (ranked.withColumn("w", F.element_at(rate, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")))
              .withColumn("full", F.lit(float(limit)) * F.col("source_size")).drop("rank"))
    fill = [F.col("full") / F.col("w"), *named]
    ranked = materialise(prefix_sums(ranked, fill, {"full_ahead_of": F.col("full"), "w_ahead_of": F.col("w")}, "mix-source-fill"),
                         "mix-sources")
    every = ranked.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()  # two numbers
    level = ((F.lit(float(total)) * F.lit(float(every["size"] or 0)) - F.col("full_ahead_of"))
             / (F.lit(float(every["w"] or 0)) - F.col("w_ahead_of")))
    # a source is not full where its own level, with all before it full, is under its limit; from there on none is:
    # the first open source fixes the level for all after it
    place = F.struct(fill[0].alias("a"), fill[1].alias("b"), fill[2].alias("c"))
    opened = ranked.withColumn("level", level).filter(F.col("w") * F.col("level") < F.col("full"))
    first = opened.agg(F.min(F.struct(place.alias("place"), F.col("level").alias("level"))).alias("first")).select("first.*")
    reached = ranked.join(first.hint("broadcast"), place >= F.col("place"), "left")  # one row
    return reached.select("source", "source_size", F.coalesce(F.least("full", F.col("w") * F.col("level")), F.col("full")).alias("target"))


def key_ranges(rows: DataFrame, ranges: int = BUCKETS) -> Column:
    """The range of a row's key, 0 to ``ranges`` - 1, so that ranges hold about equal numbers of rows.

    A key of weight w lies below k with chance 1 - exp(-w k); the mean of that
    over some quantiles of the weights is near the share of all keys below k.
    """
    some = rows.agg(F.percentile_approx("w", [0.03125 + k / 16 for k in range(16)], 10_000)).first()[0] or [1.0]
    share = sum((F.lit(1.0) - F.exp(F.lit(-float(w)) * F.col("key")) for w in some), F.lit(0.0)) / len(some)
    return F.least(F.lit(ranges - 1), F.floor(share * ranges)).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (3, 1, 2), total: float = 1.5, limit: float = 2.0, seed: int = 7,
        weight: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of ``docs`` as (doc_id, source, size, source_size, target, copies, taken, *carry*).

    ``total`` times all words is shared among the sources by weight, no target
    over ``limit`` times its source.  A document is taken ``copies`` times, as a
    whole: once per complete epoch, and once more if it is picked for the rest;
    the last pick is the one that brings the source nearest to its target.
    ``weight`` is the quality weight (default: the text's share of letters).

    NULL and blank texts have size 0 and are only taken with complete epochs;
    NULL sources are one source; repeated rows are documents of their own; ties
    in the key go by size and id; a NULL id is an id.  An empty table gives an
    empty result.
    """
    text = col(text_col)
    given = letter_share(text) if weight is None else weight
    held = F.struct(*[col(c) for c in carry]) if carry else F.lit(0)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(source_col).cast("string").alias("source"),
                       word_count(text).alias("size"), given.cast("double").alias("w"), held.alias("held"))
    safe = F.when(F.col("w") > 1e-6, F.col("w")).otherwise(1e-6)
    rows = materialise(rows.withColumn("w", safe).withColumn("key", -F.log(unit_hash(F.col("doc_id"), seed)) / F.col("w")), "mix-rows")
    rows = rows.withColumn("range", key_ranges(rows)).drop("w")
    at = [F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("no_s")]
    ranges = materialise(rows.groupBy(*at, "range").agg(F.sum("size").alias("in_range")), "mix-ranges")
    sizes = ranges.groupBy("s", "no_s").agg(F.sum("in_range").alias("source_size"))
    named = sizes.select(F.when(~F.col("no_s"), F.col("s")).alias("source"), "source_size")
    targets = (source_targets(named, weights, total, limit)
               .withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double")) + 1e-12),
                                                F.lit(0)).cast("long"))
               .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
               .withColumnsRenamed({"source": "t_source"})
               .select(F.coalesce("t_source", F.lit("")).alias("s"), F.col("t_source").isNull().alias("no_s"),
                       "source_size", "target", "epochs", "rest"))
    before = Window.partitionBy("s", "no_s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    state = (ranges.withColumn("before", F.coalesce(F.sum("in_range").over(before), F.lit(0)))
             .join(targets, ["s", "no_s"]).drop("in_range"))
    inside = Window.partitionBy("s", "no_s", "range").orderBy("key", "size", "doc_id") \
        .rowsBetween(Window.unboundedPreceding, -1)
    picked = (rows.withColumns({"s": at[0], "no_s": at[1]}).join(state, ["s", "no_s", "range"])
              .withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .withColumn("more", ((F.col("size") > 0) & (F.col("ahead") + F.col("size") / 2 <= F.col("rest"))).cast("long"))
              .withColumn("copies", F.col("epochs") + F.col("more")))
    return picked.select("doc_id", "source", "size", "source_size", "target", "copies",
                         (F.col("copies") * F.col("size")).alias("taken"),
                         *([F.col("held")] if carry else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row ``copies`` times, its columns unchanged."""
    taken = mix(docs, carry=docs.columns, **options).filter("copies > 0")
    return (taken.select("held", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
            .select("held.*"))
