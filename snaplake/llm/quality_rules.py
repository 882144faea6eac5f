"""Quality rules per document and per host.

Documents are measured with array functions (no shuffle of texts).  Failures of
each rule are added up by host, and a host's failure rate is shrunk towards
all hosts' by a beta prior fitted to them (method of moments for the
beta-binomial, Kleinman 1973): a host with three documents says little, one
with thousands speaks for itself.  Hosts whose shrunk rate passes the limit
for some rule are rejected, and the verdict is joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import WORD, col, let, materialise

#: Words in a window whose repetition counts.
WINDOW = 5
#: A host is rejected when its shrunk failure rate of a rule is over this.
HOST_LIMIT = 0.5


def _covered(starts: Column, width: int) -> Column:
    """How many positions lie in windows of ``width`` at the ascending ``starts``."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("last"))
    return F.aggregate(starts, zero, lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(width), p - acc["last"])).cast("long").alias("n"), p.alias("last")))["n"]


def _repeated(windows: Column, width: int) -> Column:
    """Positions covered by windows whose hash occurs twice or more, first ones included."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = let(placed, lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                                           | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
    return _covered(F.sort_array(F.transform(twice, lambda x: x["i"])), width)


def measure(docs: DataFrame, text_col: str, carry: Sequence[Column], window: int = WINDOW) -> DataFrame:
    """*carry* with n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and n_repeat_words of every whole text."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    measures = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    held = docs.select(F.struct(*carry).alias("held"), text.alias("text"),
                       F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    held = held.select(
        "held", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long")
                                      .alias("dup"))).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    held = held.withColumns({"n_lines": F.col("lines.n"), "n_dup_lines": F.col("lines.dup")})
    rolling = F.transform(F.sequence(F.lit(0), F.size("hashes") - window),
                          lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(window)]))
    held = held.select("held", *measures, F.when(F.size("hashes") > window, rolling).alias("windows"))
    repeated = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeated(F.col("windows"), window)).otherwise(0)
    return held.select("held.*", *measures, repeated.cast("long").alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Each rule as the condition under which a document fails it; ratios are compared without division."""
    n = F.col("n_words")
    return {
        "short": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n),
    }


#: The rules a document fails by itself; the others only speak for its host.
BASE = ("short", "repeats")


def rejected_hosts(failures: DataFrame, host: str, names: Sequence[str], limit: float) -> DataFrame:
    """Hosts (rows: host, n, one count per rule) whose shrunk failure rate of some rule is over ``limit``."""
    m = {r: F.sum(r) / F.sum("n") for r in names}
    total = failures.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("hosts"),
                         *[m[r].alias(r) for r in names],
                         *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_2") for r in names]).first()
    over = F.lit(False)
    for r in names:
        mean = float(total[r] or 0)
        if 0 < mean < 1:
            spread = float(total[f"{r}_2"]) - mean * mean * total["n"]  # sum of n * (rate - mean)^2
            expected = mean * (1 - mean)
            room = expected * (total["n"] - total["nn"] / total["n"] - (total["hosts"] - 1))
            rho = (spread - expected * (total["hosts"] - 1)) / room if room > 0 else 0.0
            strength = 1 / min(max(rho, 1e-3), 0.999) - 1
        else:
            strength = 1.0
        over = over | ((F.col(r) + mean * strength) / (F.col("n") + strength) > limit)
    return failures.filter(over).select(host)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  host_limit: float = HOST_LIMIT, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed, kept[, held]).

    ``kept`` is neither ``base_failed`` nor of a rejected host.  NULL and blank
    texts have no words and fail; a NULL host has no verdict; NULL ids and
    repeated rows are judged row by row; with ``carry`` those columns come back
    in a struct ``held``.  An empty table gives an empty result.
    """
    held = [col(id_col).cast("long").alias("doc_id"), col(host_col).cast("string").alias("host"),
            *([F.struct(*[col(c) for c in carry]).alias("held")] if carry else [])]
    failed = rules()
    base = failed[BASE[0]]
    for name in BASE[1:]:
        base = base | failed[name]
    rows = materialise(measure(docs, text_col, held).withColumn("base_failed", base), "quality-rows")
    by_host = rows.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(r) for r, c in failed.items()])
    by_host = materialise(by_host, "quality-hosts")
    bad = materialise(rejected_hosts(by_host, "host", list(failed), host_limit).withColumn("host_failed", F.lit(True)),
                      "quality-verdicts")
    return (rows.join(bad, "host", "left").withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_failed",
                    (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"), *(["held"] if carry else [])))
