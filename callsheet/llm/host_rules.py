"""Quality rules by host: shrunken failure rates per domain, joined back to the documents.

Every document gets its rule counts with DataFrame functions only. The rule
failures are aggregated by host; each host's rate is shrunk with a beta prior
fitted to all hosts by the method of moments, so a host with few pages is
pulled towards the common rate. A host whose shrunken rate reaches
``max_rate`` is rejected with all its documents.

Defined results: null text counts as empty (no words, so the base rules
fail); a null host is a host of its own that is never rejected as a whole;
repeated rows are scored one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, few, words

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.7


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, host: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns in one struct ``held``, host and the rule counts of every document.

    Repeated windows: the windows' hashes are sorted with their positions, equal
    neighbours mark repeated windows, and the union of the marked windows'
    word ranges is counted from the gaps between their sorted positions. All
    of it is linear or a sort within the row.
    """
    held = (F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None)).alias("held")
    base = docs.select(held, F.col(f"`{host}`").cast("string").alias("host"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = F.size("w")
    counted = base.select("held", "host", words(F.col("text")).alias("w"), F.split("text", "\n").alias("lines"),
                          F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"))
    # lines without a word are counted only where some line repeats
    worded = F.filter("lines", lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    distinct = counted.withColumn("lines", F.when(F.size("lines") > F.size(F.array_distinct("lines")), worded))
    wide = distinct.select(
        "held", "host", "n_symbols", n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*(F.get("w", i + j) for j in range(WINDOW))))).alias("windows"))
    # only rows with a repeated window need positions
    sized = wide.withColumn("repeats", F.coalesce(F.size("windows") > F.size(F.array_distinct("windows")), F.lit(False)))
    ordered = sized.withColumn("by_hash", F.when(F.col("repeats"), F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    marked = ordered.withColumn("at", F.when(F.col("repeats"), F.sort_array(F.transform(F.filter(
        "by_hash", lambda x, k: F.coalesce(x["h"] == F.get("by_hash", k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("by_hash", k + 1)["h"], F.lit(False))), lambda x: x["i"])))).drop("by_hash")
    covered = F.when(F.col("repeats"), F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))
    return marked.select("held", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_rates(scored: DataFrame) -> DataFrame:
    """host, n, failed, shrunken rate: (failed + alpha) / (n + alpha + beta).

    alpha and beta come from the mean and the variance of the hosts' rates,
    less the variance that sampling alone gives; with no such excess (or one
    host) the prior is as strong as ``n`` of all hosts together, which pulls
    every host to the common rate.
    """
    hosts = scored.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    prior = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("m"), F.sum("n").alias("total"),
        F.avg(F.pow(F.col("failed") / F.col("n"), 2)).alias("m2"), F.avg(F.col("failed") / F.col("n")).alias("m1"),
        F.avg(1 / F.col("n")).alias("inv"))
    noise = F.col("m") * (1 - F.col("m"))
    excess = F.col("m2") - F.pow("m1", 2) - noise * F.col("inv")
    strength = F.when(excess > 0, F.least(F.greatest(noise / excess - 1, F.lit(1e-3)), F.col("total").cast("double"))) \
        .otherwise(F.col("total").cast("double"))
    prior = prior.select(F.struct("m", strength.alias("strength"))).scalar()
    return hosts.select("host", "n", "failed", (
        (F.col("failed") + prior["m"] * prior["strength"]) / (F.col("n") + prior["strength"])).alias("rate"))


def _rejected_hosts(scratch: Scratch, scored: DataFrame, max_rate: float) -> DataFrame:
    """The rejected hosts, written once; broadcast where they are counted to be few, so no document moves."""
    return few(scratch.keep(host_rates(scored).where(F.col("rate") >= max_rate).select(F.col("host").alias("bad_host"))))


def kept_documents(docs: DataFrame, max_rate: float = MAX_RATE, host: str = "source") -> DataFrame:
    """The documents that pass, with all their columns.

    The measured documents are written once: a filter on the counts would
    otherwise be pushed below them and repeat their expressions. The texts are
    never shuffled.
    """
    scratch = Scratch(docs.sparkSession, "hosts")
    names = docs.columns
    scored = scratch.keep(measured(docs, host, tuple(names)).select("held", "host", base_failed().alias("base_failed")))
    bad = _rejected_hosts(scratch, scored.select("host", "base_failed"), max_rate)
    good = scored.where(~F.col("base_failed"))
    return good.join(bad, good["host"] == bad["bad_host"], "left_anti").select(*(F.col(f"held.`{c}`").alias(c) for c in names))


def verdicts(docs: DataFrame, max_rate: float = MAX_RATE, host: str = "source") -> DataFrame:
    """One row per document: counts, base_failed, the host's shrunken rate and the verdict ``kept``."""
    scratch = Scratch(docs.sparkSession, "hosts")
    scored = scratch.keep(measured(docs, host).withColumn("base_failed", base_failed()))
    bad = _rejected_hosts(scratch, scored, max_rate)
    joined = scored.join(bad, scored["host"] == bad["bad_host"], "left")
    return joined.select(F.col("held.doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.col("bad_host").isNull()).alias("kept"))
