"""Host-level quality rules: shrunk failure rates per host, joined back to documents.

Every document is measured by per-text rules (words, symbols, repeated lines
and repeated word windows) with DataFrame functions only. Failures are summed
per host (the ``source`` column; its host part if it is a URL). The hosts'
failure rates follow a beta prior fitted to all hosts by moments (each
host weighted by its documents); a host's shrunk rate is
``(failures + alpha) / (documents + alpha + beta)``, so small hosts stay near
the mean. A host whose shrunk rate exceeds ``max_rate`` is rejected with all
its documents.

Null text counts as text without words. A null or empty source is a host of
its own, ''. Rows that repeat are measured and counted each. Without any
document there are no hosts. If the hosts' rates do not vary more than chance
the prior is as strong as all documents together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import Scratch

# Fixed values of the rules' contract.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

MAX_RATE = 0.5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def host_of(source: Column) -> Column:
    """Lower-case host of a URL, or the name itself."""
    s = F.lower(F.trim(F.coalesce(source.cast("string"), F.lit(""))))
    return F.coalesce(F.nullif(F.regexp_extract(s, r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1),
                               F.lit("")), s)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Columns of these names are replaced. The projections are kept apart (each
    names what the next uses several times), so no array is built twice.
    """
    keep = [c for c in docs.columns if c not in [*BASE, "base_failed"]]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = docs.select(*keep, t.alias("_t"))
    d = d.withColumn("_w", F.filter(F.split("_t", SPACE), lambda w: w != ""))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    starts = F.sequence(F.lit(0), F.size("_w") - WINDOW)
    d = d.withColumn("_h", F.when(
        F.size("_w") >= WINDOW,
        F.transform(starts, lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>")))
    d = d.select(
        *keep, "_h",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.size("_h") - F.size(F.array_distinct("_h"))).alias("_again"),
    )
    # windows found twice or more, by place: sorted (hash, place) pairs that have an equal neighbour
    d = d.withColumn("_s", F.when(F.col("_again") > 0, F.array_sort(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("_p", F.array_sort(F.transform(
        F.filter("_s", lambda x, k: (x["h"] == F.get("_s", k - 1)["h"])
                 | F.coalesce(x["h"] == F.get("_s", k + 1)["h"], F.lit(False))),
        lambda x: x["i"])))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        F.transform("_p", lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW))).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.select(*keep, *BASE, failed.alias("base_failed"))


def host_rates(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host, documents, failures, shrunk_rate, rejected: from host and base_failed."""
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if("base_failed").alias("failures"))
    r = F.col("failures") / F.col("documents")
    # one row over all hosts: weighted mean and variance of the rates
    r = hosts.agg(
        F.sum("documents").alias("n"), F.count(F.lit(1)).alias("k"),
        (F.sum("failures") / F.sum("documents")).alias("mean"),
        (F.sum(F.col("documents") * r * r) / F.sum("documents")).alias("square")).first()
    n, k, mean, square = r["n"] or 0, r["k"], r["mean"] or 0.0, r["square"] or 0.0
    spread = mean * (1 - mean)
    # variance between hosts, beyond what sampling alone would give
    between = square - mean * mean - (spread * k / n if n else 0.0)
    strength = float(n)
    if between > 0 and spread > 0:
        strength = min(max(spread / between - 1, 1.0), float(n))
    shrunk = (F.col("failures") + mean * strength) / (F.col("documents") + strength)
    return hosts.select("host", "documents", "failures", shrunk.alias("shrunk_rate"),
                        (shrunk > max_rate).alias("rejected"))


def host_verdicts(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: doc_id, host, the measures, base_failed, shrunk_rate, kept."""
    sc = Scratch(docs.sparkSession, "hosts")
    measured = sc.write(
        measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                             host_of(F.col("source")).alias("host"), "text"))
        .drop("text"), "measured")
    rates = sc.write(host_rates(measured, max_rate), "rates")
    out = measured.join(rates.select("host", "shrunk_rate", "rejected"), "host", "left")
    return sc.finish(out.select(
        "doc_id", "host", *BASE, "base_failed", "shrunk_rate",
        (~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept")))


def keep_documents(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """The documents that pass the base rules and whose host is not rejected; columns as given."""
    sc = Scratch(docs.sparkSession, "hosts")
    cols = docs.columns
    m = measures(docs.select(*[F.col(c).alias(f"_d{i}") for i, c in enumerate(cols)],
                             host_of(F.col("source")).alias("host"),
                             F.col("text").alias("_text")), "_text").drop("_text", *BASE)
    m = sc.write(m, "measured")
    bad = sc.write(host_rates(m, max_rate).where("rejected").select("host"), "bad")
    kept = m.where(~F.col("base_failed")).join(bad, "host", "left_anti")
    return kept.select(*[F.col(f"_d{i}").alias(c) for i, c in enumerate(cols)])
