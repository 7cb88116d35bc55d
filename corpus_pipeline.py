"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
all documents its predecessor kept, and its result is written and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickvault.llm import bestfit, cotrain, host_rules, partenum, unit_dedup
from clickvault.llm.common import Scratch, scratch_uri
from clickvault.llm.queries import BYTE_BPE, table


def quality_classifier(spark, docs, sf_dir):
    """Documents that the co-trained classifier does not reject."""
    return cotrain.keep_documents(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the rules and whose host is not rejected."""
    return host_rules.keep_documents(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group whose five-word shingles have a similarity of 0.8 or more.

    Rows equal in doc_id and text are one document, the smallest row; rows that repeat a doc_id
    with another text are documents of their own. A row without one is in no group and stays.
    """
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("_same", F.xxhash64("text"))
    texts = named.groupBy("doc_id").agg(F.min("_same").alias("_first"), F.max("_same").alias("_last"))
    # the other texts of an id get numbers above the usual ids, so they come last in their group
    number = F.shiftrightunsigned(F.xxhash64("doc_id", "_same"), 2).bitwiseOR(F.lit(1 << 62))
    more = Scratch(spark, "near").write(
        named.join(texts.where("_first <> _last"), "doc_id").where("_same <> _first")
        .select("doc_id", "_same", number.alias("_node")).distinct(), "more")
    rows = named.join(more, ["doc_id", "_same"], "left").withColumn(
        "_node", F.coalesce("_node", F.col("doc_id").cast("long")))
    groups = partenum.jaccard_components(rows.select(F.col("_node").alias("doc_id"), "text"), 80, 100, 5)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("_node")).distinct()
    one = rows.join(kept, "_node", "left_semi").groupBy("_node").agg(
        F.min(F.struct(*docs.columns)).alias("_row"))
    return one.select("_row.*").union(docs.where(F.col("doc_id").isNull()))


def substring_dedup(spark, docs, sf_dir):
    """Documents without passages that an earlier one has; emptied documents go."""
    own = {c: f"_own_{c}" for c in docs.columns if c in unit_dedup.ADDED}
    out = unit_dedup.dedup_units(docs.withColumnsRenamed(own), inside=True)
    whole = F.size("removed_spans") > 0
    return out.where(~whole | (F.trim("text") != "")).withColumn(
        "n_chars", F.when(whole, F.length("text")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType)).select(
                *[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def best_fit_packing(spark, docs, sf_dir):
    """The pieces of what is left and their places in sequences of 1024 tokens."""
    return bestfit.pack(docs, BYTE_BPE, 1024, 2)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

# The classifier, the tokenizer and the packing have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        uri = scratch_uri(spark, f"stage-{i}")
        out.write.parquet(uri)
        docs = spark.read.schema(out.schema).parquet(uri)
    return docs
