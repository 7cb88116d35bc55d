"""Registered queries of the operators: name -> callable, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from clickvault.llm import (
    bestfit,
    bpe_stream,
    byte_bpe,
    cotrain,
    host_rules,
    importance,
    onebit_ann,
    partenum,
    quotes,
    shared_terms,
    unit_dedup,
    warc,
    wavelet,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_onebit_ann(spark, sf_dir):
    return onebit_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op2_wavelet_shards(spark, sf_dir):
    return wavelet.write_and_read(table(spark, sf_dir, "documents"), BYTE_BPE, 0)


def op3_best_fit_packing(spark, sf_dir):
    return bestfit.pack(table(spark, sf_dir, "documents"), BYTE_BPE, 1024, 2)


def op4_warc_revisits(spark, sf_dir):
    return warc.write_and_read(table(spark, sf_dir, "pages"), 1000)


def op5_line_dedup(spark, sf_dir):
    return unit_dedup.dedup_units(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_passage_dedup(spark, sf_dir):
    return unit_dedup.dedup_units(
        table(spark, sf_dir, "documents").select("doc_id", "text"), inside=True)


def op6_ngram_jaccard(spark, sf_dir):
    return partenum.jaccard_components(table(spark, sf_dir, "documents"), 90, 100, 3)


def op7_host_rules(spark, sf_dir):
    return host_rules.host_verdicts(table(spark, sf_dir, "documents"))


def op8_streaming_bpe(spark, sf_dir):
    return bpe_stream.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_cotraining(spark, sf_dir):
    return cotrain.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quotation_links(spark, sf_dir):
    return quotes.link_conversations(table(spark, sf_dir, "conversations"))


def op11_shared_terms(spark, sf_dir):
    return shared_terms.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op12_importance(spark, sf_dir):
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "item_id")


def op13_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)


# The contract's rules as SQL, for the rows the operator returns beside its own verdicts.
_WARC_SQL = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d
  FROM pages
), w AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN w.top <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN w.top <> p.page_id THEN w.top END AS refers_to, p.url
FROM p LEFT JOIN w ON p.d = w.d
"""

_SEARCH_SQL = """
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), docs AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0
), total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), each_word AS (SELECT r, unnest(w) AS term FROM words
), tf AS (
  SELECT r, term, count(*) AS tf FROM each_word WHERE term IN (SELECT term FROM items) GROUP BY r, term
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM df, total
), part AS (
  SELECT tf.r, tf.term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll)))) AS c
  FROM tf JOIN weight USING (term) JOIN docs USING (r), total
), scored AS (
  SELECT item_id, r, CAST(sum(c) AS BIGINT) AS score FROM items JOIN part USING (term) GROUP BY item_id, r
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored JOIN docs USING (r) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {f.__name__: f for f in (
    op1_onebit_ann, op2_wavelet_shards, op3_best_fit_packing, op4_warc_revisits, op5_passage_dedup,
    op5_line_dedup, op6_ngram_jaccard, op7_host_rules, op8_streaming_bpe, op9_cotraining, op10_quotation_links,
    op11_shared_terms, op12_importance, op13_byte_bpe)}
ORACLES: dict[str, str] = {"op4_warc_revisits": _WARC_SQL, "op11_shared_terms": _SEARCH_SQL}
