"""The queries over the test tables: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm import decontaminate, langid, licenses, oracle, ordermin, packing, quality
from placemill.llm import sharding, warc
from placemill.llm.license_texts import NOTICES
from placemill.llm.neardup import near_duplicates
from placemill.llm.repeats import remove_repeats
from placemill.llm.resample import resample
from placemill.llm.tokens import token_counts
from placemill.llm.variants import spelling_variants
from placemill.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
OVER_LIMIT = 2048
SHARDS = [f"shard-{number:03d}" for number in range(64)]


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


@_query()
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place where a document holds a public licence notice."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return licenses.scan_licenses(docs, NOTICES)


@_query()
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are."""
    docs = _documents(spark, sf_dir).select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    docs = ordermin.fingerprint(docs)
    docs = ordermin.with_next(docs, "doc_id", ["text", "fingerprint"])
    n_chars = F.char_length("text")
    cut = F.floor(n_chars / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n_chars - cut), F.substring("next_text", F.lit(1), cut)
    )
    docs = docs.select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        edited.alias("edited"),
        "fingerprint",
        "next_fingerprint",
    )
    docs = ordermin.fingerprint(docs, text_column="edited", out="edited_fingerprint")
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        ordermin.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        ordermin.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@_query()
def op3_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its own evidence, its source and its section there."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    return quality.score_quality(docs, _table(spark, sf_dir, "labels"))


@_query()
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.place(_documents(spark, sf_dir).select("doc_id"), SHARDS)


@_query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, through a cache that this run begins."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    path = public_tokenizers.path(TOKENIZER)
    counted = token_counts(docs, path, scratch_path(spark, "token-counts"))
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"),
    )


@_query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text; trained on documents that are not held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out()))
    done = langid.identify(docs.select("doc_id", "text"), model)
    return done.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@_query()
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document, on four-word shingles."""
    return near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"), shingle=4)


@_query()
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, in whole or paraphrased."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark"))


@_query(
    r"""
    WITH words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                   lambda x: x <> '') AS w
        FROM documents
    ),
    windows AS (
        SELECT doc_id, p, list_aggregate(w[p:p + 12], 'string_agg', ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words)
    ),
    firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p
        FROM windows JOIN firsts USING (s) WHERE first_id < doc_id
    ),
    removed AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
           sha256(coalesce(list_aggregate(
               CASE WHEN n IS NULL THEN w
                    ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END,
               'string_agg', ' '), '')) AS kept_sha256
    FROM words LEFT JOIN removed USING (doc_id)
    """
)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of 13 words that an earlier one has, too."""
    done = remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"), window=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), capacity=OVER_LIMIT)


@_query(oracle.RESAMPLE)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by their likeness to the benchmark's texts."""
    return resample(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


@_query(oracle.ARCHIVES)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back from them."""
    pages = _table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, scratch_path(spark, "archives"))
    records = warc.read_archives(manifest).where(F.col("record_type").isin("response", "revisit"))
    return records.select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@_query(oracle.VARIANTS)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, with made typos, under their commonest near spelling."""
    found = spelling_variants(_documents(spark, sf_dir), drop_every=31)
    return found.select("word", "form", "root", "n", "n_near", "form_n")
