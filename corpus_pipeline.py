"""The corpus pipeline: language, near-duplicates, repeats, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as
Parquet and are the next stage's ``docs``. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm import langid
from placemill.llm.decontaminate import without_leaks
from placemill.llm.neardup import near_duplicates
from placemill.llm.packing import pack
from placemill.llm.repeats import remove_repeats
from placemill.llm.shared import give_back, stored
from placemill.runtime import broadcast_if_small

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
REPEAT_WORDS = 50
TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
#: Rows that travel to Python at a time: whole texts, held on both sides.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2500

#: No SQL: the stages hold trained models and a linear program.
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """From now on this session sends at most ``BATCH_ROWS`` rows to Python at a time.

    Results are written after a stage has returned, so the setting stays.
    """
    now = int(spark.conf.get(ARROW_ROWS))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language, or with none that is likelier than not."""
    small_batches(spark)
    model = langid.train(docs.where(~langid.held_out()))
    done = langid.identify(docs, model, out=("lang_pred", "lang_score"))
    del model
    give_back()
    return done.where(
        (F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    small_batches(spark)
    groups = near_duplicates(docs.select("doc_id", "text"))
    gone = groups.where(~F.col("kept")).select("doc_id")
    return docs.join(broadcast_if_small(stored(gone, "gone")), "doc_id", "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops words of passages of 50 words or more that an earlier document has, too.

    Texts that lose nothing stay as they are. A document that loses all words goes.
    """
    small_batches(spark)
    before = docs.withColumn("whole", F.col("text"))
    done = remove_repeats(before, window=REPEAT_WORDS)
    done = done.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") == 0, F.col("whole")).otherwise(F.col("text"))
    done = done.withColumn("text", text)
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    small_batches(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places all that is left into sequences."""
    small_batches(spark)
    return pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER), capacity=CAPACITY)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
