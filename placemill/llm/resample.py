"""Importance resampling: documents drawn in proportion to a target's likeness.

Word runs are hashed into buckets. The logarithm of how much more often a bucket is
met in the target than in the documents is its gain, a whole number of thousandths; a
document's weight is the sum over its runs. With Gumbel noise from a digest of the id
added, the highest scores are a sample without replacement whose odds follow the
weights.

The cutoff is found by bisection: jobs that count rows of the written scores against
numeric thresholds, and then against ids among the rows that tie. Only rows above the
cutoff are range-partitioned for their ranks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from placemill.llm import words as W
from placemill.llm.checksums import crc32_spans
from placemill.llm.shared import free_name, id_filter, stored
from placemill.operators.rowindex import with_row_index

#: Bisection steps that one count job takes: 2**4 - 1 thresholds are counted together.
STEPS_A_JOB = 4

_SPACE = np.frombuffer(b" ", np.uint8)


def run_buckets(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every run of 1 to ``longest`` words, and words a text.

    Words are runs of ASCII letters, digits and all other characters beyond ASCII, with
    A-Z in lower case. A run's words are joined by one space.
    """
    data, offsets = W.text_bytes(column)
    data = W.lower_ascii(data)
    starts, ends = W.spans(data, offsets, W.letter_or_digit)
    first = np.searchsorted(starts, offsets)
    owner = np.repeat(np.arange(len(column)), np.diff(first))
    code = crc32_spans(data, starts, ends)
    found, owners = [code], [owner]
    zero = np.zeros(len(starts), np.int64)
    for size in range(2, longest + 1):
        code = crc32_spans(_SPACE, zero[: len(code)], zero[: len(code)] + 1, code)[:-1]
        code = crc32_spans(data, starts[size - 1 :], ends[size - 1 :], code)
        whole = owner[: len(code)] == owner[size - 1 :]
        found.append(code[whole])
        owners.append(owner[: len(code)][whole])
    return np.concatenate(found) % np.uint32(buckets), np.concatenate(owners), np.diff(first)


def bucket_counts(texts: DataFrame, text_column: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all texts. A task sends one row a bucket, whatever it reads."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column(0)
            for begin, end in W.pieces(column):
                found, _, _ = run_buckets(column.slice(begin, end - begin), longest, buckets)
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    part = texts.select(F.col(text_column).cast("string")).mapInArrow(count, "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to documents, one a bucket."""
    counts = []
    for side in (target, documents):
        here = np.zeros(buckets, np.int64)
        for row in side.collect():  # at most ``buckets`` rows
            here[row["bucket"]] = row["n"]
        counts.append(here)
    in_target, in_documents = counts
    total_target = float(in_target.sum() + buckets)
    total_documents = float(in_documents.sum() + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * total_documents / ((s + 1.0) * total_target)))
            for t, s in zip(in_target.tolist(), in_documents.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(
    docs: DataFrame, gains: np.ndarray, *, id_column: str, text_column: str, longest: int
) -> DataFrame:
    """(id, n_words, n_features, weight): the summed gains of every whole text."""
    buckets = len(gains)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            for begin, end in W.pieces(column):
                part = column.slice(begin, end - begin)
                found, owner, n_words = run_buckets(part, longest, buckets)
                weight = np.zeros(len(part), np.int64)
                np.add.at(weight, owner, gains[found])
                size = np.bincount(owner, minlength=len(part))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array(n_words.astype(np.int64)),
                        pa.array(size.astype(np.int64)),
                        pa.array(weight),
                    ],
                    ["id", "n_words", "n_features", "weight"],
                )

    chosen = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_column: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def least_reaching(rows: DataFrame, value: str, wanted: int) -> tuple[int, int]:
    """The least v of a whole-number column such that ``wanted`` rows are at or below v.

    Also the number of rows below v. ``wanted`` is at least 1 and at most the number of
    rows. Each job counts the rows at or below the midpoints of the next
    ``STEPS_A_JOB`` halvings of the range that is left.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    below = 0
    parts = 2**STEPS_A_JOB
    while low < high:
        marks = sorted({low + (high - low) * part // parts for part in range(1, parts)})
        counted = rows.agg(*[F.count_if(F.col(value) <= F.lit(mark)) for mark in marks]).first()
        for mark, count in zip(marks, counted, strict=True):
            if count >= wanted:
                high = mark
                break
            low, below = mark + 1, count
    return low, below


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """One row a document: its id, n_features, weight, score and rank (all long but the id).

    Of the N documents with at least ``least_words`` words, the ``floor(percent * N /
    100)`` with the highest scores are drawn, ties to the smaller id, and ranked 1, 2, 3;
    others have a null rank. All documents are counted and weighed, whole.

    Null and empty texts have no features and weight 0. A document with a null id is
    counted and weighed, but has no score and is never drawn nor part of N. Rows that
    repeat an id are documents of their own; if they tie at the cutoff, any of them may be
    drawn. No documents: no rows. An empty target gives every bucket the gain of a
    bucket not met there. Other columns of ``docs`` are left out, so their names
    do not matter; an id column with the name of a result keeps it, and the result gets
    an underscore. The id must be a whole number.
    """
    if not isinstance(docs.schema[id_column].dataType, IntegralType):
        raise ValueError(f"{id_column} must be a whole number")
    if not 0 <= percent <= 100:
        raise ValueError("percent must be from 0 to 100")
    gains = bucket_gains(
        bucket_counts(docs, text_column, longest, buckets),
        bucket_counts(target, target_column, longest, buckets),
        buckets,
    )
    weighed = weigh(docs, gains, id_column=id_column, text_column=text_column, longest=longest)
    scored = weighed.withColumn("score", F.col("weight") + noise("id", seed)).select(
        "*",
        # Ascending in the order of the draw; rows that repeat an id are told apart.
        (-F.col("score")).alias("down"),
        F.monotonically_increasing_id().alias("copy"),
    )
    scored = stored(scored, "scores")
    open_to_draw = F.col("id").isNotNull() & (F.col("n_words") >= least_words)
    pool = scored.where(open_to_draw)
    wanted = pool.count() * percent // 100
    if wanted == 0:
        drawn = F.lit(False)
    else:
        score, above = least_reaching(pool, "down", wanted)
        tied = pool.where(F.col("down") == score)
        last, _ = least_reaching(tied, "id", wanted - above)
        drawn = open_to_draw & (
            (F.col("down") < score) | ((F.col("down") == score) & (F.col("id") <= last))
        )
    ranked = with_row_index(scored.where(drawn), ["down", "id", "copy"], "place")
    rank = F.when(F.col("place") < wanted, F.col("place") + 1).cast("long")
    out = ranked.withColumn("rank", rank).drop("place")
    out = out.unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")))
    own = docs.select(id_column)
    names = {name: free_name(own, name) for name in ("n_features", "weight", "score", "rank")}
    return out.select(
        F.col("id").alias(id_column), *[F.col(old).alias(new) for old, new in names.items()]
    )


def drawn_documents(docs: DataFrame, drawn: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all their columns, that a result of ``resample`` draws."""
    ids = id_filter(drawn.where(F.col("rank").isNotNull()).select(id_column), "drawn")
    return docs.join(ids, id_column, "left_semi")
