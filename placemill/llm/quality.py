"""Quality by hierarchical empirical Bayes: document, path and host.

A logistic classifier over simple text features gives each document its own evidence.
Labelled documents count with their label, others with their probability. Sums per path
and per host, both grouped aggregates, give posterior means: a path is shrunk toward its
host, a host toward the global mean, each with a strength estimated from the spread of
the groups (method of moments). The score of a document is its own evidence, with the
path's posterior in place of the global prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.shared import free_worker, give_back, stored
from placemill.operators.spread import spread_join
from placemill.runtime import broadcast_if_small

#: Labelled rows that the classifier is fitted on, at most about so many.
FIT_ROWS = 20_000
#: The table of sites has a file for so many documents: a file costs more than its few rows.
SITE_ROWS = 20_000
STEPS = 25
_KINDS = (
    "upper lower digit space line point comma symbol bang pipe wide other "
    "words word_length distinct repeated log_size short_lines"
).split()
_STRENGTH = (2.0, 1e4)


def _byte_classes() -> np.ndarray:
    table = np.full(256, 11, np.int64)
    table[65:91], table[97:123], table[48:58] = 0, 1, 2
    table[32] = table[9] = table[13] = 3
    table[10], table[ord(".")], table[ord(",")] = 4, 5, 6
    for char in "#$%&*@^~+=<>\\_{}[]":
        table[ord(char)] = 7
    table[ord("!")], table[ord("|")], table[128:] = 8, 9, 10
    return table


def features_of(column: pa.Array) -> np.ndarray:
    """(texts, features): shares of kinds of characters, word and line statistics."""
    found = W.words_of(column)
    count = len(column)
    out = np.zeros((count, len(_KINDS)))
    if not len(found.data):
        return out
    classes = _byte_classes()[found.data]
    sizes = np.diff(found.offsets)
    owner = np.repeat(np.arange(count), sizes)
    shares = np.bincount(owner * 12 + classes, minlength=count * 12).reshape(count, 12)
    out[:, :12] = shares / np.maximum(sizes, 1)[:, None]
    words = found.counts()
    out[:, 12] = np.log1p(words)
    span = found.ends - found.starts
    word_owner = np.repeat(np.arange(count), words)
    out[:, 13] = np.bincount(word_owner, span, count) / np.maximum(words, 1)
    order = np.lexsort((found.codes, word_owner))
    same = np.zeros(len(order), bool)
    code, text = found.codes[order], word_owner[order]
    same[1:] = (code[1:] == code[:-1]) & (text[1:] == text[:-1])
    out[:, 14] = 1 - np.bincount(text, same, count) / np.maximum(words, 1)
    follows = (found.codes[1:] == found.codes[:-1]) & (word_owner[1:] == word_owner[:-1])
    out[:, 15] = np.bincount(word_owner[1:], follows, count) / np.maximum(words, 1)
    out[:, 16] = np.log1p(sizes)
    out[:, 17] = shares[:, 4] / np.maximum(words, 1)
    return out


@dataclass
class Classifier:
    """Logistic regression over standardised features."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        scaled = np.clip((features - self.middle) / self.spread, -6, 6)
        return np.clip(scaled @ self.weights[1:] + self.weights[0], -12, 12)


def fit(features: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> Classifier:
    """Penalised likelihood by Newton steps; with one class or no rows, its prior alone."""
    width = features.shape[1]
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    start = np.r_[np.log(prior / (1 - prior)), np.zeros(width)]
    if not len(labels) or labels.min() == labels.max():
        return Classifier(np.zeros(width), np.ones(width), start, prior)
    middle, spread = features.mean(axis=0), features.std(axis=0) + 1e-6
    scaled = np.clip((features - middle) / spread, -6, 6)
    full = np.c_[np.ones(len(labels)), scaled, ]
    weights, ridge = start, penalty * np.diag(np.r_[0.0, np.ones(width)])
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(full @ weights, -30, 30)))
        slope = full.T @ (labels - chance) - ridge @ weights
        curve = (full * (chance * (1 - chance) + 1e-9)[:, None]).T @ full + ridge
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(middle, spread, weights, prior)


def text_features(docs: DataFrame, id_column: str, text_column: str, keep: list[str]) -> DataFrame:
    """(id, kept columns, features) in one pass, without a shuffle."""
    source = docs.select(
        F.col(id_column).alias("id"), *[F.col(c).cast("string") for c in keep], F.col(text_column)
    )
    names = ["id", *[f"level{at}" for at in range(len(keep))]]

    def run(batches):
        free_worker()
        for batch in batches:
            text = batch.num_columns - 1
            for begin, end in W.pieces(batch.column(text)):
                part = batch.slice(begin, end - begin)
                values = features_of(part.column(text))
                rows = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(_KINDS))
                lists = rows.cast(pa.list_(pa.float64()))
                yield pa.record_batch([*part.columns[:text], lists], [*names, "features"])
            give_back()

    kind = docs.schema[id_column].dataType.simpleString()
    levels = "".join(f"{name} string, " for name in names[1:])
    return source.mapInArrow(run, f"id {kind}, {levels}features array<double>")


def _posterior(total: Column, n: Column, parent: Column, strength: Column) -> Column:
    return (total + strength * parent) / (n + strength)


def _strength(groups: DataFrame, total: str, n: str, mean: float) -> float:
    """Pseudo-count of the prior of the groups' rates, by the method of moments.

    The spread of the rates beyond what their sizes explain; little spread gives a
    strong prior. One row of sums reaches the driver.
    """
    rate = F.col(total) / F.col(n)
    row = groups.agg(
        F.sum(F.col(n) * (rate - mean) * (rate - mean)).alias("q"),
        F.sum(n).alias("n"),
        F.sum(F.col(n) * F.col(n)).alias("nn"),
        F.count(F.lit(1)).alias("k"),
    ).first()
    noise = mean * (1 - mean)
    if not row["k"] or row["k"] < 2 or noise <= 0:
        return _STRENGTH[1]
    scale = row["n"] - row["nn"] / row["n"]
    between = (row["q"] - (row["k"] - 1) * noise) / scale if scale > 0 else 0.0
    if between <= 0:
        return _STRENGTH[1]
    return float(min(max(noise / between - 1, _STRENGTH[0]), _STRENGTH[1]))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    path_column: str = "lang",
    label_column: str = "quality",
    least: float = 0.5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(id, own, host_mean, path_mean, score, kept) for every row of ``docs``.

    ``own`` is the classifier's probability, ``host_mean`` and ``path_mean`` the posteriors
    of the document's site, ``score`` all together, ``kept`` whether it is ``least`` or
    more. ``labels`` has the id and 0 or 1; null labels and ids count as none, of repeated
    ids the largest label counts. The classifier is fitted on at most about ``fit_rows``
    labelled rows, chosen by a hash; all counts cover all rows.

    Null or empty text: features 0, scored like other texts. A null host or path is a
    site of its own. No labels: the scores follow the prior, 1/2. No rows give no rows.
    """
    plain = text_features(docs, id_column, text_column, [host_column, path_column])
    known = labels.where(F.col(label_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    known = known.agg(F.max(label_column).cast("double").alias("label"))
    labelled = stored(spread_join(plain, known, ["id"], "left"), "labelled")

    count = labelled.agg(F.count("label").alias("labels"), F.count(F.lit(1)).alias("docs")).first()
    total = count["labels"]
    draw = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.where("label is not null").where(draw < min(1.0, fit_rows / max(total, 1)))
    rows = chosen.select("features", "label").toArrow()
    values = np.array(rows.column("features").to_pylist(), float).reshape(-1, len(_KINDS))
    model = fit(values, rows.column("label").to_numpy())

    scaled = (model.weights[1:] / model.spread).tolist()
    middle, spread = model.middle.tolist(), model.spread.tolist()
    terms = F.lit(float(model.weights[0]))
    for at in range(len(_KINDS)):
        value = (F.col("features")[at] - middle[at]) / spread[at]
        clipped = F.greatest(F.lit(-6.0), F.least(F.lit(6.0), value))
        terms = terms + clipped * float(scaled[at] * spread[at])
    odds = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), terms))
    judged = labelled.select("id", "level0", "level1", "label", odds.alias("odds"))
    chance = 1 / (1 + F.exp(-F.col("odds")))
    judged = judged.withColumn("own", chance)

    weight = F.coalesce("label", "own")
    paths = judged.groupBy("level0", "level1").agg(
        F.sum(weight).alias("s"), F.count(F.lit(1)).alias("n")
    )
    paths = stored(paths.coalesce(1 + count["docs"] // SITE_ROWS), "paths")
    hosts = paths.groupBy("level0").agg(F.sum("s").alias("host_s"), F.sum("n").alias("host_n"))
    whole = hosts.agg(F.sum("host_s").alias("s"), F.sum("host_n").alias("n")).first()
    mean = (whole["s"] or 0.0) / whole["n"] if whole["n"] else 0.5
    mean = min(max(mean, 1e-4), 1 - 1e-4)
    host_strength = _strength(hosts, "host_s", "host_n", mean)
    path_strength = _strength(paths, "s", "n", mean)
    host_mean = _posterior(F.col("host_s"), F.col("host_n"), F.lit(mean), F.lit(host_strength))
    hosts = hosts.select(F.col("level0").alias("h"), host_mean.alias("host_mean"))
    paths = paths.join(broadcast_if_small(hosts), F.col("level0").eqNullSafe(F.col("h"))).drop("h")
    path_mean = _posterior(F.col("s"), F.col("n"), F.col("host_mean"), F.lit(path_strength))
    sites = paths.select(
        F.col("level0").alias("a"), F.col("level1").alias("b"), "host_mean", path_mean.alias("path_mean")
    )
    same = F.col("level0").eqNullSafe(F.col("a")) & F.col("level1").eqNullSafe(F.col("b"))
    done = judged.join(broadcast_if_small(sites), same)
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_mean")))
    prior = float(np.log(model.prior / (1 - model.prior)))
    joint = F.col("odds") + F.log(bounded / (1 - bounded)) - prior
    score = F.round(1 / (1 + F.exp(-joint)), 6)
    return done.select(
        F.col("id").alias(id_column),
        F.round("own", 6).alias("own"),
        F.round("host_mean", 6).alias("host_mean"),
        F.round("path_mean", 6).alias("path_mean"),
        score.alias("score"),
        (score >= least).alias("kept"),
    )


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of an address, for tables of pages; null if none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    return F.nullif(host, F.lit("")), F.nullif(path, F.lit(""))
