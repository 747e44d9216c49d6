"""Toxicity grades by cumulative-link (proportional odds) regression.

P(grade > k) = sigmoid(w.x - t_k): one weight vector for all thresholds t_0 < t_1 < ...; x marks the
distinct words (letter runs) and word beginnings of a text that are in the vocabulary. The expected
severity is the sum of P(grade > k) over k.

Labels say toxic or not. A toxic row of the sample is graded 1, 2 or 3 by how many different features
it has of those that toxic rows make up the majority of, cut at the terciles of the toxic rows.

The model is fitted on a bounded sample of labelled documents: ``sample_rows`` rows, chosen by a hash
of the id, and at most ``max_features`` words that occur in ``min_documents`` of them and whose
occurrence depends on toxicity (likelihood ratio statistic of ``min_gain`` or more). The bounds are
parameters; the sample and the model pass through the driver (20,000 rows of word numbers, about
10 MB). Every document is scored, on its whole text.

Defined results
    null or empty text  no features: severity of the thresholds alone
    null id             is scored; cannot be labelled
    null label          the labelled row is not used
    repeated rows       are scored alike; repeated labels of one id count each
    no usable labels    every document has severity 0 and is not toxic
    empty table         no rows
    extra columns       are never read; clashing names are not a problem
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import staged

SAMPLE_ROWS = 20_000
MAX_FEATURES = 30_000
MIN_DOCUMENTS = 5
MIN_GAIN = 30.0
BEGINNING = 4

LETTERS = re.compile(r"[^\W\d_]+").findall
SCORE = "struct<severity: double, toxic_probability: double>"


def features(text: str | None) -> set[str]:
    """Words, and the beginnings of longer ones with a dash, which join the forms of one word."""
    if not text:
        return set()
    found = set(LETTERS(text.lower()))
    return found | {w[:BEGINNING] + "-" for w in found if len(w) > BEGINNING}


def severity_grades(toxic: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """0 for clean rows; toxic ones 1 to 3 by the terciles of their strength."""
    if not toxic.any():
        return np.zeros(len(toxic), np.int64)
    cuts = np.quantile(strength[toxic], [1 / 3, 2 / 3])
    return np.where(toxic, 1 + (strength[:, None] > cuts).sum(axis=1), 0)


def dependence(hits: Column, n: Column, all_hits: int, rows: int) -> Column:
    """Likelihood ratio statistic of two marks: ``n`` rows have the first, ``hits`` of them both, and
    ``all_hits`` of all ``rows`` the second."""
    cells = [
        (hits, n * F.lit(all_hits)),
        (n - hits, n * F.lit(rows - all_hits)),
        (F.lit(all_hits) - hits, (F.lit(rows) - n) * F.lit(all_hits)),
        (F.lit(rows - all_hits) - n + hits, (F.lit(rows) - n) * F.lit(rows - all_hits)),
    ]
    total = F.lit(0.0)
    for seen, product in cells:
        part = seen * F.log(seen * F.lit(float(rows)) / product)
        total = total + F.when((seen > 0) & (product > 0), part).otherwise(0.0)
    return 2 * total


@dataclass(frozen=True)
class OrdinalModel:
    """Words with their weights, and the thresholds between neighbouring grades."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def exceed(self, text: str | None) -> list[float]:
        """P(grade > k) for each threshold."""
        get = self.weights.get
        x = sum(get(w, 0.0) for w in features(text))
        return [1 / (1 + np.exp(min(50.0, t - x))) for t in self.thresholds]


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, n_features: int, steps: int = 1000, penalty: float = 1e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient descent (Adam) on the likelihood of the grades.

    ``rows`` holds the feature numbers of each document. Thresholds are kept in order by modelling
    their steps as exponentials.
    """
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if len(rows) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    cuts = int(grades.max(initial=1))
    share = [np.clip((grades > k).mean(), 1e-4, 1 - 1e-4) for k in range(cuts)]
    first = np.log(1 / np.array(share) - 1)
    # Parameters: weights, the first threshold, logarithms of the steps to the next ones.
    at = np.concatenate([np.zeros(n_features), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    mean, square = np.zeros_like(at), np.zeros_like(at)
    index = np.arange(len(rows))
    for step in range(1, steps + 1):
        jumps = np.exp(at[n_features + 1 :])
        limits = np.concatenate([[-np.inf], at[n_features] + np.concatenate([[0.0], np.cumsum(jumps)]), [np.inf]])
        x = np.bincount(owner, weights=at[flat], minlength=len(rows))
        below = 1 / (1 + np.exp(np.clip(x[:, None] - limits[None, :], -50, 50)))  # P(grade <= k - 1)
        below[:, 0], below[:, -1] = 0.0, 1.0
        low, high = below[index, grades], below[index, grades + 1]
        mass = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / mass, high * (1 - high) / mass
        by_x = (d_high - d_low) / len(rows)
        slope = np.zeros(len(at))
        slope[:n_features] = np.bincount(flat, weights=by_x[owner], minlength=n_features) + penalty * at[:n_features]
        by_limit = np.zeros(cuts)
        np.add.at(by_limit, grades[grades < cuts], -d_high[grades < cuts] / len(rows))
        np.add.at(by_limit, grades[grades > 0] - 1, d_low[grades > 0] / len(rows))
        slope[n_features] = by_limit.sum()
        slope[n_features + 1 :] = np.cumsum(by_limit[::-1])[::-1][1:] * jumps
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        at = at - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    limits = at[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(at[n_features + 1 :]))])
    return at[:n_features], limits


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    max_features: int = MAX_FEATURES,
    min_documents: int = MIN_DOCUMENTS,
    min_gain: float = MIN_GAIN,
) -> OrdinalModel:
    """Fit on labelled documents (``labels``: ``id_col``, ``toxic`` 0 or 1)."""
    marked = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).select(
        F.col(id_col).alias("id"), (F.col("toxic") > 0).alias("toxic")
    )
    share = min(1.0, sample_rows / max(1, marked.count()))
    sample = marked.where((F.xxhash64("id") / F.lit(2.0**64) + 0.5) < share)
    # The sample has about ``sample_rows`` rows of two numbers, whatever the size of the tables.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "words": [sorted(features(t)) for t in batch["text"]]})

    rows = staged(texts.mapInPandas(split, "toxic boolean, words array<string>"), "labelled")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("int")).alias("hits")).first()
    common = (
        rows.select(F.explode("words").alias("word"), F.col("toxic").cast("int").alias("toxic"))
        .groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("hits"))
        .where(F.col("n") >= min_documents)
        .where(dependence(F.col("hits"), F.col("n"), size["hits"] or 0, size["n"]) >= min_gain)
        .orderBy(F.desc("n"), "word")
        .limit(max_features)
    )
    chosen = common.collect()
    vocabulary = {r["word"]: i for i, r in enumerate(chosen)}
    marks = np.array([2 * r["hits"] > r["n"] for r in chosen], np.int64)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[vocabulary[w] for w in ws if w in vocabulary] for ws in batch["words"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "found": found})

    sparse = rows.mapInPandas(number, "toxic boolean, found array<int>").toPandas()
    if not len(sparse):
        return OrdinalModel({}, (50.0,))
    strength = np.array([marks[np.asarray(f, np.int64)].sum() for f in sparse["found"]])
    grades = severity_grades(sparse["toxic"].to_numpy(bool), strength)
    weights, limits = fit_ordinal(list(sparse["found"]), grades, len(vocabulary))
    return OrdinalModel(dict(zip(vocabulary, weights.tolist(), strict=True)), tuple(limits.tolist()))


def score(model: OrdinalModel, text: Column) -> Column:
    """``severity`` (expected grade) and ``toxic_probability`` (P(grade > 0)) of a text column."""

    @F.pandas_udf(SCORE)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [model.exceed(t) for t in texts]
        return pd.DataFrame({"severity": [sum(p) for p in found], "toxic_probability": [p[0] for p in found]})

    return run(text)


def judge(docs: DataFrame, model: OrdinalModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``id``, ``severity``, ``toxic_probability``, ``toxic``."""
    scored = docs.select(F.col(id_col).alias("id"), score(model, F.col(text_col)).alias("score"))
    return scored.select("id", "score.*", (F.col("score.toxic_probability") >= threshold).alias("toxic"))


def keep_clean(docs: DataFrame, model: OrdinalModel, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the toxic ones."""
    return docs.where(score(model, F.col(text_col))["toxic_probability"] < threshold)
