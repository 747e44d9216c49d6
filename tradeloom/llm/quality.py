"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose statistic is above the cutoff of its stratum. Labelled documents are
split by a hash of their text: the design half gives the grid of cutoffs, quantiles of each statistic over
its good documents; the holdout half certifies. A step of the grid is a vector, the same quantile of every
rule, so the steps are nested: what one turns down, all stricter ones do. Per stratum the steps are walked
from the most lenient on. One is certified if an exact binomial test rejects, on the holdout's good
documents, that its rules together turn down more than ``risk`` of them; the walk ends at the first that is
not (a fixed sequence needs no correction for its own steps), and the level is ``delta / strata``
(Bonferroni over the strata with enough good documents for the test to reject at all). So with probability
1 - delta no stratum loses more than ``risk`` of its good documents. Of the certified steps the one that
turns down most bad documents is used, and of equal ones the most lenient; a rule that catches nothing
there is off, and so are all rules of a stratum that cannot be certified.

The bound holds for independent trials, so copies are one: a text counts once per stratum and label, however
many rows, ids or labels repeat it, and all its copies are in one half. Statistics are computed once per
document and staged; all labelled texts count, as sums per step. Counts and cutoffs are tables with a row per stratum; the number of strata has no bound.

Defined results
    null or empty text   no words: every statistic is 0
    null stratum         the stratum ``*``
    rare stratum         too few good labels to certify: every rule is off
    null id or label     cannot be labelled
    no labels            every rule is off
    repeated rows        are judged alike, each its own; in the bound they are one
    repeated labels      of one id count once; an id with both labels is left out
    ties                 a statistic equal to the cutoff is kept
    empty table          no rows
    extra columns        are never read; clashing names are not a problem
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import staged, text_digest

RISK, DELTA = 0.02, 0.05
# Shares of the good documents that the cutoffs of the grid keep.
GRID = [0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 0.995, 0.996, 0.997, 0.998, 0.999, 0.9995, 0.9999, 1.0]
UNKNOWN = "*"

# The base counts.
SYMBOLS = re.compile(r"[#*$%&|<>]").findall
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["symbols", "dup_lines", "repeats", "long_words", "capitals", "exclamations"]

STATISTICS = ", ".join([*(f"{c} long" for c in COUNTS), *(f"{r} double" for r in RULES)])


def repeated_words(tokens: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    if len(tokens) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(t, len(number)) for t in tokens], np.int64)
    key = ids[: len(ids) - width + 1]
    for i in range(1, width):
        # Renumbering after each step keeps the keys below the square of the number of words.
        key = np.unique(key * len(number) + ids[i : len(ids) - width + 1 + i], return_inverse=True)[1]
    hit = np.bincount(key)[key] > 1
    covered = np.zeros(len(ids), bool)
    for i in range(width):
        covered[i : i + len(hit)] |= hit
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The base counts and the rules' statistics of one text."""
    text = text or ""
    tokens = text.encode().split()
    n = len(tokens)
    chars = len(b"".join(tokens).decode())
    lines = [line for line in text.split("\n") if line.encode().split()]
    dup = len(lines) - len(set(lines))
    symbols, repeats = len(SYMBOLS(text)), repeated_words(tokens)
    words = max(1, n)
    return (
        n,
        chars,
        symbols,
        dup,
        repeats,
        symbols / words,
        dup / max(1, len(lines)),
        repeats / words,
        chars / words,
        sum(map(str.isupper, text)) / max(1, chars),
        text.count("!") / words,
    )


def statistics(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [measure(t) for t in batch.pop("text")]
            yield pd.concat([batch, pd.DataFrame(found, columns=[*COUNTS, *RULES], index=batch.index)], axis=1)

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit(UNKNOWN)).alias("stratum"),
        text_digest(text_col).alias("digest"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInPandas(run, f"id long, stratum string, digest binary, {STATISTICS}")


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly, by its terms."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=float)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i[:-1]) / (i[:-1] + 1)))])
    logs += i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return min(1.0, float(math.exp(top) * np.exp(logs - top).sum()))


def choose(cutoffs: list[float], good: list[int], bad: list[int], n_good: int, risk: float, level: float) -> float | None:
    """The cutoff to use, None for a rule that stays off. ``cutoffs`` ascend; ``good[i]`` and ``bad[i]``
    are the holdout documents above ``cutoffs[i]``."""
    best, caught = None, 0
    for i in reversed(range(len(cutoffs))):
        if binomial_below(good[i], n_good, risk) > level:
            break
        if bad[i] > caught:
            best, caught = cutoffs[i], bad[i]
    return best


@dataclass(frozen=True)
class Cutoffs:
    """One row per stratum with labels: ``own``, its name, and ``max_`` of each rule, null if it is off."""

    table: DataFrame

    def __getitem__(self, stratum: str) -> dict[str, float]:
        row = self.table.where(F.col("own") == stratum).first()
        return {r: row[f"max_{r}"] for r in RULES if row and row[f"max_{r}"] is not None}


def fit(
    stats: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    risk: float = RISK,
    delta: float = DELTA,
    trial: str = "id",
) -> Cutoffs:
    """Cutoffs per stratum and rule from ``labels`` (``id_col``, ``quality`` 1 good, 0 bad). Rows of ``stats``
    with one ``trial`` are copies and count once per stratum and label."""
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("quality"))
        .groupBy("id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .drop("most")
    )
    half = (F.pmod(F.xxhash64("trial"), F.lit(2)) == 0).alias("design")
    rows = staged(
        stats.join(marked, "id")
        .groupBy(F.col(trial).alias("trial"), "stratum", "quality")
        .agg(*[F.max(r).alias(r) for r in RULES])
        .select("stratum", "quality", half, *RULES),
        "labelled",
    )
    good = rows.where("design and quality = 1")
    grid = [F.percentile_approx(r, GRID, 10_000).alias(f"grid_{r}") for r in RULES]
    grids = staged(good.groupBy("stratum").agg(*grid), "grids")
    # Per document and rule the number of steps that turn it down; any rule's most are those of all together.
    steps = {r: F.expr(f"size(filter(grid_{r}, c -> {r} > c))") for r in RULES}
    judged = rows.where("not design").join(grids, "stratum").select("stratum", "quality", *[n.alias(r) for r, n in steps.items()])
    judged = judged.withColumn("any", F.greatest(*RULES))
    names = ["any", *RULES]
    counted = staged(
        judged.select("stratum", (F.col("quality") == 1).alias("good"), F.expr("stack({}, {}) as (rule, above)".format(len(names), ", ".join(f"'{r}', `{r}`" for r in names))))
        .groupBy("stratum", "rule", "good", "above")
        .agg(F.count("*").alias("n")),
        "steps",
    )
    clean = counted.where("rule = 'any' and good").groupBy("stratum").agg(F.sum("n").alias("n"))
    strata = clean.where(F.pow(F.lit(1 - risk), F.col("n")) <= delta).count()
    level = delta / max(1, strata)

    def certify(cells: pd.DataFrame) -> pd.DataFrame:
        def down(rule: str, good: bool) -> list[int]:
            own = cells[(cells["rule"] == rule) & (cells["good"] == good)]
            return [int(own.loc[own["above"] > i, "n"].sum()) for i in range(-1, len(GRID))]

        good, bad = down("any", True), down("any", False)
        step = choose(list(range(len(GRID))), good[1:], bad[1:], good[0], risk, level)
        used = [] if step is None else [r for r in RULES if down(r, False)[step + 1]]
        return pd.DataFrame({"stratum": [cells["stratum"].iloc[0]], "step": [-1 if step is None else step], "used": [used]})

    chosen = counted.groupBy("stratum").applyInPandas(certify, "stratum string, step int, used array<string>")
    limits = [F.when(F.array_contains("used", r), F.get(f"grid_{r}", F.col("step"))).alias(f"max_{r}") for r in RULES]
    return Cutoffs(staged(chosen.join(grids, "stratum").select(F.col("stratum").alias("own"), *limits), "cutoffs"))


def judge(stats: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """``stats`` with ``failed``: the rules whose cutoff the document exceeds."""
    joined = stats.join(cutoffs.table, F.col("stratum") == F.col("own"), "left")
    failed = F.array_compact(F.array(*[F.when(F.col(r) > F.col(f"max_{r}"), F.lit(r)) for r in RULES]))
    return joined.withColumn("failed", failed).drop("own", *(f"max_{r}" for r in RULES))


def base_failed():
    """Too few words, or more than half of them in repeated windows."""
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def decide(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per document ``id``, the base counts, ``base_failed``, ``failed`` rules, ``kept``."""
    stats = staged(statistics(docs, id_col, text_col, stratum_col), "statistics")
    judged = judge(stats, fit(stats, labels, id_col, trial="digest"))
    return judged.select(
        "id", *COUNTS, base_failed().alias("base_failed"), "failed"
    ).withColumn("kept", (~F.col("base_failed")) & (F.size("failed") == 0))
