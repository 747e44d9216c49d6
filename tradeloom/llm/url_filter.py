"""URL filter by a sort-merge range join of hosts and rules.

A host is written as its labels in reverse, each with a full stop (``com.example.www.``), so a rule's
host is a prefix of the keys of its subdomains and covers an interval of the key order. Urls are dealt to
key ranges, and each rule to the ranges its interval meets. In a range, rules and urls are sorted
together and read once: the sweep keeps a stack of the rule hosts whose interval is open, each nested in
the one below it; a url looks for the longest of their rules whose path it starts with.

Range borders are quantiles of a bounded, hash-chosen sample of keys; they decide only which task
does the work. A host that fills several ranges is dealt to them by a hash of the url's id.

Defined results
    null url, or one without ://  empty host and path; no rule fits, the default verdict
    null id                       kept as null
    very long url                 whole
    repeated rows                 each is judged
    ties                          longest means most characters of host and path, then of the host;
                                  of rules with one host and path, block wins
    no rules, empty table         default verdicts; no rows
    extra columns                 are never read; clashing names are not a problem
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import shuffle_partitions

SAMPLE_PER_RANGE = 40
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = chr(0x10FFFF)

OUTPUT = "id long, host string, path string, rule string, verdict string"


def url_host(url: str = "url") -> Column:
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: str) -> Column:
    """Labels in reverse, each followed by a full stop."""
    return F.when(F.col(host) == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    )


@dataclass
class OpenHost:
    """A rule host whose interval is open, with its rules by path."""

    key: str
    paths: dict[str, tuple[str, str]]
    lengths: list[int]


class Sweep:
    """Rows in key order, a rule before the urls of its key."""

    def __init__(self) -> None:
        self.stack: list[OpenHost] = []

    def rule(self, key: str, host: str, path: str, verdict: str) -> None:
        self._close(key)
        if not self.stack or self.stack[-1].key != key:
            self.stack.append(OpenHost(key, {}, []))
        top = self.stack[-1]
        if path not in top.paths or verdict == "block":
            top.paths[path] = (host + path, verdict)
        top.lengths = sorted({len(p) for p in top.paths}, reverse=True)

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def url(self, key: str, path: str) -> tuple[str, str] | None:
        self._close(key)
        best: tuple[str, str] | None = None
        for level in reversed(self.stack):
            for length in level.lengths:
                found = level.paths.get(path[:length]) if length <= len(path) else None
                if found:
                    if best is None or len(found[0]) > len(best[0]):
                        best = found
                    break
        return best


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page ``id``, ``host``, ``path``, ``rule``, ``verdict``. ``rules``: ``host``, ``path``,
    ``verdict`` (allow or block), of any number."""
    spark = pages.sparkSession
    ranges = shuffle_partitions(spark)
    urls = pages.select(
        F.col(id_col).cast("long").alias("id"), url_host(url_col).alias("host"), url_path(url_col).alias("path")
    ).withColumn("key", host_key("host"))
    sample = (
        urls.select("key", F.xxhash64("id", "host", "path").alias("h")).orderBy("h").limit(ranges * SAMPLE_PER_RANGE)
    )
    keys = sorted(r["key"] for r in sample.select("key").collect())
    borders = np.array([keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else [], dtype=object)

    @F.pandas_udf("int")
    def url_range(key: pd.Series, spread: pd.Series) -> pd.Series:
        low = np.searchsorted(borders, key.to_numpy(), "left") if len(borders) else np.zeros(len(key), int)
        high = np.searchsorted(borders, key.to_numpy(), "right") if len(borders) else low
        return pd.Series(low + spread.to_numpy() % (high - low + 1))

    @F.pandas_udf("array<int>")
    def rule_ranges(key: pd.Series) -> pd.Series:
        low = [int(np.searchsorted(borders, k, "left")) if len(borders) else 0 for k in key]
        high = [int(np.searchsorted(borders, k + _LAST, "right")) if len(borders) else 0 for k in key]
        return pd.Series([list(range(a, b + 1)) for a, b in zip(low, high, strict=True)])

    spread = F.pmod(F.xxhash64("id", "path"), F.lit(1 << 30))
    left = urls.select(url_range("key", spread).alias("range"), "key", F.lit(1).alias("kind"), "id", "host", "path", F.lit("").alias("verdict"))
    ruled = rules.select(F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), "path", "verdict").withColumn("key", host_key("host"))
    right = ruled.select(
        F.explode(rule_ranges("key")).alias("range"), "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), "host", "path", "verdict"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sweep, now = Sweep(), None
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("range", "key", "kind", "host", "path", "verdict"))
            for at, (where, key, kind, host, path, verdict) in enumerate(zip(*columns, strict=True)):
                if where != now:
                    sweep, now = Sweep(), where
                if kind == 0:
                    sweep.rule(key, host, path, verdict)
                else:
                    out.append((at, host, path, *(sweep.url(key, path) or (None, default))))
            done = pd.DataFrame(out, columns=["at", "host", "path", "rule", "verdict"])
            done.insert(0, "id", batch["id"].astype("Int64").to_numpy()[done.pop("at").to_numpy(dtype=int)])
            yield done

    both = left.unionByName(right).repartition(ranges, "range").sortWithinPartitions("range", "key", "kind", "host", "path")
    return both.mapInPandas(run, OUTPUT)
