"""Line dedup by a log-template tree.

Lines are parsed to a fixed depth: by their number of tokens, then by their first ``depth`` tokens, with
tokens that hold a digit as ``<*>``. The lines under one leaf give its template: at each place the token
that at least ``agree`` of them share, else ``<*>``. A line belongs to the leaf's template if it equals
it in at least ``similar`` of its places; any other line is a template of its own, with its digits
generalised. Templates found in ``min_documents`` different texts recur and their lines are dropped; from
``long_tokens`` tokens on ``long_documents`` different texts are enough. A token is shared if two lines have it.

All counts are over distinct texts, so exact copies of a document do not make its lines recur. Leaves
and templates are counted from hashes of fixed size with partial aggregation; tokens are looked at only
for leaves that reach as many texts, and their votes are counted per (leaf, place, token), never
gathered per leaf. Leaves, templates and texts are told apart by 64-bit hashes, lines by their place.

Defined results
    null or empty text  no lines, nothing dropped; the text stays null or empty
    null id             kept as null
    short lines         of fewer than ``min_tokens`` tokens are kept, and so are blank ones
    very long lines     one leaf each, whole
    repeated rows       rows with one id and text have the same lines dropped
    ties                of tokens with equal votes at a place, the smallest
    empty table         no rows
    extra columns       are never read; clashing names are not a problem
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import staged

WILD = "<*>"
DEPTH, MIN_TOKENS, MIN_DOCUMENTS = 3, 3, 5
LONG_TOKENS, LONG_DOCUMENTS = 50, 2
AGREE, SIMILAR = 0.5, 0.6

_DIGIT, _SPACE = re.compile(r"\d"), re.compile(r"\s")


def tokens(line: str) -> list[bytes]:
    """Tokens of a line between ASCII white space, in UTF-8, those with a digit generalised. A token with
    other white space in it stays as it is."""
    parts = line.encode().split()
    if not _DIGIT.search(line):
        return parts
    texts = b" ".join(parts).decode().split(" ")
    return [
        WILD.encode() if _DIGIT.search(text) and not _SPACE.search(text) else part
        for part, text in zip(parts, texts, strict=True)
    ]


def leaf(parts: list[bytes], depth: int = DEPTH) -> int:
    """The tree's leaf, unsigned: number of tokens and leading tokens."""
    return xxhash.xxh64_intdigest(b"%d\n" % len(parts) + b" ".join(parts[:depth]))


def template(parts: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(parts))


def _parse(docs: DataFrame, depth: int, min_tokens: int, long_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """(``id``, ``text_key``, ``line``, ``leaf``, ``own``, ``is_long``) of every line with enough tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, lines, leaves, own, sizes = [], [], [], [], []
            for row, text in enumerate(batch["text"]):
                for line, words in enumerate((text or "").split("\n")):
                    parts = tokens(words)
                    if len(parts) >= min_tokens:
                        rows.append(row)
                        lines.append(line)
                        leaves.append(leaf(parts, depth))
                        own.append(template(parts))
                        sizes.append(len(parts))
            row = np.array(rows, np.int64)
            yield pd.DataFrame(
                {
                    "id": batch["id"].astype("Int64").to_numpy()[row],
                    "text_key": batch["text_key"].to_numpy()[row],
                    "line": np.array(lines, np.int32),
                    "leaf": np.array(leaves, np.uint64).view(np.int64),
                    "own": np.array(own, np.uint64).view(np.int64),
                    "is_long": np.array(sizes, np.int64) >= long_tokens,
                }
            )

    rows = _keyed(docs, id_col, text_col)
    return rows.mapInPandas(run, "id long, text_key long, line int, leaf long, own long, is_long boolean")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
        F.col(text_col).alias("text"),
    )


def _texts_with(texts: int, long_texts: int, key: str, rows: DataFrame) -> DataFrame:
    """Keys found in at least so many different texts, or in fewer if they are long. Lines of one key are
    of one length."""
    found = rows.select(key, "is_long", "text_key").distinct().groupBy(key, "is_long").agg(F.count("*").alias("texts"))
    least = F.when(F.col("is_long"), min(texts, long_texts)).otherwise(texts)
    return found.where(F.col("texts") >= least).drop("is_long")


def _line_tokens(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The tokens of chosen ``lines`` (``id``, ``text_key``, ``line``, ...), one row of each text."""
    first = lines.groupBy("text_key").agg(F.min("id").alias("id"), F.collect_set(F.struct("line", "leaf", "own")).alias("lines"))
    rows = _keyed(docs, id_col, text_col).dropDuplicates(["id", "text_key"])
    both = rows.join(first.withColumnRenamed("id", "first_id"), "text_key").where("id <=> first_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, chosen in zip(batch["text"], batch["lines"], strict=True):
                parts = text.split("\n")
                for c in chosen:
                    out.append((c["leaf"], c["own"], b" ".join(tokens(parts[c["line"]])).decode().split(" ")))
            yield pd.DataFrame(out, columns=["leaf", "own", "parts"])

    return both.select("text", "lines").mapInPandas(run, "leaf long, own long, parts array<string>")


def templates(lines: DataFrame, agree: float = AGREE, similar: float = SIMILAR) -> DataFrame:
    """(``own``, ``leaf``, ``general``) for the distinct parsed lines (``leaf``, ``own``, ``parts``) that
    belong to their leaf's template."""
    distinct = staged(
        lines.groupBy("leaf", "own").agg(F.first("parts").alias("parts"), F.count("*").alias("n")), "lines"
    )
    placed = distinct.select("leaf", "own", "n", F.posexplode("parts").alias("place", "token"))
    votes = placed.groupBy("leaf", "place", "token").agg(F.sum("n").alias("votes"))
    total = distinct.groupBy("leaf").agg(F.sum("n").alias("total"))
    led = (
        votes.groupBy("leaf", "place")
        .agg(F.max_by("token", F.struct("votes", F.hash("token"))).alias("token"), F.max("votes").alias("votes"))
        .join(total, "leaf")
        .where((F.col("votes") >= F.greatest(agree * F.col("total"), F.lit(2))) & (F.col("token") != WILD))
        .select("leaf", "place", "token")
    )
    equal = placed.join(led, ["leaf", "place", "token"]).groupBy("leaf", "own").agg(F.count("*").alias("equal"))
    return (
        distinct.select("leaf", "own", F.size("parts").alias("size"))
        .join(equal, ["leaf", "own"])
        .where(F.col("equal") >= similar * F.col("size"))
        .select("leaf", "own", F.lit(True).alias("general"))
    )


def find(
    docs: DataFrame,
    depth: int = DEPTH,
    min_tokens: int = MIN_TOKENS,
    min_documents: int = MIN_DOCUMENTS,
    long_tokens: int = LONG_TOKENS,
    long_documents: int = LONG_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Lines to drop: ``id``, ``text_key``, ``line``, ``template``, ``texts`` it occurs in."""
    lines = staged(_parse(docs, depth, min_tokens, long_tokens, id_col, text_col), "parsed")
    leaves = _texts_with(min_documents, long_documents, "leaf", lines).select("leaf")
    busy = staged(lines.join(leaves, "leaf", "left_semi"), "busy")
    fitting = templates(_line_tokens(docs, busy, id_col, text_col))
    named = busy.join(fitting, ["leaf", "own"], "left").select(
        "id", "text_key", "line", "is_long", F.when(F.col("general"), F.col("leaf")).otherwise(F.col("own")).alias("template")
    )
    named = staged(named, "named")
    return named.drop("is_long").join(_texts_with(min_documents, long_documents, "template", named), "template")


def dedup(
    docs: DataFrame,
    depth: int = DEPTH,
    min_tokens: int = MIN_TOKENS,
    min_documents: int = MIN_DOCUMENTS,
    long_tokens: int = LONG_TOKENS,
    long_documents: int = LONG_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document ``id``, ``n_lines``, ``n_dropped`` and the ``text`` that is left."""
    dropped = (
        find(docs, depth, min_tokens, min_documents, long_tokens, long_documents, id_col, text_col)
        .groupBy("id", "text_key")
        .agg(F.collect_set("line").alias("dropped"))
        .select(F.col("id").alias("__id"), F.col("text_key").alias("__key"), "dropped")
    )

    @F.pandas_udf("string")
    def rest(texts: pd.Series, dropped: pd.Series) -> pd.Series:
        out = []
        for text, numbers in zip(texts, dropped, strict=True):
            if text is not None and numbers is not None:
                gone = set(numbers)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            out.append(text)
        return pd.Series(out, dtype=object)

    joined = _keyed(docs, id_col, text_col).join(
        dropped, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")), "left"
    )
    n_lines = F.when(F.coalesce("text", F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split("text", "\n")))
    return joined.select(
        "id",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        rest("text", "dropped").alias("text"),
    )
