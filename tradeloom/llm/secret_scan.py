"""Secret scan (DataFrame and SQL functions only): pattern rules, and character Markov models that tell
random strings from ordinary identifiers.

Both models are first-order: the probability of a character given the one before it, with one added to
each count. A candidate is a run of 16 or more key characters in what is left when the pattern spans are
blanked, so what stands before and after one is tested by itself; it is a secret if the log-likelihood ratio of random to ordinary, summed over its transitions, is above the threshold
(ln 1000: one random string to a thousand identifiers). The models come from labelled samples; only
their counts, at most 2 x 65 x 65, reach the driver.

All spans are found row by row, without a shuffle, in time proportional to the text. A match's place is the
running sum of the lengths of the pieces and matches up to it.

Defined results
    null or empty text  no spans
    null id             kept as null
    very long text      whole; candidates are split into characters once
    repeated rows       each has its own result
    ties                spans with one start stand in the order of the kinds
    empty table         no rows
    extra columns       are never read; clashing names are not a problem
    no samples          all transitions are equally likely, so the models add no span
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds, their patterns, and what a match must have.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE_LENGTH = 6
KINDS = ["assign", "access", "hex", "random"]

# A blanked span starts with EDGE. Keys that run into the next span are blanked with it: an access key into
# an upper-case name or the hex run after it, a hex run into the "a" of a name.
EDGE = "\x01"
KEYS = rf"AKIA[A-Z0-9]{{16,}}[0-9a-f]*|AKIA[A-Z0-9]*(?={EDGE})|[0-9a-f]{{24,}}|[0-9a-f]{{23}}(?={EDGE})"

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
FIRST, SPAN = ord("+"), ord("z") - ord("+") + 1

THRESHOLD = math.log(1000)
SAMPLE_ROWS = 4_000


def _matches(text: str | Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def labelled_samples(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``label``, ``sample``) from about ``sample_rows`` documents chosen by a hash of the id: what the
    patterns find is random (1), the identifiers beside it are ordinary (0)."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    chosen = docs.where((F.xxhash64(id_col) / F.lit(2.0**64) + 0.5) < share).select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    values = F.filter(_matches("text", ASSIGN, 2), lambda v: F.length(v) >= VALUE_LENGTH)
    random = F.concat(values, _matches("text", ACCESS), _matches("text", HEX))
    ordinary = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    pairs = chosen.select(
        F.explode(
            F.concat(
                F.transform(random, lambda s: F.struct(F.lit(1).alias("label"), s.alias("sample"))),
                F.transform(ordinary, lambda s: F.struct(F.lit(0).alias("label"), s.alias("sample"))),
            )
        ).alias("pair")
    )
    return pairs.select("pair.*")


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each transition, as a table of SPAN x SPAN."""
    folded = samples.groupBy("label", "sample").agg(F.count("*").alias("n"))
    chars = folded.select("label", "n", F.split("sample", "").alias("c"))
    steps = chars.select(
        "label", "n", F.explode(F.arrays_zip(F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))).alias("x"), F.expr("slice(c, 2, greatest(size(c) - 1, 0))").alias("y"))).alias("s")
    )
    counted = steps.groupBy("label", "s.x", "s.y").agg(F.sum("n").alias("n")).collect()
    seen = {(r["label"], r["x"], r["y"]): r["n"] for r in counted}
    table = [0.0] * (SPAN * SPAN)
    for x in SYMBOLS:
        of = [sum(seen.get((label, x, y), 0) for y in SYMBOLS) + len(SYMBOLS) for label in (0, 1)]
        for y in SYMBOLS:
            ordinary, random = ((seen.get((label, x, y), 0) + 1) / of[label] for label in (0, 1))
            table[(ord(x) - FIRST) * SPAN + ord(y) - FIRST] = round(math.log(random / ordinary), 6)
    return table


def _let(use: Callable[[Column], Column], **values: Column) -> Column:
    """``use`` of a struct of ``values``, which are computed once however often ``use`` names them."""
    bound = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.get(F.transform(bound, use), 0)


def _last(numbers: Column) -> Column:
    return F.coalesce(F.get(numbers, F.size(numbers) - 1), F.lit(0))


def _sums(numbers: Column) -> Column:
    return F.aggregate(numbers, F.array().cast("array<int>"), lambda acc, n: F.concat(acc, F.array(_last(acc) + n)))


def _running(numbers: Column, block: int = 256) -> Column:
    """Running sums. Arrays grow by copies, so sums are taken in blocks and the totals of blocks added."""

    def whole(own: Column) -> Column:
        return F.flatten(
            F.transform(
                own["blocks"],
                lambda sums, i: F.transform(sums, lambda n: n + F.get(own["totals"], i) - _last(sums)),
            )
        )

    def blocks(own: Column) -> Column:
        count = F.ceil(F.size(own["numbers"]) / block).cast("int")
        firsts = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)
        return F.transform(firsts, lambda b: _sums(F.slice(own["numbers"], b * block + 1, F.lit(block))))

    return _let(
        lambda own: _let(whole, blocks=own["blocks"], totals=_sums(F.transform(own["blocks"], _last))),
        blocks=_let(blocks, numbers=numbers),
    )


def _spans(rank: int, text: Column, pattern: str, keep: Callable[[Column], Column] | None = None, group: int = 0) -> Column:
    """Structs (start, rank, end) of the matches whose ``group`` fits ``keep``."""

    def span(own: Column) -> Column:
        return F.transform(
            own["lengths"],
            lambda n, i: F.struct(
                (F.get(own["ends"], i) - n).alias("start"), F.lit(rank).alias("rank"), F.get(own["ends"], i).alias("end")
            ),
        )

    def placed(own: Column) -> Column:
        steps = F.transform(own["lengths"], lambda n, i: n + F.get(own["pieces"], i))
        return _let(span, lengths=own["lengths"], ends=_running(steps))

    lengths = F.transform(_matches(text, pattern), F.length)
    every = _let(placed, lengths=lengths, pieces=F.transform(F.split(text, pattern), F.length))
    if keep is None:
        return every
    return _let(
        lambda own: F.filter(own["every"], lambda s, i: keep(F.get(own["groups"], i))),
        every=every,
        groups=_matches(text, pattern, group),
    )


def _blanked(text: Column, pattern: str, keep: Callable[[Column], Column], group: int = 0) -> Column:
    """``text`` with blanks, as many, for the matches whose ``group`` fits ``keep``."""

    def joined(own: Column) -> Column:
        def filled(piece: Column, i: Column) -> Column:
            match = F.get(own["matches"], i)
            blank = F.concat(F.lit(EDGE), F.repeat(F.lit(" "), F.length(match) - 1))
            return F.concat(piece, F.coalesce(F.when(keep(F.get(own["groups"], i)), blank).otherwise(match), F.lit("")))

        return F.array_join(F.transform(own["pieces"], filled), "")

    return _let(
        joined, pieces=F.split(text, pattern), matches=_matches(text, pattern), groups=_matches(text, pattern, group)
    )


def _ratio(table: list[float], candidate: Column) -> Column:
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - FIRST)

    def add(acc: Column, code: Column) -> Column:
        step = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.get(ratios, acc["last"] * SPAN + code))
        return F.struct(code.alias("last"), (acc["sum"] + step).alias("sum"))

    return F.aggregate(codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), add)["sum"]


def find(
    docs: DataFrame,
    table: list[float],
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document ``id``, ``base`` (spans of the patterns) and ``spans`` (these and the models'):
    structs of start, rank in KINDS, end, in code points, ordered."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    long_enough = lambda value: F.length(value) >= VALUE_LENGTH
    likely = lambda candidate: _ratio(table, candidate) > threshold
    base = F.concat(_spans(0, text, ASSIGN, long_enough, 2), _spans(1, text, ACCESS), _spans(2, text, HEX))
    more = _let(
        lambda own: _spans(3, own["rest"], CANDIDATE, likely),
        rest=_let(
            lambda own: _blanked(own["rest"], KEYS, lambda key: F.lit(True)),
            rest=_blanked(text, ASSIGN, long_enough, 2),
        ),
    )
    found = rows.select("id", F.sort_array(base).alias("base"), more.alias("more"))
    return found.select("id", "base", F.sort_array(F.concat("base", "more")).alias("spans"))


def written(spans: str) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def count_kind(spans: str, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
