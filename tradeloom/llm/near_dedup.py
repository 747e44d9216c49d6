"""Near-duplicate detection by min-max hashing, with exact confirmation on full shingle sets.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
64 permutations give the 128 values that plain min-hashing takes 128 for. The values are cut into
bands; documents with an equal band are candidates.

1. One pass over the texts gives each document's set size, a digest of its shingle set and its band
   keys. Documents with equal sets are one class from then on, named by their smallest id.
2. In each bucket every class is paired with the one that meets most others, the lead, which is linear
   in the size of the bucket. Pairs that sizes and sketches allow are confirmed on the full sets. Links
   give components.
3. Members of a bucket outside the lead's component may still be linked with each other or with a
   member inside it. Such pairs must share a shingle in which both differ from the lead, among the
   first few of either (see ``_differences``), so they are found by a join on these, not by listing the
   bucket's pairs. This is exact, for every size of bucket.

No step lists all pairs of a group of copies, and none drops a bucket, a member or a candidate.

A pair at exactly the threshold misses all bands with probability below ``miss`` (1e-4 by default;
far less for closer pairs). Pairs whose sketches, four bits of each signature value, differ in more
places than the threshold's mean and seven deviations are not confirmed (a linked pair is that unlucky
once in 1e9). Sets are compared by 64-bit shingle hashes.

Defined results
    null or empty text, or one without words   size 0, linked with nothing, its own component
    fewer words than a shingle                 the whole sequence is the one shingle
    null id                                    sorts below every id and is joined to nothing
    repeated rows                              rows with one id and text are one document
    empty table                                no rows
    extra columns                              are never read; clashing names are not a problem
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import lower_words, select_documents, staged, text_digest
from tradeloom.llm.graph import components

PERMUTATIONS = 64

_SEEDS = np.random.default_rng(20_011).integers(1, 2**63, size=(2, 1024), dtype=np.uint64) | np.uint64(1)


def band_rows(percent: int, values: int = 2 * PERMUTATIONS, miss: float = 1e-4) -> int:
    """The most rows a band can have so that a pair at the threshold misses all bands with
    probability ``miss`` at most."""
    best = 1
    for rows in range(1, values + 1):
        if (1 - (percent / 100) ** rows) ** (values // rows) <= miss:
            best = rows
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit changes about half of the output bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class ShingleHasher:
    """64-bit hashes of a text's distinct shingles. Word hashes are remembered up to a bound."""

    def __init__(self, width: int, remembered: int = 200_000) -> None:
        self.width, self.remembered, self.seen = width, remembered, {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = lower_words(text)
        if not tokens:
            return np.empty(0, np.uint64)
        if len(self.seen) > self.remembered:
            self.seen.clear()
        for word in set(tokens).difference(self.seen):
            self.seen[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(self.seen.__getitem__, tokens), np.uint64, len(tokens))
        width = min(self.width, len(tokens))
        out = np.full(len(tokens) - width + 1, width, np.uint64)
        for i in range(width):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)])
        return np.unique(out)


def min_max(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minimum and maximum under each permutation; long sets are read in chunks."""
    xor, times = _SEEDS[0, :permutations, None], _SEEDS[1, :permutations, None]
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for at in range(0, len(shingles), 4096):
        permuted = (shingles[None, at : at + 4096] ^ xor) * times
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per document and band. A band takes minima and maxima of different permutations."""
    bands = signatures.shape[1] // rows
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(signatures), 1))
    for at in range(0, bands * rows, bands):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + signatures[:, at : at + bands])
    return out.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each of the 128 values, as four planes of 128 bits: eight numbers per document."""
    bits = _mix(signatures)
    planes = [np.packbits((bits >> np.uint64(i)).astype(np.uint8) & 1, axis=1) for i in range(4)]
    return np.concatenate(planes, axis=1).view(np.int64)


def most_unlike(percent: int, values: int = 2 * PERMUTATIONS) -> int:
    """Sketch places in which a pair at the threshold may differ: the mean and seven deviations."""
    p = (1 - percent / 100) * 15 / 16
    return math.ceil(values * p + 7 * math.sqrt(values * p * (1 - p)))


def signatures(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per document ``id``, ``digest`` of the text, ``n_shingles``, ``set_key``, ``bands``, ``sketch``."""
    rows = band_rows(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = ShingleHasher(width)
        for batch in batches:
            size, key = [], []
            signed = np.empty((len(batch), 2 * PERMUTATIONS), np.uint64)
            for at, text in enumerate(batch.pop("text")):
                shingles = hasher(text)
                size.append(len(shingles))
                signed[at] = min_max(shingles)
                key.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            found = [(k, b) if n else (None, []) for n, k, b in zip(size, key, band_keys(signed, rows), strict=True)]
            yield batch.assign(
                n_shingles=size,
                set_key=[k for k, _ in found],
                bands=[b for _, b in found],
                sketch=list(sketches(signed)),
            )

    return docs.select(
        F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("digest"), F.col(text_col).alias("text")
    ).mapInPandas(run, "id long, digest binary, n_shingles long, set_key binary, bands array<long>, sketch array<long>")


def _shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = ShingleHasher(width)
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "shingles": [hasher(t).view(np.int64) for t in batch["text"]]})

    return texts.mapInPandas(run, "id long, shingles array<long>")


def _stars(classes: DataFrame) -> DataFrame:
    """(``lead``, ``id``): every class beside the lead of each bucket it is in. A bucket's lead is the
    class that meets most others in all its buckets: of a text and its variants most likely the text."""
    keyed = classes.select(F.explode("bands").alias("key"), "id")
    several = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = staged(keyed.join(several, "key"), "buckets")
    meets = members.groupBy("id").agg(F.sum("members").alias("meets"))
    lead = (
        members.join(meets, "id")
        .groupBy("key")
        .agg(F.max(F.struct("meets", (-F.col("id")).alias("first"))).alias("lead"))
        .select("key", (-F.col("lead.first")).alias("lead"))
    )
    return members.select("key", "id").join(lead, "key").where("id != lead").select("lead", "id").distinct()


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that can be linked: the smaller set must have at least the threshold's
    share of the larger, and the sketches must not differ more than a linked pair's can."""
    for side in "ab":
        own = classes.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
        pairs = pairs.join(own, side)
    words = [
        "bit_count(" + " | ".join(f"(s_a[{2 * i + w}] ^ s_b[{2 * i + w}])" for i in range(4)) + ")" for w in range(2)
    ]
    return (
        pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .where(f"{' + '.join(words)} <= {most_unlike(percent)}")
        .select("a", "b")
    )


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``, ...) with their shingle sets ``x`` and ``y``."""
    return pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"
    )


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets reach the threshold."""
    shared = F.size(F.array_intersect("x", "y"))
    return (
        _with_sets(pairs, sets)
        .select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("both"))
        .where(f"100 * shared >= {percent} * (both - shared)")
        .select("a", "b")
    )


def _differences(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Per star member the leading shingles in which it differs from the lead: those it has alone, then
    those it lacks, each by hash.

    Two members x and y reach the threshold t only if their sets differ in at most
    (1 - t) / (1 + t) (|x| + |y|) shingles, and that is |Dx| + |Dy| less twice what the differences
    Dx and Dy from the lead share. If x is not linked with the lead, they must then share one; and by
    the prefix argument one of the first floor((1 - t) / t |x|) + 1 of either. ``size`` is |x|, ``far``
    is |Dx|, ``place`` the shingle's place in Dx, ``bits0`` and ``bits1`` mark its shingles by 7 bits of
    their hashes.
    """
    own, gone = F.array_except("y", "x"), F.array_except("x", "y")
    ordered = F.concat(F.sort_array(own), F.sort_array(gone))
    first = F.floor(F.size("y") * (100 - percent) / percent).cast("int") + 1

    def marks(word: int) -> Column:
        mine = F.filter("all", lambda e: F.shiftright(e, 6).bitwiseAND(F.lit(1)) == word)
        bit = lambda e: F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, e: acc.bitwiseOR(bit(e)))

    both = _with_sets(stars.withColumnsRenamed({"lead": "a", "id": "b"}), sets).select(
        F.col("a").alias("lead"), F.col("b").alias("id"), "component", "outside", ordered.alias("all"), first.alias("first"), F.size("y").alias("size")
    )
    return both.select(
        "lead",
        "id",
        "component",
        "outside",
        "size",
        F.size("all").alias("far"),
        marks(0).alias("bits0"),
        marks(1).alias("bits1"),
        F.posexplode(F.slice("all", F.lit(1), F.col("first"))).alias("place", "shingle"),
    )


def _across(stars: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (``a``, ``b``) of star members that no link connects yet: those outside the
    lead's component with all others, by the differences from the lead that they share."""
    parts = components(links)
    placed = (
        stars.join(parts, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .join(parts.select(F.col("id").alias("lead"), F.col("component").alias("at")), "lead", "left")
        .withColumn("outside", F.col("component") != F.coalesce("at", "lead"))
        .drop("at")
    )
    unsettled = placed.groupBy("lead").agg(F.count("*").alias("members"), F.max("outside").alias("any"))
    placed = placed.join(unsettled.where("any and members > 1").select("lead"), "lead", "left_semi")
    marks = staged(_differences(placed, sets, percent), "differences")
    # A shingle that the members of one component alone have joins nothing; most are such.
    mixed = (
        marks.groupBy("lead", "shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("outside").alias("any"))
        .where("low < high and any")
        .select("lead", "shingle")
    )
    marks = staged(marks.join(mixed, ["lead", "shingle"], "left_semi"), "mixed")
    # The sets may differ in so many shingles. For given |Dx| and |Dy|, the shared shingle is even among
    # the first (|Dx| - |Dy| + apart) / 2 + 1 of Dx, and likewise of Dy.
    apart = f"(x.size + y.size) * {100 - percent} / {100 + percent}"
    # Each mark of Dx that Dy lacks stands for a shingle of Dx, at least, that is not shared.
    shared = f"(x.far + y.far - {apart}) / 2"
    most_x = "x.far - bit_count(x.bits0 & ~y.bits0) - bit_count(x.bits1 & ~y.bits1)"
    most_y = "y.far - bit_count(y.bits0 & ~x.bits0) - bit_count(y.bits1 & ~x.bits1)"
    return (
        marks.where("outside").alias("x")
        .join(marks.alias("y"), ["lead", "shingle"])
        .where("x.component != y.component")
        .where(f"2 * x.place <= x.far - y.far + {apart} and 2 * y.place <= y.far - x.far + {apart}")
        .where(f"{shared} <= {most_x} and {shared} <= {most_y}")
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )


def find_links(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Confirmed links (``a``, ``b``) between classes (``id``, ``n``, ``bands``, ``sketch``): enough to
    connect all that any candidate pair connects. ``sets_of(ids)`` gives the shingle sets of some ids."""
    stars = staged(_stars(classes), "stars")
    ids = stars.select("id").unionByName(stars.select(F.col("lead").alias("id"))).distinct()
    sets = staged(sets_of(ids), "shingles")
    spokes = _possible(stars.withColumnsRenamed({"lead": "a", "id": "b"}), classes, percent)
    links = staged(_confirm(spokes, sets, percent), "links")
    across = staged(_across(stars, links, sets, percent), "across")
    return links.unionByName(staged(_confirm(_possible(across, classes, percent), sets, percent), "links"))


def decide(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id``, ``digest``, ``n_shingles``, ``component`` (smallest id that links
    reach), ``kept`` (it is that id)."""
    signed = staged(signatures(docs, width, percent, id_col, text_col), "signatures")
    classes = staged(
        signed.where("set_key is not null and id is not null")
        .groupBy("set_key")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "classes",
    )

    def sets_of(ids: DataFrame) -> DataFrame:
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        return _shingle_sets(texts.join(ids.hint("merge"), "id", "left_semi"), width).dropDuplicates(["id"])

    parts = components(find_links(classes.drop("set_key"), sets_of, percent))
    placed = classes.select("set_key", F.col("id").alias("__class")).join(
        parts.select(F.col("id").alias("__class"), "component"), "__class", "left"
    )
    placed = placed.select("set_key", F.coalesce("component", "__class").alias("component"))
    return (
        signed.drop("bands")
        .join(placed, "set_key", "left")
        .select("id", "digest", "n_shingles", F.coalesce("component", "id").alias("component"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
    )


def dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component."""
    kept = decide(docs, width, percent, id_col, text_col).where("kept").groupBy("id", "digest").agg(F.count("*").alias("n"))
    return select_documents(docs, kept, id_col, text_col)
