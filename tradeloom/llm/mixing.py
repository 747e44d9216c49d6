"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output divided by its own mass. Every
document draws its number of copies from the Poisson distribution with that mean: a uniform number,
made from a hash of seed and id, is inverted in the distribution function. The copies are dealt to all
partitions and ordered by a hash, so the result is shuffled globally and the same on every run.

A source's distribution function is one array, as long as mean + 10 deviations + 20. Means above 500 are
drawn as sums of independent parts, each with its own hash, so the array stays short and the first
probability stays above zero. Its work is in proportion to the copies it makes.

Mass is code points + 1 per document, so a source of empty texts has mass as well.

Defined results
    null source        a source of its own
    null text          mass 1
    null id            hashed as the empty text
    no target          the source is left out (rate 0), and so is one with a weight of 0, null or less
    repeated rows      draw the same number of copies, each row its own
    empty table        no rows
    extra columns      come along; names that start with ``__`` are the operator's own
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import shuffle_partitions, staged

PART = 500.0


def mass(text_col: str = "text") -> Column:
    return F.coalesce(F.length(text_col), F.lit(0)).cast("long") + 1


def source_mass(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(``source``, ``mass``): partial sums, so a hot source costs one row per task."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(mass(text_col)).alias("mass"))


def tempered_weights(masses: DataFrame, power: float = 0.5) -> DataFrame:
    """Targets that flatten the natural shares: weight = mass ** power."""
    return masses.select("source", F.pow("mass", F.lit(power)).alias("weight"))


def rates(masses: DataFrame, targets: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(``source``, ``rate``): the mean copies of a document, for an output of ``epochs`` times the
    whole mass."""
    wanted = targets.select(F.col("source").alias("__source"), "weight").where("weight > 0")
    both = masses.join(wanted, F.col("source").eqNullSafe(F.col("__source")))
    whole = masses.agg(F.sum("mass")).first()[0] or 0
    total = both.agg(F.sum("weight")).first()[0] or 1.0
    return both.select("source", (F.col("weight") / F.lit(float(total)) * F.lit(float(epochs * whole)) / F.col("mass")).alias("rate"))


def distribution(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... as one array."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("below"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(acc["below"], F.array(F.element_at(acc["below"], -1) + p)).alias("below"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["below"]


def uniform(seed: str, id_col: str, part: Column | int = 0) -> Column:
    """A number in [0, 1) from the first 48 bits of an MD5 digest."""
    part = part if isinstance(part, Column) else F.lit(part)
    text = F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"), part.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(2**48))


def mix(
    docs: DataFrame,
    targets: DataFrame | None = None,
    epochs: float = 1.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` replicated, with ``n_copies``, ``copy`` (from 1) and ``shuffle_key``, in global hash
    order. Without ``targets`` the weights are ``tempered_weights``."""
    masses = staged(source_mass(docs, source_col, text_col), "masses")
    rate = rates(masses, targets if targets is not None else tempered_weights(masses), epochs)
    parts = rate.withColumn("__parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int")))
    drawn = parts.select(
        F.col("source").alias("__source"), "__parts", distribution(F.col("rate") / F.col("__parts")).alias("__below")
    )
    # Left to Spark: few sources are broadcast by measured size; else a hot source is split as skewed.
    placed = docs.join(drawn, F.col(source_col).eqNullSafe(F.col("__source")))

    drawn_numbers = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda part: uniform(seed, id_col, part))
    copies = F.aggregate(
        drawn_numbers, F.lit(0), lambda n, u: n + F.size(F.filter("__below", lambda p: p <= u))
    )
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col(id_col).cast("string"), F.col("copy").cast("string")))
    counted = placed.withColumn("n_copies", copies).where("n_copies > 0").drop("__source", "__parts", "__below")
    dealt = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies")))).withColumn("shuffle_key", key)
    return dealt.repartition(shuffle_partitions(docs.sparkSession), "shuffle_key").sortWithinPartitions("shuffle_key")
