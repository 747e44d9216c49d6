"""Prefix trie of conversations as node tables addressed by minimal perfect hashes.

A node is a distinct sequence of first turns. Its digest is the running sum of the digests of (depth, turn), so
digests come from sums over sorted rows, also where one conversation spans many partitions.

Conversations are dealt to shards by family, long ones in pieces of ``PIECE`` turns. A shard enumerates the
distinct digests of its rows: level by level each digest claims a place by its hash, the holder's whole digest is
compared, and those that differ go on to the next level; occupied places are numbered without gaps. Counts are
scattered into flat arrays by slot and accumulated through the array of parent slots, deepest nodes first.
Shards give partial sums per node, which are added up, so a prefix that all conversations share costs
one row per shard. What only all shards together know (members, children) goes back once, to the shard that
holds a node's smallest member, and subtree sums are accumulated in the same way. A piece's last node gets what
its conversations own beyond the piece.

Defined results
    null conversation    takes no part
    null role or text    empty
    null turn            first
    ties in turn         by role, then text
    repeated rows        each is a turn
    very long text       whole, by its digest
    very long conversation   whole, in pieces
    empty table          no rows, no root
    extra columns        are never read; clashing names are not a problem
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeloom.llm.common import staged

# Turns of a conversation that are kept together.
PIECE = 4096
# Rows of a shard, about.
SHARD_ROWS = 1 << 16
# Running sums are kept modulo 2**60, so two of them never overflow a long.
MASK = (1 << 60) - 1
EMPTY = hashlib.sha256(b"").hexdigest()

_LOCAL = "shard long, lo long, hi long, parent_lo long, parent_hi long, depth long, size long, n_convs long, owner long"
_SUMS = "lo long, hi long, depth long, saved_tokens long, n_leaves long"


def running(rows: DataFrame, key: str, order: list, sums: dict[str, str], keep: list[str]) -> DataFrame:
    """``key``, ``keep``, ``place`` (from 1, in order) and, per entry of ``sums``, the running total of a
    column within ``key``, all modulo 2**60.

    Rows are dealt by range over key and order, so a key with very many rows spans tasks. Of what came before
    in other tasks only a task's first key needs to know: at most one row per task, which is added at the end.
    """
    names = ["place", *sums]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, before = TaskContext.get().partitionId(), None, np.zeros(len(names), np.int64)
        for batch in batches:
            if batch.empty:
                continue
            own = batch[key].to_numpy()
            values = np.column_stack([np.ones(len(own), np.int64), *(batch[c].to_numpy() for c in sums.values())])
            totals = np.cumsum(values, axis=0)
            starts = np.r_[0, np.flatnonzero(own[1:] != own[:-1]) + 1]
            shift = totals[starts] - values[starts]
            if own[0] == last:
                shift[0] -= before
            totals = (totals - np.repeat(shift, np.diff(np.r_[starts, len(own)]), axis=0)) & MASK
            last, before = own[-1], totals[-1]
            out = batch[[key, *keep]].assign(part=part)
            out[names] = totals
            yield out

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in (key, *keep)], "part int", *[f"{n} long" for n in names]])
    dealt = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    needed = dealt.select(key, *dict.fromkeys([*keep, *sums.values()]))
    local = staged(needed.mapInPandas(run, schema), "running")

    edges = local.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last")).orderBy("part").collect()
    shared = {a.last for a, b in zip(edges, edges[1:], strict=False) if a.last == b.first}
    if not shared:
        return local.drop("part")
    spark = rows.sparkSession
    keys = F.broadcast(spark.createDataFrame([(k,) for k in shared], f"{key} {kinds[key]}"))
    ends = local.join(keys, key).groupBy(key, "part").agg(*[F.max_by(n, "place").alias(n) for n in names])
    before: dict = {}
    offsets = []
    for r in ends.orderBy(key, "part").collect():
        total = before.get(r[key], [0] * len(names))
        offsets.append((r[key], r["part"], *total))
        before[r[key]] = [(t + r[n]) & MASK for t, n in zip(total, names, strict=True)]
    fields = [f"{key} {kinds[key]}", "part int", *[f"__{n} long" for n in names]]
    added = F.broadcast(spark.createDataFrame(offsets, ", ".join(fields)))
    whole = [(F.col(n) + F.coalesce(f"__{n}", F.lit(0))).bitwiseAND(F.lit(MASK)).alias(n) for n in names]
    return local.join(added, [key, "part"], "left").select(key, *keep, *whole)


def turns_in_order(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``place``, ``digest``, ``size``): the turns of every conversation, numbered from 1. The digest
    is of role and text, the size that of the text in UTF-8."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    framed = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.select(
        "*", F.unhex(F.sha2(framed.cast("binary"), 256)).alias("digest"), F.octet_length("text").cast("long").alias("size")
    )
    return running(rows, "conv_id", [F.col("turn").asc_nulls_first(), "role", "text"], {}, ["digest", "size"])


def branched(ordered: DataFrame, head: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to start with the first ``head`` (``most`` at most) turns of another one, ``base``
    (all if it has fewer), and to go on with their own turns after their first ``head``.

    Returns the turns (``conv_id``, ``family``, ``depth``, ``n_turns``, ``digest``, ``size``) and the conversations
    (``conv_id``, ``n_turns``), among them those without turns.
    """
    convs = ordered.groupBy("conv_id").agg(F.count("*").alias("own_turns"))
    convs = convs.select("*", head.cast("long").alias("head"), base.alias("family"))
    fronts = ordered.where(F.col("place") <= most).withColumnRenamed("conv_id", "family")
    lengths = convs.select(F.col("conv_id").alias("family"), F.least("own_turns", F.lit(most)).alias("there"))
    taken = F.least("head", F.coalesce("there", F.lit(0)))
    convs = convs.join(lengths, "family", "left").select("*", taken.alias("taken"))
    convs = convs.select("*", (F.col("taken") + F.greatest(F.col("own_turns") - F.col("head"), F.lit(0))).alias("n_turns"))
    convs = staged(convs, "conversations")
    columns = ["conv_id", "family", "depth", "n_turns", "digest", "size"]
    front = convs.join(fronts, "family").where("place <= head").withColumn("depth", F.col("place"))
    rest = (
        ordered.where(F.col("place") > head)
        .join(convs, "conv_id")
        .withColumn("depth", F.col("place") - F.col("head") + F.col("taken"))
    )
    return front.select(columns).unionByName(rest.select(columns)), convs.select("conv_id", "n_turns")


def _mixed(lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    x = lo.astype(np.uint64) ^ (hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(level * 0xD1B54A32D192ED03 % 2**64)
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xFF51AFD7ED558CCD)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


class SlotTable:
    """Slots 0 to n - 1 for the distinct digests among ``lo``, ``hi``; a slot's holder is compared whole."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray]] = []
        self.slots = np.full(len(lo), -1, np.int64)
        held_lo, held_hi, n = [], [], 0
        left = np.arange(len(lo))
        while len(left):
            size = 1 << max(3, int(len(left) * 1.3).bit_length())
            at = (_mixed(lo[left], hi[left], len(self.levels)) & np.uint64(size - 1)).astype(np.int64)
            holder = np.full(size, -1, np.int64)
            holder[at] = left
            taken = holder >= 0
            number = np.where(taken, n + np.cumsum(taken) - 1, -1)
            held_lo.append(lo[holder[taken]])
            held_hi.append(hi[holder[taken]])
            n += int(taken.sum())
            self.levels.append((size, number))
            own = holder[at]
            same = (lo[own] == lo[left]) & (hi[own] == hi[left])
            self.slots[left[same]] = number[at[same]]
            left = left[~same]
        empty = [np.empty(0, np.int64)]
        self.lo, self.hi = np.concatenate(held_lo or empty), np.concatenate(held_hi or empty)

    def __len__(self) -> int:
        return len(self.lo)

    def find(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The digests' slots, -1 where the table has none."""
        out, left = np.full(len(lo), -1, np.int64), np.arange(len(lo))
        for level, (size, number) in enumerate(self.levels):
            slot = number[(_mixed(lo[left], hi[left], level) & np.uint64(size - 1)).astype(np.int64)]
            # An empty place means that no digest of the table came this way.
            left, slot = left[slot >= 0], slot[slot >= 0]
            same = (self.lo[slot] == lo[left]) & (self.hi[slot] == hi[left])
            out[left[same]] = slot[same]
            left = left[~same]
        return out


class Shard:
    """The nodes of a shard as flat arrays by slot."""

    def __init__(self, rows: pd.DataFrame, piece: int) -> None:
        lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
        self.table = SlotTable(lo, hi)
        self.slots = self.table.slots
        self.columns = {c: self._scattered(rows[c]) for c in ("parent_lo", "parent_hi", "depth", "size")}
        parent = self.table.find(self.columns["parent_lo"], self.columns["parent_hi"])
        # The parent of a piece's first node is in another piece.
        self.parent = np.where((self.columns["depth"] - 1) % piece == 0, -1, parent)

    def _scattered(self, values: pd.Series) -> np.ndarray:
        out = np.zeros(len(self.table), np.int64)
        out[self.slots] = values.to_numpy()
        return out

    def accumulate(self, *arrays: tuple[np.ndarray, np.ufunc]) -> None:
        """Fold every array into the parents' slots, deepest nodes first."""
        depth = self.columns["depth"]
        order = np.argsort(-depth, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            at = at[self.parent[at] >= 0]
            for values, fold in arrays:
                fold.at(values, self.parent[at], values[at])


def nodes(paths: DataFrame, convs: DataFrame, piece: int = PIECE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per distinct sequence of first turns, from the root (depth 0) on.

    ``paths``: (``conv_id``, ``family``, ``depth`` from 1, ``n_turns``, ``digest``, ``size``); conversations of one family
    likely share turns. ``convs``: (``conv_id``, ``n_turns``), also those without turns. Columns: ``conv_id`` (the
    smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over
    the subtree, the size of a node's last text times its members but one), ``ends_sha256``.
    """
    spark = paths.sparkSession
    step = F.sha2(F.concat(F.col("digest"), F.lit(":").cast("binary"), F.col("depth").cast("string").cast("binary")), 256)
    lanes = [F.conv(F.substring(step, at, 15), 16, 10).cast("long") for at in (1, 16)]
    stepped = paths.select("*", lanes[0].alias("step_lo"), lanes[1].alias("step_hi"))
    keep = ["family", "depth", "n_turns", "size", "step_lo", "step_hi"]
    summed = running(stepped, "conv_id", ["depth"], {"lo": "step_lo", "hi": "step_hi"}, keep)
    facts = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), F.max("n_turns").alias("longest"), F.sum("n_turns").alias("turns")).first()
    shards = max(1, -(-(facts.turns or 0) // shard_rows))
    block = F.floor((F.col("depth") - 1) / piece).cast("long")
    rows = summed.select(
        F.pmod(F.xxhash64("family", block), F.lit(shards)).alias("shard"), "conv_id", "depth", "n_turns", "size", "lo", "hi",
        *[(F.col(c) - F.col(f"step_{c}")).bitwiseAND(F.lit(MASK)).alias(f"parent_{c}") for c in ("lo", "hi")],
    )

    def members(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(rows, piece)
        last = ((rows["depth"] == rows["n_turns"]) | (rows["depth"] % piece == 0)).to_numpy()
        count = np.bincount(shard.slots[last], minlength=len(shard.table)).astype(np.int64)
        owner = np.full(len(shard.table), np.iinfo(np.int64).max)
        np.minimum.at(owner, shard.slots[last], rows["conv_id"].to_numpy()[last])
        shard.accumulate((count, np.add), (owner, np.minimum))
        return pd.DataFrame(
            {"shard": rows["shard"].iloc[0], "lo": shard.table.lo, "hi": shard.table.hi, **shard.columns, "n_convs": count, "owner": owner}
        )[[c.split()[0] for c in _LOCAL.split(", ")]]

    local = staged(rows.groupBy("shard").applyInPandas(members, _LOCAL), "shards")
    known = staged(
        local.groupBy("lo", "hi", "depth").agg(
            F.sum("n_convs").alias("n_convs"), F.min("owner").alias("conv_id"),
            *[F.min(c).alias(c) for c in ("parent_lo", "parent_hi", "size")],
        ),
        "nodes",
    )
    children = known.groupBy(F.col("parent_lo").alias("lo"), F.col("parent_hi").alias("hi")).agg(F.count("*").alias("n_children"))
    known = staged(known.join(children, ["lo", "hi"], "left").fillna(0, ["n_children"]), "nodes")

    # What a node adds to its subtrees, in the shard that holds its smallest member.
    adds = known.select(
        "lo", "hi", "depth", "conv_id",
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
    )
    here = F.col("owner") == F.col("conv_id")
    columns = ["shard", "lo", "hi", "parent_lo", "parent_hi", "depth", "size", "saved_tokens", "n_leaves"]
    values = local.join(adds, ["lo", "hi", "depth"]).select(
        *columns[:7], *[F.when(here, F.col(c)).otherwise(0).alias(c) for c in ("saved_tokens", "n_leaves")]
    )
    if (facts.longest or 0) > piece:
        own = adds.groupBy("conv_id", block.alias("block")).agg(F.sum("saved_tokens").alias("s"), F.sum("n_leaves").alias("n"))
        later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, 0)
        beyond = own.select("conv_id", (F.col("block") - 1).alias("block"), F.sum("s").over(later).alias("saved_tokens"), F.sum("n").over(later).alias("n_leaves"))
        # Pieces up to the first that a conversation owns nodes in are not all in ``own``: carry on to each of them.
        edges = rows.where((F.col("depth") % piece == 0) & (F.col("depth") < F.col("n_turns"))).withColumn("block", block)
        first = beyond.groupBy("conv_id").agg(F.min_by(F.struct("block", "saved_tokens", "n_leaves"), "block").alias("least"))
        carried = edges.join(first, "conv_id").join(beyond.withColumnRenamed("block", "at"), ["conv_id"], "left")
        carried = carried.where((F.col("at") == F.greatest("block", "least.block")))
        values = values.unionByName(carried.drop("least", "at").select(columns))

    def subtrees(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(rows, piece)
        sums = [np.zeros(len(shard.table), np.int64) for _ in range(2)]
        for total, c in zip(sums, ("saved_tokens", "n_leaves"), strict=True):
            np.add.at(total, shard.slots, rows[c].to_numpy())
        shard.accumulate(*[(total, np.add) for total in sums])
        return pd.DataFrame(
            {"lo": shard.table.lo, "hi": shard.table.hi, "depth": shard.columns["depth"], "saved_tokens": sums[0], "n_leaves": sums[1]}
        )

    totals = (
        values.groupBy("shard").applyInPandas(subtrees, _SUMS).groupBy("lo", "hi", "depth")
        .agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    )

    if not facts.n:
        roots = []
    else:
        top = adds.agg(F.sum("saved_tokens"), F.sum("n_leaves"), F.sum((F.col("depth") == 1).cast("long"))).first()
        roots = [(0, 0, 0, facts.first, None, facts.n, top[2] or 0, top[1] or 1, top[0] or 0)]
    root = spark.createDataFrame(
        roots, "lo long, hi long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    )
    parents = known.select(F.col("lo").alias("parent_lo"), F.col("hi").alias("parent_hi"), F.col("conv_id").alias("above"))
    inner = known.where("depth > 1").join(parents, ["parent_lo", "parent_hi"])
    outer = known.where("depth = 1").withColumn("above", F.lit(facts.first).cast("long"))
    whole = inner.unionByName(outer).withColumnRenamed("above", "parent_conv_id")
    whole = whole.join(totals, ["lo", "hi", "depth"]).select(root.columns).unionByName(root)

    last = summed.where("depth = n_turns").select("lo", "hi", "conv_id")
    none = convs.where("n_turns = 0").select(F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), "conv_id")
    return whole.join(ends(last.unionByName(none)), ["lo", "hi"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def ends(rows: DataFrame) -> DataFrame:
    """Per (``lo``, ``hi``) the SHA-256 of its ids in order, comma-joined. Ids are sorted and joined in many tasks;
    of a node with very many, one task reads the joined texts as a stream."""
    key = ["lo", "hi"]

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grouped = batch.groupby(key, sort=False)["conv_id"]
            yield pd.DataFrame({"first": grouped.first(), "text": grouped.agg(lambda ids: ",".join(map(str, ids)))}).reset_index()

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, digest = None, None
        for batch in batches:
            out = []
            for lo, hi, _, text in batch.itertuples(index=False):
                if (lo, hi) == last:
                    digest.update(b"," + text.encode())
                    continue
                if digest:
                    out.append((*last, digest.hexdigest()))
                last, digest = (lo, hi), hashlib.sha256(text.encode())
            yield pd.DataFrame(out, columns=[*key, "ends_sha256"])
        if digest:
            yield pd.DataFrame([(*last, digest.hexdigest())], columns=[*key, "ends_sha256"])

    order = [*key, "conv_id"]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(joined, "lo long, hi long, first long, text string")
    return (
        parts.repartition(*key).sortWithinPartitions(*key, "first").mapInPandas(hashed, "lo long, hi long, ends_sha256 string")
    )
