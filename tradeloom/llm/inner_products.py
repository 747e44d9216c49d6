"""Exact top-k search by integer inner product over vectors sorted by length.

Vectors are dealt by length, longest first, into packed blocks. Queries meet the block of the longest
vectors first; the k-th best score found there is a query's threshold. Of the other blocks a query block
meets those whose longest vector could still reach a threshold of one of its queries. Inside a block, vectors go
by descending length until length times length falls short. The rest is rotated by the singular vectors
of a sample, so that the first coordinates carry most of the product: their partial sum, plus the
Cauchy-Schwarz bound on what remains, rules out all but few vectors. Those get the exact integer product.

Rotation, thresholds and bounds only save work. Bounds carry a margin above rounding errors, so results are
exact: the sample changes no score.

Defined results
    null vector, null or non-finite component    the vector takes no part
    vectors of other lengths than the query's    have no product with it
    null id              a candidate like others, after all ids on ties; never a query
    very large components    exact; products beyond a long come out as its largest value, or that negated
    ties                 the smaller id
    repeated rows        each is a candidate and, with a query's id, a query; rows with the query's id are its own
    empty table          no rows
    extra columns        are never read; clashing names are not a problem
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeloom.llm.common import shuffle_partitions, staged

# Vectors that the rotation is fitted on, at most.
SAMPLE_ROWS = 4096
# Share of the squared length that the first rotated coordinates carry.
ENERGY = 0.8
# Components in a block.
BLOCK_SIZE = 1 << 18
# Bytes of head blocks that are sent to every executor; beyond, they are joined.
BROADCAST_BYTES = 32 << 20
# Rows that are multiplied at once.
CHUNK = 512

_PACKED = "block long, dim int, n int, longest double, ids binary, known binary, kind string, parts binary"
_FOUND = "query_block long, query_row int, query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(``id``, ``parts``): whole components as doubles, of the vectors that take part."""
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * scale)
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), scaled.alias("parts")).where(
        F.col("parts").isNotNull() & finite
    )


def _pack(block: int, ids: pd.Series, parts: np.ndarray) -> tuple:
    top = np.abs(parts).max(initial=0)
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
    known = ids.notna().to_numpy()
    numbers = ids.fillna(0).to_numpy(np.int64)
    longest = float(np.sqrt((parts**2).sum(axis=1)).max(initial=0))
    return block, parts.shape[1], len(ids), longest, numbers.tobytes(), known.tobytes(), kind, parts.astype(kind).tobytes()


def packed(rows: DataFrame, label: str) -> DataFrame:
    """Rows by dimension and descending length in blocks, one row each, written once."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in _PACKED.split(", ")]
        held: list[pd.DataFrame] = []

        def closed(frame: pd.DataFrame) -> pd.DataFrame:
            parts = np.floor(np.stack(frame["parts"].to_list())) if frame["dim"].iloc[0] else np.zeros((len(frame), 0))
            return pd.DataFrame([_pack(number, frame["id"].astype("Int64"), parts)], columns=names)

        for batch in batches:
            for dim, own in batch.groupby("dim", sort=True):
                size = max(1, BLOCK_SIZE // max(dim, 64))
                if held and (held[0]["dim"].iloc[0] != dim):
                    yield closed(pd.concat(held))
                    number, held = number + 1, []
                while len(own):
                    room = size - sum(map(len, held))
                    held.append(own.iloc[:room])
                    own = own.iloc[room:]
                    if sum(map(len, held)) == size:
                        yield closed(pd.concat(held))
                        number, held = number + 1, []
        if held:
            yield closed(pd.concat(held))

    squares = F.aggregate("parts", F.lit(0.0), lambda total, x: total + F.floor(x).cast("double") * F.floor(x))
    order = ["dim", F.col("squares").desc(), "id"]
    dealt = rows.select("id", F.size("parts").alias("dim"), squares.alias("squares"), "parts")
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "dim", "parts")
    return staged(dealt.mapInPandas(pack, _PACKED), label)


@dataclass
class Block:
    """The vectors of a packed row, longest first."""

    ids: np.ndarray
    known: np.ndarray
    parts: np.ndarray
    norms: np.ndarray

    @classmethod
    def of(cls, dim: int, ids: bytes, known: bytes, kind: str, parts: bytes) -> Block:
        ids, known = np.frombuffer(ids, np.int64), np.frombuffer(known, bool)
        values = np.frombuffer(parts, kind).astype(np.float64).reshape(len(ids), dim)
        return cls(ids, known, values, np.sqrt((values**2).sum(axis=1)))


def rotations(rows: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """Per dimension the singular directions of a sample, and how many of them carry ``ENERGY``."""
    total = rows.count()
    every = max(1, -(-total // SAMPLE_ROWS))
    sample = rows.where(F.pmod(F.xxhash64("id", "parts"), F.lit(every)) == 0).limit(SAMPLE_ROWS)
    held: dict[int, list] = {}
    for r in sample.select("parts").toLocalIterator():
        held.setdefault(len(r.parts), []).append(r.parts)
    out = {}
    for dim, parts in held.items():
        if dim:
            vectors = np.floor(np.array(parts, np.float64))
            vectors /= max(1.0, np.abs(vectors).max())
            _, weight, directions = np.linalg.svd(vectors, full_matrices=True)
            weight = np.pad(weight**2, (0, dim - len(weight)))
            carried = np.cumsum(weight) / max(weight.sum(), 1e-300)
            out[dim] = directions.T.copy(), int(np.searchsorted(carried, ENERGY)) + 1
    return out


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise integer products: doubles where every sum is exact in them, else Python integers."""
    top = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if top < 2.0**53:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    limit = np.iinfo(np.int64).max
    both = zip(left.tolist(), right.tolist(), strict=True)
    sums = (sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for a, b in both)
    return np.array([min(max(s, -limit), limit) for s in sums], np.int64)


def _best(rows: np.ndarray, scores: np.ndarray, places: np.ndarray, block: Block, k: int) -> np.ndarray:
    """Which of the found ones are among the k best of their query; the result is in order."""
    order = np.lexsort((block.ids[places], ~block.known[places], -scores, rows))
    first = np.r_[True, rows[order][1:] != rows[order][:-1]] if len(order) else np.empty(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


def search(queries: Block, block: Block, least: np.ndarray, k: int, rotation: tuple | None) -> tuple[np.ndarray, ...]:
    """(query row, place in ``block``, score) of the up to ``k`` best per query that reach ``least``."""
    dim = block.parts.shape[1]
    turned, first = (rotation[0], rotation[1]) if rotation else (np.eye(dim), dim)
    with np.errstate(all="ignore"):
        turned_q, turned_c = queries.parts @ turned, block.parts @ turned
        rest_q, rest_c = (np.sqrt((t[:, first:] ** 2).sum(axis=1)) for t in (turned_q, turned_c))
    out: list[tuple[np.ndarray, ...]] = []
    for q in range(0, len(queries.ids), CHUNK):
        own = slice(q, min(q + CHUNK, len(queries.ids)))
        least_q, norms = least[own].copy(), queries.norms[own]
        rows, places, scores = (np.empty(0, np.int64) for _ in range(3))
        for c in range(0, len(block.ids), CHUNK):
            near = slice(c, min(c + CHUNK, len(block.ids)))
            with np.errstate(all="ignore"):
                slack = 1e-9 * (1 + norms * block.norms[c])
                live = np.flatnonzero(~(norms * block.norms[c] < least_q - slack))
                if not len(live):
                    break
                bound = turned_q[own][live, :first] @ turned_c[near, :first].T + np.outer(rest_q[own][live], rest_c[near])
                i, j = np.nonzero(~(bound < (least_q - slack)[live, None]))
            i, j = live[i], j + c
            other = ~((queries.ids[own][i] == block.ids[j]) & queries.known[own][i] & block.known[j])
            i, j = i[other], j[other]
            exact = np.concatenate(
                [np.empty(0, np.int64)]
                + [exact_products(queries.parts[own][i[s : s + 65536]], block.parts[j[s : s + 65536]]) for s in range(0, len(i), 65536)]
            )
            rows, places, scores = np.r_[rows, i], np.r_[places, j], np.r_[scores, exact]
            kept = _best(rows, scores, places, block, k)
            rows, places, scores = rows[kept], places[kept], scores[kept]
            full = np.flatnonzero(np.bincount(rows, minlength=len(norms)) >= k)
            last = np.searchsorted(rows, full, side="right") - 1
            # A long rounds to the nearest double, which the margin covers.
            least_q[full] = np.maximum(least_q[full], scores[last].astype(np.float64))
        out.append((rows + q, places, scores))
    return tuple(np.concatenate([o[n] for o in out]) if out else np.empty(0, np.int64) for n in range(3))


def _found(turned: dict[int, tuple[np.ndarray, int]], k: int):
    """For rows of a query block beside a candidate block: what of the second is among the first's best."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                queries = Block.of(r.dim, r.q_ids, r.q_known, r.q_kind, r.q_parts)
                block = Block.of(r.dim, r.ids, r.known, r.kind, r.parts)
                least = np.frombuffer(r.least, np.float64) if r.least else np.full(len(queries.ids), -np.inf)
                rows, places, scores = search(queries, block, least, k, turned.get(r.dim))
                ids = pd.Series(block.ids[places], dtype="Int64").mask(~block.known[places])
                yield pd.DataFrame(
                    {"query_block": r.q_block, "query_row": rows.astype(np.int32), "query_id": queries.ids[rows], "vec_id": ids, "score": scores}
                )

    return run


def _thresholds(k: int):
    """Per query block: each query's k-th best score so far, and the least length that can reach one."""

    def run(held: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        r = next(held.itertuples())
        norms = Block.of(r.dim, r.q_ids, r.q_known, r.q_kind, r.q_parts).norms
        ordered = found.sort_values(["query_row", "score"], ascending=[True, False])
        last = ordered[ordered.groupby("query_row").cumcount() == k - 1]
        least = np.full(len(norms), -np.inf)
        least[last["query_row"]] = last["score"].astype(np.float64)
        with np.errstate(all="ignore"):
            reach = np.where(least > 0, (least * (1 - 1e-9) - 1) / norms, -np.inf)
        return pd.DataFrame([(r.q_block, float(np.nan_to_num(reach, nan=-np.inf).min(initial=np.inf)), least.tobytes())])

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): per row whose ``id`` meets ``is_query`` the ``k`` other
    rows with the highest integer inner product of ``floor(scale * component)``."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale)
    turned = rotations(rows)
    candidates = packed(rows, "vectors")
    asked = packed(rows.where(is_query & F.col("id").isNotNull()), "queries")
    asked = asked.select(
        F.col("block").alias("q_block"), "dim", *[F.col(c).alias(f"q_{c}") for c in ("ids", "known", "kind", "parts")]
    )

    head = candidates.groupBy("dim").agg(F.max_by("block", F.struct("longest", -F.col("block"))).alias("block"))
    heads = candidates.join(head, ["dim", "block"], "left_semi")
    size = heads.agg(F.sum(F.length("parts") + F.length("ids"))).first()[0] or 0
    at_hand = F.broadcast(heads) if size <= BROADCAST_BYTES else heads
    first = staged(
        asked.join(at_hand, "dim").withColumn("least", F.lit(None).cast("binary")).mapInPandas(_found(turned, k), _FOUND),
        "first-found",
    )
    thresholds = staged(
        asked.groupBy("q_block").cogroup(first.groupBy("query_block")).applyInPandas(_thresholds(k), "q_block long, reach double, least binary"),
        "thresholds",
    )

    # Pairs of blocks, named by their numbers; the numbers of one dimension are dealt over all tasks.
    salts = shuffle_partitions(spark)
    reach = asked.select("q_block", "dim").join(thresholds.select("q_block", "reach"), "q_block")
    reach = reach.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    others = candidates.join(head, ["dim", "block"], "left_anti").select(
        "block", "dim", "longest", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    )
    pairs = others.join(reach, ["dim", "salt"]).where("longest >= reach").select("block", "q_block")
    met = (
        pairs.join(candidates.drop("longest", "n"), "block")
        .join(asked.drop("dim"), "q_block")
        .join(thresholds.drop("reach"), "q_block")
    )
    found = first.unionByName(met.mapInPandas(_found(turned, k), _FOUND))
    order = Window.partitionBy("query_block", "query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
