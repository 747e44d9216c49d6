"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection of their ends.

Both tokenizers cut the same bytes. The shorter list of token ends drives an exponential and then binary
search through the longer one, for all its ends at once. Ends found in both cut the tokens into groups; between two ends of the
shorter list, the difference of ranks in the longer one is the range of tokens that overlap.

Neither tokenizer joins anything across a space that follows a visible character, so both always end
there. Texts are cut at these places, and every distinct piece is encoded and aligned once per task (in a
bounded memory). Tasks close blocks of documents; a block numbers the id pairs it holds, so pair counts over
the corpus are summed over (block, pair) rows and go back to the documents by block.

Defined results
    null or empty text    no tokens: zeros, an empty ``groups_sha256``
    text changed by a tokenizer (its tokens' bytes differ from space + text)   the same
    null id               kept as null
    very long text        whole; a text without spaces is one piece
    repeated rows         each is a document, and counts as one for the pairs it holds
    ties                  all pairs with the highest count of their A id are best
    empty table           no rows
    extra columns         are never read; clashing names are not a problem
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeloom.llm.common import staged

# A block is closed at so many documents, or (document, pair) entries.
BLOCK_DOCUMENTS, BLOCK_ENTRIES = 4096, 1 << 19
# Pieces that a task remembers before it starts anew.
REMEMBERED = 200_000
# Characters that are encoded in one call.
SLICE = 1 << 18

_DOCUMENT = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCKS = f"block long, {_DOCUMENT}, places binary, times binary, pairs array<long>, held array<long>"


def gallop(ends: np.ndarray, values: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Per value the first place, from its ``low`` on, whose end is at least the value. All values step ahead by
    doubling strides until they are past their place, and close in on it by halving."""
    last = len(ends) - 1
    low, high, step = low.copy(), low.copy(), 1
    ahead = np.flatnonzero(ends[low] < values)
    while len(ahead):
        low[ahead] = high[ahead] + 1
        high[ahead] = np.minimum(high[ahead] + step, last)
        ahead, step = ahead[ends[high[ahead]] < values[ahead]], step * 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        under = ends[middle] < values[open_]
        low[open_[under]] = middle[under] + 1
        high[open_[~under]] = middle[~under]
        open_ = open_[low[open_] < high[open_]]
    return high


def overlaps(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For two lists of ends with the same last one: per token of ``short`` the first and last token of ``long``
    it overlaps, and whether both end there. ``start`` is a place in ``long`` at or before each."""
    last = gallop(long, short, start)
    both = long[last] == short
    return np.r_[0, (last + both)[:-1]], last, both


def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable bytes stand for themselves, others follow U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens, groups and links of texts for a byte-level BPE file (A) and a sentence-piece model (B)."""

    # From a space on, to the next space that follows a visible character.
    PIECES = re.compile(r" [^ ]*(?:(?<=\s) [^ ]*)*").findall

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_alphabet()
        names = self.a.get_vocab()
        self.bytes_a = [b""] * (1 + max(names.values()))
        for name, i in names.items():
            self.bytes_a[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(name[3:-1], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.sizes = [np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b)]
        # Ids as text, within a group and at its end.
        self.written = [
            [np.array([f"{i}{mark}" for i in range(len(table))], object) for mark in ("," + end)]
            for table, end in ((self.bytes_a, "|"), (self.bytes_b, ";"))
        ]
        # A piece of the model with a space after a visible character would join pieces of a text.
        self.whole = any("▁" in name.lstrip("▁") for name in names)
        self.space = self.b.piece_to_id("▁")
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        self.memory: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.links, self.starts = array("q"), array("q", [0])

    def pieces(self, text: str) -> list[str]:
        return [" " + text] if self.whole else self.PIECES(" " + text)

    @staticmethod
    def _unchanged(own: list[bytes], ids: np.ndarray, counts: np.ndarray, table: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Which pieces are the bytes of their tokens."""
        at, ends = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(sizes[ids])]
        cut = [table[i] for i in ids.tolist()]
        same = ends[at[1:]] - ends[at[:-1]] == np.fromiter(map(len, own), np.int64, len(own))
        if same.all() and b"".join(cut) == b"".join(own):
            return same
        return np.array([b"".join(cut[i:j]) == piece for piece, i, j in zip(own, at.tolist(), at[1:].tolist(), strict=False)], bool)

    def learn(self, pieces: list[str]) -> None:
        """Encode and align the pieces that are not known yet, as one text; one that a tokenizer changes has no
        tokens."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.memory))
        if not new:
            return
        self.memory.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        found_a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        # The model adds the space itself, but not to an empty text.
        found_b = self.b.encode([p[1:] for p in new], num_threads=1)
        found_b = [found if len(p) > 1 else [self.space] for p, found in zip(new, found_b, strict=True)]
        counts = [np.fromiter(map(len, found), np.int64, len(new)) for found in (found_a, found_b)]
        ids = [np.fromiter(chain.from_iterable(found), np.int64, n.sum()) for found, n in zip((found_a, found_b), counts, strict=True)]
        own = [p.encode() for p in new]
        kept = self._unchanged(own, ids[0], counts[0], self.bytes_a, self.sizes[0])
        kept &= self._unchanged(own, ids[1], counts[1], self.bytes_b, self.sizes[1])
        ids = [i[np.repeat(kept, n)] for i, n in zip(ids, counts, strict=True)]
        counts = [np.where(kept, n, 0) for n in counts]
        links, n_links, n_groups = np.empty(0, np.int64), np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        if kept.any():
            # The shorter list searches the longer one, from the start of its piece.
            s = int(len(ids[0]) > len(ids[1]))
            ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids, strict=True)]
            start = np.repeat(np.cumsum(counts[1 - s]) - counts[1 - s], counts[s])
            low, high, both = overlaps(ends[s], ends[1 - s], start)
            width = high - low + 1
            one = np.repeat(ids[s], width)
            other = ids[1 - s][np.arange(len(one)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low, width)]
            a, b = (other, one) if s else (one, other)
            links = (a << 32) + b
            at = np.cumsum(counts[s])
            n_links, n_groups = (np.diff(np.r_[0, np.r_[0, np.cumsum(x)][at]]) for x in (width, both))
            closes = [np.zeros(len(i), bool) for i in ids]
            closes[s], closes[1 - s][high[both]] = both, True
            self._write(ids, closes, n_groups)
        else:
            self.groups += [""] * len(new)
        for held, values in (
            (self.n_a, counts[0]), (self.n_b, counts[1]), (self.n_groups, n_groups), (self.links, links),
            (self.starts, self.starts[-1] + np.cumsum(n_links)),
        ):
            held.frombytes(values.astype(np.int64).tobytes())

    def _write(self, ids: list[np.ndarray], closes: list[np.ndarray], n_groups: np.ndarray) -> None:
        """The groups of every piece as text, each group closed by a semicolon."""
        words = np.concatenate([np.where(c, w[1][i], w[0][i]) for w, c, i in zip(self.written, closes, ids, strict=True)])
        group = np.concatenate([2 * (np.cumsum(c) - c) + side for side, c in enumerate(closes)])
        order = np.argsort(group, kind="stable")
        ordered = words[order].tolist()
        to = np.searchsorted(group[order], 2 * np.cumsum(n_groups))
        self.groups += ["".join(ordered[i:j]) for i, j in zip([0, *to.tolist()], to.tolist(), strict=False)]

    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: token counts, groups, links, the groups' digest, distinct pairs and their times."""
        if len(self.memory) > self.remembered:
            self.forget()
        cut = [self.pieces(t) if t else [] for t in texts]
        self.learn([p for pieces in cut for p in pieces])
        n_a, n_b, n_groups, links, starts = (
            np.frombuffer(kept, np.int64) if len(kept) else np.empty(0, np.int64)
            for kept in (self.n_a, self.n_b, self.n_groups, self.links, self.starts)
        )
        none = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        out = []
        for pieces in cut:
            found = np.fromiter(map(self.memory.__getitem__, pieces), np.int64, len(pieces))
            if not pieces or (n_a[found] == 0).any():
                out.append(none)
                continue
            written = "".join([self.groups[i] for i in found.tolist()])
            digest = hashlib.sha256(written[:-1].encode()).hexdigest()
            distinct, times = np.unique(found, return_counts=True)
            sizes = starts[distinct + 1] - starts[distinct]
            shift = np.repeat(starts[distinct] - np.cumsum(sizes) + sizes, sizes)
            held, place = np.unique(links[shift + np.arange(len(shift))], return_inverse=True)
            times = np.bincount(place, np.repeat(times, sizes)).astype(np.int64)
            out.append((n_a[found].sum(), n_b[found].sum(), n_groups[found].sum(), times.sum(), digest, held, times))
        return out


def _slices(sizes: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """(First, length) of runs of texts that hold about ``most`` bytes, or are one text."""
    run = np.cumsum(sizes) // most
    cuts = np.r_[0, np.flatnonzero(run[1:] != run[:-1]) + 1, len(sizes)]
    return ((int(i), int(j - i)) for i, j in zip(cuts, cuts[1:], strict=False) if j > i)


def _narrow(values: np.ndarray) -> bytes:
    """One byte for the width, then the values as unsigned integers of that width."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Aligned documents in blocks, written once. The first row of a block lists its pairs (A id in the upper
    half) and how many of its documents hold each; a document has the pairs' places there and their times."""

    def closed(number: int, held: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([d[-2] for d in held])
        pairs, place = np.unique(keys, return_inverse=True)
        own = np.split(place, np.cumsum([len(d[-2]) for d in held])[:-1])
        rest = [None] * (len(held) - 1)
        longs = [pa.array(list(c), pa.int64()) for c in list(zip(*held, strict=True))[:5]]
        columns = [
            pa.array([number] * len(held), pa.int64()),
            *longs,
            pa.array([d[5] for d in held], pa.string()),
            pa.array([_narrow(p) for p in own], pa.binary()),
            pa.array([_narrow(d[-1]) for d in held], pa.binary()),
            pa.array([pairs, *rest], pa.list_(pa.int64())),
            pa.array([np.bincount(place, minlength=len(pairs)), *rest], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        number, held, entries = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for first, length in _slices(sizes.astype(np.int64)):
                part = batch.slice(first, length)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for i, found in zip(part.column("id").to_pylist(), aligner.align(texts), strict=True):
                    held.append((i, *found))
                    entries += len(found[-1])
                    if len(held) == BLOCK_DOCUMENTS or entries >= BLOCK_ENTRIES:
                        yield closed(number, held)
                        number, held, entries = number + 1, [], 0
        if held:
            yield closed(number, held)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return staged(texts.mapInArrow(run, _BLOCKS), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(``own_block``, ``place``, ``a``, ``b``, ``n``, ``best``): the pairs of every block, the documents of the
    corpus that hold each, and whether no pair of the same A id is held by more."""
    own = aligned.where("pairs IS NOT NULL").select(
        F.col("block").alias("own_block"), F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "pair")
    )
    own = own.select(
        "own_block",
        "place",
        F.shiftright("pair.pairs", 32).cast("int").alias("a"),
        F.col("pair.pairs").bitwiseAND((1 << 32) - 1).cast("int").alias("b"),
        F.col("pair.held").alias("held"),
    )
    counts = own.groupBy("a", "b").agg(F.sum("held").alias("n"))
    # At most one row per token of B in a window.
    same = Window.partitionBy("a")
    ranked = counts.withColumn("best", (F.col("n") == F.max("n").over(same)))
    return own.drop("held").join(ranked, ["a", "b"])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: tokens, groups and links, how many links are best for their A id, the sum of the
    links' corpus counts, and the digest of the groups."""
    aligned = blocks(docs, path_a, path_b, id_col, text_col)

    def totals(held: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        n, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), bool)
        n[counts["place"]], best[counts["place"]] = counts["n"], counts["best"]
        out = held.drop(columns=["block", "places", "times"]).astype({"id": "Int64"})
        entries = [(_wide(p), _wide(t)) for p, t in zip(held["places"], held["times"], strict=True)]
        out["n_best"] = [int(times[best[places]].sum()) for places, times in entries]
        out["count_sum"] = [int((times * n[places]).sum()) for places, times in entries]
        return out

    held = aligned.drop("pairs", "held").groupBy("block")
    counts = pair_counts(aligned).select("own_block", "place", "n", "best").groupBy("own_block")
    return held.cogroup(counts).applyInPandas(totals, f"{_DOCUMENT}, n_best long, count_sum long")
