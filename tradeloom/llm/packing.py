"""Packing token sequences into fixed windows by the sum-of-squares rule.

Every document goes, as it comes, to the fill level that leaves the smallest sum of squared counts of
partially filled windows over all levels. The counts are kept in one array indexed by level. Longer
documents first give whole windows; their rest is placed like a short document.

Each task packs the documents of its partition in one pass, without a shuffle. It holds the open
windows only, at most ``max_open``; beyond that, and at the end, they are drained: the tail of the
emptiest window is cut off to fill the gap of the fullest until all but one are full. So a partition
leaves at most one window with padding, and memory is bounded by ``max_open`` windows and the text at
hand.

Defined results
    null or empty text  its end token only
    null id             kept as null
    very long text      whole windows and a rest
    repeated rows       each is packed
    ties                equal sums go to the fullest level
    empty table         no rows
    extra columns       are never read; clashing names are not a problem
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, padded_length long"
)


class Remembered(dict):
    """A bounded memory that works out what it does not hold. When it is full it starts anew beside the
    one before, from which it takes what is asked for again."""

    def __init__(self, work_out: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.work_out, self.most, self.older = work_out, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.work_out(key)
        self[key] = found
        return found

    def trim(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Token ids of a text for a tokenizer file of the ``tokenizers`` library.

    The tokenizer lower-cases, drops white space and splits words independently, so words are looked
    up in a bounded memory, new words by their pieces, and only new pieces go through the merge model.
    Texts with characters for which its own clean-up might differ from the one here go through the
    tokenizer whole.
    """

    PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ɏ]*")

    def __init__(self, path: str, remembered: int = 200_000) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.memory = self.tokenizer.model, Remembered(self._word, remembered)
        # The word pattern of the vocabulary file.
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        # Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = (b for b in range(256) if b not in set(own))
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(rest)}

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isalpha()):
            pieces = self.pieces(word)
            if len(pieces) > 1:
                return b"".join([self.memory[piece] for piece in pieces])
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.alphabet)
        return array("i", [t.id for t in self.model.tokenize(word)]).tobytes()

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if "<|" in text or not self.PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        self.memory.trim()
        return np.frombuffer(b"".join(map(self.memory.__getitem__, text.lower().split())), np.int32)


class Packer:
    """Open windows by fill level. ``add`` and ``close`` give the windows they fill, as lists of
    (document, start, ids) pieces."""

    def __init__(self, length: int, max_open: int) -> None:
        self.length, self.max_open, self.open = length, max_open, 0
        self.counts = np.zeros(length + 1, np.int64)
        self.windows: list[list[list[tuple]]] = [[] for _ in range(length + 1)]
        # Change of the sum of squares when a window leaves a level, and when one reaches it.
        self.leave = np.full(length + 1, np.iinfo(np.int64).max // 4)
        self.reach = np.ones(length + 1, np.int64)
        self.leave[0] = self.reach[length] = 0

    def _count(self, level: int, by: int) -> None:
        if 0 < level < self.length:
            self.open += by
            n = self.counts[level] = self.counts[level] + by
            self.leave[level] = 1 - 2 * n if n else np.iinfo(np.int64).max // 4
            self.reach[level] = 2 * n + 1

    def level_for(self, size: int) -> int:
        change = self.leave[: self.length - size + 1] + self.reach[size:]
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, document: tuple, ids: np.ndarray) -> Iterator[list[tuple]]:
        start, whole = 0, len(ids) - len(ids) % self.length
        for start in range(0, whole, self.length):
            yield [(document, start, ids[start : start + self.length])]
        size = len(ids) - whole
        if not size:
            return
        level = self.level_for(size)
        window = self.windows[level].pop() if level else []
        self._count(level, -1)
        window.append((document, whole, ids[whole:]))
        if level + size == self.length:
            yield window
            return
        self.windows[level + size].append(window)
        self._count(level + size, 1)
        if self.open > self.max_open:
            yield from self._drain()

    def _drain(self) -> Iterator[list[tuple]]:
        """Fill the fullest open windows from the emptiest; one may stay open."""
        held = [(level, w) for level in range(self.length - 1, 0, -1) for w in self.windows[level]]
        for level in {level for level, _ in held}:
            self._count(level, -len(self.windows[level]))
            self.windows[level] = []
        first, last = 0, len(held) - 1
        while first < last:
            level, window = held[first]
            lower, donor = held[last]
            document, start, ids = donor.pop()
            cut = max(0, len(ids) - (self.length - level))
            window.append((document, start + cut, ids[cut:]))
            if cut:
                donor.append((document, start, ids[:cut]))
            level, lower = level + len(ids) - cut, lower - len(ids) + cut
            held[first], held[last] = (level, window), (lower, donor)
            if level == self.length:
                yield window
                first += 1
            if not lower:
                last -= 1
        if first == last:
            level, window = held[first]
            self.windows[level].append(window)
            self._count(level, 1)

    def close(self) -> Iterator[list[tuple]]:
        yield from self._drain()
        yield from (window for level in self.windows for window in level)


def padded_length(tokens: int, length: int) -> int:
    """A sequence is padded to ``length`` unless its size is a power of two."""
    return tokens if tokens & (tokens - 1) == 0 else length


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    length: int = 4096,
    max_open: int = 1024,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, the ids before it, its ids (null without ``with_ids``) and
    their checksum, its sequence, and its place there. Sequence ids carry the partition in front."""

    def rows(first: int, windows: list[list[tuple]]) -> pd.DataFrame:
        out = []
        for number, window in enumerate(windows, first):
            offset, total = 0, padded_length(sum(len(ids) for *_, ids in window), length)
            for (document, tokens), start, ids in window:
                crc = zlib.crc32(np.ascontiguousarray(ids, "<i4"))
                kept = ids if with_ids else None
                out.append((document, start, len(ids), kept, crc, tokens, number, offset, total))
                offset += len(ids)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pd.DataFrame(out, columns=names).astype({"id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, packer = Encoder(tokenizer_path), Packer(length, max_open)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            done: list[list[tuple]] = []
            for document, text in zip(batch["id"].astype("Int64"), batch["text"], strict=True):
                ids = np.append(encoder(text), np.int32(end_id))
                document = None if document is pd.NA else int(document)
                done += packer.add((document, len(ids)), ids)
                if len(done) >= 256:
                    yield rows(number, done)
                    number, done = number + len(done), []
            yield rows(number, done)
            number += len(done)
        yield rows(number, list(packer.close()))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(run, SCHEMA)
