"""Scoring by a hierarchical Pitman-Yor language model.

The root restaurant seats words; every training word is a context with a restaurant of its own for the
words that follow it, one more is the start of a text, and all contexts share the root as their parent.

Seating is sampled by Gibbs, dish by dish. Given the tables of the others, the number of tables of a
dish with c customers has the probability S(c, t) x (parent probability)^t x prod (theta + d (T + i)),
with S the generalised Stirling number, and is drawn from it exactly for c up to ``EXACT``. Further
customers of the dish are seated after these by the restaurant's rule, in steps of a sixteenth of those
already seated. A pair (context, word) that occurs once has one table and is never drawn.

A round is one sweep: every dish is drawn once, beside the tables that all others had after the round
before. ``BURN_IN`` rounds are followed by ``SAMPLES`` rounds, whose predictive probabilities are averaged.

What is counted and drawn lies in packed rows, so that Spark moves few and small ones:

    blocks  the texts of about ``BLOCK`` words as numbers of the block's own vocabulary
    buckets of words by hash: their counts, their tables in the root, and of their own restaurants the
            sum of the tables; a word's id is its rank in its bucket, and names the bucket
    shards  of pairs by the hash of the context; a context with more than ``PART`` customers is dealt to
            several by its words. Only pairs that occur twice or more are kept and drawn

A block asks the buckets for its words and the shards for its pairs; in each round a shard tells the
buckets what its pairs saved (customers less tables, per word and per context) and is told the totals. So
a shard or block meets only words that occur in it, and only two numbers of the root pass through the
driver. There is a bucket and a shard for every ``SHARE`` bytes of text, so a task's part stays alike at
every size and messages stay large.

Defined results
    null or empty text  one token, the end
    null id             counted as the empty text for the split: training
    very long text      whole; a block of its own at most
    unknown word        the root's probability of an unseen word
    repeated rows       count and are scored each
    empty table         no rows; no training text: all words are unknown, N = V = 0
    extra columns       are never read; clashing names are not a problem
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import lower_words, staged

# No word is empty or holds a line feed or tab.
END, START = b"\n", b"\t"
BLOCK = 1 << 22
# Bytes of text for each bucket and shard.
SHARE = 1 << 24
# Customers of a context from which on its pairs are dealt to several shards.
PART = 1 << 20
EXACT = 64
DISCOUNT, STRENGTH = 0.75, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.75, 1.0
BURN_IN, SAMPLES = 3, 3


def is_held_out(id_col: str) -> Column:
    """Fixed value: the documents not learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


# --- Packed columns ---------------------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers from 0 on, of one length, byte plane by byte plane, compressed."""
    widths = [max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 1 for c in columns]
    planes = [np.asarray(c, "<u8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, w in zip(columns, widths, strict=True)]
    return struct.pack("<q", len(columns[0])) + bytes(widths) + pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    n, widths = struct.unpack_from("<q", data)[0], data[8 : 8 + columns]
    if n == 0:
        return [np.zeros(0, np.int64) for _ in range(columns)]
    planes = np.frombuffer(pa.decompress(data[8 + columns :], n * sum(widths), "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for w in widths:
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :w] = planes[at : at + n * w].reshape(w, n).T
        out.append(whole.view("<i8").ravel())
        at += n * w
    return out


def pack_pairs(context: np.ndarray, word: np.ndarray, *columns: np.ndarray) -> bytes:
    """Like ``pack``, of pairs sorted by context and word, which are written as differences."""
    step = np.diff(context, prepend=0)
    rise = np.diff(word, prepend=0)
    return pack(step, np.where(step == 0, rise, word), *columns)


def unpack_pairs(data: bytes, columns: int) -> list[np.ndarray]:
    step, rise, *rest = unpack(data, 2 + columns)
    first = np.flatnonzero(step)
    total = np.cumsum(rise)
    before = np.zeros(len(step), np.int64)
    if len(first):
        before[first] = np.diff(total[first] - rise[first], prepend=0)
    return [np.cumsum(step), total - np.cumsum(before), *rest]


def pack_words(words: list[bytes]) -> bytes:
    joined = b" ".join(words)
    return struct.pack("<q", len(joined)) + pa.compress(joined, "zstd", asbytes=True)


def unpack_words(data: bytes) -> list[bytes]:
    return pa.decompress(data[8:], struct.unpack_from("<q", data)[0], "zstd", asbytes=True).split(b" ")


def merged(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, with their sums."""
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    first = np.flatnonzero((np.diff(context, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0))
    return context[first], word[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


# --- Blocks -----------------------------------------------------------------------------------


class Block:
    """Documents as numbers of their own vocabulary."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {START: 0}
        self.ids: list = []
        self.held: list[bool] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, document, held: bool, text: str | None) -> None:
        words, number = lower_words(text), self.words
        words.append(END)
        for word in set(words).difference(number):
            number[word] = len(number)
        self.tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        self.ids.append(None if document is pd.NA else int(document))
        self.held.append(bool(held))
        self.size += len(words)

    def rows(self, block: int, buckets: int) -> Iterator[pd.DataFrame]:
        """The texts, with words numbered by falling frequency after the start, which is 0; then per bucket its
        words in that order, with their counts in training documents."""
        if not self.ids:
            return
        tokens, lengths = np.concatenate(self.tokens), np.array([len(t) for t in self.tokens])
        size = len(self.words)
        order = np.argsort(-np.bincount(tokens, minlength=size)[1:], kind="stable") + 1
        rank = np.zeros(size, np.int64)
        rank[order] = np.arange(1, size)
        tokens, learnt = rank[tokens], np.repeat(~np.array(self.held), lengths)
        counts = np.bincount(tokens[learnt], minlength=size)
        counts[0] = len(self.held) - sum(self.held)
        words = list(self.words)
        words = [words[i] for i in (0, *order)]
        home = np.array([zlib.crc32(w) % buckets for w in words])
        text = {"block": [block], "bucket": [-1], "ids": [self.ids], "held": [self.held], "lengths": [lengths]}
        yield pd.DataFrame(text | {"data": [pack(tokens)], "more": [pack(home)]})
        for bucket in np.unique(home):
            at = np.flatnonzero(home == bucket)
            own = {"block": [block], "bucket": [bucket], "ids": [None], "held": [None], "lengths": [None]}
            yield pd.DataFrame(own | {"data": [pack_words([words[i] for i in at])], "more": [pack(counts[at])]})


BLOCK_ROWS = "block long, bucket int, ids array<long>, held array<boolean>, lengths array<int>, data binary, more binary"


def blocks(
    docs: DataFrame, id_col: str, text_col: str, held: Column | None = None, buckets: int | None = None
) -> DataFrame:
    """Documents where ``held`` (by default ``is_held_out``) are scored, not learnt from. ``buckets`` of words are
    counted from the bytes of text, if not set."""
    held = is_held_out(id_col) if held is None else F.coalesce(held, F.lit(False))
    if buckets is None:
        buckets = (docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0) // SHARE + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for document, held, text in zip(batch["id"].astype("Int64"), batch["held"], batch["text"], strict=True):
                block.add(document, held, text)
                if block.size >= BLOCK:
                    yield from block.rows(number, buckets)
                    number, block = number + 1, Block()
        yield from block.rows(number, buckets)

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held.alias("held"), F.col(text_col).alias("text")
    )
    return staged(rows.mapInPandas(run, BLOCK_ROWS), "blocks")


def _texts(counted: DataFrame) -> DataFrame:
    return counted.where("bucket < 0").select(F.col("block").alias("home"), "ids", "held", "lengths", "data", "more")


# --- Words ------------------------------------------------------------------------------------

# A bucket's answers to blocks: ids from 1 on (0: not in a training text) and counts, in the order asked.
# Its own row (no block): the counts by rank, and where the start of a text stands among them, if it does.
WORDS = "bucket int, block long, data binary, start long, words long, tokens long"


def _numbered(counted: DataFrame, buckets: int) -> DataFrame:
    def run(messages: pd.DataFrame) -> pd.DataFrame:
        messages = messages.sort_values("block")
        bucket, number, asked = int(messages["bucket"].iloc[0]), {}, []
        for data in messages["data"]:
            words = unpack_words(data)
            asked.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        n = np.zeros(len(number), np.int64)
        for at, more in zip(asked, messages["more"], strict=True):
            n[at] += unpack(more, 1)[0]
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(n), np.int64)
        rank[order] = np.arange(len(n))
        ids = np.where(n > 0, rank * buckets + bucket + 1, 0)
        known = n[order][: int((n > 0).sum())]
        start = number.get(START, -1)
        start = int(rank[start]) if start >= 0 and n[start] else -1
        own = known if start < 0 else np.delete(known, start)
        answers = pd.DataFrame({"bucket": bucket, "block": pd.array(messages["block"], "Int64"), "data": [pack(ids[at], n[at]) for at in asked], "start": -1, "words": 0, "tokens": 0})
        state = {"bucket": [bucket], "block": pd.array([None], "Int64"), "data": [pack(known)], "start": [start], "words": [len(own)], "tokens": [int(own.sum())]}
        return pd.concat([pd.DataFrame(state), answers])

    return staged(counted.where("bucket >= 0").groupBy("bucket").applyInPandas(run, WORDS), "words")


# --- Pairs ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pairs:
    """The distinct pairs of a block in the order of their codes, the pair of each token, and which pairs go to
    which shard in what order."""

    ids: np.ndarray
    n: np.ndarray
    context: np.ndarray
    word: np.ndarray
    of: np.ndarray
    sent: np.ndarray
    shard: np.ndarray

    @classmethod
    def find(cls, text, answers: pd.DataFrame, shards: int, part: int) -> Pairs:
        (home,), (tokens,) = unpack(text.more, 1), unpack(text.data, 1)
        ids, n = np.zeros(len(home), np.int64), np.zeros(len(home), np.int64)
        for bucket, data in zip(answers["key"], answers["data"], strict=True):
            at = np.flatnonzero(home == bucket)
            ids[at], n[at] = unpack(data, 2)
        before = np.roll(tokens, 1)
        lengths = np.asarray(text.lengths, np.int64)
        before[np.cumsum(lengths) - lengths] = 0
        code, of = np.unique(before * len(home) + tokens, return_inverse=True)
        context, word = code // len(home), code % len(home)
        sent = np.flatnonzero((ids[context] > 0) & (ids[word] > 0))
        c, w = ids[context[sent]].astype(np.uint64), ids[word[sent]].astype(np.uint64)
        dealt = _mixed(w) % (n[context[sent]] // part + 1).astype(np.uint64)
        shard = (_mixed(c + _mixed(dealt)) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((w, c, shard))
        return cls(ids, n, context, word, of, sent[order], shard[order])

    def by_shard(self) -> Iterator[tuple[int, np.ndarray]]:
        for at in np.split(np.arange(len(self.sent)), np.flatnonzero(np.diff(self.shard)) + 1):
            if len(at):
                yield int(self.shard[at[0]]), self.sent[at]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over all 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


ANSWERS = "block long, kind int, key int, data binary"


def _word_answers(words: DataFrame) -> DataFrame:
    return words.where("block is not null").select("block", F.lit(0).alias("kind"), F.col("bucket").alias("key"), "data")


def _asked(counted: DataFrame, words: DataFrame, shards: int) -> DataFrame:
    """(``shard``, ``block``, ``data``): a block's pairs in a shard with their counts in training documents."""
    part = PART

    def run(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in texts.itertuples():
            pairs = Pairs.find(text, answers, shards, part)
            learnt = np.repeat(~np.asarray(text.held, bool), np.asarray(text.lengths))
            n = np.bincount(pairs.of[learnt], minlength=len(pairs.word))
            for shard, at in pairs.by_shard():
                data = pack_pairs(pairs.ids[pairs.context[at]], pairs.ids[pairs.word[at]], n[at])
                out.append((shard, text.home, data))
        return pd.DataFrame(out, columns=["shard", "block", "data"])

    found = _texts(counted).groupBy("home").cogroup(_word_answers(words).groupBy("block"))
    return staged(found.applyInPandas(run, "shard int, block long, data binary"), "pairs")


def _merged_shard(asks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of training documents in a shard, with their counts."""
    parts = []
    for data in asks["data"]:
        context, word, n = unpack_pairs(data, 1)
        parts.append((context[n > 0], word[n > 0], n[n > 0]))
    return merged(*[np.concatenate(x) for x in zip(*parts, strict=True)])


# --- Seating ----------------------------------------------------------------------------------


def stirling(limit: int, discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: row c, column t."""
    out = np.full((limit + 1, limit + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(limit + 1)
    with np.errstate(divide="ignore"):
        for c in range(limit):
            stay = out[c] + np.log(np.maximum(c - discount * t, 0.0))
            new = np.concatenate([[-np.inf], out[c, :-1]])
            out[c + 1] = np.logaddexp(stay, new)
    return out


class Restaurant:
    """Draws table numbers of dishes with discount d and strength theta."""

    def __init__(self, discount: float, strength: float) -> None:
        self.discount, self.strength = discount, strength
        self.arrangements = stirling(EXACT, discount)

    def draw(self, rng: np.random.Generator, c: np.ndarray, others: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Tables of dishes with ``c`` customers, ``others`` tables of other dishes in their restaurant,
        and ``parent`` probabilities."""
        tables = np.minimum(c, 1)
        first = np.minimum(c, EXACT)
        for size in np.unique(first[first > 1]):
            at = np.flatnonzero(first == size)
            count = np.arange(size)
            opened = np.log(self.strength + self.discount * (others[at, None] + count)).cumsum(axis=1)
            weight = self.arrangements[size, 1 : size + 1] + opened + (count + 1) * np.log(parent[at, None])
            tables[at] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
        at = np.flatnonzero(c > EXACT)
        seated = np.full(len(at), EXACT)
        while len(at):
            step = np.minimum(np.maximum(seated // 16, 1), c[at] - seated)
            new = (self.strength + self.discount * (others[at] + tables[at])) * parent[at]
            tables[at] += rng.binomial(step, new / (new + seated - self.discount * tables[at]))
            seated = seated + step
            more = seated < c[at]
            at, seated = at[more], seated[more]
        return tables


@dataclass(frozen=True)
class Root:
    """The root's customers and tables, and the number of words."""

    customers: int
    tables: int
    words: int

    def probability(self, customers, tables, gone=0):
        """Of words with so many customers and tables, ``gone`` customers having left."""
        rest = (ROOT_STRENGTH + ROOT_DISCOUNT * self.tables) / (self.words + 1)
        return (customers - ROOT_DISCOUNT * tables + rest) / (ROOT_STRENGTH + self.customers - gone)


# A shard's own row (no bucket): its pairs that occur twice or more, with their counts, their tables, and the
# sum of the tables over the samples. Its messages: ids, and what their pairs saved as words and as contexts.
SHARDS = "shard int, bucket int, data binary"
# A bucket's own row (no shard): by rank the counts and tables in the root, then of each sample the customers
# and tables in the root and the tables in the word's own restaurant. Its answers: counts and these three.
BUCKETS = "bucket int, shard int, data binary, start long, customers long, tables long"


def _shard_rows(shard: int, buckets: int, pairs: list[np.ndarray]) -> pd.DataFrame:
    context, word, n, tables, _ = pairs
    ids = np.union1d(context, word)
    saved = [np.bincount(np.searchsorted(ids, x), weights=n - tables, minlength=len(ids)).astype(np.int64) for x in (word, context)]
    rows = [(shard, None, pack_pairs(*pairs))]
    home = (ids - 1) % buckets
    for bucket in np.unique(home):
        at = home == bucket
        rows.append((shard, int(bucket), pack(np.diff(ids[at], prepend=0), saved[0][at], saved[1][at])))
    rows = pd.DataFrame(rows, columns=["shard", "bucket", "data"])
    return rows.assign(bucket=pd.array(rows["bucket"], "Int32"))


def _opened(asked: DataFrame, buckets: int) -> DataFrame:
    """Shards with one table per pair."""

    def run(asks: pd.DataFrame) -> pd.DataFrame:
        context, word, n = _merged_shard(asks)
        twice = n > 1
        one = np.ones(int(twice.sum()), np.int64)
        return _shard_rows(int(asks["shard"].iloc[0]), buckets, [context[twice], word[twice], n[twice], one, 0 * one])

    return staged(asked.groupBy("shard").applyInPandas(run, SHARDS), "seated")


def _told(own: DataFrame, shards: DataFrame, root: Root, buckets: int, samples: int, keep: bool, seed: int) -> DataFrame:
    """Buckets with the totals of what the shards saved, the root seated anew; and their answers to the shards.
    ``own``: (``bucket``, ``data``, ``start``), with ``samples`` samples so far; ``keep``: this is one."""

    def run(own: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        bucket, start = int(own["bucket"].iloc[0]), int(own["start"].iloc[0])
        n, old, *kept = unpack(own["data"].iloc[0], 2 + 3 * samples)
        messages = messages.sort_values("from")
        customers, tables, asked = n.copy(), n.copy(), []
        if start >= 0:
            customers[start] = 0
        for data in messages["saved"]:
            step, as_word, as_context = unpack(data, 3)
            at = (np.cumsum(step) - 1) // buckets
            customers[at] -= as_word
            tables[at] -= as_context
            asked.append(at)
        rng = np.random.default_rng([seed, bucket])
        base = np.full(len(n), 1 / (root.words + 1))
        drawn = Restaurant(ROOT_DISCOUNT, ROOT_STRENGTH).draw(rng, customers, np.maximum(root.tables - old, 0), base)
        new = [customers, drawn, tables]
        state = pack(n, drawn, *kept, *(new if keep else []))
        rows = [(None, state, start, int(customers.sum()), int(drawn.sum()))]
        rows += [(s, pack(n[at], *[x[at] for x in new]), -1, 0, 0) for s, at in zip(messages["from"], asked, strict=True)]
        rows = pd.DataFrame(rows, columns=["shard", "data", "start", "customers", "tables"])
        return rows.assign(bucket=bucket, shard=pd.array(rows["shard"], "Int32"))[["bucket", "shard", "data", "start", "customers", "tables"]]

    messages = shards.where("bucket is not null").select(F.col("bucket").alias("to"), F.col("shard").alias("from"), F.col("data").alias("saved"))
    return staged(own.groupBy("bucket").cogroup(messages.groupBy("to")).applyInPandas(run, BUCKETS), "told")


def _drawn(shards: DataFrame, told: DataFrame, root: Root, buckets: int, keep: bool, seed: int) -> DataFrame:
    """One sweep over all pairs that occur twice or more."""

    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        shard = int(own["shard"].iloc[0])
        context, word, n, t, summed = unpack_pairs(own["data"].iloc[0], 3)
        ids = np.union1d(context, word)
        totals = np.zeros((4, len(ids)), np.int64)
        for bucket, data in zip(answers["bucket"], answers["data"], strict=True):
            totals[:, (ids - 1) % buckets == bucket] = unpack(data, 4)
        _, customers, tables, _ = totals[:, np.searchsorted(ids, word)]
        others = totals[3, np.searchsorted(ids, context)] - t
        # The dish's own tables have left the root when it is drawn.
        rest = customers - t
        parent = root.probability(rest, np.minimum(tables, rest), t)
        rng = np.random.default_rng([seed, shard])
        t = Restaurant(DISCOUNT, STRENGTH).draw(rng, n, others, parent)
        return _shard_rows(shard, buckets, [context, word, n, t, summed + t if keep else summed])

    own = shards.where("bucket is null").select("shard", "data")
    answers = told.where("shard is not null").select(F.col("shard").alias("to"), "bucket", "data")
    return staged(own.groupBy("shard").cogroup(answers.groupBy("to")).applyInPandas(run, SHARDS), "seated")


def _root(told: DataFrame, words: int) -> Root:
    sums = told.where("shard is null").agg(F.sum("customers"), F.sum("tables")).first()
    return Root(sums[0] or 0, sums[1] or 0, words)


@dataclass(frozen=True)
class Model:
    """Words with ids, the buckets and shards after the last round, the root of each sample, V and N; and what
    was asked by the blocks that it was learnt from."""

    words: DataFrame
    told: DataFrame
    shards: DataFrame
    roots: tuple[Root, ...]
    size: int
    tokens: int
    buckets: int
    shard_count: int
    asked: DataFrame


def fit(counted: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES, shards: int | None = None, seed: int = 7) -> Model:
    """``counted``: the rows of ``blocks``. As many ``shards`` as buckets, if not set."""
    buckets = (counted.agg(F.max("bucket")).first()[0] or 0) + 1
    shards = shards or buckets
    words = _numbered(counted, buckets)
    size = words.agg(F.sum("words"), F.sum("tokens")).first()
    size, tokens = size[0] or 0, size[1] or 0
    asked = _asked(counted, words, shards)
    seated = _opened(asked, buckets)
    first = words.where("block is null").select("bucket", "start", "data")
    own = first.groupBy("bucket").applyInPandas(_with_tables, "bucket int, data binary, start long")
    root, roots = Root(0, size, size), []
    for sweep in range(burn_in + samples + 1):
        # What the shards drew in the last sweep, and with it the root, is a sample from ``burn_in`` on.
        told = _told(own, seated, root, buckets, len(roots), sweep > burn_in, seed + 2 * sweep)
        root = _root(told, size)
        own = told.where("shard is null").select("bucket", "data", "start")
        if sweep > burn_in:
            roots.append(root)
        if sweep < burn_in + samples:
            seated = _drawn(seated, told, root, buckets, sweep >= burn_in, seed + 2 * sweep + 1)
    return Model(words, told, seated, tuple(roots), size, tokens, buckets, shards, asked)


def _with_tables(own: pd.DataFrame) -> pd.DataFrame:
    """One table in the root per word."""
    (n,) = unpack(own["data"].iloc[0], 1)
    one = np.ones(len(n), np.int64)
    start = int(own["start"].iloc[0])
    if start >= 0:
        one[start] = 0
    return own.assign(data=[pack(n, one)])[["bucket", "data", "start"]]


# --- Scores -----------------------------------------------------------------------------------

SCORES = (
    "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _totals(model: Model) -> DataFrame:
    """The buckets' answers to the blocks: of each sample a word's customers and tables in the root and the
    tables in its own restaurant."""
    samples, buckets = len(model.roots), model.buckets

    def run(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        _, _, *kept = unpack(own["data"].iloc[0], 2 + 3 * samples)
        for block, bucket, data in zip(asks["block"], asks["key"], asks["data"], strict=True):
            ids, _ = unpack(data, 2)
            at = (ids[ids > 0] - 1) // buckets
            out.append((block, 1, bucket, pack(*[x[at] for x in kept])))
        return pd.DataFrame(out, columns=["block", "kind", "key", "data"])

    own = model.told.where("shard is null").select("bucket", "data")
    return own.groupBy("bucket").cogroup(_word_answers(model.words).groupBy("key")).applyInPandas(run, ANSWERS)


def _seats(model: Model) -> DataFrame:
    """The shards' answers to the blocks: customers of the pairs, and their tables summed over the samples."""
    samples = len(model.roots)

    def run(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        context, word, n = _merged_shard(asks)
        summed = np.full(len(n), samples)
        summed[n > 1] = unpack_pairs(own["data"].iloc[0], 3)[4]
        places, out = Places(context, word), []
        for block, shard, data in zip(asks["block"], asks["shard"], asks["data"], strict=True):
            c, w, _ = unpack_pairs(data, 1)
            found, at = places.of(c, w)
            answer = np.zeros((2, len(c)), np.int64)
            answer[:, found] = n[at], summed[at]
            out.append((block, 2, shard, pack(*answer)))
        return pd.DataFrame(out, columns=["block", "kind", "key", "data"])

    own = model.shards.where("bucket is null").select(F.col("shard").alias("own"), "data")
    return own.groupBy("own").cogroup(model.asked.groupBy("shard")).applyInPandas(run, ANSWERS)


class Places:
    """Finds pairs among sorted distinct ones."""

    def __init__(self, context: np.ndarray, word: np.ndarray) -> None:
        self.contexts, self.top = np.unique(context), int(word.max(initial=0)) + 1
        self.keys = np.searchsorted(self.contexts, context) * self.top + word

    def of(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are among them, and where those are."""
        if not len(self.keys):
            return np.zeros(len(word), bool), np.zeros(0, np.int64)
        row = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        key = row * self.top + word
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.contexts[row] == context) & (word < self.top) & (self.keys[at] == key)
        return found, at[found]


def score(model: Model, counted: DataFrame) -> DataFrame:
    """Per document of the blocks that ``model`` was learnt from its token counts, its base score and its log10
    probability: of each token, the mean of the samples' predictive probabilities."""
    roots, tokens, size, shards, part = model.roots, model.tokens, model.size, model.shard_count, PART
    answers = _word_answers(model.words).unionByName(_totals(model)).unionByName(_seats(model))

    def run(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in texts.itertuples():
            kinds = {k: answers[answers["kind"] == k] for k in range(3)}
            pairs = Pairs.find(text, kinds[0], shards, part)
            (home,), (stream,) = unpack(text.more, 1), unpack(text.data, 1)
            totals = np.zeros((3 * len(roots), len(home)), np.int64)
            for bucket, data in zip(kinds[1]["key"], kinds[1]["data"], strict=True):
                totals[:, (home == bucket) & (pairs.ids > 0)] = unpack(data, 3 * len(roots))
            n, summed = np.zeros(len(pairs.word), np.int64), np.zeros(len(pairs.word), np.int64)
            seats = dict(zip(kinds[2]["key"], kinds[2]["data"], strict=True))
            for shard, at in pairs.by_shard():
                n[at], summed[at] = unpack(seats[shard], 2)
            customers = pairs.n[pairs.context]
            chance = (n - DISCOUNT * summed / len(roots)) / (STRENGTH + customers)
            for root, (eaten, seated, own) in zip(roots, totals.reshape(len(roots), 3, -1), strict=True):
                backoff = (STRENGTH + DISCOUNT * own) / (STRENGTH + pairs.n)
                chance += backoff[pairs.context] * root.probability(eaten, seated)[pairs.word] / len(roots)
            base = np.log10((pairs.n + 1) / (tokens + size + 1))
            lengths = np.asarray(text.lengths, np.int64)
            starts = np.cumsum(lengths) - lengths
            out.append(
                pd.DataFrame(
                    {
                        "id": pd.array([None if x is None or x != x else int(x) for x in text.ids], "Int64"),
                        "held_out": text.held,
                        "n_tokens": lengths,
                        "n_known": np.add.reduceat((pairs.n[stream] > 0).astype(np.int64), starts),
                        "train_tokens": tokens,
                        "base_score": np.add.reduceat(base[stream], starts),
                        "score": np.add.reduceat(np.log10(chance)[pairs.of], starts),
                    }
                )
            )
        return pd.concat(out)

    return _texts(counted).groupBy("home").cogroup(answers.groupBy("block")).applyInPandas(run, SCORES)
