"""The language model beside a plain one that reads the seating of every sample."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import WORD, lower
from tradeloom.llm import lm


def ids_of(model, counted):
    """Word to id."""
    asked = {(r.block, r.bucket): lm.unpack_words(bytes(r.data)) for r in counted.where("bucket >= 0").collect()}
    out = {}
    for r in model.words.where("block is not null").collect():
        out |= dict(zip(asked[r.block, r.bucket], lm.unpack(bytes(r.data), 2)[0].tolist(), strict=True))
    return {w: i for w, i in out.items() if i}


def seating(model):
    """Per id its count, and per sample its customers and tables in the root and the tables of its own restaurant;
    per pair that occurs twice or more its customers, and its tables summed over the samples."""
    samples, words, pairs = len(model.roots), {}, {}
    for r in model.told.where("shard is null").collect():
        columns = lm.unpack(bytes(r.data), 2 + 3 * samples)
        for rank, row in enumerate(zip(*[c.tolist() for c in columns], strict=True)):
            words[rank * model.buckets + r.bucket + 1] = row[0], np.array(row[2:]).reshape(samples, 3)
    for r in model.shards.where("bucket is null").collect():
        for context, word, n, _, summed in zip(*lm.unpack_pairs(bytes(r.data), 3), strict=True):
            pairs[int(context), int(word)] = int(n), int(summed)
    return words, pairs


class Plain:
    """The model's probabilities, pair by pair, from counts of the texts and the seating."""

    def __init__(self, docs, spark, **options):
        counted = lm.blocks(docs, "doc_id", "text", F.col("held"), buckets=5)
        self.model = lm.fit(counted, **options)
        self.scores = {r.id: r for r in lm.score(self.model, counted).collect()}
        self.ids = ids_of(self.model, counted)
        self.words, self.kept = seating(self.model)
        self.counts = Counter()
        for r in docs.collect():
            if not r.held:
                self.counts.update(self.pairs(r.text))

    @staticmethod
    def pairs(text):
        words = [lm.START, *[w.encode() for w in WORD(lower(text or ""))], lm.END]
        return list(zip(words, words[1:], strict=False))

    def chance(self, context, word):
        samples, c, w = len(self.model.roots), self.ids.get(context), self.ids.get(word)
        n = self.counts[context, word]
        summed = self.kept[c, w][1] if n > 1 else n * samples
        customers = self.words[c][0] if c else 0
        out = (n - lm.DISCOUNT * summed / samples) / (lm.STRENGTH + customers)
        for s, root in enumerate(self.model.roots):
            tables = self.words[c][1][s][2] if c else 0
            eaten, own = self.words[w][1][s][:2] if w else (0, 0)
            back = (lm.STRENGTH + lm.DISCOUNT * tables) / (lm.STRENGTH + customers)
            rest = (lm.ROOT_STRENGTH + lm.ROOT_DISCOUNT * root.tables) / (root.words + 1)
            out += back * (eaten - lm.ROOT_DISCOUNT * own + rest) / (lm.ROOT_STRENGTH + root.customers) / samples
        return out


TEXTS = ["the cat sat on the mat", "the cat sat", None, "", "The dog sat on the log \n the cat", "a b a b a b a b a"] * 3
TEXTS += [f"rare{i} tail{i} the cat" for i in range(20)]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(i, t, i % 5 == 4) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    return Plain(docs, spark)


def test_scores_equal_the_plain_mean_of_the_samples(plain):
    for i, text in enumerate(TEXTS):
        want = sum(math.log10(plain.chance(*p)) for p in plain.pairs(text))
        assert plain.scores[i].score == pytest.approx(want)


def test_probabilities_after_every_context_sum_to_one(plain):
    menu = [w for w in plain.ids if w != lm.START]
    assert len(menu) == plain.model.size
    for context in plain.ids:
        if context != lm.END:
            assert sum(plain.chance(context, w) for w in [*menu, b"never"]) == pytest.approx(1)


def test_customers_of_the_root_are_the_tables_of_the_pairs(plain):
    """Of each sample the restaurants' tables and the root's customers are the same tables."""
    customers, contexts = Counter(), Counter()
    for context, _ in plain.counts.elements():
        contexts[context] += 1
    for (context, word), n in plain.counts.items():
        c, w = plain.ids[context], plain.ids[word]
        customers[w] += plain.kept[c, w][1] if n > 1 else n * len(plain.model.roots)
    for word, i in plain.ids.items():
        n, samples = plain.words[i]
        assert samples[:, 0].sum() == customers[i]
        if word != lm.END:
            assert n == contexts[word]
    for s, root in enumerate(plain.model.roots):
        assert sum(x[s][2] for w, i in plain.ids.items() if w != lm.END for x in [plain.words[i][1]]) == root.customers


def test_rare_words_have_restaurants(plain):
    """A word that always follows a rare one is likelier there."""
    known = [i for i in range(20) if f"rare{i}".encode() in plain.ids]
    one, other = known[:2]
    assert plain.chance(f"rare{one}".encode(), f"tail{one}".encode()) > 10 * plain.chance(f"rare{one}".encode(), f"tail{other}".encode())


def test_context_dealt_to_several_shards(spark, monkeypatch):
    """Where a context's pairs lie changes its scores by sampling only."""
    docs = spark.createDataFrame([(i, f"x a{i % 90} x b{i % 70} x", i % 9 == 0) for i in range(400)], "doc_id long, text string, held boolean")
    means = []
    for part in (1 << 20, 50):
        monkeypatch.setattr(lm, "PART", part)
        model = Plain(docs, spark, shards=7)
        x = model.ids[b"x"]
        own = [{c for c, _ in zip(*lm.unpack_pairs(bytes(r.data), 3)[:2], strict=True)} for r in model.model.shards.where("bucket is null").collect()]
        assert (sum(x in c for c in own) > 1) == (part == 50)
        for r in docs.limit(5).collect():
            assert model.scores[r.doc_id].score == pytest.approx(sum(math.log10(model.chance(*p)) for p in model.pairs(r.text)))
        means.append(sum(s.score for s in model.scores.values()) / 400)
    assert means[0] == pytest.approx(means[1], rel=0.03)


def test_packed_columns_come_back():
    rng = np.random.default_rng(3)
    context, word, n = lm.merged(rng.integers(1, 50, 900), rng.integers(1, 1 << 40, 900), np.ones(900, np.int64))
    back = lm.unpack_pairs(lm.pack_pairs(context, word, n), 1)
    assert all((a == b).all() for a, b in zip(back, (context, word, n), strict=True))
    empty = np.zeros(0, np.int64)
    assert [len(x) for x in lm.unpack_pairs(lm.pack_pairs(empty, empty), 0)] == [0, 0]
    found, at = lm.Places(context, word).of(np.r_[context[::7], 51, 7], np.r_[word[::7], 1, 0])
    assert found[:-2].all() and not found[-2:].any() and (at == np.arange(0, 900, 7)).all()
