"""Top-k search, prefix trie and token alignment against plain versions, also on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import SCHEMA, odd_rows
from tradeloom.llm import inner_products, prefix_trie, token_alignment
from tradeloom.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, id long, parts string, score int, block long"


def plain_top_k(rows, k=5):
    """Sorted (query, rank, id, score) rows."""
    vectors = []
    for key, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            vectors.append((key, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for key, vector in vectors:
        if key is not None and key % 50 == 0:
            scores = [
                (-min(sum(map(lambda x, y: x * y, vector, other)), np.iinfo(np.int64).max), i is None, i or 0, i)
                for i, other in vectors
                if i != key and len(other) == len(vector)
            ]
            out += [(key, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def top_k(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, "p", 2, 3) for i, v in rows], VECTORS)
    return sorted(map(tuple, inner_products.top_k(frame, F.col("id") % 50 == 0).collect()), key=str)


def test_top_k_on_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(1, 40)]
    rows += [(50, rows[3][1]), (100, [0.0] * 6), (100, [0.0] * 6), (150, None), (200, [1.0, None]), (250, [math.nan] * 6)]
    rows += [(300, [math.inf] * 6), (None, [0.5] * 6), (350, [1.0, 2.0]), (351, [3.0, 4.0]), (400, []), (401, [])]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (450, [3e14] * 6), (451, [3e12] * 6)]
    assert top_k(spark, rows) == plain_top_k(rows)
    assert top_k(spark, []) == []


def test_top_k_over_many_small_blocks(spark, monkeypatch):
    """Pairs of blocks are left out and bounds rule vectors out; the result is as without."""
    monkeypatch.setattr(inner_products, "BLOCK_SIZE", 64 * 16)
    monkeypatch.setattr(inner_products, "CHUNK", 8)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(4, 12))
    rows = [(i, (base[i % 4] * rng.random() + rng.normal(size=12) * 0.02).tolist()) for i in range(600)]
    assert top_k(spark, rows) == plain_top_k(rows)


def test_bounds_rule_out_most_vectors(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(size=(2000, 16)) * np.geomspace(100, 1, 16))
    norms = np.sqrt((vectors**2).sum(axis=1))
    order = np.argsort(-norms)
    block = inner_products.Block(np.arange(2000), np.ones(2000, bool), vectors[order], norms[order])
    queries = inner_products.Block(np.arange(9000, 9020), np.ones(20, bool), vectors[:20], norms[:20])
    directions = np.linalg.svd(vectors)[2].T
    multiplied = []
    exact = inner_products.exact_products
    monkeypatch.setattr(inner_products, "exact_products", lambda a, b: (multiplied.append(len(a)), exact(a, b))[1])
    rows, places, scores = inner_products.search(queries, block, np.full(20, -np.inf), 5, (directions, 3))
    products = (queries.parts @ block.parts.T).astype(np.int64)
    assert (scores.reshape(20, 5) == -np.sort(-products, axis=1)[:, :5]).all()
    assert (products[rows, places] == scores).all()
    assert sum(multiplied) < 20 * 2000 / 3


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth long, family long, lo long"


def plain_trie(rows, key="crc"):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(int(c - math.fmod(c, 5)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, own in rebuilt.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(node))
        out.append(
            (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]), leaves[node],
             saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def trie(spark, rows, **sizes):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATIONS)
    ordered = prefix_trie.turns_in_order(frame)
    conv = F.col("conv_id")
    paths, convs = prefix_trie.branched(ordered, F.crc32(conv.cast("string")) % 9, conv - conv % 5, most=8)
    return sorted(map(tuple, prefix_trie.nodes(paths, convs, **sizes).collect()), key=str)


def odd_conversations():
    rng = random.Random(1)
    rows = []
    for c in range(-12, 60):
        for turn in range(rng.choice([1, 2, 3, 9, 14])):
            text = rng.choice(["same", "sämе", None, "", f"own {c}"]) if turn else "hello"
            rows.append((c, None if rng.random() < 0.05 else turn, rng.choice(["user", "assistant", None]), text))
    rows += [(7, 3, "user", "tie"), (7, 3, "user", "tie"), (7, 3, "assistant", "tie"), (None, 1, "user", "x")]
    rows += [(100 + c, t, "user", f"{t % 3}") for c in range(40) for t in range(11)]
    return rows + [(61, t, "u", "x" * 20_000 if t == 1 else str(t)) for t in range(60)]


@pytest.mark.parametrize("sizes", [{}, {"piece": 3, "shard_rows": 40}], ids=["whole", "pieces"])
def test_trie(spark, sizes):
    rows = odd_conversations()
    assert trie(spark, rows, **sizes) == plain_trie(rows)


def test_trie_of_one_conversation_and_of_none(spark):
    rows = [(5, t, "u", "a") for t in range(300)]
    assert trie(spark, rows, piece=7, shard_rows=20) == plain_trie(rows)
    assert trie(spark, []) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    assert trie(spark, [(alone, 0, "u", "gone")]) == plain_trie([(alone, 0, "u", "gone")])


def test_running_sums_of_a_key_over_many_tasks(spark):
    rows = spark.range(4000).selectExpr("IF(id % 4 = 0, id % 3, 9) AS key", "id AS at", "id * id AS v")
    got = {(r.key, r["at"]): (r.place, r.total) for r in prefix_trie.running(rows, "key", ["at"], {"total": "v"}, ["at"]).collect()}
    place, total = Counter(), Counter()
    for at in range(4000):
        key = at % 3 if at % 4 == 0 else 9
        place[key] += 1
        total[key] += at * at
        assert got[key, at] == (place[key], total[key])


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 3)), max_size=200))
@settings(max_examples=50, deadline=None)
def test_slots_are_minimal_and_perfect(keys):
    lo, hi = (np.array([k[n] for k in keys], np.int64) for n in (0, 1))
    table = prefix_trie.SlotTable(lo, hi)
    assert len(table) == len(set(keys)) and sorted(set(table.slots.tolist())) == list(range(len(table)))
    assert [(table.lo[s], table.hi[s]) for s in table.slots] == keys
    assert (table.find(lo, hi) == table.slots).all()
    assert (table.find(lo + 31, hi) == -1).all()


PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


class Plain:
    """Whole texts through both tokenizers; groups by sets of ends, links by comparing all ranges."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        self.a.encode_special_tokens = True
        self.names = {i: t for t, i in self.a.get_vocab().items()}
        self.letters = token_alignment.byte_alphabet()

    def tokens(self, text):
        a = [(i, bytes(self.letters[c] for c in self.names[i])) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            name = self.b.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    @staticmethod
    def spans(tokens):
        out, at = [], 0
        for i, x in tokens:
            out.append((at, at + len(x), i))
            at += len(x)
        return out

    def document(self, text):
        a, b = map(self.spans, self.tokens(text or ""))
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, low = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in (a, b)] if len(cuts) < 400 else None
            groups.append("|".join(sides) if sides else None)
            low = cut
        if len(cuts) >= 400:
            groups = self.long_groups(a, b, set(cuts))
        links = Counter()
        j = 0
        for s, e, i in a:
            while j < len(b) and b[j][1] <= s:
                j += 1
            n = j
            while n < len(b) and b[n][0] < e:
                links[i, b[n][2]] += 1
                n += 1
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        return len(a), len(b), len(cuts), links, digest

    @staticmethod
    def long_groups(a, b, cuts):
        out, sides = [], [iter(a), iter(b)]
        for _ in sorted(cuts):
            cut = []
            for side in sides:
                own = []
                for _, e, i in side:
                    own.append(str(i))
                    if e in cuts:
                        break
                cut.append(",".join(own))
            out.append("|".join(cut))
        return out

    def corpus(self, texts):
        found = [self.document(t) for t in texts]
        count = Counter(pair for f in found for pair in f[3])
        most = Counter()
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        return [
            (n_a, n_b, n_groups, sum(links.values()), digest, sum(n for p, n in links.items() if count[p] == most[p[0]]),
             sum(n * count[p] for p, n in links.items()))
            for n_a, n_b, n_groups, links, digest in found
        ]


def test_alignment_of_whole_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    name = next(n for n in QUERIES if n.startswith("op13_"))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES[name](spark, sf_dir).collect()}
    assert got == dict(zip(texts, Plain().corpus(texts.values()), strict=True))


ODD_TEXTS = ["  two  spaces ", " ", "   ", "tab\tand\nline\n next", "trailing ", "a▁b", "<s> <0x41> <|endoftext|>", "nul\0byte",
             " x　y \x1c z\x85 w", "東京 タワー", "ﬁ ſ İ é \U0001f600", "\n \n  \n", "'s we'll don't 12 345", "x" * 3000, "-" * 500]


def test_alignment_of_odd_rows_and_texts(spark):
    rows = odd_rows() + [(50 + n, t, *odd_rows()[0][2:]) for n, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in token_alignment.align(docs, *PATHS).collect())
    want = Plain().corpus([r[1] for r in rows])
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, want, strict=True))
    assert token_alignment.align(docs.where(F.lit(False)), *PATHS).count() == 0


@given(st.lists(st.text(st.sampled_from("ab \n\t.é '1　 "), max_size=30), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_tokens_of_whole_texts(texts):
    aligner, plain = ALIGNER, PLAIN
    for text, found in zip(texts, aligner.align(texts), strict=True):
        n_a, n_b, n_groups, links, digest = plain.document(text)
        assert found[:5] == (n_a, n_b, n_groups, sum(links.values()), digest)
        assert dict(zip(found[5].tolist(), found[6].tolist(), strict=True)) == {(a << 32) + b: n for (a, b), n in links.items()}


ALIGNER, PLAIN = token_alignment.Aligner(*PATHS, remembered=50), Plain()


@given(st.sets(st.integers(1, 60), min_size=1), st.sets(st.integers(1, 60), min_size=1))
@settings(max_examples=200, deadline=None)
def test_galloping_ranges(a, b):
    ends = [sorted(x | {61}) for x in (a, b)]
    short, long = (np.array(x) for x in sorted(ends, key=len))
    low, high, both = token_alignment.overlaps(short, long, np.zeros(len(short), np.int64))
    assert short[both].tolist() == sorted(set(short.tolist()) & set(long.tolist())) == long[high[both]].tolist()
    for i, end in enumerate(short):
        start = short[i - 1] if i else 0
        assert [j for j in range(len(long)) if (long[j - 1] if j else 0) < end and long[j] > start] == list(range(low[i], high[i] + 1))
