"""Operators against plain versions on whole small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import WORD, lower
from tradeloom.llm import exact_dedup, line_dedup, lm, mixing, near_dedup, packing, quality, secret_scan, toxicity, url_filter
from tradeloom.llm.common import text_digest
from tradeloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def rows(spark, sf_dir, prefix):
    name = next(n for n in QUERIES if n.startswith(prefix))
    return QUERIES[name](spark, sf_dir).collect()


def test_lm_counts_and_held_out_perplexity(spark, sf_dir, texts):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    tokens = {i: [*WORD(lower(t)), None] for i, t in texts.items()}
    counts = Counter(w for i in texts if not held[i] for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    total, base = defaultdict(float), defaultdict(float)
    for r in rows(spark, sf_dir, "op2_"):
        own = tokens[r.doc_id]
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert r.base_score == pytest.approx(want)
        total[r.held_out] += r.score
        base[r.held_out] += r.base_score
    assert total[True] > base[True] and total[False] > base[False]


def test_table_numbers_follow_the_conditional():
    """Three customers of one dish: the three table numbers by their exact weights."""
    place, rng = lm.Restaurant(0.5, 1.0), np.random.default_rng(1)
    drawn = place.draw(rng, np.full(40_000, 3), np.zeros(40_000), np.full(40_000, 0.3))
    weight = np.array([0.75, 1.5, 1.0]) * 0.3 ** np.arange(1, 4) * np.array([1, 1 * 1.5, 1 * 1.5 * 2])
    assert np.bincount(drawn, minlength=4)[1:] / 40_000 == pytest.approx(weight / weight.sum(), abs=0.01)
    many = place.draw(rng, np.full(200, 100_000), np.zeros(200), np.full(200, 0.01))
    assert many.min() >= 1 and many.max() < 100_000


def test_exact_dedup_against_an_index_of_earlier_batches(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    first = spark.createDataFrame([(5, "a"), (9, "a"), (3, None)], "doc_id long, text string")
    later = spark.createDataFrame([(20, "a"), (21, "b"), (22, "")], "doc_id long, text string")
    assert [r.doc_id for r in exact_dedup.dedup(first, index).orderBy("doc_id").collect()] == [3, 9]
    plan = index.missing(later.select(text_digest().alias("digest")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    decided = {r.id: (r.keep_id, r.kept) for r in exact_dedup.decide(later, again).collect()}
    assert decided == {20: (9, False), 21: (21, True), 22: (3, False)}
    index.append(spark.createDataFrame([(hashlib.sha256(b"b").digest(), 1)], "digest binary, keep_id long"))
    assert again.read().count() == 3


def plain_quality(text):
    words = WORD(text)
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_counts(spark, sf_dir, texts):
    for r in rows(spark, sf_dir, "op4_"):
        want = plain_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_cutoffs_hold_their_risk(spark):
    """A rule that parts good from bad is used, its bound holds, and one that does not stays off."""
    rng = np.random.default_rng(3)
    good, bad = 20_000, 2_000
    stats = [(i, "en", 60, 300, 0, 0, 0, float(rng.random()), 0.0, 0.0, float(rng.random()), 0.0, 0.0) for i in range(good)]
    stats += [(good + i, "en", 60, 300, 0, 0, 0, 0.9 + float(rng.random()), 0.0, 0.0, float(rng.random()), 0.0, 0.0) for i in range(bad)]
    frame = spark.createDataFrame(stats, f"id long, stratum string, {quality.STATISTICS}")
    labels = spark.range(good + bad).selectExpr("id AS doc_id", f"IF(id < {good}, 1, 0) AS quality")
    cutoffs = quality.fit(frame, labels)
    assert 0.9 < cutoffs["en"]["symbols"] <= 1.0 and "dup_lines" not in cutoffs["en"]
    judged = quality.judge(frame, cutoffs)
    lost = judged.where(f"id < {good} and size(failed) > 0").count() / good
    caught = judged.where(f"id >= {good} and array_contains(failed, 'symbols')").count() / bad
    assert lost <= quality.RISK and caught > 0.85


def test_binomial_tail():
    want = sum(math.comb(50, i) * 0.1**i * 0.9 ** (50 - i) for i in range(4))
    assert quality.binomial_below(3, 50, 0.1) == pytest.approx(want)
    assert quality.binomial_below(0, 0, 0.1) == 1.0


PATTERNS = [
    ("assign", re.compile(secret_scan.ASSIGN, re.A)),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def plain_spans(text):
    least = {"access": 20, "hex": 24}
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= least[kind]:
                found.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def test_secrets(spark, sf_dir, texts):
    for r in rows(spark, sf_dir, "op5_"):
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_random_strings_are_found_and_identifiers_are_not(spark):
    rng = np.random.default_rng(5)
    symbols = np.array(list(secret_scan.SYMBOLS[:62]))
    keys = ["".join(rng.choice(symbols, 32)) for _ in range(300)]
    parts = "get set user name index count parse table read write total session value handler".split()
    names = ["".join(p.title() for p in rng.choice(parts, 5)) for _ in range(600)]
    samples = [(1, k) for k in keys[:200]] + [(0, n) for n in names[:400]]
    table = secret_scan.fit(spark.createDataFrame(samples, "label int, sample string"))
    texts = [(i, f"é use {k} here") for i, k in enumerate(keys[200:])] + [(1000 + i, f"call {n} now") for i, n in enumerate(names[400:])]
    found = secret_scan.find(spark.createDataFrame(texts, "doc_id long, text string"), table)
    got = {r.id: r.spans for r in found.select("id", secret_scan.written("spans").alias("spans")).collect()}
    assert sum(got[i] == "random:6:38" for i in range(100)) >= 95
    assert sum(got[1000 + i] != "" for i in range(200)) <= 2
    odd = spark.createDataFrame([(1, "secret=token: abcdefgh AKIA" + "A" * 16 + " API_KEY: 'abcdef'" + "0" * 24)], "doc_id long, text string")
    base = secret_scan.find(odd, table).select(secret_scan.written("base").alias("b")).first().b
    assert base == plain_spans(odd.first().text)


def test_urls_against_a_loop(spark):
    rng = np.random.default_rng(9)
    labels, paths = ["a", "b", "com", "net"], ["/", "/x/", "/x/y", "/z", ""]
    hosts = [".".join(rng.choice(labels, rng.integers(1, 5))) for _ in range(400)]
    urls = [(i, f"https://{h}{rng.choice(paths)}{rng.choice(['', '?q', '#f'])}") for i, h in enumerate(hosts)]
    urls += [(1000 + i, "https://hot.com/x/y") for i in range(800)]
    rules = list({(".".join(rng.choice(labels, rng.integers(1, 4))), str(rng.choice(paths[:4]))): str(rng.choice(["allow", "block"])) for _ in range(60)}.items())
    frame = spark.createDataFrame([(h, p, v) for (h, p), v in rules], "host string, path string, verdict string")
    got = {r.id: (r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), frame).collect()}
    for i, url in urls:
        host, path = re.match(r"https://([^/?#]*)([^?#]*)", url).groups()
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (max(fits)[2:] if fits else (None, "allow")), url


def test_toxicity_on_held_out_documents(spark):
    """Planted insults among made-up words: toxic documents are caught, clean ones left alone."""
    rng = np.random.default_rng(8)
    common = ["w" + "".join(chr(97 + x) for x in rng.integers(0, 26, 5)) for _ in range(400)]
    insults = ["fool", "dolt", "oaf", "dunce"]
    rows, marks = [], []
    for i in range(3_000):
        toxic = int(rng.random() < 0.15)
        words = list(rng.choice(common, 60)) + list(rng.choice(insults, 3 * toxic))
        rows.append((i, " ".join(rng.permutation(words)).title()))
        marks.append((i, int(rng.random() < 0.8), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels.where("doc_id < 1500"))
    got = {r.id: r for r in toxicity.judge(docs, model).where("id >= 1500").collect()}
    truth = {i: t for i, _, t in marks if i >= 1500}
    assert sum(got[i].toxic and not t for i, t in truth.items()) == 0
    assert sum(got[i].toxic and t for i, t in truth.items()) >= 0.97 * sum(truth.values())
    assert all(0 <= r.toxic_probability <= r.severity <= 3 for r in got.values())


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 3, 600)
    found = [np.flatnonzero(rng.random(4) < [0.5, 0.5, 0.1 + 0.4 * g, 0.9 - 0.4 * g]) for g in grades]
    weights, limits = toxicity.fit_ordinal(found, grades, 4)
    assert weights[2] > 0.5 > -0.5 > weights[3] and abs(weights[0]) < 0.5 and limits[0] < limits[1]


def plain_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = WORD(lower(t))
        sets[i] = {tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = Counter((a, b) for ids in where.values() for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    return {i: top(i) for i in texts}


@pytest.mark.parametrize(("width", "percent"), [(5, 80), (3, 85)])
def test_near_copies(spark, sf_dir, texts, width, percent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.id: r.component for r in near_dedup.decide(docs, width, percent).collect()}
    assert got == plain_components(texts, width, percent)


def test_large_bucket_of_unlike_documents_is_settled(spark):
    """Many texts share a long passage without being near copies; a few pairs among them are."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, 6))
    passage = [word() for _ in range(60)]
    texts = {i: " ".join(passage + [word() for _ in range(25)]) for i in range(300)}
    for i in range(40):
        texts[1000 + i] = texts[i] + " " + word()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: r.component for r in near_dedup.decide(docs, 3, 85).collect()}
    assert got == plain_components(texts, 3, 85)


def test_min_max_signature_estimates_similarity():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    agree = np.mean(near_dedup.min_max(a, 512) == near_dedup.min_max(b, 512))
    assert agree == pytest.approx(1 / 3, abs=0.06)


def test_line_templates(spark):
    shared = [f"Posted on 2024-01-{i:02d} by user{i} in the daily news section of the site" for i in range(1, 9)]
    texts = [(i, f"{shared[i]}\nThis text number {'abcdefgh'[i]} says only what nobody else has to say {'xyzuvwrs'[i]}\nok") for i in range(8)]
    texts += [(100 + i, texts[0][1]) for i in range(20)]
    texts += [(200 + i, "copied whole many times over\nand never found elsewhere at all") for i in range(9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.id: r for r in line_dedup.dedup(docs).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        lines = text.split("\n")
        want = lines[1:] if i < 200 else lines
        if i < 200:
            assert got[i].n_dropped >= 1 and lines[0] not in got[i].text and got[i].text.endswith("ok")
        else:
            assert got[i].text.split("\n") == want


def test_packing_round_trip(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, sf_dir, "op10_"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in texts.items():
        ids, at = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4"), 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    used = padded = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        used, padded = used + at, padded + packing.padded_length(at, 4096)
    assert used / padded > 0.98


def test_encoder_equals_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    for text in ["It's 12 o'clock, isn't it?", "Grüße, ÄÖÜ ß × ÷ ñ\xa0x", "İstanbul", "東京 ok", "a<|endoftext|>b", "\x1c x\x85y", "ΟΔΟΣ", "e\u0301", "½²ª", "x" * 3000]:
        assert list(encoder(text)) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_sum_of_squares_rule_and_drain():
    packer = packing.Packer(10, 3)
    done = []
    sizes = [6, 6, 6, 4, 7, 25, 3, 2, 2, 9, 1]
    for i, n in enumerate(sizes):
        if packer.counts.sum() and n < 10:
            change = {}
            for level in range(0, 10 - n + 1):
                if level == 0 or packer.counts[level]:
                    after = packer.counts.copy()
                    if level:
                        after[level] -= 1
                    if level + n < 10:
                        after[level + n] += 1
                    change[level] = (int((after**2).sum()), -level)
            assert packer.level_for(n) == min(change, key=change.get)
        done += packer.add((i, n), np.arange(n))
        assert packer.open <= 3
    done += packer.close()
    got = defaultdict(list)
    for window in done:
        assert sum(len(ids) for *_, ids in window) <= 10
        for (i, _), start, ids in window:
            got[i].append((start, list(ids)))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in got.items()} == {i: list(range(n)) for i, n in enumerate(sizes)}
    assert len(done) == -(-sum(sizes) // 10)


def test_poisson_replication_meets_its_rates(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', 'b') AS source", "'1234' AS text")
    targets = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    mixed = mixing.mix(docs, targets, epochs=2.0)
    got = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert got["a"] == pytest.approx(60_000, rel=0.02) and got["b"] == pytest.approx(20_000, rel=0.03)
    counts = mixed.where("source = 'a'").groupBy("doc_id").count().groupBy("count").count().collect()
    share = {r[0]: r[1] / 13_334 for r in counts}
    rate = 60_000 / 13_334
    assert all(share[k] == pytest.approx(math.exp(-rate) * rate**k / math.factorial(k), abs=0.015) for k in (1, 3, 5, 8))
    high = mixing.mix(docs.where("doc_id < 3"), targets, epochs=3_000.0).groupBy("source").count().collect()
    assert sum(r["count"] for r in high) == pytest.approx(9_000, rel=0.05)
