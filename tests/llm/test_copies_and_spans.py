"""Spans beside a plain scan, copies in the binomial bound, groups just below the threshold, packing memory."""

import re
import time

import numpy as np
from pyspark.sql import functions as F

from tradeloom.llm import line_dedup, near_dedup, packing, quality, secret_scan

ASSIGN = re.compile(secret_scan.ASSIGN, re.A)


def plain_scan(text, table, threshold):
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]{16,}", text)]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
    rest = list(text)
    for start, _, end in base:
        rest[start:end] = " " * (end - start)
    for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", "".join(rest)):
        codes = [ord(c) - secret_scan.FIRST for c in m[0]]
        total = 0.0
        for x, y in zip(codes, codes[1:], strict=False):
            total += table[x * secret_scan.SPAN + y]
        if total > threshold:
            base.append((m.start(), 3, m.end()))
    return ",".join(f"{secret_scan.KINDS[r]}:{a}:{b}" for a, r, b in sorted(base))


def test_all_spans_equal_a_plain_scan(spark):
    """Keys around, before, behind and between pattern spans are tested by themselves."""
    rng = np.random.default_rng(12)
    symbols = np.array(list(secret_scan.SYMBOLS[:62]))

    def part():
        n = int(rng.integers(0, 40))
        return [
            "".join(rng.choice(symbols, n)),
            "".join(rng.choice(list("0123456789abcdef"), n)),
            "AKIA" + "".join(rng.choice(list("ABCXYZ0123456789"), n)),
            "token=" + "".join(rng.choice(symbols, n)),
            "API_KEY: '" + "".join(rng.choice(symbols, n)) + "'",
            "é東\U0001f600\n",
            "getUserNameIndexFromTheTable",
        ][int(rng.integers(0, 7))]

    texts = ["".join(part() + str(rng.choice(["-", " ", "/", "+"])) for _ in range(int(rng.integers(0, 12)))) for _ in range(600)]
    key = "QwErTyUiZxCvBnMgH" + "0123456789abcdef01234567" + "ZxKvBnMgHQwErTyUiLmN"
    texts += [key, "see " + key + " and token=" + key, "token=" + key, "0" * 23 + "api_key=abcdef", "AKIA" + "B" * 13 + "TOKEN=abcdef"]
    table = [round(float(x), 6) for x in rng.normal(0.05, 1, secret_scan.SPAN**2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for threshold in (secret_scan.THRESHOLD, -1e9):
        found = secret_scan.find(docs, table, threshold).select("id", secret_scan.written("spans").alias("spans"))
        got = {r.id: r.spans for r in found.collect()}
        for i, text in enumerate(texts):
            assert got[i] == plain_scan(text, table, threshold), text
    assert got[600] == "random:0:17,hex:17:41,random:41:61"


def test_many_matches_in_one_text(spark):
    """40,000 runs in a megabyte; time is in proportion, not in the square."""
    text = " ".join(["0123456789abcdef0123456789"] * 40_000)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    spans = secret_scan.find(docs, [1.0] * secret_scan.SPAN**2).first().spans
    assert len(spans) == 40_000 and (spans[-1].start, spans[-1].end) == (len(text) - 26, len(text))
    assert time.time() - began < 60


def test_copies_do_not_certify(spark):
    """60 good labels certify nothing; neither do ten copies of each row, text or label."""
    prose = "the quick brown fox jumps over a lazy dog while owls watch from old oak trees near some river bank today and"
    texts = [(i, " ".join(f"{w}{i}" for w in (prose + " " + prose[::-1] + " " + prose.upper()).split()) + " #" * (20 * (i % 2))) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in texts], "doc_id long, quality int")
    ten = spark.range(10).withColumnRenamed("id", "copy")
    other = lambda rows: rows.crossJoin(F.broadcast(ten)).withColumn("doc_id", F.col("doc_id") + 1000 * F.col("copy")).drop("copy")
    same = lambda rows: rows.crossJoin(F.broadcast(ten)).drop("copy")
    for d, m in ((docs, labels), (docs, same(labels)), (same(docs), labels), (other(docs), other(labels))):
        judged = quality.decide(d, m)
        assert judged.where("size(failed) > 0").count() == 0 and judged.count() == d.count()


def test_contradicting_labels_are_left_out(spark):
    stats = spark.createDataFrame(
        [(i, "en", 60, 300, 0, 0, 0, float(i >= 1500), 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(2000)],
        f"id long, stratum string, {quality.STATISTICS}",
    )
    marks = [(i, int(i < 1500)) for i in range(2000)]
    both = [(i, 1) for i in range(1500, 2000)]
    fit = lambda rows: quality.fit(stats, spark.createDataFrame(rows, "doc_id long, quality int"))["en"]
    assert fit(marks) == {"symbols": 0.0}
    assert fit(marks + both) == {}


def test_groups_just_below_the_threshold_join_nothing(spark, monkeypatch):
    """Variants of two texts that are not linked: pairs of one component never meet, so what is joined does
    not grow with the square of a group."""
    rng = np.random.default_rng(7)
    word = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, 6))
    common, first, second = ([word() for _ in range(n)] for n in (80, 10, 10))
    base = [" ".join(common + first), " ".join(common + second)]
    texts = [(i, f"{base[i % 4 != 0]} {word()} {word()}") for i in range(240)]
    seen = []
    plain = near_dedup.staged

    def watched(rows, label):
        out = plain(rows, label)
        if label == "mixed":
            seen.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "staged", watched)
    got = near_dedup.decide(spark.createDataFrame(texts, "doc_id long, text string"), 3, 85)
    assert {r.id: r.component for r in got.collect()} == {i: 0 if i % 4 == 0 else 1 for i, _ in texts}
    assert sum(seen) <= 240


def test_long_line_bounds_are_parameters(spark):
    line = " ".join("abcdefghij"[i % 10] * (1 + i // 10) for i in range(30))
    docs = spark.createDataFrame([(0, line), (1, line + "\nx")], "doc_id long, text string")
    assert line_dedup.dedup(docs).agg(F.sum("n_dropped")).first()[0] == 0
    assert line_dedup.dedup(docs, long_tokens=30).agg(F.sum("n_dropped")).first()[0] == 2
    assert line_dedup.dedup(docs, long_tokens=30, long_documents=3).agg(F.sum("n_dropped")).first()[0] == 0


def test_line_tokens_equal_a_plain_parse():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        line = "".join(rng.choice(list("aé7٣ \t\x0b\x1c\x85\xa0 .x"), int(rng.integers(0, 30))))
        want = ["<*>" if re.fullmatch(r"\S*\d\S*", t) else t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]
        assert [t.decode() for t in line_dedup.tokens(line)] == want


def test_remembered_words_stay_right_when_the_memory_turns():
    asked = []
    memory = packing.Remembered(lambda key: asked.append(key) or key.encode(), 3)
    for _ in range(3):
        for key in "abcde":
            assert memory[key] == key.encode()
        memory.trim()
    assert asked == list("abcde") and len(memory) <= 3
