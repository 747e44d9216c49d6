"""Long lines that recur in few texts."""

from tradeloom.llm import line_dedup


def test_long_lines_recur_in_two_texts(spark):
    """A long passage in two texts is dropped, exact or with a changed word; a short line and long lines
    that only begin alike stay."""
    passage = " ".join(f"{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8]}" for i in range(60))
    changed = passage.replace("ck", "other")
    alike = [" ".join(["one", "two", "six"] + [c + "qrstuvwx"[i % 8] + "qrstuvwx"[i // 8] for i in range(57)]) for c in "yz"]
    short = "a short line of the text"
    lines = [passage, passage + "\n" + short, changed, short, *alike]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.id: r.text for r in line_dedup.dedup(docs).collect()}
    assert got == {0: "", 1: short, 2: "", 3: short, 4: alike[0], 5: alike[1]}
