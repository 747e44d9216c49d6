"""Small documents with every odd case, and plain versions of the counts."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Extra columns whose names the operators use themselves.
    "id long, digest string, kept string, score string, severity double, n long, key string, block long"
)

PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river"


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None, 1, "d", "k", "s", 0.5, 2, "x", 3)


def odd_rows():
    return [
        row(1, PROSE),
        row(2, PROSE),
        row(2, PROSE),
        row(3, None, None, None),
        row(4, ""),
        row(5, " \t\r\n "),
        row(6, "one"),
        row(7, PROSE + " today", "de", "b"),
        row(8, "\n".join([PROSE] * 40), "fr", "b"),
        row(9, "x" * 50_000),
        row(10, "word " * 20_000),
        row(None, "no id here", "en", None),
        row(None, PROSE),
        row(11, "Grüße aus Köln, İstanbul ſ – 東京 <|endoftext|> 'll a1b2"),
    ]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
