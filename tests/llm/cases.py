"""Small inputs with the awkward cases, and brute-force readings of the contracts."""

from __future__ import annotations

import re

WORD = re.compile("[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

SENTENCE = " ".join(f"word{i} part{i % 7}" for i in range(60))
LINE = "This line is quite long and stands in very many of the documents."
TEXTS = [
    SENTENCE, SENTENCE, SENTENCE.upper(), None, "", " \t\n\x0b\x0c\r ", "one", "one two", "İstanbul ßtraße ÀÉ\u00a0x \u2003y \u0085z",
    "a " * 5000, "ab" * 40_000, LINE + "\n" + LINE.upper() + "\nshort\n", "x\n" + LINE, "  " + LINE + "  \ny", LINE, "z\n" + LINE, LINE + "\nlast",
    "\n\n\n", "pre " + SENTENCE + " post", "tail " + " ".join(SENTENCE.split()[40:90]), "a\x00b \x1c \x1f \ufeff", "# % & | < > $ * # ", "🙂 👍🏽 e\u0301 " * 30,
    " ".join(f"alt{i}" for i in range(200)) + " " + " ".join(SENTENCE.split()[:25]),
]


def rows(texts=TEXTS):
    langs = ["en", "de", None, ""]
    return [(i, t, langs[i % 4], "src0", None if t is None else len(t)) for i, t in enumerate(texts)]


def frame(spark, data=None, schema=SCHEMA):
    return spark.createDataFrame(rows() if data is None else data, schema)


def words(text):
    return WORD.findall(text or "")
