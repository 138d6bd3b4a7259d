"""Brute-force forms of the operators and small tables that hold odd rows."""

import re

TABLES = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{k % 997} the" for k in range(30_000))

ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "two words", "Two  Words", "a b c d e f g h i j", "a b c d e f g h i j k",
    "tab\tand\x0bvertical\x0cfeed\r\n", "\x1c odd \x85 spaces   here", "Größe ÀÉ 日本語 😀 é", "<|endoftext|> <|im_end|>",
    "same line\nsame line\nsame line", LONG, "x" * 50_000, "NUL \x00 in text", "...!!!???", "a" + " b" * 40,
]


def odd_documents(spark, extra=False):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "no id at all"), (None, None), (7, ODD_TEXTS[7]), (5, "two words")]
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    rows = [(d, t, "en", "s", len(t or ""), "k", 1) for d, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kind string, id int")


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width=5):
    w = space_words((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
