"""Small tables and plain versions of the rules for the corpus tests."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _h string, body string, k int, path string, late int, copies int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i} and more" for i in range(6000)) + "\n" + "x" * 3000

#: Null, empty, repeated and long texts, ties, and columns with clashing names.
EDGE = [(1, None, "s"), (2, "", "s"), (2, "", "s"), (3, "a", None), (None, "hello world", "t"), (None, None, None), (4, LONG, "t"), (5, LONG, "t"),
        (5, LONG, "t"), (6, "Same text here. Same text here.\nSame\nSame\nSame\nSame", "u"), (7, " \n\t ", "u"), (8, "é É Ünï 𝒳 ᠎ ok", "u"), (6, "another text", "v")]


def edge_docs(spark, rows=EDGE):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "h", "b", 1, "p", 0, 9) for i, t, s in rows], SCHEMA)


def docs_of(spark, texts, source=lambda i: "s"):
    return spark.createDataFrame([(i, t, "en", source(i), len(t or ""), "h", "b", 1, "p", 0, 9) for i, t in enumerate(texts)], SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
