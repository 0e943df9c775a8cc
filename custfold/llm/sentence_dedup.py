"""Substring dedup by sliding sentence spans.

Sentences end at ``.``, ``!`` or ``?`` before white space, or at a line end.
From every sentence, forwards and backwards, the shortest run of consecutive
sentences with at least ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words is
a span; one sentence of ``ALONE_WORDS`` words is a span by itself.  So each
sentence of a repeated passage lies in a span inside that passage.  Spans are
hashed (128 bits, white space collapsed) and joined over all documents; all
sentences covered by a span's non-first occurrence (order: ``doc_id``, nulls
last, then position) are removed.

The count combines before the shuffle, and only repeated spans go on; joins
on them are split by adaptive execution where one span is very frequent.

Defined cases: a null text counts as empty; white space alone is no sentence;
rows with equal ``doc_id`` and text are one document and give equal rows; a
very long text has all its spans taken, one batch at a time; an empty table gives an
empty result; no other column of the input is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import same_key, ship, store, table, text_of

MIN_SENTENCES, MIN_WORDS, ALONE_WORDS = 2, 12, 30
#: One sentence with the white space behind it; every character is in one.
SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?=[^\s.!?])[^.!?\n]*)*[.!?]*\s*")


def sentences(text: str) -> list[str]:
    """Sentences with the white space around them; joined they are ``text``."""
    return [s for s in SENTENCE.findall(text) if s]


def spans(words: list[int]) -> set[tuple[int, int]]:
    """Index pairs (first, last) of the spans over sentences of these lengths."""
    n, out = len(words), set()
    for i in range(n):
        if words[i] >= ALONE_WORDS:
            out.add((i, i))
        j, w = i, words[i]
        while j + 1 < n and (w < MIN_WORDS or j - i + 1 < MIN_SENTENCES):
            j += 1
            w += words[j]
        if w >= MIN_WORDS and j - i + 1 >= MIN_SENTENCES:
            out.add((i, j))
        j, w = i, words[i]
        while j > 0 and (w < MIN_WORDS or i - j + 1 < MIN_SENTENCES):
            j -= 1
            w += words[j]
        if w >= MIN_WORDS and i - j + 1 >= MIN_SENTENCES:
            out.add((j, i))
    return out


def _visible(text: str) -> tuple[list[str], list[list[str]], list[int]]:
    """Sentences, their words, and the indices of those that have words."""
    parts = sentences(text)
    words = [p.split() for p in parts]
    return parts, words, [i for i, w in enumerate(words) if w]


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        src, at, to, dig = [], [], [], []
        for r, body in enumerate(b["body"]):
            _, words, real = _visible(body)
            clean = [" ".join(words[i]) for i in real]
            for i, j in spans([len(words[k]) for k in real]):
                src.append(r)
                at.append(real[i])
                to.append(real[j])
                dig.append(xxhash.xxh3_128_digest(clean[i] if i == j else " ".join(clean[i:j + 1])))
        h = np.frombuffer(b"".join(dig), dtype=np.int64).reshape(-1, 2)
        row = np.array(src, dtype=np.int64)
        yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[row] if len(row) else b["doc_id"].iloc[:0],
                            "_h": b["_h"].to_numpy()[row] if len(row) else b["_h"].iloc[:0],
                            "a": h[:, 0], "b": h[:, 1], "pos": np.array(at, dtype=np.int32), "last": np.array(to, dtype=np.int32)})


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_sentences, n_removed, text`` (what stays) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("body"), F.xxhash64(text).alias("_h"))
    found = store(rows.mapInPandas(_emit, f"doc_id {kind}, _h long, a long, b long, pos int, last int"), "spans")
    # Counted by half of the hash; the whole hash decides below.
    repeated = store(found.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "span-repeats")
    at = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_h", "pos").alias("at")
    places = store(found.join(repeated, "a").select("a", "b", at, "last"), "span-places")
    # Written, so that the join below deals both sides anew and hot spans are split.
    first = store(places.groupBy("a", "b").agg(F.min("at").alias("first")), "span-first")
    later = places.join(first, ["a", "b"]).where(F.col("at") > F.col("first"))
    gone = (later.select("at.doc_id", "at._h", F.explode(F.sequence("at.pos", "last")).alias("pos"))
            .groupBy("doc_id", "_h").agg(F.collect_set("pos").alias("gone")))

    @F.pandas_udf("n_sentences long, n_removed long, text string")
    def rest(bodies: pd.Series, gones: pd.Series) -> pd.DataFrame:
        out = []
        for body, g in zip(bodies, gones, strict=True):
            parts, _, real = _visible(body)
            drop = set() if g is None else set(g)
            out.append((len(real), sum(i in drop for i in real), "".join(p for i, p in enumerate(parts) if i not in drop) if drop else body))
        return pd.DataFrame(out, columns=["n_sentences", "n_removed", "text"])

    return (rows.join(gone.hint("shuffle_hash"), same_key(rows, gone, ["doc_id", "_h"]), "left")
            .select(rows["doc_id"], rest("body", "gone").alias("r")).select("doc_id", "r.*"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated sentence spans over all of ``documents``."""
    out = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_sentences", "n_removed", F.sha2("text", 256).alias("text_sha256"))
