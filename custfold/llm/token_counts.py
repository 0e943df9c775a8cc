"""Token counts with overlap resynchronisation for huge documents.

The byte-level BPE cuts a text into pretokens before any merge, so a token
never crosses a pretoken boundary.  A position is a *proven stable* boundary
when a visible character precedes it, a space stands at it and a visible
character follows: whatever else the text holds, a pretoken starts
there, and the special strings hold no space.  Between two stable
boundaries the tokens depend on nothing outside, so each piece is encoded by
the library itself, once per worker while it stays in a bounded memo.

Documents longer than ``chunk`` characters are cut into chunks that overlap
and are encoded in different tasks, each with the offsets of its stable
boundaries.  Neighbouring chunks are spliced at a boundary that both report
inside their overlap.  Where they share none (a run without spaces longer
than the overlap), that document is cut again with a doubled overlap.

Defined cases: a null text counts as empty (no bytes, no tokens); rows with
equal ``doc_id`` and text each give a row; an empty table gives an empty
result; no other column of the input is read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import same_key, ship, store, table, text_of

CHUNK, OVERLAP, LIMIT = 16_384, 256, 1024
FEW = 64  # chunks cut into pieces at once
SLICE = 1 << 20  # characters cut into pieces at once
MEMO = 1 << 20  # pieces in a generation of a worker's memo
#: U+180E is white space in older Unicode tables only; never cut beside it.
STABLE = re.compile("(?<=[^\\s\u180e])(?= [^\\s\u180e])")
VISIBLE = re.compile("[^\\s\u180e](?:.*[^\\s\u180e])?", re.S)
BLANK = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
FIRST = re.compile(".*[^\\s\u180e]", re.S)
_TOKENIZERS: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


class PieceCounter:
    """Token counts of texts by a ``tokenizers`` file, piece by piece.

    The memo has two generations of at most ``MEMO`` pieces: a full one
    becomes the old one, and pieces met again move to the new one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.memo: dict[str, int] = {}
        self.old: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> PieceCounter:
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = cls(path)
        return _TOKENIZERS[path]

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: set[str]) -> None:
        """Put the counts of these pieces into the memo; -1 marks a piece that
        does not begin and end with a visible character."""
        memo, old = self.memo, self.old
        new = pieces - memo.keys()
        if len(memo) + len(new) > MEMO:
            self.old, self.memo = memo, {}
            memo, old, new = self.memo, self.old, pieces
        known = {p: old[p] for p in new if p in old}
        memo.update(known)
        rest = list(new - known.keys())
        ok = [p for p in rest if VISIBLE.fullmatch(p)]
        memo.update(dict.fromkeys(rest, -1))
        memo.update(zip(ok, self.encode([" " + p for p in ok]), strict=True))

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out: list[int] = []
        lo = 0
        while lo < len(texts):  # some texts at a time, to bound the pieces in memory
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE):
                size += len(texts[hi])
                hi += 1
            out += [n for _, _, n in self.stable(texts[lo:hi])]
            lo = hi
        return out

    def stable(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], int]]:
        """Of each text: offsets of its stable boundaries, tokens before each,
        tokens in all.  Texts are cut at single spaces; where a space is not a
        stable boundary the text takes the pattern instead."""
        cuts = [t.split(" ") for t in texts]
        self.learn(set().union(*(c[1:] for c in cuts)))
        # A blank at the end belongs to the last piece.
        for c in cuts:
            if len(c) > 2 and not c[-1]:
                c[-2:] = [c[-2] + " "]
        ends = self.encode([" " + c[-1] if len(c) > 1 else c[0] for c in cuts])
        heads = self.encode([c[0] for c in cuts])
        counts = [list(map(self.memo.__getitem__, c[1:-1])) for c in cuts]  # before the memo turns over
        for text, c, ks, head, end in zip(texts, cuts, counts, heads, ends, strict=True):
            if len(c) == 1:
                yield [], [], head
                continue
            if -1 in ks or not c[-1][:1].strip(BLANK) or not (c[0] == "" or FIRST.fullmatch(c[0])):
                yield self.by_pattern(text)
                continue
            at = list(accumulate(map(len, c[:-1])))
            at = [a + i for i, a in enumerate(at)]
            before = list(accumulate(ks, initial=head))
            skip = 1 if not at[0] else 0  # the start of a text is no boundary inside it
            yield at[skip:], before[skip:], before[-1] + end

    def by_pattern(self, text: str) -> tuple[list[int], list[int], int]:
        pieces = STABLE.split(text)
        self.learn({p[1:] for p in pieces[1:]})
        at, before, pos, n = [], [], len(pieces[0]), self.encode(pieces[:1])[0]
        for p in pieces[1:]:
            at.append(pos)
            before.append(n)
            k = self.memo[p[1:]]
            n += k if k >= 0 else self.encode([p])[0]
            pos += len(p)
        return at, before, n


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """``(number, start, end)`` of overlapping chunks over ``text``."""
    out, start = [], 0
    while True:
        end = min(len(text), start + chunk + overlap)
        out.append((len(out), start, end))
        if end == len(text):
            return out
        start += chunk


def splice(chunks: list[tuple]) -> int | None:
    """Tokens of a document from its chunks ``(start, end, at, before, n)`` in
    order, or None where two neighbours share no stable boundary."""
    total, begun = 0, 0
    for left, right in zip(chunks, chunks[1:], strict=False):
        tail = {left[0] + a: b for a, b in zip(left[2], left[3], strict=True) if left[0] + a > right[0]}
        hit = next(((tail[right[0] + a], b) for a, b in zip(right[2], right[3], strict=True) if right[0] + a in tail), None)
        if hit is None or hit[0] < begun:
            return None
        total += hit[0] - begun
        begun = hit[1]
    return total + chunks[-1][4] - begun


_CHUNKS = "doc_id {t}, _h long, no int, start long, end long, body string"
_COUNTED = "doc_id {t}, _h long, start long, end long, at array<long>, before array<long>, n long"


def _long_counts(long: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """``doc_id, _h, n_tokens`` (null where the overlap was too short)."""
    kind = long.schema["doc_id"].dataType.simpleString()

    def cut_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, h, body in zip(b["doc_id"], b["_h"], b["body"], strict=True):
                yield pd.DataFrame([(d, h, i, s, e, body[s:e]) for i, s, e in cut(body, chunk, overlap)],
                                   columns=["doc_id", "_h", "no", "start", "end", "body"]).astype({"doc_id": b["doc_id"].dtype})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PieceCounter.of(tokenizer)
        for b in batches:
            rows = []
            found = (x for lo in range(0, len(b), FEW) for x in counter.stable(b["body"].iloc[lo:lo + FEW].tolist()))
            for d, h, s, e, (at, before, n) in zip(b["doc_id"], b["_h"], b["start"], b["end"], found, strict=True):
                keep = [i for i, a in enumerate(at) if a <= overlap or a >= e - s - overlap]
                rows.append((d, h, s, e, [at[i] for i in keep], [before[i] for i in keep], n))
            yield pd.DataFrame(rows, columns=["doc_id", "_h", "start", "end", "at", "before", "n"]).astype({"doc_id": b["doc_id"].dtype})

    def join_up(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("start")
        n = splice(list(g[["start", "end", "at", "before", "n"]].itertuples(index=False, name=None)))
        return pd.DataFrame({"doc_id": g["doc_id"].iloc[:1], "_h": g["_h"].iloc[:1],
                             "n_tokens": pd.array([n], dtype="Int64")})

    chunks = (long.mapInPandas(cut_all, _CHUNKS.format(t=kind)).repartition("doc_id", "_h", "no")
              .mapInPandas(encode, _COUNTED.format(t=kind)))
    return chunks.groupBy("doc_id", "_h").applyInPandas(join_up, f"doc_id {kind}, _h long, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``."""
    ship(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("body"))
    huge = F.length("body") > chunk + overlap

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter.of(tokenizer)
        for s in texts:
            yield pd.Series(counter.count_all(s.tolist()), dtype="int64")

    small = rows.where(~huge).select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"),
                                     count("body").alias("n_tokens"))
    # Equal rows are cut once; `times` brings them back.
    long = rows.where(huge).withColumn("_h", F.xxhash64("body"))
    long = store(long.groupBy("doc_id", "_h").agg(F.first("body").alias("body"), F.count(F.lit(1)).alias("times")), "tokens-long")
    done, todo = None, long
    while not todo.isEmpty():
        got = store(_long_counts(todo, tokenizer, chunk, overlap), "tokens-counted")
        ok = got.where("n_tokens IS NOT NULL")
        done = ok if done is None else done.unionByName(ok)
        again = got.where("n_tokens IS NULL")
        todo = todo.join(again, same_key(todo, again, ["doc_id", "_h"]), "left_semi")
        chunk, overlap = max(chunk, 4 * overlap), 2 * overlap
    out = small
    if done is not None:
        counted = (long.join(done, same_key(long, done, ["doc_id", "_h"]))
                   .select(long["doc_id"], F.octet_length("body").cast("long").alias("n_bytes"), "n_tokens",
                           F.explode(F.sequence(F.lit(1).cast("long"), long["times"]))))
        out = small.unionByName(counted.drop("col"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the byte-level BPE file."""
    return token_counts(table(spark, sf_dir, "documents"))
