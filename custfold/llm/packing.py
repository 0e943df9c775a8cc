"""Packing by power-of-two decomposition.

A document of ``n`` ids is cut into pieces whose lengths are the powers of two
of ``n``: as many pieces of ``most`` ids as it holds, then one piece for every
set bit of the rest, longest first.  A piece is a sequence of its own, and
sequences of equal length form a bucket.  So no sequence crosses documents, none
is padded, and a batch drawn from one bucket is rectangular.

Ids come from the ``tokenizers`` library.  This vocabulary drops white space
and nothing it does reaches over a space or a line feed (its normaliser composes
and lower-cases within a word, its special strings hold neither), so a text
is cut there and every different word is encoded once per worker while it
stays in a memo of bounded size.

No shuffle is needed: a document is packed where it is read, and a lost task is
run again with the same result.  ``sequence_id`` is the place of the piece in the
order of reading (partition number in the high bits), so it is unique, rises
along a document, and stays the same as long as the files are split alike.

Defined cases: a null text counts as empty; an empty text is the closing id
alone, one piece of length 1; rows with equal ``doc_id`` and text are packed one by
one, each with sequences of its own; a null ``doc_id`` stays null; a very long text is
one row held by one task, with its ids as four bytes each beside it; an empty
table gives an empty result.  Other columns of the input are not read, so their
names cannot clash.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import ship, table, text_of

MOST = 4096  # ids in the longest piece, a power of two
END_ID = 2  # closes every document
MEMO = 1 << 18  # words in a generation of a worker's memo
SOME = 1 << 24  # bytes of text whose words are numbered together
BLOCK = 1 << 19  # words whose ids are laid out together
HELD = 1 << 23  # bytes of ids in a batch of pieces
RUN = 256  # words in one list for the library
STOP = "([a-zß-öø-ÿ])([.,])( |$)"
_ENCODERS: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, word by word.

    The memo has two generations of at most about ``MEMO`` words: a full one
    becomes the old one, and words met again move to the new one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.digit = self.tok.encode("0", add_special_tokens=False).ids[0]
        self.merges = Tokenizer(self.tok.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def encode(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word; words go to the library in lists, whose
        tokens name the word they belong to."""
        lists = [words[lo:lo + RUN] for lo in range(0, len(words), RUN)]
        for ws, e in zip(lists, self.tok.encode_batch(lists, is_pretokenized=True, add_special_tokens=False), strict=True):
            yield from _cut(little_endian(e.ids), np.bincount(np.asarray(e.word_ids, np.int64), minlength=len(ws)))

    def encode_letters(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words that ``plain`` allows: nothing is left to normalise
        or to split in them, so the vocabulary's merges alone are run, over one
        text per list in which a digit, never part of a longer token, stands
        between words."""
        lists = [words[lo:lo + RUN] for lo in range(0, len(words), RUN)]
        for e in self.merges.encode_batch_fast([" 0 ".join([*ws, ""]) for ws in lists], add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(ids == self.digit)
            yield from _cut(np.delete(ids, ends).tobytes(), np.diff(ends, prepend=-1) - 1)

    def learn(self, words: list[str]) -> None:
        """Put the ids of these words into the memo."""
        if len(self.memo) > MEMO:
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        parts, letters, others = {}, set(), set()
        for w in filterfalse(memo.__contains__, words):
            if w in old:
                memo[w] = old[w]
                continue
            if plain(w):
                letters.add(w)
                continue
            parts[w] = ps = split_word(w)
            for p in ps:
                if p not in memo:
                    if p in old:
                        memo[p] = old[p]
                    else:
                        (letters if plain(p) else others).add(p)
        for todo, encode in ((list(letters), self.encode_letters), (list(others), self.encode)):
            memo.update(zip(todo, encode(todo), strict=True))
        for w, ps in parts.items():
            if len(ps) > 1 or ps[0] != w:
                memo[w] = b"".join([memo[p] for p in ps])

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text.  The words of some texts at a time are
        numbered, looked up once each, and their ids laid out by number."""
        # A-Z may be lowered first, except where a special string may stand: the
        # library looks for these before it lowers.  A full stop or comma
        # between a letter and a space is a word of its own.
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for lo, hi in _slices(size, SOME):
            spaced = pc.replace_substring_regex(pc.replace_substring(texts.slice(lo, hi - lo), "\n", " "), STOP, r"\1 \2\3")
            cut = pc.split_pattern(spaced, " ")
            coded = cut.flatten().dictionary_encode()
            words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            self.learn(words)
            found = [self.memo[w] for w in words]
            length = np.array([len(f) for f in found], np.int64) // 4
            flat, begin = np.frombuffer(b"".join(found), "<u4"), np.cumsum(length) - length
            at, offsets = coded.indices.to_numpy(), cut.offsets.to_numpy()
            offsets = offsets - offsets[0]
            for i, j in _slices(np.diff(offsets), BLOCK):
                here = at[offsets[i]:offsets[j]]
                n = length[here]
                ends = np.cumsum(n)
                out = flat[np.repeat(begin[here] - (ends - n), n) + np.arange(n.sum())].tobytes()
                bounds = (4 * np.concatenate([[0], ends]))[offsets[i:j + 1] - offsets[i]].tolist()
                yield from (out[x:y] for x, y in zip(bounds, bounds[1:], strict=False))


def _cut(ids: bytes, counts: np.ndarray) -> Iterator[bytes]:
    pos = 0
    for n in counts.tolist():
        yield ids[pos:pos + 4 * n]
        pos += 4 * n


def _slices(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of about ``most`` together."""
    group = np.cumsum(size, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(size)] if len(size) else [0]
    yield from zip(cuts, cuts[1:], strict=False)


def little_endian(ids: list[int]) -> bytes:
    a = array("I", ids)
    if a.itemsize != 4 or array("H", [1]).tobytes() != b"\1\0":
        return b"".join(i.to_bytes(4, "little") for i in ids)
    return a.tobytes()


def plain(word: str) -> bool:
    """Lower-case Latin letters, composed: the library changes nothing in them."""
    return word.isalpha() and max(word) < "\u0250" and word == word.lower()


def split_word(word: str) -> tuple[str, ...]:
    """The parts of a word that are encoded on their own: Latin letters in
    lower case (where that leaves letters only), and a full stop or comma behind
    them, which the library cuts off."""
    stem, rest = (word[:-1], (word[-1],)) if word[-1:] in (".", ",") else (word, ())
    if stem.isalpha() and max(stem) < "\u0250":
        low = stem.lower()
        if low.isalpha():
            return (low, *rest)
    return (word,)


def powers(n: int, most: int = MOST) -> list[int]:
    """The lengths of the pieces of ``n`` ids, longest first."""
    out = [most] * (n // most)
    rest = n % most
    while rest:
        top = 1 << (rest.bit_length() - 1)
        out.append(top)
        rest -= top
    return out


def binary_pieces(docs: DataFrame, tokenizer: str | None = None, most: int = MOST, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens``, where
    ``ids`` holds little-endian unsigned 32-bit numbers."""
    if most < 1 or most & (most - 1):
        raise ValueError("most must be a power of two")
    ship(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    close = little_endian([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        for b in batches:
            doc = b.column(0)
            at, start, length, ids, total, held = [], [], [], [], [], 0
            for i, found in enumerate(encoder.ids(b.column(1))):
                found += close
                pos = 0
                for n in powers(len(found) // 4, most):
                    at.append(i)
                    start.append(pos)
                    length.append(n)
                    ids.append(found[4 * pos:4 * (pos + n)])
                    total.append(len(found) // 4)
                    pos += n
                held += len(found)
                if held > HELD:
                    yield _pieces(doc, at, start, length, ids, total)
                    at, start, length, ids, total, held = [], [], [], [], [], 0
            if at:
                yield _pieces(doc, at, start, length, ids, total)

    return rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")


def _pieces(doc: pa.Array, at: list, start: list, length: list, ids: list, total: list) -> pa.RecordBatch:
    columns = [doc.take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
               pa.array(ids, pa.binary()), pa.array(total, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens"])


def sequences(docs: DataFrame, **options) -> DataFrame:
    """``binary_pieces`` with the sequence that each piece is: ``sequence_id``
    and its ``offset`` there, which is 0 as no sequence holds two pieces."""
    return (binary_pieces(docs, **options)
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(docs: DataFrame, path: str, **options) -> None:
    """Write the sequences as Parquet, one folder per length."""
    sequences(docs, **options).write.partitionBy("length").parquet(path)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, with a checksum for its ids."""
    return sequences(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
