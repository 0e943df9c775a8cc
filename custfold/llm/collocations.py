"""Phrase collocations from an FM-index per shard.

1. ``shards``: documents of one language are read into shards of at most about
   ``shard_words`` words (cut between pieces only), as numbers over the shard's own
   words, the most frequent first.  Word counts are summed over all shards.
2. A phrase that occurs ``least`` times has only words that do.  Shards pack
   their words per bucket of words; each bucket adds the counts and tells every
   shard which of its words are frequent everywhere (nothing is broadcast).
   Any other word is a break.
3. ``BiIndex``: the Burrows-Wheeler transforms of a shard and of its reverse,
   sorted to the depth of the longest phrase that is extended.  A phrase is an
   interval in each; ``extend`` adds a word at either end and moves both.  The
   interval gives the count, and the transforms over it give the words before and
   after.
4. Phrases are enumerated length by length, as sorted numbers (the id of all but
   the last word, then the last word) packed per bucket of phrases; each bucket
   adds its shards' counts, gives the phrases that are frequent everywhere an id
   and tells every shard which of its own these are.  The next length extends the
   intervals of these alone, to phrases whose other part is frequent too, as both
   parts of a frequent phrase are.
5. A phrase lies inside a longer candidate of the same count where a frequent
   phrase of one word more has it as a part.  One word more is enough: what lies
   between has the same count.

A shard is one row of bounded size, read for each length where it lies (shards are
stored in buckets).  Its transforms take twice its size and are never stored: they
are made in the task that walks them, sorted no deeper than that length needs.  A
hot word or phrase counts once per shard, and buckets grow in number with the
words.  The bucket of a phrase follows from its two numbers, so the last word is
sent without the part that the bucket tells, and frequent words have small numbers.
All tables in between are Parquet files in the shared folder, deleted when they
were read last.

Defined cases: a null text counts as empty; a null language is ``und``; an empty
text adds nothing; rows with equal ``doc_id`` and text are counted each time; a very long
text is read by one task and lies in one shard at most ``shard_words`` words past
its cut; ties are ordered by the phrase's UTF-8 bytes; an empty table gives an
empty result.  Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custfold.llm.common import LOWER, UPPER, release, ship, store, stored_paths, table, text_of

LEAST, DEPTH, TOP = 100, 5, 2000
SHARD_WORDS = 1 << 21
#: Words of the corpus for each bucket of pairs, so pairs that a bucket may hold.
BUCKET_WORDS = 1 << 20
#: Rows of an index that are extended at once.
ROWS = 1 << 19
#: Words in the buffer that is turned into numbers at once.
SOME = 1 << 18
_BREAK = b"\n"
#: The bits of the last word's number in a phrase's key.
_LAST = (1 << 31) - 1
#: Bytes: A-Z lower-cased, a tab as a space, whatever ends a piece as a line feed.
_BYTES = bytes.maketrans(UPPER.encode() + b"\t.,;:!?\x0b\x0c\r", LOWER.encode() + b" " + _BREAK * 9)


class BiIndex:
    """Bidirectional FM-index over ``text`` (0 is a break, words from 1).

    ``bwt[0]`` holds the symbol before each suffix in sorted order, ``bwt[1]``
    the symbol after each reversed prefix.  Suffixes are sorted by their first
    ``depth`` symbols, which is all that phrases up to ``depth`` words need
    (these may be looked at one word further).  Where only one direction is
    walked, the other may be None.
    """

    def __init__(self, bwt: tuple, size: int):
        self.bwt, self.size = bwt, size
        held = bwt[0] if bwt[0] is not None else bwt[1]
        self.rows = len(held)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(held, minlength=size + 1))]).astype(np.int64)
        self.at: list[np.ndarray | None] = [None, None]

    @staticmethod
    def transforms(text: np.ndarray, depth: int, sides: tuple = (0, 1)) -> tuple[np.ndarray | None, np.ndarray | None]:
        """The transforms of ``text`` and of its reverse; None where not in ``sides``."""
        out: list[np.ndarray | None] = [None, None]
        for side in sides:
            t = text if side == 0 else text[::-1]
            out[side] = t[_sorted_suffixes(t, depth) - 1]  # before the first symbol stands the last one, a break
        return out[0], out[1]

    def occurrences(self, side: int, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before ``row``."""
        if self.at[side] is None:
            self.at[side] = np.sort(self.bwt[side].astype(np.int64) * self.rows + np.arange(self.rows))
        return np.searchsorted(self.at[side], symbol.astype(np.int64) * self.rows + row) - self.first[symbol]

    def words(self) -> dict:
        """The intervals of all single words."""
        w = np.flatnonzero(np.diff(self.first)[1:self.size + 1]) + 1
        lo = self.first[w]
        return {"lo": (lo, lo), "n": self.first[w + 1] - lo, "phrase": w[:, None]}

    def followers(self, found: dict, side: int) -> Iterator[tuple]:
        """``(interval, symbol, count, offset)`` of the symbols before (``side`` 0)
        or after (1) each interval, some intervals at a time; in the other
        index the longer phrases divide the interval in symbol order, so
        ``offset`` counts the smaller ones."""
        lo, n = found["lo"][side], found["n"]
        for i, j in _blocks(n, ROWS):
            which = np.repeat(np.arange(i, j), n[i:j])
            row = np.arange(len(which)) + np.repeat(lo[i:j] - (np.cumsum(n[i:j]) - n[i:j]), n[i:j])
            key, count = np.unique(which * (self.size + 1) + self.bwt[side][row], return_counts=True)
            which, symbol = np.divmod(key, self.size + 1)
            before = np.cumsum(count) - count
            yield which, symbol, count, before - before[np.searchsorted(which, np.arange(i, j))][which - i]

    def longer(self, found: dict, side: int, keep: Callable | None = None) -> Iterator[tuple]:
        """``(interval, symbol, count, offset, phrase)`` of the phrases one word
        longer, some at a time; ``keep`` tells which of an array of phrases to take."""
        for which, symbol, count, offset in self.followers(found, side):
            at = symbol > 0
            which, symbol, count, offset = which[at], symbol[at], count[at], offset[at]
            parts = [symbol[:, None], found["phrase"][which]]
            phrase = np.concatenate(parts if side == 0 else parts[::-1], axis=1)
            if keep is not None:
                at = keep(phrase)
                which, symbol, count, offset, phrase = which[at], symbol[at], count[at], offset[at], phrase[at]
            yield which, symbol, count, offset, phrase

    def extend(self, found: dict, side: int, keep: Callable | None = None) -> dict:
        """All phrases one word longer that ``keep`` takes, before (``side`` 0) or after (1)."""
        out = [(np.zeros(0, np.int64),) * 3 + (np.zeros((0, found["phrase"].shape[1] + 1), np.int64),)]
        for which, symbol, count, offset, phrase in self.longer(found, side, keep):
            here = self.first[symbol] + self.occurrences(side, symbol, found["lo"][side][which])
            out.append((here, found["lo"][1 - side][which] + offset, count, phrase))
        here, other, count, phrase = (np.concatenate(x) for x in zip(*out, strict=True))
        return {"lo": (here, other) if side == 0 else (other, here), "n": count, "phrase": phrase}

    def always(self, found: dict, side: int) -> np.ndarray:
        """The word that every occurrence has before (0) or after (1) it, else 0."""
        b, lo, n = self.bwt[side], found["lo"][side], found["n"]
        if not len(n):
            return np.zeros(0, np.int64)
        run = np.concatenate([[0], np.cumsum(b[1:] != b[:-1], dtype=np.int32)])
        return np.where(run[lo] == run[lo + n - 1], b[lo], 0)


def _blocks(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring items of about ``most`` together."""
    if len(size):
        group = np.cumsum(size, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(size)]
        yield from zip(cuts, cuts[1:], strict=False)


def _ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of ``key``, then of their place, and the sorted keys.
    Key and place share one number where they fit, which sorts fastest."""
    n = len(key)
    if n and int(key.max()) < (1 << 63) // n - 1:
        packed = key * n + np.arange(n)
        packed.sort()
        keys, order = np.divmod(packed, n)
        return order, keys
    order = np.argsort(key, kind="stable")
    return order, key[order]


def _sorted_suffixes(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols (cyclic: the text
    ends in breaks, which no phrase holds)."""
    rank, have = t.astype(np.int64), 1
    if depth == 1:
        return _ordered(rank)[0]
    while True:
        step = min(have, depth - have)
        # One symbol more is a smaller number than the rank of several.
        more = np.roll(t, -have) if step == 1 else np.roll(rank, -step)
        order, keys = _ordered(rank * (int(more.max()) + 1) + more)
        have += step
        if have >= depth:
            return order
        rank[order] = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])


def _pack(a: np.ndarray) -> bytes:
    """Numbers from 0, their bytes regrouped by place, without the places that are
    0 in all of them.  Bytes of one place repeat in runs or not at all, so only
    runs and frequent bytes are made shorter."""
    places = np.ascontiguousarray(a, "<i8").view(np.uint8).reshape(-1, 8).T
    used = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    z = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS, zlib.DEF_MEM_LEVEL + 1, zlib.Z_RLE)
    return bytes([used]) + z.compress(places[:used].tobytes()) + z.flush()


def _unpack(b: bytes) -> np.ndarray:
    places = np.frombuffer(zlib.decompress(b[1:], -zlib.MAX_WBITS), np.uint8).reshape(b[0], -1)
    out = np.zeros((places.shape[1], 8), np.uint8)
    out[:, :b[0]] = places.T
    return out.view("<i8").reshape(-1)


def _pack_ids(ids: np.ndarray, buckets: int) -> bytes:
    """Ids of one bucket, equal modulo ``buckets``."""
    return _pack(np.concatenate([[buckets, ids[0] % buckets], ids // buckets]))


def _unpack_ids(b: bytes) -> np.ndarray:
    v = _unpack(b)
    return v[2:] * v[0] + v[1]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of phrases; numbers are even over the buckets, so these are, too,
    whatever one number they share."""
    return ((key >> 31) + (key & _LAST)) % buckets


def _pack_keys(key: np.ndarray, buckets: int) -> tuple[bytes, bytes]:
    """``heads, lasts`` of the sorted keys of one bucket, which tells each last
    number modulo ``buckets``."""
    rest = (key & _LAST) // buckets
    return _pack(np.diff(key >> 31, prepend=0)), _pack(np.concatenate([[buckets, _bucket(key[:1], buckets)[0]], rest]))


def _unpack_keys(heads: bytes, lasts: bytes) -> np.ndarray:
    head, v = np.cumsum(_unpack(heads)), _unpack(lasts)
    return head << 31 | (v[2:] * v[0] + (v[1] - head) % v[0])


class _Shard:
    """Words of one language as numbers, piece by piece."""

    def __init__(self):
        self.of: dict[bytes, int] = defaultdict()
        self.of.default_factory = self.of.__len__
        self.of[_BREAK], self.of[b""]  # 0 and 1
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, body: bytes) -> None:
        ws = body.replace(_BREAK, b" \n ").split(b" ")
        ids = np.fromiter(map(self.of.__getitem__, ws), np.int32, len(ws))
        ids = ids[ids != 1]
        self.words += int(np.count_nonzero(ids))
        self.parts += [ids, np.zeros(1, np.int32)]

    def row(self, number: int, lang: str) -> tuple:
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids, minlength=len(self.of))
        order = np.argsort(-counts[2:], kind="stable") + 2
        to = np.zeros(len(counts), np.int64)
        to[order] = np.arange(2, len(counts))
        words = list(self.of)
        return number, lang, self.words, zlib.compress(_BREAK.join([words[i] for i in order])), _pack(counts[order]), _pack(to[ids])


def _words(b: bytes) -> list[str]:
    """Words that were joined by breaks; none is empty."""
    joined = zlib.decompress(b).decode()
    return joined.split("\n") if joined else []


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``shard, lang, n, words, counts, body``: the documents as numbers over
    each shard's own words (number i is word ``i - 2`` of ``words``, 0 a break);
    the last three are packed."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), text_of(docs, text_col).alias("body"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[str, _Shard] = {}

        def out(lang: str) -> pd.DataFrame:
            nonlocal number
            number += 1
            return pd.DataFrame([open_.pop(lang).row(number, lang)], columns=["shard", "lang", "n", "words", "counts", "body"])

        for b in batches:
            for lang, text in zip(b["lang"], b["body"], strict=True):
                body = text.encode().translate(_BYTES)
                while body:
                    end = len(body) if len(body) <= 4 * SOME else body.find(_BREAK, 4 * SOME) + 1 or len(body)
                    open_.setdefault(lang, _Shard()).add(body[:end])
                    body = body[end:]
                    if open_[lang].words >= shard_words:
                        yield out(lang)
                if sum(s.words for s in open_.values()) >= 2 * shard_words:
                    yield out(max(open_, key=lambda k: open_[k].words))
        for lang in list(open_):
            yield out(lang)

    return rows.mapInPandas(read, "shard long, lang string, n long, words binary, counts binary, body binary")


_PACKED = "lang string, bucket int, shard long, heads binary, lasts binary, counts binary"
_FREQUENT = "lang string, shard long, heads binary, lasts binary, ids binary, counts binary"


def pack_words(parts: DataFrame, buckets: int) -> DataFrame:
    """``lang, bucket, shard, at, words, counts``: every shard's own words, packed
    per bucket."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, shard, words, counts in b.itertuples(index=False):
                words, counts = np.asarray(_words(words), object), _unpack(counts)
                of = (pd.util.hash_array(words, categorize=False) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(of, kind="stable")
                rows = [(lang, int(of[order[i]]), shard, _pack(np.diff(order[i:j], prepend=0)), zlib.compress("\n".join(words[order[i:j]]).encode()), _pack(counts[order[i:j]]))
                        for i, j in _blocks_of(of[order])]
                yield pd.DataFrame(rows, columns=["lang", "bucket", "shard", "at", "words", "counts"])

    return parts.select("lang", "shard", "words", "counts").mapInPandas(pack, "lang string, bucket int, shard long, at binary, words binary, counts binary")


def frequent_words(packed: DataFrame, least: int, buckets: int) -> DataFrame:
    """Bucket by bucket the words that all shards together hold ``least`` times.
    Per shard ``at, ids``: its frequent words and their ids; and one row without
    a shard, ``words, f, own`` (the words, their counts and ids)."""

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        lists = [_words(w) for w in g["words"]]
        code, words = pd.factorize(np.array([w for ws in lists for w in ws], object))
        f = np.zeros(len(words), np.int64)
        np.add.at(f, code, np.concatenate([_unpack(c) for c in g["counts"]]))
        often = np.flatnonzero(f >= least)
        often = often[np.argsort(-f[often], kind="stable")]  # small numbers for frequent words
        ids = np.full(len(words), -1, np.int64)
        ids[often] = np.arange(len(often)) * buckets + g["bucket"].iloc[0]
        rows, pos = [(None, None, None, list(words[often]), f[often].tolist(), ids[often].tolist())] if len(often) else [], 0
        for shard, at, ws in zip(g["shard"], g["at"], lists, strict=True):
            mine = ids[code[pos:pos + len(ws)]]
            pos += len(ws)
            if (mine >= 0).any():
                there = np.cumsum(_unpack(at))[mine >= 0]
                rows.append((shard, _pack(np.diff(there, prepend=0)), _pack_ids(mine[mine >= 0], buckets), None, None, None))
        out = pd.DataFrame(rows, columns=["shard", "at", "ids", "words", "f", "own"])
        return out.astype({"shard": "Int64"}).assign(lang=g["lang"].iloc[0])

    return packed.groupBy("lang", "bucket").applyInPandas(
        merge, "shard long, at binary, ids binary, words array<string>, f array<long>, own array<int>, lang string")


def index_shards(parts: DataFrame, frequent: DataFrame) -> DataFrame:
    """``shard, lang, body, words``: what the index of every shard is made of, its
    text and those of its words that ``frequent (shard, at, ids)`` names.  The
    words are stored beside the text, in buckets of shards as ``parts`` is."""
    ship(parts.sparkSession)
    known = store(frequent.groupBy("shard").agg(F.collect_list(F.struct("at", "ids")).alias("words")), "phrase-known", "shard")
    return parts.select("shard", "lang", "body").join(known, "shard")


def _text_of(body: bytes, words: list) -> tuple[np.ndarray, np.ndarray]:
    """A shard's text over its frequent words, and their ids; any other word is a break."""
    text = _unpack(body)
    at = np.concatenate([np.cumsum(_unpack(k["at"])) for k in words])
    ids = np.concatenate([_unpack_ids(k["ids"]) for k in words])
    order = np.argsort(at)
    to = np.zeros(max(text.max(initial=0), at.max(initial=0) + 2) + 1, np.int32)
    to[at[order] + 2] = np.arange(1, len(ids) + 1)
    text = to[text]
    text = text[np.concatenate([[True], (text[1:] > 0) | (text[:-1] > 0)])]  # one break is enough
    return np.concatenate([[0], text, [0]]).astype(np.int32), ids[order]


class _Levels:
    """The frequent phrases of one shard, length by length: sorted keys
    ``id of all but the last word << 31 | id of the last word`` and their ids."""

    def __init__(self, ids: np.ndarray):
        self.words, self.keys, self.ids = ids, [], []

    def add(self, parts: list[tuple[bytes, bytes, bytes]]) -> None:
        keys = np.concatenate([_unpack_keys(h, x) for h, x, _ in parts] or [np.zeros(0, np.int64)])
        ids = np.concatenate([_unpack_ids(i) for _, _, i in parts] or [np.zeros(0, np.int64)])
        order = np.argsort(keys)
        self.keys.append(keys[order])
        self.ids.append(ids[order])

    def numbers(self, phrase: np.ndarray) -> np.ndarray:
        """The ids of phrases (rows of the shard's words); -1 where one is not frequent."""
        words = self.words[phrase - 1]
        out = words[:, 0]
        for m in range(1, words.shape[1]):
            keys, ids = self.keys[m - 1], self.ids[m - 1]
            if not len(keys):
                return np.full(len(words), -1, np.int64)
            want = out << 31 | words[:, m]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            out = np.where((out >= 0) & (keys[at] == want), ids[at], -1)
        return out


def phrases_of(index: DataFrame, frequent: dict[int, DataFrame], size: int, buckets: int) -> DataFrame:
    """``lang, bucket, shard, heads, lasts, counts``: every shard's phrases of
    ``size`` words whose parts are ``frequent`` (all shorter ones, by size), as
    sorted keys packed per bucket."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard, lang, body, words, known in b.itertuples(index=False):
                text, ids = _text_of(body, words)
                # Phrases one word shorter are extended; the last step reads its own side only.
                fm = BiIndex(BiIndex.transforms(text, size - 1, (0, 1) if size > 2 else (1,)), len(ids))
                found, levels = fm.words(), _Levels(ids)
                for m in range(2, size):
                    levels.add([(k["heads"], k["lasts"], k["ids"]) for k in known if k["size"] == m])
                    found = fm.extend(found, 1 - m % 2, lambda p: levels.numbers(p) >= 0)  # in turn after and before
                keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                both = (lambda p: levels.numbers(p[:, 1:]) >= 0) if size > 2 else None
                for _, _, count, _, phrase in fm.longer(found, 1 - size % 2, both):
                    head = levels.numbers(phrase[:, :-1])
                    at = head >= 0
                    keys.append(head[at] << 31 | ids[phrase[at, -1] - 1])
                    counts.append(count[at])
                key, count = np.concatenate(keys), np.concatenate(counts)
                of = _bucket(key, buckets)
                order = np.lexsort((key, of))
                key, count, of = key[order], count[order], of[order]
                rows = [(lang, int(of[i]), shard, *_pack_keys(key[i:j], buckets), _pack(count[i:j])) for i, j in _blocks_of(of)]
                yield pd.DataFrame(rows, columns=["lang", "bucket", "shard", "heads", "lasts", "counts"])

    if size == 2:
        entry = "array<struct<size:int,heads:binary,lasts:binary,ids:binary>>"
        return index.select("shard", "lang", "body", "words", F.lit(None).cast(entry).alias("known")).mapInPandas(walk, _PACKED)
    parts = [frequent[m].where("shard IS NOT NULL").select("shard", F.struct(F.lit(m).alias("size"), "heads", "lasts", "ids").alias("k")) for m in range(2, size)]
    known = reduce(DataFrame.union, parts).groupBy("shard").agg(F.collect_list("k").alias("known"))
    # Nothing of this size stands where nothing one word shorter is frequent.
    return index.join(known, "shard").select("shard", "lang", "body", "words", "known").mapInPandas(walk, _PACKED)


def _blocks_of(of: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else [0]
    yield from zip(cuts, cuts[1:], strict=False)


def frequent_phrases(packed: DataFrame, least: int, buckets: int) -> DataFrame:
    """Bucket by bucket the phrases that all shards together hold ``least`` times:
    per shard ``heads, lasts, ids`` of its own, and one row without a shard of all, with
    ``counts``.  There are at most ``1 / least`` as many as words, so ids fit 31 bits."""

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack_keys(h, x) for h, x in zip(g["heads"], g["lasts"], strict=True)]
        every, code = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, code, np.concatenate([_unpack(c) for c in g["counts"]]))
        often = np.flatnonzero(total >= least)
        ids = np.full(len(every), -1, np.int64)
        ids[often] = np.arange(len(often)) * buckets + g["bucket"].iloc[0]
        rows = [(None, *_pack_keys(every[often], buckets), _pack_ids(ids[often], buckets), _pack(total[often]))] if len(often) else []
        pos = 0
        for shard, k in zip(g["shard"], keys, strict=True):
            mine = ids[code[pos:pos + len(k)]]
            pos += len(k)
            if (mine >= 0).any():
                rows.append((shard, *_pack_keys(k[mine >= 0], buckets), _pack_ids(mine[mine >= 0], buckets), None))
        out = pd.DataFrame(rows, columns=["shard", "heads", "lasts", "ids", "counts"]).astype({"shard": "Int64"})
        return out.assign(lang=g["lang"].iloc[0])[["lang", "shard", "heads", "lasts", "ids", "counts"]]

    return packed.groupBy("lang", "bucket").applyInPandas(merge, _FREQUENT)


def listed_phrases(frequent: DataFrame) -> DataFrame:
    """``lang, id, head, last, a`` of every frequent phrase of one size."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, heads, lasts, ids, counts in b.itertuples(index=False):
                key = _unpack_keys(heads, lasts)
                yield pd.DataFrame({"lang": lang, "id": _unpack_ids(ids).astype(np.int32), "head": (key >> 31).astype(np.int32),
                                    "last": (key & _LAST).astype(np.int32), "a": _unpack(counts)})

    return frequent.where("shard IS NULL").select("lang", "heads", "lasts", "ids", "counts").mapInPandas(read, "lang string, id int, head int, last int, a long")


def phrase_counts(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, shard_words: int = SHARD_WORDS,
                  text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(totals, words, phrases)``: ``lang, n``; ``lang, word, f, id`` of words
    with ``f >= least`` (ids are unique in a language); ``lang, phrase, a, inside`` of phrases of 2 to ``depth``
    words with ``a >= least``, where ``phrase`` holds word ids and ``inside`` tells
    whether a longer phrase within ``depth`` has the same count."""
    spark = docs.sparkSession
    parts = store(shards(docs, shard_words, text_col, lang_col), "phrase-shards", "shard")
    read_once = stored_paths(spark)[-1:]
    totals = store(parts.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, n // BUCKET_WORDS)
    often = store(frequent_words(pack_words(parts, buckets), least, buckets), "phrase-words")
    listed = often.where("shard IS NULL").select("lang", F.explode(F.arrays_zip("words", "f", "own")).alias("w"))
    words = listed.select("lang", F.col("w.words").alias("word"), "w.f", F.col("w.own").alias("id"))
    index = index_shards(parts, often.where("shard IS NOT NULL").select("shard", "at", "ids"))
    read_once += stored_paths(spark)[-1:]

    frequent: dict[int, DataFrame] = {}
    spelled = words.select("lang", "id", F.array("id").alias("phrase"))
    found = []
    for size in range(2, depth + 1):
        frequent[size] = store(frequent_phrases(phrases_of(index, frequent, size, buckets), least, buckets), "phrase-frequent")
        read_once += stored_paths(spark)[-1:]
        shorter = spelled.select("lang", F.col("id").alias("head"), F.col("phrase").alias("begin"))
        level = store(listed_phrases(frequent[size]).join(shorter, ["lang", "head"])
                      .select("lang", "id", F.concat("begin", F.array("last")).alias("phrase"), "a"), "phrase-level")
        read_once += stored_paths(spark)[-1:]
        spelled = level.select("lang", "id", "phrase")
        found.append(level.select("lang", "phrase", "a"))
    every = reduce(DataFrame.union, found) if found else spark.createDataFrame([], "lang string, phrase array<int>, a long")
    ends = every.where(F.size("phrase") > 2).select("lang", F.explode(F.array(F.expr("slice(phrase, 1, size(phrase) - 1)"), F.expr("slice(phrase, 2, size(phrase) - 1)"))).alias("phrase"), "a")
    held = ends.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    phrases = every.join(held, ["lang", "phrase"], "left").select("lang", "phrase", "a", F.coalesce(F.col("most") >= F.col("a"), F.lit(False)).alias("inside"))
    phrases = store(phrases, "phrase-counts")
    release(spark, read_once)
    return totals, words, phrases


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int | None = TOP, shard_words: int = SHARD_WORDS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the phrases that no longer
    candidate of the same count holds, each language's first ``top`` (None: all)."""
    totals, words, phrases = phrase_counts(docs, least, depth, shard_words, text_col, lang_col)
    counts = (phrases.select("lang", "phrase", "a")
              .unionByName(words.select("lang", F.array("id").alias("phrase"), F.col("f").alias("a"))))
    cuts = (phrases.where(~F.col("inside"))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
            .withColumn("head", F.expr("slice(phrase, 1, k)"))
            .withColumn("tail", F.expr("slice(phrase, k + 1, size(phrase) - k)")))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    big = "cast({} as decimal(19, 0))".format
    score = f"(cast(1000 as decimal(4, 0)) * {big('a')} * {big('n')}) div ({big('l')} * {big('r')})"
    scored = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
              .withColumn("score", F.expr(score)))
    best = (scored.groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    spelled = (best.select("lang", "phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
               .groupBy("lang", "phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("spelled")))
    rows = best.join(spelled, ["lang", "phrase"]).select("lang", F.col("spelled").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists),
grams AS (
    SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
    FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS m) AS sizes
    WHERE i + m - 1 <= len(ws)),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100),
longer AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS ws, m FROM f WHERE m >= 3),
parts AS (
    SELECT lang, a, array_to_string(ws[1:m - 1], ' ') AS phrase FROM longer
    UNION ALL
    SELECT lang, a, array_to_string(ws[2:m], ' ') FROM longer),
held AS (SELECT lang, phrase, max(a) AS a FROM parts GROUP BY lang, phrase),
candidates AS (
    SELECT f.lang, f.phrase, f.a, f.m, string_split(f.phrase, ' ') AS ws
    FROM f LEFT JOIN held ON f.lang = held.lang AND f.phrase = held.phrase
    WHERE f.m >= 2 AND (held.a IS NULL OR 100 * held.a < 100 * f.a)),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:m], ' ') AS tail
    FROM candidates AS c, (SELECT unnest([1, 2, 3, 4]) AS k) AS ks WHERE k < m),
scored AS (
    SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, n,
           CAST((1000::HUGEINT * c.a::HUGEINT * n::HUGEINT) // (h.a::HUGEINT * t.a::HUGEINT) AS BIGINT) AS score
    FROM cuts AS c
    JOIN f AS h ON h.lang = c.lang AND h.phrase = c.head
    JOIN f AS t ON t.lang = c.lang AND t.phrase = c.tail
    JOIN totals ON totals.lang = c.lang),
best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
