"""N-gram Jaccard join by chosen paths.

Sets are the five-word shingles of a text; pairs of Jaccard similarity 0.8 or
more are links.  Texts of equal sets form one class and are joined once.

* **Split.**  In each run every set starts in one root bucket and moves to the
  buckets of the shingles it samples: shingle ``j`` of a set of ``n`` is taken
  where ``hash(run, j) < 1 / (0.8 n)``.  Two sets of similarity 0.8 or more
  share at least one taken shingle on average, two that share little almost
  none.  Buckets of more than ``LEAF`` sets are split again the same way with
  a hash of the path so far, down to ``DEPTH`` levels, unless their sets are
  alike: splitting cannot reduce such a bucket and would only repeat its sets.
  A bucket's sets are alike where their sketches agree in most of ``BITS`` bits.
* **Brute force.**  All pairs of a small bucket are compared.  A large bucket
  of alike sets, or at the last level, is compared in cells of two blocks of at
  most about ``LEAF`` sets each, so no task holds a large bucket.  A pair that meets in several buckets counts in the one of the
  smallest path only.  A 64-bin sketch first drops members without any likely
  partner; what remains is compared on its whole sets, exactly.
* **Repeat.**  The number of runs follows from the target recall: a pair at
  the threshold survives ``d`` levels with probability
  ``p(d) = 1 - exp(-p(d-1))``, ``p(0) = 1``, in each run.

Pairs are never emitted: a cell yields per member its number of links and the
root of its part of the bucket; classes of linked texts come from those edges
by min-label rounds with pointer jumping, on tables in the shared folder.

Defined cases: a null or wordless text has no shingles and no links; a text
of one to four words has one shingle; rows that repeat a ``doc_id`` and text
count as rows; a null ``doc_id`` comes last when a class is named; a very long text is
cut into shingles whole, in segments, and its set moves only where it has a likely
partner; an empty table gives an empty result; no other column of the input is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import doc_hash, same_key, ship, sift, store, table, text_of
from custfold.llm.shingles import mix, shingle_sets

THRESHOLD, LEAF, DEPTH, RECALL = 0.8, 128, 3, 0.995
BINS, LIKELY = 64, 0.58
#: One bit of so many bins tells whether a bucket's sets agree: nearly all sets
#: have the same bit for near copies, about half of them for other sets.  Empty
#: bins tell nothing and count as no agreement.
BITS, ALIKE = 16, 0.6
_U = np.uint64


def runs_for(recall: float, depth: int = DEPTH) -> int:
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def sketch(s: np.ndarray) -> np.ndarray:
    """Per bin (top 6 bits) eight bits of the smallest hash; 0: empty bin."""
    edges = np.arange(BINS, dtype=np.uint64) << _U(58)
    at = np.minimum(np.searchsorted(s, edges), len(s) - 1)
    low = s[at]
    value = ((low >> _U(20)) % _U(255) + _U(1)).astype(np.uint8)
    return np.where(low >> _U(58) == np.arange(BINS, dtype=np.uint64), value, 0).astype(np.uint8)


def bits_of(sk: np.ndarray) -> int:
    """Of every fourth bin of a sketch the lowest bit, and above these bits
    whether the bin is filled, as one number."""
    bins = sk[::BINS // BITS].astype(np.int64)
    return int(((bins & 1) << np.arange(BITS)).sum() | ((bins > 0).astype(np.int64) << np.arange(BITS, 2 * BITS)).sum())


def _agreement(bits: str = "bits") -> Column:
    """How far the sets of a bucket agree in their bits: 0 (not) to 1 (all)."""
    def surplus(i: int) -> Column:
        one, filled = f"(({bits} >> {i}) & 1)", f"(({bits} >> {BITS + i}) & 1)"
        return F.abs(F.expr(f"sum(2 * {one} - {filled})"))

    return sum((surplus(i) for i in range(1, BITS)), surplus(0)) / (F.count(F.lit(1)) * BITS)


def _limit(n: int, threshold: float) -> np.uint64:
    return _U(min((1 << 64) - 1, int((1 << 64) / (threshold * n))))


def chosen(s: np.ndarray, paths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of ``paths`` for the set ``s``: index of the parent, path."""
    if not len(s) or not len(paths):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    limit, up, out = _limit(len(s), threshold), [], []
    step = max(1, (1 << 18) // max(1, len(s)))
    for lo in range(0, len(paths), step):
        h = mix(s[None, :] ^ mix(paths[lo:lo + step])[:, None])
        i, j = np.nonzero(h < limit)
        up.append(i + lo)
        out.append(mix(h[i, j] + paths[lo:lo + step][i] * _U(0x9E3779B97F4A7C15)))
    return np.concatenate(up), np.concatenate(out)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _signer(runs: int, threshold: float, depth: int):
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, sketches, bits = [], [], [], []
            levels: list[list[list[np.ndarray]]] = [[[], []] for _ in range(depth)]
            for s in shingle_sets(b.column("body").to_pylist()):
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                sk = sketch(s) if len(s) else np.zeros(0, np.uint8)
                sketches.append(sk.tobytes())
                bits.append(bits_of(sk) if len(s) else 0)
                paths = roots if len(s) else roots[:0]
                for up, at in levels:
                    parent, paths = chosen(s, paths, threshold)
                    up.append(parent.astype(np.int32))
                    at.append(paths.view(np.int64))
            cols = [b.column("doc_id"), b.column("_h"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), pa.array(bits, pa.int64())]
            names = ["doc_id", "_h", "k", "n", "sketch", "bits"]
            for d, (up, at) in enumerate(levels, 1):
                cols += [_lists(up, pa.int32()), _lists(at, pa.int64())]
                names += [f"up{d}", f"p{d}"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return sign


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of batches that are sorted by ``keys``."""
    left: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([left, t]).combine_chunks() if left is not None else t
        if not len(t):
            continue
        change = np.zeros(len(t) - 1, dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield t.slice(lo, hi - lo)
        left = t.slice(cuts[-1])
    if left is not None and len(left):
        yield left


def _owned_pairs(path: int, blocks: np.ndarray, paths: list[list[int]]) -> np.ndarray:
    """Pairs of this cell that share no smaller path than this one."""
    m = len(paths)
    pairs = np.triu(np.ones((m, m), dtype=bool), 1)
    pairs |= pairs.T
    if blocks.min() != blocks.max():
        pairs &= blocks[:, None] != blocks[None, :]
    smaller = [[p for p in ps if p < path] for ps in paths]
    names, at = np.unique(np.array([p for ps in smaller for p in ps], dtype=np.int64), return_inverse=True)
    if len(names):
        has = np.zeros((m, len(names)), dtype=np.float32)
        has[np.repeat(np.arange(m), [len(ps) for ps in smaller]), at] = 1
        pairs &= (has @ has.T) == 0
    return pairs


def _prefilter(threshold: float):
    keys = ["path", "bi", "bj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        rows = 0
        for g in by_group(batches, keys):
            m = len(g)
            if m < 2:
                continue
            sk = np.frombuffer(b"".join(g.column("sketch").to_pylist()), np.uint8).reshape(m, BINS)
            n = g.column("n").to_numpy()
            pairs = np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :])
            same = np.zeros((m, m), dtype=np.int16)
            used = np.zeros((m, m), dtype=np.int16)
            for c in range(0, BINS, 8):
                x, y = sk[:, None, c:c + 8], sk[None, :, c:c + 8]
                some = (x | y) != 0
                used += some.sum(2, dtype=np.int16)
                same += ((x == y) & some).sum(2, dtype=np.int16)
            pairs &= same >= LIKELY * used
            np.fill_diagonal(pairs, False)
            if not pairs.any():
                continue
            pairs &= _owned_pairs(g.column("path")[0].as_py(), g.column("block").to_numpy(), g.column("paths").to_pylist())
            stay = np.flatnonzero(pairs.any(1))
            if len(stay):
                kept.append(g.select(["path", "bi", "bj", "block", "k"]).take(pa.array(stay)))
                rows += len(stay)
                if rows > 8192:
                    yield from pa.concat_tables(kept).combine_chunks().to_batches()
                    kept, rows = [], 0
        if kept:
            yield from pa.concat_tables(kept).combine_chunks().to_batches()

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, values[1:] != values[:-1]] if len(values) else np.empty(0, bool)
    ids = np.cumsum(new) - 1
    shared = np.bincount(ids, minlength=1)[ids] > 1
    ids, owner = np.unique(ids[shared], return_inverse=True)[1], owner[shared]
    out = np.zeros((m, m), dtype=np.int64)
    step = 1 << 13
    bounds = np.searchsorted(ids, np.arange(0, (ids[-1] + 1 if len(ids) else 0) + step, step))
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        if hi > lo:
            a = np.zeros((m, step), dtype=np.float32)
            a[owner[lo:hi], ids[lo:hi] % step] = 1
            out += (a @ a.T).astype(np.int64)
    return out


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for g in by_group(batches, ["path", "bi", "bj"]):
            ks = g.column("k").to_pylist()
            first = list({k: i for i, k in reversed(list(enumerate(ks)))}.values())  # repeated rows: one each
            if len(first) < 2:
                continue
            g = g.take(pa.array(sorted(first)))
            ks, copies = g.column("k").to_pylist(), g.column("copies").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in g.column("body").to_pylist()]
            n = np.array([len(s) for s in sets])
            both = overlaps(sets)
            links = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-9
            links &= _owned_pairs(g.column("path")[0].as_py(), g.column("block").to_numpy(), g.column("paths").to_pylist())
            if not links.any():
                continue
            label = np.arange(len(ks))
            while True:  # smallest index that each member reaches
                low = np.minimum(label, np.where(links, label[None, :], len(ks)).min(1))
                if (low == label).all():
                    break
                label = low
            for i in np.flatnonzero(links.any(1)):
                out.append((ks[i], int(copies[links[i]].sum()), ks[label[i]]))
            if len(out) > 8192:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return run


def _edges(rows: list[tuple]) -> pa.RecordBatch:
    k, links, root = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())], names=["k", "links", "root"])


def connected(edges: DataFrame) -> DataFrame:
    """``v, c``: every endpoint of ``edges (u, v)`` with the smallest vertex of
    its component, by min-label rounds with pointer jumping."""
    # One star step first: each vertex points at its smallest root, and its
    # other roots at that one, so many roots of a large group become few edges.
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    edges = (edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
             .where("u <> v").distinct())
    both = store(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    label = store(both.groupBy("v").agg(F.min("u").alias("c")).select("v", F.least("v", "c").alias("c")), "cc-labels")
    while True:
        near = (both.join(label.select(F.col("v").alias("u"), "c"), "u").groupBy("v").agg(F.min("c").alias("m")))
        # Written, so that the next join deals both sides anew and a hot root is split.
        step = store(label.join(near, "v").select("v", "c", F.least("c", "m").alias("m")), "cc-step")
        up = step.select(F.col("v").alias("m"), F.col("m").alias("to"))
        new = store(step.join(up, "m").select("v", "c", F.least("m", "to").alias("m")), "cc-labels")
        done = new.where("m <> c").isEmpty()
        label = new.select("v", F.col("m").alias("c"))
        if done:
            return label


def _buckets(one: DataFrame, leaf: int, depth: int) -> DataFrame:
    """``k, path, cnt`` of all leaves with more than one set."""
    leaves, big = None, None
    for d in range(1, depth + 1):
        above = F.col("up1").cast("array<long>")
        if d > 1:
            parents = F.col(f"p{d - 1}")
            above = F.transform(f"up{d}", lambda i: F.get(parents, i))  # noqa: B023
        rows = one.select("k", "bits", F.explode(F.arrays_zip(above.alias("parent"), F.col(f"p{d}").alias("path"))).alias("e")).select("k", "bits", "e.parent", "e.path")
        if big is not None:
            # Read twice below, by the counts and by the leaves.
            rows = store(rows.join(big.select(F.col("path").alias("parent")), "parent").select("k", "bits", "path"), f"bucket-rows-{d}")
        counts = store(rows.groupBy("path").agg(F.count(F.lit(1)).alias("cnt"), _agreement().alias("alike")).where("cnt > 1"), f"bucket-sizes-{d}")
        splits = (F.col("cnt") > leaf) & (F.col("alike") < ALIKE) if d < depth else F.lit(False)
        found = rows.join(counts.where(~splits), "path").select("k", "path", "cnt")
        leaves = found if leaves is None else leaves.unionByName(found)
        big = counts.where(splits)
    return leaves


def similar_texts(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, leaf: int = LEAF, depth: int = DEPTH,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, _h, class_id, class_h, n_links`` of every row: the class of
    linked texts, named by its first document, and the number of other rows
    whose text is linked to this one."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("_h"), text.alias("body"))
    runs = runs_for(recall, depth)
    schema = f"doc_id {kind}, _h long, k binary, n int, sketch binary, bits long, " + ", ".join(f"up{d} array<int>, p{d} array<long>" for d in range(1, depth + 1))
    signed = store(rows.mapInArrow(_signer(runs, threshold, depth), schema), "join-signatures")

    name = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_h")
    cols = ["n", "sketch", "bits", *(f"{x}{d}" for d in range(1, depth + 1) for x in ("up", "p"))]
    one = store(signed.where("n > 0").groupBy("k").agg(F.min(name).alias("name"), F.count(F.lit(1)).alias("copies"),
                                                         F.first(F.struct(*cols)).alias("s")).select("k", "name", "copies", "s.*"), "join-sets")
    leaves = _buckets(one, leaf, depth)
    per_set = store(leaves.groupBy("k").agg(F.collect_list(F.struct("path", "cnt")).alias("at")), "join-members")

    cells = (one.select("k", "n", "sketch").join(per_set, "k")
             .select("k", "n", "sketch", F.transform("at", lambda x: x["path"]).alias("paths"), F.explode("at").alias("e"))
             .withColumn("blocks", F.ceil(F.col("e.cnt") / F.lit(leaf)).cast("long"))
             .withColumn("block", F.pmod(F.xxhash64("k", "e.path"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select(F.col("e.path").alias("path"), F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                     "block", "k", "n", "sketch", "paths"))
    key = ["path", "bi", "bj"]
    likely = store(cells.repartition(*key).sortWithinPartitions(*key)
                   .mapInArrow(_prefilter(threshold), "path long, bi long, bj long, block long, k binary"), "join-likely")

    # Whole sets of the members that have a likely partner, from their texts.
    wanted = (likely.groupBy("k").agg(F.collect_list(F.struct(*key, "block")).alias("cells"))
              .join(one.select("k", "name", "copies"), "k").join(per_set, "k")
              .select("k", F.col("name.doc_id").alias("doc_id"), F.col("name._h").alias("_h"), "copies", "cells",
                      F.transform("at", lambda x: x["path"]).alias("paths")))
    wanted = store(wanted, "join-wanted")
    some, _ = sift(rows, doc_hash(rows["doc_id"], rows["_h"]), wanted, doc_hash("doc_id", "_h"))
    texts = some.join(wanted.hint("shuffle_hash"), same_key(rows, wanted, ["doc_id", "_h"])).select("k", "copies", "cells", "paths", "body")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("body")
            yield b.set_column(at, pa.field("body", pa.binary()), pa.array([s.tobytes() for s in shingle_sets(b.column("body").to_pylist())], pa.binary()))

    sets = texts.mapInArrow(whole, "k binary, copies long, cells array<struct<path:long,bi:long,bj:long,block:long>>, paths array<long>, body binary")
    linked = store(sets.select("k", "copies", "paths", "body", F.explode("cells").alias("c")).select("c.*", "k", "copies", "paths", "body")
                   .repartition(*key).sortWithinPartitions(*key)
                   .mapInArrow(_verify(threshold), "k binary, links long, root binary"), "join-links")

    classes = connected(linked.where("k <> root").select(F.col("k").alias("u"), F.col("root").alias("v")).distinct())
    named = classes.withColumnRenamed("v", "k").join(one.select("k", "name"), "k").groupBy("c").agg(F.min("name").alias("first"))
    found = (one.select("k", "name", "copies").join(linked.groupBy("k").agg(F.sum("links").alias("links")), "k", "left")
             .join(classes.withColumnRenamed("v", "k"), "k", "left").join(named, "c", "left")
             .select("k", F.coalesce("first", "name").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    found = store(found, "join-classes")
    return (signed.select("doc_id", "_h", "k", "n").join(found, "k", "left")
            .select("doc_id", "_h", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                    F.coalesce("first._h", "_h").alias("class_h"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and link counts of all ``documents``."""
    return similar_texts(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
