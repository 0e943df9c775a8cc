"""Mixing sources to target weights by cube-method balanced sampling.

A source's rate is its target over its size.  Every document is taken
``floor(rate)`` times and once more with the rest of the rate as inclusion
probability.  The cube method turns these probabilities into 0 or 1: three
undecided documents at a time move along the null space of the constraints
(number of documents, number of words), so both totals stay as they are while
at least one of the three is decided.

Documents are dealt by a hash into blocks of about ``BLOCK`` within their
source.  A block leaves at most two undecided documents, which meet in the
blocks of the next round, until a source fits one block; sources of one block
do not wait for larger ones.  ``RESERVE`` documents of each source are held
back (of several blocks each holds its share for the next round); they and what
the flight leaves are the landing problem, solved by trying its outcomes for
the word total nearest to the target.  All draws come from hashes, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own,
last in the order; a source without words has target 0 and gives nothing; a
null ``doc_id`` and repeated rows are rows like others; a very
long text is counted whole and moves as its size only; an empty table gives an
empty result; no other column of the input is read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custfold.llm.common import same_key, ship, store, table, text_of

BLOCK, RESERVE, CAP, WEIGHTS, SEED = 1024, 12, 3, (1, 2, 3), 7
TOKEN = r"[^\x20\x09-\x0D]+"
_EPS = 1e-9


def source_targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sid, source, source_size, target`` of every source.

    One row per source is ordered here (not documents).  Sources in order of
    cap over weight: each is at its cap if the words left for it and those
    after it, shared by weight, would reach the cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order)
    per = per.select("source", "source_size", rank.alias("sid"),
                     F.get(F.array(*map(F.lit, weights)), (rank - 1) % len(weights)).cast("double").alias("weight"))
    per = per.withColumn("most", (F.col("source_size") * cap).cast("double"))
    place = F.struct((F.col("most") / F.col("weight")).alias("ratio"), "sid")
    by = Window.orderBy(place)
    before, whole = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0.0)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), zero)
    share = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)
    per = per.withColumn("place", place).withColumn("level", left / share)
    open_ = F.col("weight") * F.col("level") < F.col("most")
    # The first source in that order whose cap is not reached sets the level.
    per = per.withColumn("first", F.min(F.when(open_, F.struct("place", "level"))).over(whole))
    full = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    return per.select("sid", "source", "source_size", F.when(full, F.col("most")).otherwise(F.col("weight") * F.col("first.level")).alias("target"))


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase over units in order; at most two stay undecided."""
    p = p.astype(float).tolist()
    z = size.astype(float).tolist()
    draws = rng.random(len(p) + 3).tolist()
    act: list[int] = []
    for k in range(len(p)):
        if _EPS < p[k] < 1 - _EPS:
            act.append(k)
        else:
            p[k] = float(round(p[k]))
            continue
        while len(act) == 3 or (len(act) == 2 and z[act[0]] == z[act[1]]):
            if len(act) == 3:
                a, b, c = act
                u = [z[b] - z[c], z[c] - z[a], z[a] - z[b]]
                if u[0] == u[1] == u[2] == 0:
                    u = [1.0, -1.0, 0.0]
            else:
                u = [1.0, -1.0]
            up = down = float("inf")
            for i, d in zip(act, u, strict=True):
                if d > 0:
                    up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
                elif d < 0:
                    up, down = min(up, -p[i] / d), min(down, (p[i] - 1) / d)
            step = up if draws[k] * (up + down) < down else -down
            rest = []
            for i, d in zip(act, u, strict=True):
                p[i] += step * d
                if _EPS < p[i] < 1 - _EPS:
                    rest.append(i)
                else:
                    p[i] = float(round(p[i]))
            act = rest
    return np.array(p)


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Try every outcome of the undecided units for the nearest word total,
    among outcomes within one of the expected number of documents."""
    at = np.flatnonzero((p > 0) & (p < 1))
    if not len(at):
        return p
    bits = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
    words = np.abs(bits @ size[at].astype(float) - p[at] @ size[at])
    docs = np.abs(bits.sum(1) - p[at].sum())
    order = np.lexsort((docs, np.round(words, 6), docs > 1))
    out = p.copy()
    out[at] = bits[order[0]]
    return out


def _decide(names: list[str], seed: int, level: int, block: int):
    def work(g: pd.DataFrame) -> pd.DataFrame:
        blocks = int(g["_blocks"].iloc[0])  # of this source alone
        g = g.sort_values(["_r", "doc_id", "size"], kind="stable")
        at = [seed, level, int(g["sid"].iloc[0]), int(g["_b"].iloc[0])]
        p, size = g["p"].to_numpy(copy=True), g["size"].to_numpy()
        # Kept for the landing; small blocks hold less, so that each round leaves fewer.
        held = RESERVE if blocks == 1 else -(-min(RESERVE, block // 4) // blocks)
        p[held:] = fly(p[held:], size[held:], np.random.default_rng(at))
        return g.assign(p=land(p, size) if blocks == 1 else p)[names]

    return work


def balanced(units: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``units (sid, p, size, ...)`` with every ``p`` decided to 0 or 1, the
    sums of ``p`` and of ``p * size`` kept per ``sid``."""
    ship(units.sparkSession)
    schema = units.schema
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    done, todo, level = None, units, 0
    while True:
        counts = todo.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
        blocks = store(counts.select("sid", F.ceil(F.col("n") / block).cast("long").alias("_blocks")), "mix-blocks")
        last = blocks.where("_blocks > 1").isEmpty()

        random = F.xxhash64("doc_id", "size", F.lit(seed * 1000 + level))
        dealt = todo.join(blocks, "sid").withColumn("_r", random).withColumn("_b", F.pmod(F.col("_r"), F.col("_blocks")))
        out = store(dealt.groupBy("sid", "_b").applyInPandas(_decide(schema.names, seed, level, block), schema), f"mix-level-{level}")
        ready = out.where(~undecided)
        done = ready if done is None else done.unionByName(ready)
        if last:
            return done
        todo, level = out.where(undecided), level + 1


def mix_sources(docs: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, seed: int = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every
    row: how often the mix takes it and the words that gives."""
    sizes = store(docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                              F.regexp_count(text_of(docs, text_col), F.lit(TOKEN)).cast("long").alias("size")), "mix-sizes")
    targets = store(source_targets(sizes, cap, weights), "mix-targets")
    rate = F.when(targets["source_size"] > 0, targets["target"] / targets["source_size"]).otherwise(F.lit(0.0))
    rows = (sizes.join(targets, same_key(sizes, targets, ["source"]))
            .select(sizes["doc_id"], "sid", "size", rate.alias("rate")).withColumn("whole", F.floor("rate"))
            .select("doc_id", "sid", "size", F.col("whole").cast("long").alias("whole"), (F.col("rate") - F.col("whole")).alias("p")))
    done = balanced(rows, block, seed)
    copies = (F.col("whole") + F.round("p")).cast("long")
    return done.join(targets, "sid").select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                                           (F.col("size") * copies).alias("taken"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
