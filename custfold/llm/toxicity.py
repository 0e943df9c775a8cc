"""Toxicity by a subsequence string kernel with Nystrom landmarks and a
support vector machine, trained on labelled texts.

* **Kernel.**  Two strings are as similar as the weighted subsequences of
  ``P`` letters they share inside a span of ``SPAN`` characters.  A skipped
  letter weighs ``GAP``, a skipped sign (white space, digit, punctuation)
  ``SIGN``, and a landmark's own subsequences skip one letter at most; so ``l-o-s-e-r`` and ``idiiot`` stay near ``loser``, ``idiot``.
  Letters are compared without case; bytes beyond ASCII fall in five classes.
* **Landmarks.**  Runs of 4 to 6 letters (or a word's start and the letters
  after it) that mark the toxic labels best
  (counted in Spark over the training texts), no two of them much alike.
* **Features.**  For every landmark its best kernel value over the text's
  half-overlapping windows of ``WINDOW`` bytes, and the logarithm of how many
  windows reach ``GOOD``; both whitened by the inverse root of the landmarks'
  own kernel matrix (Nystrom).
* **Machine.**  A linear SVM (squared hinge, Newton steps) on these features
  and a logistic curve on its margins.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, chosen by a hash
of ``doc_id``, never on held-out ones (``crc32(doc_id) mod 5 = 0``); it scores
every whole text.  ``lang``, ``source`` and ``doc_id`` are no inputs.

Defined cases: a null text counts as empty and scores the model's offset; a
null ``doc_id`` counts as the empty string for the fold; labels that are null
are not used; without labels of both kinds every text gets the share of toxic
labels (0 without any); an empty table gives an empty result; no other column
of the inputs is read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import ship, store, table, text_of

P, SPAN, GAP, SIGN, WINDOW, GOOD = 4, 7, 0.5, 0.9, 16, 0.7
TRAIN_ROWS, LANDMARKS, LEAST_DOCS, ALIKE, COST = 8000, 48, 4, 0.3, 10.0
RUNS = (4, 5, 6)
SEGMENT = 1 << 19

#: Letter classes of bytes: 0 sign, 1-26 letters, 27-31 bytes beyond ASCII.
_CLASS = np.zeros(256, dtype=np.uint32)
_CLASS[0x61:0x7B] = _CLASS[0x41:0x5B] = np.arange(1, 27)
_CLASS[0x80:] = 27 + np.arange(128) % 5
_OFFSETS = [(0, *rest) for rest in itertools.combinations(range(1, SPAN), P - 1)]


def classes(raw: bytes) -> np.ndarray:
    return _CLASS[np.frombuffer(raw, np.uint8)]


def subsequences(letters: tuple[int, ...]) -> dict[int, float]:
    """Weights of the ``P``-letter subsequences of a run of letters."""
    out: dict[int, float] = {}
    for i in range(len(letters)):
        for off in _OFFSETS:
            if i + off[-1] < len(letters):
                code = 0
                for o in off:
                    code = code << 5 | letters[i + o]
                out[code] = out.get(code, 0.0) + GAP ** (off[-1] + 1 - P)
    return out


def kernel(a: dict[int, float], b: dict[int, float]) -> float:
    return sum(w * b.get(u, 0.0) for u, w in a.items())


@dataclass(frozen=True)
class Model:
    landmarks: tuple[tuple[int, ...], ...]
    weights: tuple[float, ...]
    offset: float
    slope: float
    shift: float
    prior: float


class Features:
    """Best kernel value of each landmark over the windows of texts."""

    _built: dict = {}

    def __init__(self, landmarks: tuple[tuple[int, ...], ...]):
        self.m = len(landmarks)
        entries = []
        for j, x in enumerate(landmarks):
            subs = subsequences(x)
            entries += [(u, j, w / kernel(subs, subs)) for u, w in subs.items() if w >= GAP]
        entries.sort()
        self.codes, self.first, self.times = np.unique(np.array([e[0] for e in entries], dtype=np.int64), return_index=True, return_counts=True)
        self.mark = np.array([e[1] for e in entries], dtype=np.int64)
        self.weight = np.array([e[2] for e in entries])
        self.known = np.zeros(1 << 5 * P, dtype=bool)
        self.known[self.codes] = True

    @classmethod
    def of(cls, landmarks: tuple[tuple[int, ...], ...]) -> Features:
        if landmarks not in cls._built:
            cls._built.clear()
            cls._built[landmarks] = cls(landmarks)
        return cls._built[landmarks]

    def _hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, landmarks and weights of shared subsequences."""
        n = len(c) - SPAN
        letter = np.concatenate([[0], np.cumsum(c > 0)])
        pairs = {d: (c[: len(c) - d] << np.uint32(5)) | c[d:] for d in range(1, SPAN - 2)}
        at, mark, weight = [], [], []
        for off in _OFFSETS:
            code = (pairs[off[1]][:n] << np.uint32(10)) | pairs[off[3] - off[2]][off[2]: off[2] + n]
            pos = np.flatnonzero(self.known[code])
            if not len(pos):
                continue
            skipped = letter[pos + off[3] + 1] - letter[pos] - P + (c[pos] == 0)
            w = GAP ** skipped * SIGN ** (off[3] + 1 - P - skipped.astype(float))
            e = np.searchsorted(self.codes, code[pos])
            times = self.times[e]
            slot = np.repeat(self.first[e] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            at.append(np.repeat(pos, times))
            mark.append(self.mark[slot])
            weight.append(np.repeat(w, times) * self.weight[slot])
        if not at:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        return np.concatenate(at), np.concatenate(mark), np.concatenate(weight)

    def _best(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Best window and number of good windows of texts that are padded to
        whole windows."""
        raw = b"".join(texts)
        at, mark, weight = self._hits(classes(raw + b" " * SPAN))
        begin = np.cumsum([0, *(len(t) // WINDOW for t in texts[:-1])])
        best, many = np.zeros((2, len(texts), self.m))
        wide = len(raw) // WINDOW + 1
        for shift in (0, WINDOW // 2):
            total = np.bincount((at + shift) // WINDOW * self.m + mark, weights=weight, minlength=wide * self.m).reshape(wide, self.m)
            np.maximum(best, np.maximum.reduceat(total, begin), out=best)
            np.maximum(many, np.add.reduceat(total >= GOOD, begin, dtype=float), out=many)
        return best, many

    def __call__(self, texts: list[str]) -> np.ndarray:
        """``2 m`` features of each text: the best windows, then the logarithms
        of the numbers of good windows."""
        best, many = np.zeros((2, len(texts), self.m))
        if not self.m:
            return best
        group: list[bytes] = []
        begin = size = 0
        for i, t in enumerate(texts):
            raw = b" " + t.encode("utf-8", "replace")
            # Half a window of blanks at least, so that no window holds letters of two texts.
            raw += b" " * (WINDOW - len(raw) % WINDOW if len(raw) % WINDOW <= WINDOW // 2 else 2 * WINDOW - len(raw) % WINDOW)
            if group and size + len(raw) > SEGMENT:
                best[begin:i], many[begin:i] = self._best(group)
                group, begin, size = [], i, 0
            if len(raw) > SEGMENT:  # overlapping parts of one long text
                for lo in range(0, len(raw), SEGMENT):
                    b, n = self._best([raw[lo: lo + SEGMENT + 2 * WINDOW]])
                    best[i], many[i] = np.maximum(best[i], b[0]), many[i] + n[0]
                begin = i + 1
                continue
            group.append(raw)
            size += len(raw)
        if group:
            best[begin:], many[begin:] = self._best(group)
        return np.concatenate([best, np.log2(1 + many)], axis=1)


def runs_of(text: str) -> np.ndarray:
    """Distinct letter runs of a text, also those that begin at a word's start
    (the sign before it): five bits a letter, the length above them."""
    c = classes(b" " + text.encode("utf-8", "replace")).astype(np.int64)
    found = []
    for n in RUNS:
        if len(c) >= n:
            code, fine = np.zeros(len(c) - n + 1, dtype=np.int64), np.ones(len(c) - n + 1, dtype=bool)
            for i in range(n):
                part = c[i: len(c) - n + 1 + i]
                code, fine = code << 5 | part, fine & ((part > 0) | (i == 0))
            found.append(np.unique(code[fine]) | n << 40)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def decode(run: int) -> tuple[int, ...]:
    n = run >> 40
    return tuple(run >> 5 * (n - 1 - i) & 31 for i in range(n))


def pick_landmarks(train: DataFrame, positive: int, negative: int, most: int = LANDMARKS) -> tuple[tuple[int, ...], ...]:
    """Landmarks from ``train (body, toxic)``: the runs whose share among toxic
    texts stands out most, without near repeats."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for toxic, rows in b.groupby("toxic")["body"]:
                names, n = np.unique(np.concatenate([runs_of(t) for t in rows]), return_counts=True)
                yield pd.DataFrame({"run": names, "a": n * int(toxic), "b": n * (1 - int(toxic))})

    a, b = F.col("a") / F.lit(positive), F.col("b") / F.lit(negative)
    pooled = (F.col("a") + F.col("b")) / F.lit(positive + negative)
    score = (a - b) / F.sqrt(pooled * (1 - pooled) + F.lit(1e-12))
    counts = train.mapInPandas(count, "run long, a long, b long").groupBy("run").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    top = (counts.where((F.col("a") >= LEAST_DOCS) & (a > 2 * b)).withColumn("score", F.round(score, 9))
           .orderBy(F.desc("score"), F.desc("run")).limit(40 * most).collect())
    chosen: list[tuple[tuple[int, ...], dict, float]] = []
    for r in top:
        x = decode(r["run"])
        s = subsequences(x)
        own = kernel(s, s)
        if all(kernel(s, t) <= ALIKE * (own * k) ** 0.5 for _, t, k in chosen):
            chosen.append((x, s, own))
            if len(chosen) == most:
                break
    return tuple(x for x, *_ in chosen)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = COST) -> np.ndarray:
    """Weights and offset of a squared-hinge SVM (primal Newton steps)."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.r_[np.ones(x.shape[1] - 1), 1e-6]
    for _ in range(50):
        on = y * (x @ w) < 1
        new = np.linalg.solve(np.diag(ridge) + 2 * cost * x[on].T @ x[on], 2 * cost * x[on].T @ y[on])
        if np.allclose(new, w, atol=1e-10):
            break
        w = new
    return w


def fit_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve ``1 / (1 + exp(-(slope * margin + shift)))`` on margins,
    with targets drawn in a little as usual for margins of the same rows."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z, x = np.array([1.0, 0.0]), np.c_[margin, np.ones(len(margin))]
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ z, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (t - q))
        z = z + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    return float(z[0]), float(z[1])


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def train_model(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``rows`` labelled rows outside the held-out fold."""
    ship(docs.sparkSession)
    known = labels.select(labels["doc_id"], labels["toxic"].cast("int").alias("toxic")).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = store(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "toxic-labels")
    body = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("body"))
    train = store(body.join(sample, "doc_id").select("doc_id", "body", "toxic").limit(2 * rows), "toxic-train")
    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, negative = n.get(1, 0), n.get(0, 0)
    prior = positive / (positive + negative) if n else 0.0
    marks = pick_landmarks(train, positive, negative) if positive and negative else ()
    if not marks:
        return Model((), (), 0.0, 0.0, 0.0, prior)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(Features.of(marks)(texts.tolist())))

    got = train.select(features("body").alias("f"), "toxic").collect()  # bounded: 4 * rows * LANDMARKS numbers
    got.sort()
    f, y = np.array([r["f"] for r in got]), np.array([2 * r["toxic"] - 1 for r in got], dtype=float)
    subs = [subsequences(x) for x in marks]
    own = np.array([kernel(s, s) for s in subs])
    gram = np.array([[kernel(s, t) for t in subs] for s in subs]) / np.sqrt(np.outer(own, own))
    value, vector = np.linalg.eigh(gram)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    both = np.kron(np.eye(2), root)
    w = fit_svm(f @ both, y)
    weights, offset = both @ w[:-1], w[-1]
    slope, shift = fit_curve(f @ weights + offset, y)
    return Model(marks, tuple(map(float, weights)), float(offset), slope, shift, prior)


def toxic_score(model: Model, text: Column) -> Column:
    """Score 0 to 1 of a text column under a fitted model."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, weights = Features.of(model.landmarks), np.array(model.weights)
        for s in texts:
            if not model.landmarks:
                yield pd.Series(np.full(len(s), model.prior))
                continue
            margin = features(s.tolist()) @ weights + model.offset
            yield pd.Series(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30))))

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    model = train_model(docs, labels, id_col=id_col, text_col=text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("body"))
    return (rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), toxic_score(model, F.col("body")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, columns unchanged."""
    model = train_model(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(toxic_score(model, text_of(docs, text_col)) < 0.5)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, learned from ``labels``."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
