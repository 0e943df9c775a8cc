"""Gibberish score on random local parts vs a plain restatement of the rule."""

import random
import re
from collections import Counter

from custfold.functions import email as E

CONS = set("bcdfghjklmnpqrstvwxz")


def _restated(local):
    w = local
    for i, ch in enumerate(w):
        if ch in "._+-":
            w = w[:i]
            break
    w = w.rstrip("0123456789")
    n = len(w)
    if n < 6:
        return 0, []
    out = []
    if any(w[i] == w[i + 1] == w[i + 2] for i in range(n - 2)):
        out.append(("repeat_char", 2))
    if w[:3] == w[0] * 3 or w[:6] == w[:2] * 3:
        out.append(("repeat_unit", 3))
    v = sum(ch in "aeiouy" for ch in w)
    if v == 0:
        out.append(("no_vowels", 3))
    elif v / n < 0.15:
        out.append(("low_vowels", 2))
    if re.search("[bcdfghjklmnpqrstvwxz]{5}", w):
        out.append(("consonant_run", 2))
    if sum(w[i] in CONS and w[i + 1] in CONS for i in range(n - 1)) / (n - 1) > 0.6:
        out.append(("cc_density", 2))
    d = len(set(w)) / n
    if d <= 0.4:
        out.append(("low_diversity", 3))
    elif d <= 0.5:
        out.append(("mid_diversity", 2))
    c = Counter(w[i:i + 2] for i in range(n - 1))
    rep = sum(1 for k in c.values() if k >= 2)
    if rep >= 2:
        out.append(("repeat_bigrams", 2))
    elif rep == 1 and max(c.values()) >= 3:
        out.append(("repeat_bigram_x3", 2))
    return sum(s for _, s in out), [name for name, _ in out]


def test_random_local_parts(spark):
    rng = random.Random(11)
    alphabet = "abcdghkmsxyzaeiouy0123._-+"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 16))) for _ in range(3000)]
    words += ["abababab", "abcabcabc", "zzzzzz", "qqwwqqww", "aaabbbccc", "xyxyxyxq1"]
    df = spark.createDataFrame([(x,) for x in words], "l string")
    got = {r.l: (r.gibberish_score, list(r.gibberish_signals)) for r in E.with_gibberish(df, "l").collect()}
    bad = [(w, got[w], _restated(w)) for w in words if got[w] != _restated(w)]
    assert not bad, bad[:5]
