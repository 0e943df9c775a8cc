"""Exact dedup, Jaccard join, sentence spans, mix, toxicity, token counts."""

import collections
import hashlib
import itertools
import random
import sys
import zlib

import numpy as np

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import EDGE, LONG, docs_of, edge_docs, shingles  # noqa: E402

from custfold.llm import exact_dedup, jaccard_join, sentence_dedup, source_mix, token_counts, toxicity  # noqa: E402
from custfold.llm.shingles import shingle_set, words_by_text  # noqa: E402

SF = "/root/testdata/sf0.01"


# -- exact dedup ---------------------------------------------------------

def test_filters_merge_losslessly():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 500, dtype=np.uint64)
    keys = np.concatenate([keys, (keys[:200] & np.uint64(0xFFFFFFFF00000000)) | np.uint64(5)])  # shared quotients
    parts = [rng.choice(keys, 1000) for _ in range(4)]
    want = collections.Counter(int(k) for p in parts for k in p)
    shards = collections.defaultdict(list)
    for p in parts:
        for s, *rest in exact_dedup.build_filter(p, 6):
            shards[s].append(tuple(rest))
    got = {}
    for s in shards.values():
        k, n = exact_dedup.merge_filters(s)
        assert (np.diff(k.astype(object)) > 0).all()
        got.update(zip(map(int, k), map(int, n), strict=True))
    assert got == want


def test_exact_dedup_edges(spark):
    got = exact_dedup.exact_duplicates(edge_docs(spark)).collect()
    texts = collections.defaultdict(list)
    for i, t, _ in EDGE:
        texts[t or ""].append(i)
    assert len(got) == len(EDGE)
    by_sha = collections.defaultdict(list)
    for r in got:
        by_sha[r["text_sha256"]].append(r)
    for t, ids in texts.items():
        rows = by_sha[hashlib.sha256(t.encode()).hexdigest()]
        top = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids))
        assert all(r["group_size"] == len(ids) and r["keep_id"] == top for r in rows)
        assert [r["doc_id"] for r in rows if r["kept"]] == [top]
    assert exact_dedup.exact_duplicates(edge_docs(spark).limit(0)).count() == 0
    stay = exact_dedup.unique_texts(edge_docs(spark))
    assert stay.columns == edge_docs(spark).columns
    assert sorted((r["text"] or "") for r in stay.collect()) == sorted(texts)


# -- Jaccard join --------------------------------------------------------

def plain_links(texts):
    sets = {i: shingles(t) for i, t in texts}
    links, parent = collections.Counter(), {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (root(i), links[i]) for i in sets}


def test_shingle_hashes_follow_the_words():
    texts = [t or "" for _, t, _ in EDGE] + ["A b C d e f", "a B c d E F", "a b c d e f a b c d e", "İx K", "a_b-c d"]
    for t, w in zip(texts, words_by_text(texts), strict=True):
        assert len(shingle_set(w)) == len(shingles(t))
    a, b = (shingle_set(w) for w in words_by_text(texts[-5:-3]))
    assert (a == b).all()


def test_long_text_is_hashed_in_segments(monkeypatch):
    import custfold.llm.shingles as sh
    whole = list(words_by_text([LONG]))[0]
    monkeypatch.setattr(sh, "SEGMENT", 1000)
    assert (list(words_by_text(["x", LONG, "y"]))[1] == whole).all()


def test_join_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocab, k=90) for _ in range(25)]
    common = rng.choices(vocab, k=30)
    texts = []
    for b in base:
        for _ in range(rng.randint(1, 5)):
            t = list(b)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            texts.append(" ".join(t))
    texts += [" ".join(common + rng.choices(vocab, k=60)) for _ in range(150)]  # one frequent passage
    big = rng.choices(vocab, k=240)
    for _ in range(150):  # one group that no split reduces
        t = list(big)
        for _ in range(2):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        texts.append(" ".join(t))
    texts += [texts[0], texts[0].upper(), "one two", "one two", "one", "", None, "one two three four five six"]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.similar_texts(docs_of(spark, texts), leaf=16).collect()}
    want = plain_links(list(enumerate(texts)))
    links = sum(n for _, n in want.values())
    assert links > 5000
    assert sum(n for _, n in got.values()) >= 0.995 * links and all(got[i][1] <= want[i][1] for i in want)
    assert {i: c for i, (c, _) in got.items()} == {i: c for i, (c, _) in want.items()}


def test_join_edges(spark):
    out = jaccard_join.similar_texts(edge_docs(spark)).collect()
    assert len(out) == len(EDGE)
    long = [r for r in out if r["n_links"]]
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in long} == {(4, 4, 2), (5, 4, 2)}
    assert jaccard_join.similar_texts(edge_docs(spark).limit(0)).count() == 0


def test_runs_reach_the_target_recall():
    assert jaccard_join.runs_for(0.9, 1) == 3 and jaccard_join.runs_for(0.995, 3) == 12


# -- sentence spans ------------------------------------------------------

def plain_passages(rows):
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        parts = sentence_dedup.sentences(t or "")
        assert "".join(parts) == (t or "")
        real = [k for k, p in enumerate(parts) if p.split()]
        gone = set()
        for a, b in sorted(sentence_dedup.spans([len(parts[k].split()) for k in real])):
            s = " ".join(" ".join(parts[k].split()) for k in real[a:b + 1])
            if s in seen:
                gone.update(range(real[a], real[b] + 1))
            seen.add(s)
        out[(i, t or "")] = (len(real), sum(k in gone for k in real), "".join(p for k, p in enumerate(parts) if k not in gone))
    return out


def test_passages_equal_plain_version(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(3000)]
    sent = lambda n: " ".join(rng.choices(vocab, k=n)).capitalize() + "."
    passage = " ".join(sent(n) for n in (3, 3, 20, 9, 4, 2, 12, 3))
    lone = sent(60)
    rows = [(i, f"{sent(8)} {sent(11)} {passage} {sent(7)}") for i in range(5)] + [(10, f"Intro here.\n{passage}\nThe end."), (11, lone), (12, f"{sent(5)} {lone} {sent(6)}")]
    rows += [(i, " ".join(sent(rng.randint(1, 15)) for _ in range(12))) for i in range(20, 40)]
    rows += [(41, "Of. The. It. Of. The."), (42, "Of. The. It. Of. The."), (43, f"{passage}\n{passage}")]
    rows += [(i, t) for i, t, _ in EDGE if i != 6]
    got = sentence_dedup.remove_repeated_passages(edge_docs(spark, [(i, t, "s") for i, t in rows])).collect()
    want = plain_passages(rows)
    key = lambda i: (i is None, i or 0)
    assert sorted((key(r["doc_id"]), r["n_sentences"], r["n_removed"], r["text"]) for r in got) == sorted((key(i), *want[(i, t or "")]) for i, t in rows)
    text = {r["doc_id"]: r["text"] for r in got if r["doc_id"] is not None}
    assert passage in text[0] and not any(s in text[k] for k in (1, 4, 10) for s in passage.split(". ")[1:-1] if len(s.split()) > 3)
    assert lone in text[11] and lone not in text[12]
    assert text[42] == "Of. The. It. Of. The."
    assert sentence_dedup.remove_repeated_passages(edge_docs(spark).limit(0)).count() == 0


# -- mix -----------------------------------------------------------------

def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / w for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s] + 1e-9}
        if not over - capped:
            return target
        capped |= over


def test_mix_meets_targets(spark):
    rng = random.Random(8)
    sources = {"a": 900, "b": 20, "c": 300, "é": 5, None: 40, "Z": 1}
    rows = [(k, " ".join(["w"] * rng.randint(0, 60)), s) for k, s in enumerate(s for s, n in sources.items() for _ in range(n))]
    got = source_mix.mix_sources(edge_docs(spark, rows), block=64).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = plain_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    for s in ("a", "c", None):
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 5
    assert taken["é"] <= 3 * sizes["é"]
    again = source_mix.mix_sources(edge_docs(spark, rows).repartition(7), block=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_is_near_for_small_sources_beside_large_ones(spark):
    # Sources of one block, of two and of many: each lands over its own reserve.
    rng = random.Random(5)
    count = {sid: 60 for sid in range(10)} | {sid: 100 for sid in range(10, 20)} | {20: 3000}
    rows = [(k, sid, rng.randint(50, 500), rng.uniform(0.1, 0.9)) for k, sid in enumerate(s for s, n in count.items() for _ in range(n))]
    units = spark.createDataFrame(rows, "doc_id long, sid int, size long, p double")
    want, got, docs = collections.Counter(), collections.Counter(), collections.Counter()
    for _, sid, size, p in rows:
        want[sid] += p * size
        docs[sid] += p
    done = source_mix.balanced(units, block=64).collect()
    assert len(done) == len(rows) and {r["p"] for r in done} == {0.0, 1.0}
    for r in done:
        got[r["sid"]] += r["p"] * r["size"]
        docs[r["sid"]] -= r["p"]
    assert all(abs(d) <= 1 + 1e-6 for d in docs.values())
    for sids in (range(10), range(10, 20), [20]):
        assert sum(abs(got[s] - want[s]) / want[s] for s in sids) / len(sids) < 0.003


def test_flight_keeps_totals():
    rng = np.random.default_rng(4)
    p, z = rng.random(500), rng.integers(0, 50, 500)
    q = source_mix.fly(p, z, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(p.sum() - q.sum()) < 1e-6 and abs(p @ z - q @ z) < 1e-4


def test_mix_edges(spark):
    got = source_mix.mix_sources(edge_docs(spark)).collect()
    assert len(got) == len(EDGE) and all(r["copies"] <= 3 for r in got)
    empty = source_mix.mix_sources(edge_docs(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["target"], r["taken"]) for r in empty] == [(0.0, 0)] * 2
    assert source_mix.mix_sources(edge_docs(spark).limit(0)).count() == 0


# -- toxicity ------------------------------------------------------------

def test_features_equal_plain_kernel():
    mark = lambda w: tuple(ord(c) - 96 for c in w)
    f = toxicity.Features.of((mark("loser"), mark("idiot")))
    near = lambda t: dict(zip(("loser", "idiot"), f([t])[0], strict=False))
    assert abs(near("you loser")["loser"] - near("LOSER")["loser"]) < 1e-9 and near("you loser")["idiot"] == 0
    for odd in ("l-o-s-e-r", "lo ser", "loxser", "l.oser"):
        assert near(odd)["loser"] > 0.3, odd
    assert near("l------o-----s----e---r")["loser"] == 0 and near("the tree")["loser"] == 0
    texts = ["idiot", "x" * 700_000 + " loser", "", "clean words", "a loser"]
    whole = f(texts)
    alone = np.concatenate([f([t]) for t in texts])
    assert (whole == alone).all() and whole[1, 0] >= 0.99


def test_subsequence_weights_equal_enumeration():
    word = tuple(ord(c) - 96 for c in "pathetic")
    want = collections.Counter()
    for at in itertools.combinations(range(len(word)), 4):
        if at[-1] - at[0] < toxicity.SPAN:
            code = 0
            for i in at:
                code = code << 5 | word[i]
            want[code] += toxicity.GAP ** (at[-1] - at[0] + 1 - 4)
    assert toxicity.subsequences(word) == dict(want)


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choices("abcdeghnrtuvm", k=rng.randint(3, 8))) for _ in range(500)]
    insults = ["loser", "idiot", "scum"]
    rows, labels = [], []
    for i in range(700):
        w, toxic = rng.choices(vocab, k=40), i % 4 == 0
        if toxic:
            for _ in range(2):
                x = rng.choice(insults)
                if zlib.crc32(str(i).encode()) % 5 == 0 and rng.random() < 0.5:
                    x = "-".join(x)  # disguised in the held-out fold only
                w.insert(rng.randrange(40), x)
        rows.append((i, " ".join(w), "s"))
        labels.append((i, 1, int(toxic), "x"))
    lab = spark.createDataFrame(labels + [(9999, 1, 1, "x"), (None, 1, 1, "x"), (3, 1, None, "x")], "doc_id long, quality int, toxic int, body string")
    got = toxicity.toxicity(edge_docs(spark, rows), lab).collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = toxicity.toxicity(edge_docs(spark), lab).collect()
    assert len(odd) == len(EDGE) and all(0 <= r["score"] <= 1 for r in odd)
    assert [r["score"] for r in toxicity.toxicity(edge_docs(spark), lab.limit(0)).collect()] == [0.0] * len(EDGE)
    assert toxicity.toxicity(edge_docs(spark).limit(0), lab).count() == 0


# -- token counts --------------------------------------------------------

def library_counts(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(token_counts.default_tokenizer())
    return [len(tok.encode(t, add_special_tokens=False)) for t in texts]


def nasty(rng, n):
    parts = ["the", " ", "  ", "\n", " \n", "\t", "<|endoftext|>", "<|endof", "it's", "é", "日本語", "᠎", "\x85", "\xa0", " ", "123", "...", "'ll", "A" * 40, "\x1c", "𝒳", "a b c"]
    return "".join(rng.choice(parts) + (" " if rng.random() < 0.4 else "") for _ in range(n))


def test_token_counts_equal_the_library(spark):
    rng = random.Random(6)
    texts = [nasty(rng, rng.randint(0, 60)) for _ in range(300)] + [nasty(rng, 1500), "ab " * 3000, "x" * 2000 + " y" * 500, " " * 900 + "z w " * 300, LONG, "", " ", " a", "a "]
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs_of(spark, texts + [None]), chunk=700, overlap=20).collect()}
    assert [got[i]["n_tokens"] for i in range(len(texts))] == library_counts(texts)
    assert [got[i]["n_bytes"] for i in range(len(texts))] == [len(t.encode()) for t in texts]
    assert got[len(texts)]["n_tokens"] == 0 and got[len(texts)]["n_bytes"] == 0
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got.values())


def test_token_counts_edges(spark):
    got = token_counts.token_counts(edge_docs(spark), chunk=1000, overlap=10).collect()
    want = dict(zip([t or "" for _, t, _ in EDGE], library_counts([t or "" for _, t, _ in EDGE]), strict=True))
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), want[t or ""]) for i, t, _ in EDGE)
    assert token_counts.token_counts(edge_docs(spark).limit(0)).count() == 0


def test_memo_generations(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 50)
    c = token_counts.PieceCounter(token_counts.default_tokenizer())
    rng = random.Random(9)
    texts = [" ".join(str(rng.randrange(200)) for _ in range(30)) for _ in range(40)]
    assert [c.count_all([t])[0] for t in texts] == library_counts(texts)
    assert len(c.memo) <= 80 and len(c.old) <= 80


def test_alike_sets_agree_in_their_bits():
    """Near copies are told from texts that share one passage."""
    rnd = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    base = list(rnd.choice(words, 300))

    def agreement(texts):
        bits = [jaccard_join.bits_of(jaccard_join.sketch(s)) for s in jaccard_join.shingle_sets(texts)]
        n = jaccard_join.BITS
        return sum(abs(sum(2 * (b >> i & 1) - (b >> n + i & 1) for b in bits)) for i in range(n)) / (len(bits) * n)

    near = [" ".join(w if rnd.random() > 0.02 else "x" + w for w in base) for _ in range(200)]
    passage = [" ".join([*base[:60], *rnd.choice(words, 240)]) for _ in range(200)]
    assert agreement(near) > jaccard_join.ALIKE + 0.1 and agreement(passage) < jaccard_join.ALIKE - 0.1
    short = [" ".join(["the", "same", "five", "words", "here", w]) for w in words[:200]]  # few bins filled
    assert agreement(short) < 0.2
