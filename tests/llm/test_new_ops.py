"""Packing, conversation repair and phrase collocations."""

import hashlib
import random
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import edge_docs  # noqa: E402

from custfold.llm import collocations, conversations, packing  # noqa: E402
from custfold.llm.common import store, table  # noqa: E402

SF = "/root/testdata/sf0.01"

# ---------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_tokenizer())


def plain_pieces(library, text):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
    out, pos = [], 0
    for n in [4096] * (len(ids) // 4096) + [1 << b for b in range(11, -1, -1) if len(ids) % 4096 >> b & 1]:
        out.append((pos, n, zlib.crc32(np.array(ids[pos:pos + n], "<u4").tobytes()), len(ids)))
        pos += n
    assert pos == len(ids)
    return out


def pieces_by_doc(rows):
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    return {k: sorted(v) for k, v in got.items()}


def test_packing_equals_library(spark, library):
    rows = packing.op11_packing(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    got = pieces_by_doc(rows)
    assert got.keys() == docs.keys()
    assert all(got[d] == plain_pieces(library, t) for d, t in docs.items())
    assert len({r["sequence_id"] for r in rows}) == len(rows) and {r["offset"] for r in rows} == {0}


ODD = ["", None, " ", "İ. İx, Σ. ΟΔΟΣ. Σ,", "x́. é, ́. a", "<|endoftext|> <|ENDOFTEXT|>. <|startoftext|>,a", "it's IT'S. don't, 'S 's.",
       "a\tb\x0bc d e\x1cf᠎g", "= ̸ ≠", "A.B,C..,, .", "word" * 3000, "ᄀ ᅡᆨ", "5.6,7 ½ ²"]


def test_packing_odd_texts(spark, library):
    schema = "doc_id long, text string, start long, ids string, length int, body string"
    docs = spark.createDataFrame([(i, t, 1, "x", 2, "y") for i, t in enumerate(ODD)], schema)
    assert pieces_by_doc(packing.sequences(docs).selectExpr("*", "crc32(ids) ids_crc32").collect()) == {i: plain_pieces(library, t) for i, t in enumerate(ODD)}
    edge = edge_docs(spark)
    rows = packing.sequences(edge).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in rows if r["start"] == 0) == Counter(
        (d, len(library.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in ((r["doc_id"], r["text"]) for r in edge.collect()))
    assert packing.sequences(edge.limit(0)).count() == 0


def test_buckets_hold_equal_lengths(spark, tmp_path):
    packing.write_buckets(table(spark, "/root/testdata/sf0.001", "documents"), str(tmp_path / "b"), most=64)
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where("octet_length(ids) <> 4 * length OR length > 64").count() == 0


def test_memo_turns_over(library):
    e = packing.WordEncoder(packing.default_tokenizer())
    old, packing.MEMO = packing.MEMO, 3
    try:
        for t in ["a b c d", "e f g a", "b c a h", "a b."]:
            assert list(np.frombuffer(next(e.ids(pa.array([t]))), "<u4")) == library.encode(t, add_special_tokens=False).ids
    finally:
        packing.MEMO = old


# ---------------------------------------------------------------- conversations


def plain_repair(rows):
    """``rows`` of one conversation: (turn, role, text), any order, nulls as None."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, fault = set(), []
    for _, r, x in rows:
        v = x.strip(" \t\n\x0b\x0c\r")
        fault.append("blank" if not v else "duplicate" if (r, x) in seen else "truncated" if v[-1] not in ".!?" else "")
        seen.add((r, x))
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    @lru_cache(None)
    def best(i, q, run):  # (cost, audit, repaired), the least
        found = [(0, "", ())] if i == len(rows) and q in (0, 3) else []
        if run < 3:
            for role in ("user", "assistant"):
                if q in step[role[0]]:
                    c, a, t = best(i, step[role[0]][q], run + 1)
                    found.append((c + 5, "I" + a, (role + ":", *t)))
        if i < len(rows):
            _, r, x = rows[i]
            c, a, t = best(i + 1, q, 0)
            found.append((c + 2, "D" + a, t))
            if fault[i] not in ("blank", "duplicate"):
                extra = 5 * (fault[i] == "truncated")
                for role, cost, letter in ((r, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if q in step.get(role[:1], {}):
                        c, a, t = best(i + 1, step[role[:1]][q], 0)
                        found.append((c + cost + extra, letter + a, (f"{role}:{x}", *t)))
        return min(found, default=(10 ** 9, "", ()))

    cost, audit, left = best(0, 0, 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), bad, cost, audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest())


def plain_damage(conv, rows):
    out = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def as_dict(rows):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}


def grouped(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    return out


def test_op12_equals_plain_version(spark):
    convs = grouped(table(spark, SF, "conversations").collect())
    got = as_dict(conversations.op12_conversation_repair(spark, SF).collect())
    assert got == {c: plain_repair(plain_damage(c, rs)) for c, rs in convs.items()}


def test_conversations_over_several_segments(spark):
    """Small batches: most conversations lie in many segments, dealt over tasks."""
    rnd = random.Random(5)
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Hi.", "Well?", "no end", "", " \n", None, "x!  ", "Yes.", "ok\n"]
    rows = [(c, rnd.choice([None, t, t // 2, t * 2]), rnd.choices(roles, [2, 6, 6, 1, 1, 1, 1])[0], rnd.choice(texts), 7)
            for c in [None, *range(12)] for t in range(rnd.choice([1, 2, 5, 40]))]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seg int")
    want = {c: plain_repair(rs) for c, rs in grouped(df.collect()).items()}
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("3", "7", "10000"):
            spark.conf.set(key, size)
            assert as_dict(conversations.digest(conversations.repair(df)).collect()) == want
    finally:
        spark.conf.set(key, old)
    assert conversations.digest(conversations.repair(df.limit(0))).count() == 0


def test_damage_and_dropped_conversations(spark, tmp_path):
    rows = [(c, t, r, x) for c in [None, *range(40)] for t, r, x in [(None, None, None), (1, "user", "Hi. Ho?")]]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = as_dict(conversations.op12_conversation_repair(spark, str(tmp_path)).collect())
    want = {c: plain_repair(plain_damage(c, rs)) for c, rs in grouped(table(spark, str(tmp_path), "conversations").collect()).items()}
    assert got == want and len(got) == 41


def test_sql_of_the_repair_equals_plain_version():
    import duckdb
    rnd = random.Random(8)
    rows = [(c, rnd.choice([None, t]), rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             rnd.choice(["Hi.", "Well?", "no end", "", " \n", None, "Yes! "])) for c in [None, *range(40)] for t in range(rnd.choice([1, 3, 9]))]
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = {r[0]: tuple(r[1:]) for r in db.execute(conversations.OP12_SQL).fetchall()}
    convs = defaultdict(list)
    for c, *r in rows:
        convs[c].append(tuple(r))
    assert got == {c: plain_repair(plain_damage(c, rs)) for c, rs in convs.items()}


def test_square_root_checkpoints():
    codes = [(conversations.KEPT["u"], False, 0), (conversations.KEPT["a"], False, 5)] * 50
    step, marks = conversations.checkpoints(codes, conversations.END)
    assert step == 10 and len(marks) == 11


# ---------------------------------------------------------------- collocations


def plain_collocations(docs, least, depth, top):
    grams, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = (text or "").translate({i: i + 32 for i in range(65, 91)} | {ord(c): "\n" for c in ".,;:!?\x0b\x0c\r"} | {9: " "})
        for piece in low.split("\n"):
            ws = [w for w in piece.split(" ") if w]
            n[lang] += len(ws)
            grams.update((lang, tuple(ws[i:i + m])) for m in range(1, depth + 1) for i in range(len(ws) - m + 1))
    f = {k: a for k, a in grams.items() if a >= least}
    held = {(la, p[i:j]): a for (la, p), a in sorted(f.items(), key=lambda x: x[1]) for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p)}
    out = defaultdict(list)
    for (la, p), a in f.items():
        if len(p) >= 2 and not 100 * held.get((la, p), 0) >= 100 * a:
            score, k = min((1000 * a * n[la] // (f[la, p[:k]] * f[la, p[k:]]), k) for k in range(1, len(p)))
            out[la].append((-score, -a, " ".join(p).encode(), f[la, p[:k]], f[la, p[k:]]))
    return {(la, i + 1): (p.decode(), -a, l, r, n[la], -s) for la, xs in out.items() for i, (s, a, p, l, r) in enumerate(sorted(xs)[:top])}


def collocation_rows(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("shard_words, least, depth, top", [(30, 3, 5, 20), (400, 2, 4, 500), (1 << 21, 1, 2, 50)])
def test_collocations_over_shards(spark, shard_words, least, depth, top):
    rnd = random.Random(shard_words)
    vocab = ["a", "b", "C", "d\te", "é", "f-g", "h"]
    texts = [" ".join(rnd.choice(vocab) + rnd.choice(["", "", "", ".", " x y", "\n"]) for _ in range(rnd.choice([0, 3, 30, 90]))) for _ in range(60)]
    texts += [None, "", " .,", "one two three four five six seven"] * 3 + ["long one two three four five six"] * 3
    docs = [(rnd.choice(["en", None, "und", "fr"]), t) for t in texts]
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "lang string, text string, shard int, words string, n int").repartition(3)
    got = collocation_rows(collocations.collocations(df, least=least, depth=depth, top=top, shard_words=shard_words))
    assert got == plain_collocations(docs, least, depth, top)


def test_collocation_edges(spark):
    docs = edge_docs(spark)
    got = collocation_rows(collocations.collocations(docs, least=2))
    assert got == plain_collocations([(r["lang"], r["text"]) for r in docs.collect()], 2, 5, 2000)
    assert collocations.collocations(docs.limit(0), least=1).count() == 0


def test_index_counts_both_ways():
    rnd = np.random.default_rng(3)
    text = np.concatenate([[0], rnd.integers(0, 5, 400), [0]])
    index = collocations.BiIndex(collocations.BiIndex.transforms(text, 4), 4)
    want = Counter(tuple(text[i:i + 3]) for i in range(len(text) - 2) if text[i:i + 3].all())
    for sides in ((1, 1), (0, 0), (0, 1), (1, 0)):
        found = index.words()
        for s in sides:
            found = index.extend(found, s)
        assert dict(zip(map(tuple, found["phrase"].tolist()), found["n"].tolist(), strict=True)) == want
        for side in (0, 1):
            for p, w in zip(found["phrase"].tolist(), index.always(found, side), strict=True):
                ends = {text[(i - 1) if side == 0 else (i + 3)] for i in range(len(text) - 2) if list(text[i:i + 3]) == p}
                assert w == (ends.pop() if len(ends) == 1 else 0)


def test_rare_phrases_stop_at_the_next_length(spark):
    """Three words over two frequent pairs that are rare together are counted, and
    nothing longer; a shard reports a few packed rows, none for each phrase."""
    texts = [f"a b {w}." for w in "pq"] * 30 + [f"{w} a b." for w in "rs"] * 30 + ["b c d e f g."] * 3 + ["x b c.", "c d y.", "d e z.", "e f w."] * 9
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(4)
    parts = store(collocations.shards(docs, 40), "t", "shard")
    often = store(collocations.frequent_words(collocations.pack_words(parts, 2), 10, 2), "t")
    index = store(collocations.index_shards(parts, often.where("shard IS NOT NULL").select("shard", "at", "ids")), "t", "shard")
    frequent, tables = {}, {}
    for size in (2, 3, 4):
        tables[size] = store(collocations.phrases_of(index, frequent, size, 2), "t")
        frequent[size] = store(collocations.frequent_phrases(tables[size], 10, 2), "t")
    shards = parts.count()
    assert shards > 4 and all(t.count() <= 2 * shards for t in tables.values())
    held = {s: collocations.listed_phrases(f).count() for s, f in frequent.items()}
    assert held == {2: 9, 3: 4, 4: 0} and tables[4].isEmpty()
    assert "Exchange hashpartitioning(shard" not in index.groupBy("shard").count()._jdf.queryExecution().executedPlan().toString()
    assert collocation_rows(collocations.collocations(docs, least=10, shard_words=40)) == plain_collocations([("en", t) for t in texts], 10, 5, 2000)


def test_a_shard_is_stored_once_and_pairs_are_sent_small(spark):
    """What an index is read from is hardly more than the text of its shard, and a
    pair takes less than two bytes on its way to its bucket, many buckets or few."""
    def held(x):
        return len(x) if isinstance(x, bytes | bytearray) else sum(map(held, x)) if isinstance(x, list | tuple) else 0

    rnd = random.Random(13)
    vocab = [f"w{i}" for i in range(2000)]
    texts = [rnd.choices(vocab, [1 / (i + 1) for i in range(2000)], k=200) for _ in range(600)]
    pairs = len({p for t in texts for p in zip(t, t[1:], strict=False)})
    docs = spark.createDataFrame([("en", " ".join(t)) for t in texts], "lang string, text string").coalesce(1)
    parts = store(collocations.shards(docs), "t", "shard")
    for buckets in (1, 16):
        often = store(collocations.frequent_words(collocations.pack_words(parts, buckets), 1, buckets), "t")
        index = store(collocations.index_shards(parts, often.where("shard IS NOT NULL").select("shard", "at", "ids")), "t", "shard")
        assert sum(map(held, index.collect())) < 1.2 * sum(held(r) for r in parts.select("body").collect())
        sent = collocations.phrases_of(index, {}, 2, buckets).collect()
        assert len(sent) == buckets and sum(map(held, sent)) < 2 * pairs
