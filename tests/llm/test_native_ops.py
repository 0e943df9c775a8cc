"""URL filter, line dedup, decontamination and secret scan."""

import re
import sys
import time

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import EDGE, LONG, docs_of, edge_docs, words  # noqa: E402

from custfold.llm import decontaminate, line_dedup, secret_scan, url_filter  # noqa: E402
from custfold.llm.catalog import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(ORACLES[name])
    result = QUERIES[name](spark, SF)
    assert sorted(result.columns) == sorted(want.columns)
    got = sorted(tuple(map(str, r)) for r in result.select(*want.columns).collect())
    assert got and got == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_no_python_in_native_plans(spark):
    for name in ("op1_url_filter", "op5_line_dedup", "op6_benchmark_decontamination", "op8_secret_scan"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


PAGES = "page_id long, url string, html string, host string, hit int, trust long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, 2) for i, (u, h) in enumerate(rows)], PAGES)


def test_rules_and_odd_urls(spark):
    urls = ["https://A.example.NET/en/x?q#f", "http://example.net/de/", "http://net/x", "http://x.net", "http://sub.example.com/de/1", "http://example.com/fr/",
            "http://a.org/fr/z", "http://notexample.net/en/", None, "", "no scheme", "http://u:p@example.com/de/", "http://example.com:80/de/"]
    got = {r["page_id"]: r for r in url_filter.judge_pages(pages(spark, [(u, None) for u in urls])).collect()}
    rule = [got[i]["rule"] for i in range(len(urls))]
    assert rule == ["example.net/en/", "net/", "net/", None, "example.com/de/", None, "org/fr/", "net/", None, None, None, None, None]
    assert (got[0]["host"], got[0]["path"]) == ("a.example.net", "/en/x")
    assert [(got[i]["host"], got[i]["path"]) for i in (8, 9, 10)] == [("", "")] * 3
    assert [got[i]["verdict"] for i in (0, 1, 4, 6, 8)] == ["allow", "block", "block", "allow", "allow"]
    assert url_filter.judge_pages(pages(spark, []).limit(0)).count() == 0


def test_distrust_runs_against_links_and_trust_along_them(spark):
    a = lambda *hosts: "".join(f'<A class="x" HREF="https://{h}/p">l</A>' for h in hosts)
    rows = [("http://bad.net/x", ""), ("http://good.org/fr/x", a("friend.io")), ("http://friend.io/", ""),
            ("http://spam.io/", a("bad.net")), ("http://spammer.io/", a("spam.io")), ("http://plain.io/", a("other.io"))]
    got = {r["host"]: r for r in url_filter.judge_pages(pages(spark, rows)).collect()}
    assert got["friend.io"]["trust"] > 0 and got["friend.io"]["verdict"] == "allow"
    assert got["spam.io"]["verdict"] == "block" and got["spammer.io"]["distrust"] > 0
    assert got["plain.io"]["distrust"] == 0 and got["plain.io"]["verdict"] == "allow"


def plain_lines(rows, window=3):
    """Lines that stay, in order of doc_id (nulls last) and text hash ties."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        ls = (t or "").split("\n")
        gone = set()
        for p in range(len(ls) - window + 1):
            w = tuple(ls[p:p + window])
            if w in seen:
                gone.update(range(p, p + window))
            seen.add(w)
        out[(i, t or "")] = (len(ls), len(gone), "\n".join(x for p, x in enumerate(ls) if p not in gone))
    return out


def test_line_dedup_edges(spark):
    rows = [r for r in EDGE if r[0] != 6] + [(20, "a\nb\nc\nd", "s"), (21, "x\na\nb\nc\ny", "s"), (22, "b\nc\nd\nb\nc\nd", "s"), (23, "q\nq\nq\nq\nq", "s")]
    got = line_dedup.remove_repeated_lines(edge_docs(spark, rows)).collect()
    want = plain_lines([(i, t) for i, t, _ in rows])
    assert len(got) == len(rows)
    have = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_lines"], r["n_removed"], r["text"]) for r in got)
    assert have == sorted(((i is None, i or 0), *want[(i, t or "")]) for i, t, _ in rows)
    assert line_dedup.remove_repeated_lines(edge_docs(spark).limit(0)).count() == 0


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, words string, n int")


def plain_hits(doc, bench):
    w, hit, ids = words(doc), set(), set()
    for i, t in bench:
        b = words(t)
        n = min(10, len(b))
        if i is None or not n:
            continue
        grams = {tuple(b[s:s + n]) for s in range(len(b) - n + 1)}
        for p in range(len(w) - n + 1):
            if tuple(w[p:p + n]) in grams:
                hit.update(range(p, p + n))
                ids.add(str(i))
    return len(w), len(hit), ",".join(sorted(ids))


def test_decontamination_equals_plain_version(spark):
    import hashlib
    bench = [(1, "One two three four five six seven eight nine TEN eleven twelve"), (2, "the the the the the the the the the the the"), (10, "rare"), (3, ""), (4, None),
             (None, "null item words that nobody can name ever again in here"), (5, "É é Kelvin K sign"), (1, "One two three four five six seven eight nine TEN eleven twelve")]
    texts = ["x one two, three four five six seven eight nine ten eleven y", "the " * 30, "a rare bird, RARE", "É é kelvin k sign", "é é kelvin k sign", "É é Kelvin K sign",
             "two three four five six seven eight nine ten eleven twelve one two", None, "", "one two three four five", "null item words that nobody can name ever again in here"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s"), (None, texts[0], "s"), (0, "other words", "s"), (99, LONG + " " + texts[0], "s")]
    got = decontaminate.contamination_digest(decontaminate.contamination(edge_docs(spark, rows), items(spark, bench))).collect()
    have = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got)
    want = []
    for i, t, _ in rows:
        n, h, ids = plain_hits(t, bench)
        want.append((str(i), n, h, len(ids.split(",")) if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), h > 0))
    assert have == sorted(want)


def test_terms_do_not_depend_on_their_neighbours(spark):
    import hashlib
    bench = [(1, "Α.Σ. ΟΔΟΣ.ΑΒ"), (2, "ΟΔΟΣ'ΑΒ:Σ İ.I one two three four five six seven eight nine")]
    texts = ["Α.Σ. ΟΔΟΣ.ΑΒ", "x Α Σ ΟΔΟΣ ΑΒ y", "ΟΔΟΣ ΑΒ Σ İ I one two three four five", "α.σ. οδος.αβ", "ΟΔΟΣ"]
    got = decontaminate.contamination_digest(decontaminate.contamination(docs_of(spark, texts), items(spark, bench))).collect()
    for r in got:
        n, h, ids = plain_hits(texts[r["doc_id"]], bench)
        assert (r["n_words"], r["n_hit"], r["items_sha256"]) == (n, h, hashlib.sha256(ids.encode()).hexdigest())
    assert sorted(r["doc_id"] for r in got if r["contaminated"]) == [0, 1, 2]


def test_words_of_every_kind_of_character(spark):
    odd = [*range(0x250), 0x3A3, 0x2028, 0xD7FF, 0xE000, 0xFEFF, 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]
    texts = [" ".join(map(chr, odd)), "".join(map(chr, odd)), "\U0001F600a\U0001F600,e\u0301 \U0010FFFF", "", ".,;"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(docs.select("i", decontaminate.words_of(F.col("t"))).collect())
    assert got == {i: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t) for i, t in enumerate(texts)}


def test_words_are_cut_faster_than_by_the_negated_class(spark):
    line = F.concat(F.col("id").cast("string"), F.lit(" Some words, and 123 more of them (\u00e9t\u00e9). Then others; they end here.\n"))
    texts = spark.range(4, numPartitions=4).select(F.repeat(line, 50000).alias("t")).localCheckpoint()

    def seconds(words):
        took = []
        for _ in range(2):
            begun = time.perf_counter()
            n = texts.agg(F.sum(F.size(words))).collect()[0][0]
            took.append(time.perf_counter() - begun)
        assert n == 4 * 50000 * 14
        return min(took)

    plain = seconds(F.regexp_extract_all("t", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)))
    assert 2 * seconds(decontaminate.words_of(F.col("t"))) < plain


def test_decontamination_empty_tables(spark):
    docs, bench = edge_docs(spark), items(spark, [(1, "a b c")])
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    none = decontaminate.contamination_digest(decontaminate.contamination(docs, bench.limit(0)))
    assert none.count() == len(EDGE) and none.where("contaminated").count() == 0


def test_proximity_matches(spark):
    rows = decontaminate._keyed(docs_of(spark, ["zeta then omega and sigma", "zeta " + "filler " * 60 + "omega " + "filler " * 60 + "sigma",
                                                "omega sigma", "and zeta omega zeta omega zeta"]), "doc_id", "text")
    bench = decontaminate.benchmark_items(items(spark, [(1, "alpha sigma omega zeta and")]))
    counts = decontaminate.term_counts(rows, bench)
    assert {r["term"]: r["n"] for r in counts.collect()} == {"sigma": 3, "omega": 4, "zeta": 3, "and": 2}
    rare = decontaminate.rare_terms(bench, counts, rows, docs=3)
    assert sorted(r["term"] for r in rare.collect()) == ["and", "sigma", "zeta"]
    index = decontaminate.positional_index(rows, rare)
    near = decontaminate.proximity_matches(index, rare, slop=10, least=3)
    assert [(r["doc_id"], r["near"]) for r in near.collect()] == [(0, 3)]
    assert decontaminate.proximity_matches(index, rare, slop=4, least=3).count() == 0  # five words apart


def test_near_matches_with_production_parameters(spark):
    import hashlib
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima"
    bench = [(1, item + " absentword"), (2, "zulu yankee xray whiskey absentone victor"), (3, "lonely absenttwo absentthree absentfour")]
    w = item.split()
    texts = [" ".join(reversed(w)), " ".join(["swapped" if x == "delta" else x for x in w]), "victor then whiskey and xray or yankee of zulu",
             (" filler" * 50).join(w), "lonely words", "alpha " + "filler " * 19 + "bravo charlie", "", None, item]
    got = {r["doc_id"]: r for r in decontaminate.contamination_digest(decontaminate.contamination(docs_of(spark, texts), items(spark, bench), proximity=True)).collect()}
    near = {0: "1", 1: "1", 2: "2", 8: "1"}
    assert {i: r["near_items_sha256"] for i, r in got.items()} == {i: hashlib.sha256(near.get(i, "").encode()).hexdigest() for i in range(len(texts))}
    assert all(r["n_near"] == (i in near) and r["contaminated"] == (i == 8) for i, r in got.items())


def test_near_matches_by_common_words_on_request(spark):
    bench = items(spark, [(1, "the and of to in is"), (2, "alpha bravo charlie delta")])
    docs = docs_of(spark, ["to of and the"] * 25 + ["the " + "filler " * 20 + "and of to", "delta charlie bravo alpha", None])
    for share, near in ((decontaminate.RARE_SHARE, [0] * 25 + [0, 1, 0]), (1.0, [1] * 25 + [0, 1, 0])):
        found = decontaminate.contamination_digest(decontaminate.contamination(docs, bench, proximity=True, rare_share=share))
        assert [r["n_near"] for r in found.orderBy("doc_id").collect()] == near


def test_secret_scan(spark):
    good = "0123456789abcdef0123456789abcdef01234567"
    texts = [f'some words token = "{good[k % 16:]}{k:04d}" more' if k % 2 else f"call 40{k:014d} or see /path/{k:020d}/x now" for k in range(120)]
    texts += [None, "", LONG, f"a={good} b={good}", "short1 words only"]
    docs = docs_of(spark, texts)
    got = secret_scan.scan_secrets(docs).collect()
    find = re.compile(r"(?<![A-Za-z0-9_+/=\-])(?=[A-Za-z_+/=\-]*[0-9])[A-Za-z0-9_+/=\-]{16,}")
    want = sorted((i, len(m)) for i, t in enumerate(texts) for m in find.findall(t or ""))
    assert sorted((r["doc_id"], r["length"]) for r in got) == want
    held = [r for r in got if r["doc_id"] < 120]
    assert sum(r["is_secret"] == (r["doc_id"] % 2 == 1) for r in held) >= 0.95 * len(held)
    assert secret_scan.scan_secrets(docs.limit(0)).count() == 0
    alone = secret_scan.scan_secrets(docs.where("doc_id = 1"), label=lambda df: F.lit(None))
    assert [r["score"] for r in alone.collect()] == [1.0]


def test_secret_features_entropy_and_coverage(spark):
    docs = docs_of(spark, ["apple apple apple apple apple 12appleaaaabbbb34 x", "zz/aa1/aaaaaaaaaaaaaaaaaaaaaaa"])
    rows = {r["doc_id"]: r for r in secret_scan.with_features(secret_scan.candidates(docs), docs).collect()}
    assert rows[0]["coverage"] == 0 and rows[0]["changes"] == 2 and rows[0]["digits"] == 4
    assert rows[1]["in_path"] == 1 and rows[1]["entropy"] < 1.6
