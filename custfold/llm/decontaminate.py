"""Benchmark decontamination over a positional inverted index (DataFrame
functions only).

1. The documents that hold each benchmark term are counted.
2. Per window of an item (``WINDOW`` consecutive words; a shorter item is one
   window) the ``PROBES`` rarest terms are its probes.  A window with a term
   the corpus lacks cannot occur.
3. The index holds the posting ``(term, document, position)`` of every corpus
   token that is a probe; it is written once to the shared folder.
4. Posting lists are intersected after each list is shifted by its term's
   offset in the item: postings of one document, item and *diagonal*
   (position - offset) meet in one group.  Only diagonals on which enough
   probes meet go on.
5. Those diagonals are compared word by word with the item, which gives the
   exact phrase matches.
6. ``proximity_matches`` reads the same index for reordered or edited passages:
   ``LEAST`` different *rare* terms of an item within ``SLOP`` positions, in any
   order.  A term is rare where at most a ``RARE_SHARE`` of the documents (but
   ``RARE_DOCS`` in any case) hold it, so common words neither match nor cost.
   ``contamination`` does this on request only.  Rarity belongs to what a
   match is (``OP6_SQL`` states the same rule); ``rare_share=1.0`` counts every
   term, so items of common words are searched exactly too.  Its cost is each
   posting of a common term times the items that have it.

Terms are words with A-Z lowered, in the index as in the comparison, so that
a word is the same term wherever it stands (Spark's ``lower`` depends on the
neighbours of a Greek capital sigma).

Defined cases: a null text has no words; an item without words or with a null
``item_id`` cannot name a match (it is left out); repeated items count once;
rows of documents with equal ``doc_id`` and text are one document and give
equal rows; a very long text is searched whole and compared at its candidates' places
only; with an empty table on either side nothing is hit; no other
column of the inputs is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custfold.llm.common import WORD, ascii_lower, doc_hash, same_key, sift, store, table, text_of

WINDOW, PROBES = 10, 2
LEAST, SLOP = 4, 20
RARE_SHARE, RARE_DOCS = 0.001, 20


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _lowered(text: Column) -> Column:
    """``ascii_lower``, by Spark's faster ``lower`` where all of it is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].alias("doc_id"), text.alias("body"), F.xxhash64(text).alias("_h"))


def benchmark_items(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``_item, item_id (string), words`` that have words."""
    words = words_of(ascii_lower(text_of(items, text_col)))
    return (items.select(items[item_col].cast("string").alias("item_id"), words.alias("words"))
            .where(F.col("item_id").isNotNull() & (F.size("words") > 0)).distinct()
            .withColumn("_item", F.xxhash64("item_id", "words")))


def _terms(items: DataFrame) -> DataFrame:
    return items.select("_item", F.posexplode("words").alias("off", "term"))


def term_counts(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``term, n``: how many of all rows hold each of the items' terms."""
    wanted = store(_terms(items).select("term").distinct(), "bench-terms")
    tokens = rows.select(F.explode(F.array_distinct(words_of(_lowered(F.col("body"))))).alias("term"))
    return store(tokens.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "bench-counts")


def rarest_probes(rows: DataFrame, items: DataFrame, window: int = WINDOW, probes: int = PROBES, counts: DataFrame | None = None) -> DataFrame:
    """``_item, off, term, need`` of every probe, from counts over all rows."""
    terms = _terms(items)
    counts = term_counts(rows, items) if counts is None else counts
    ranked = (terms.join(counts, "term", "left").groupBy("_item")
              .agg(F.array_sort(F.collect_list(F.struct("off", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("t")))
    length = F.least(F.lit(window), F.size("t"))
    at = ranked.select("_item", length.alias("len"), "t", F.explode(F.sequence(F.lit(1), F.size("t") - length + 1)).alias("s"))
    chosen = at.select("_item", "len", F.expr("slice(t, s, len)").alias("t")).where(F.forall("t", lambda x: x["n"] > 0))
    by_count = F.array_sort(F.transform("t", lambda x: F.struct(x["n"], x["off"], x["term"])))
    return (chosen.select("_item", F.least(F.lit(probes), F.col("len")).alias("need"), F.explode(F.slice(by_count, 1, probes)).alias("p"))
            .select("_item", "p.off", "p.term", "need").distinct())


def rare_terms(items: DataFrame, counts: DataFrame, rows: DataFrame, share: float = RARE_SHARE, docs: int = RARE_DOCS) -> DataFrame:
    """``_item, term``: the items' terms that few rows hold."""
    most = rows.agg(F.greatest(F.lit(docs), F.floor(F.count(F.lit(1)) * F.lit(share)))).scalar()
    return _terms(items).select("_item", "term").distinct().join(counts.where(F.col("n") <= most).select("term"), "term").select("_item", "term")


def positional_index(rows: DataFrame, probes: DataFrame) -> DataFrame:
    """Postings ``term, doc_id, _h, pos`` of the probe terms in all rows."""
    tokens = rows.select("doc_id", "_h", F.posexplode(words_of(_lowered(F.col("body")))).alias("pos", "term"))
    return store(tokens.join(probes.select("term").distinct(), "term"), "postings")


def diagonals(index: DataFrame, probes: DataFrame) -> DataFrame:
    """``doc_id, _h, _item, diag`` on which enough shifted postings meet."""
    return (index.join(probes, "term").groupBy("doc_id", "_h", "_item", (F.col("pos") - F.col("off")).alias("diag"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need")).where("n >= need").drop("n", "need"))


def proximity_matches(index: DataFrame, terms: DataFrame, slop: int = SLOP, least: int = LEAST) -> DataFrame:
    """``doc_id, _h, _item, near``: documents where at least ``least`` different
    terms of an item lie within ``slop`` positions, in any order (``near``: the
    most found)."""
    enough = terms.groupBy("_item").agg(F.count_distinct("term").alias("n")).where(F.col("n") >= least).select("_item")
    span = Window.partitionBy("doc_id", "_h", "_item").orderBy("pos").rangeBetween(0, slop - 1)
    return (index.join(terms.join(enough, "_item").distinct(), "term")
            .withColumn("n", F.size(F.collect_set("term").over(span))).where(F.col("n") >= least)
            .groupBy("doc_id", "_h", "_item").agg(F.max("n").alias("near")))


def _matches(words: Column, window: int) -> Column:
    """Exact matches on each diagonal of ``cands``: item and hit positions."""
    def one(c: Column) -> Column:
        same = F.transform(c["words"], lambda w, i: F.coalesce(F.get(words, c["diag"] + i) == w, F.lit(False)))
        return F.struct(c["item_id"].alias("item_id"), c["diag"].alias("diag"), same.alias("same"))

    def covered(m: Column) -> Column:
        length = F.least(F.lit(window), F.size(m["same"]))
        starts = F.filter(F.sequence(F.lit(0), F.size(m["same"]) - length),
                          lambda s: F.forall(F.slice(m["same"], s + 1, length), lambda x: x))
        return F.struct(m["item_id"].alias("item_id"),
                        F.flatten(F.transform(starts, lambda s: F.sequence(m["diag"] + s, m["diag"] + s + length - 1))).alias("at"))

    return F.filter(F.transform(F.transform("cands", one), covered), lambda m: F.size(m["at"]) > 0)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", proximity: bool = False, rare_share: float = RARE_SHARE) -> DataFrame:
    """``doc_id, _h, n_words, hits, near`` of every row; ``hits`` lists the
    item and the word positions of each exact match (null: none), ``near`` with
    ``proximity`` the items with a proximity match (null: none) by terms that at
    most ``rare_share`` of the rows hold (1.0: all terms)."""
    rows = _keyed(docs, id_col, text_col)
    bench = store(benchmark_items(items, item_col, item_text), "bench-items")
    counts = term_counts(rows, bench)
    probes = store(rarest_probes(rows, bench, window, counts=counts), "bench-probes")
    rare = store(rare_terms(bench, counts, rows, rare_share), "bench-rare") if proximity else None
    index = positional_index(rows, probes.select("term").union(rare.select("term")) if proximity else probes)
    cands = (diagonals(index, probes).join(bench, "_item").select("doc_id", "_h", F.struct("item_id", "diag", "words").alias("c"))
             .groupBy("doc_id", "_h").agg(F.collect_list("c").alias("cands")))
    if proximity:
        close = (proximity_matches(index, rare).join(bench.select("_item", "item_id"), "_item")
                 .groupBy(F.col("doc_id").alias("_d"), F.col("_h").alias("_dh")).agg(F.collect_set("item_id").alias("near")))
        cands = cands.join(close, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_dh")), "full").select(
            F.coalesce("doc_id", "_d").alias("doc_id"), F.coalesce("_h", "_dh").alias("_h"), "cands", "near")
    else:
        cands = cands.withColumn("near", F.lit(None).cast("array<string>"))
    cands = store(cands, "bench-cands")
    some, rest = sift(rows, doc_hash(rows["doc_id"], rows["_h"]), cands, doc_hash("doc_id", "_h"))
    joined = some.join(cands.hint("shuffle_hash"), same_key(rows, cands, ["doc_id", "_h"]), "left").select(
        rows["doc_id"], rows["_h"], "body", "cands", "near")
    none = [F.lit(None).cast(cands.schema[c].dataType).alias(c) for c in ("cands", "near")]
    joined = joined.union(rest.select("doc_id", "_h", "body", *none))
    exact = F.transform(F.array(words_of(ascii_lower(F.col("body")))), lambda ws: _matches(ws, window))
    hits = F.when(F.col("cands").isNotNull(), F.get(exact, F.lit(0)))
    return joined.select("doc_id", "_h", F.regexp_count("body", F.lit(WORD)).cast("long").alias("n_words"), hits.alias("hits"), "near")


def contamination_digest(found: DataFrame) -> DataFrame:
    """Word and item counts of ``contamination``'s rows; ``contaminated`` is by
    exact matches, ``n_near`` counts the items with a proximity match."""
    none = F.array().cast("array<string>")
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda m: m["item_id"])))
    at = F.array_distinct(F.flatten(F.transform("hits", lambda m: m["at"])))
    out = found.select("doc_id", "_h", "n_words", F.coalesce(F.array_size(at), F.lit(0)).cast("long").alias("n_hit"),
                       F.coalesce(ids, none).alias("ids"), F.coalesce(F.array_sort("near"), none).alias("near"))
    return out.select("doc_id", "_h", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                      F.size("near").cast("long").alias("n_near"), F.sha2(F.array_join("near", ","), 256).alias("near_items_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` inside benchmark windows of ten words, and items whose
    rare terms stand near each other (``n_near``, ``near_items_sha256``)."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), proximity=True)
    return contamination_digest(found).drop("_h")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0 AND item IS NOT NULL),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM bw),
ln AS (SELECT DISTINCT n FROM g),
dw AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ln),
m AS (SELECT rid, item, i, dw.n FROM (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM dw) dw JOIN g ON dw.n = g.n AND dw.gram = g.gram),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid),
bt AS (SELECT DISTINCT item, unnest(w) AS term FROM b WHERE item IS NOT NULL),
dt AS (SELECT rid, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
df AS (SELECT term, count(DISTINCT rid) AS n FROM dt WHERE term IN (SELECT term FROM bt) GROUP BY term),
rare AS (SELECT item, term FROM bt JOIN df USING (term) WHERE n <= greatest(20, floor((SELECT count(*) FROM documents) * 0.001))),
post AS (SELECT rid, item, term, pos FROM dt JOIN rare USING (term)),
close AS (SELECT DISTINCT rid, item FROM (
    SELECT x.rid, x.item, x.pos FROM post x JOIN post y ON y.rid = x.rid AND y.item = x.item AND y.pos BETWEEN x.pos AND x.pos + 19
    GROUP BY x.rid, x.item, x.pos HAVING count(DISTINCT y.term) >= 4)),
nr AS (SELECT rid, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near FROM close GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near, sha256(coalesce(near, '')) AS near_items_sha256
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid) LEFT JOIN nr USING (rid)
"""
