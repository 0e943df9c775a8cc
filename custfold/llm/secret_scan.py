"""Secret scan with a random forest against false positives (DataFrame
functions and Spark's own forest only).

* **Candidates.**  Runs of at least ``MIN_LENGTH`` characters of letters,
  digits and ``_+/=-`` that hold a digit, in whole texts.
* **Features.**  Length, counts of letters, digits and signs, changes of
  character class, distinct characters, entropy, share covered by dictionary
  words (letter runs that are words of at least ``DICTIONARY`` occurrences in
  the corpus, counted over all rows), whether the candidate is part of a path
  or url, and the hashed neighbouring words.
* **Forest.**  Trained on labelled findings (at most ``TRAIN_ROWS``, chosen by
  a hash, none from the held-out fold ``crc32(doc_id) mod 5 = 0``).  Labels can
  be handed in; ``assigned_label`` labels findings by the code around them: 1
  where a credential name is assigned the candidate, 0 otherwise.  The label
  is no feature.

Results carry a digest of the candidate, never the candidate.

Defined cases: a null text counts as empty; repeated candidates in a text are
findings of their own; repeated rows repeat their findings; without labels of
both kinds every finding scores the share of 1 among them (1 where there are
none); an empty table gives an empty result; no other column of the input is
read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import store, table, text_of

MIN_LENGTH, DICTIONARY, TRAIN_ROWS, TREES, DEPTH, HASHED, SEED = 16, 5, 20_000, 30, 6, 64, 11
_SET = r"A-Za-z0-9_+/=\-"
CANDIDATE = rf"(?<![{_SET}])(?=[A-Za-z_+/=\-]*+[0-9])[{_SET}]{{{MIN_LENGTH},}}+"
#: What stands before a candidate that is assigned to a credential name.
ASSIGNED = r"(?i)(token|secret|passw(or)?d|pwd|key|credential|auth)\w*[\"']?\s*(:=|=>|[=:])\s*[\"']?$"
NUMBERS = ["length", "letters", "digits", "signs", "changes", "distinct", "entropy", "coverage", "in_path"]
WORDS = ["before2", "before1", "after1"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, word_no, no, secret, before2, before1, after1, lead`` of every
    candidate; ``lead`` is what precedes it in its word."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("body")).where(F.col("body").rlike(CANDIDATE))

    def hits(ws: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).rlike(CANDIDATE))

    def around(ws: Column) -> Column:
        near = lambda i, k: F.coalesce(F.get(ws, i + k), F.lit("")).alias
        return F.transform(hits(ws), lambda i: F.struct(i.alias("word_no"), F.get(ws, i).alias("word"), near(i, -2)("before2"),
                                                        near(i, -1)("before1"), near(i, 1)("after1")))

    words = F.transform(F.array(F.split("body", r"\s+")), around)
    found = rows.select("doc_id", F.explode(F.get(words, F.lit(0))).alias("w")).select("doc_id", "w.*")
    found = found.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))).alias("no", "secret"))
    return found.withColumn("lead", F.expr("substring_index(word, secret, 1)")).drop("word")


def assigned_label(found: DataFrame) -> Column:
    return F.concat_ws(" ", "before2", "before1", "lead").rlike(ASSIGNED).cast("int")


def dictionary_words(docs: DataFrame, parts: DataFrame, least: int = DICTIONARY, text_col: str = "text") -> DataFrame:
    """Those of ``parts (part)`` that are words of the corpus, counted over all rows."""
    words = docs.select(F.explode(F.split(F.lower(text_of(docs, text_col)), r"[^a-z]+")).alias("part"))
    return words.join(parts, "part").groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("part")


def with_features(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``found`` with the number columns of ``NUMBERS``."""
    s = F.col("secret")
    length = F.length(s)
    chars = F.split(s, "")
    counts = F.transform(F.array_distinct(chars), lambda c: F.array_size(F.filter(chars, lambda x: x == c)) / length)
    kinds = F.translate(s, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/=-", "U" * 26 + "L" * 26 + "9" * 10 + "." * 5)
    runs = F.regexp_replace(kinds, r"(.)\1*", "$1")
    bare = F.lower(F.concat_ws(" ", "before1", "lead"))
    found = store(found.withColumn("_f", F.monotonically_increasing_id()), "secret-found")
    parts = found.select("_f", F.explode(F.filter(F.split(F.lower(s), r"[^a-z]+"), lambda p: F.length(p) >= 3)).alias("part"))
    words = dictionary_words(docs, store(parts.select("part").distinct(), "secret-parts"), text_col=text_col)
    covered = parts.join(words, "part").groupBy("_f").agg(F.sum(F.length("part")).alias("covered"))
    return (found.join(covered, "_f", "left").drop("_f")
            .withColumn("length", length.cast("double"))
            .withColumn("letters", F.regexp_count(s, F.lit("[A-Za-z]")).cast("double"))
            .withColumn("digits", F.regexp_count(s, F.lit("[0-9]")).cast("double"))
            .withColumn("signs", F.col("length") - F.col("letters") - F.col("digits"))
            .withColumn("changes", (F.length(runs) - 1).cast("double"))
            .withColumn("distinct", F.array_size(F.array_distinct(chars)).cast("double"))
            .withColumn("entropy", F.round(F.aggregate(counts, F.lit(0.0), lambda a, p: a - p * F.log2(p)), 9))
            .withColumn("coverage", F.coalesce("covered", F.lit(0)) / length)
            .withColumn("in_path", (s.contains("/") | bare.contains("/") | bare.contains("www.")).cast("double")).drop("covered"))


def scan_secrets(docs: DataFrame, label=assigned_label, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, word_no, no, secret_sha256, length, score, is_secret`` of every
    candidate; ``label`` gives the training label from the finding's columns
    (null: not labelled)."""
    found = with_features(candidates(docs, id_col, text_col), docs, text_col)
    found = store(found.withColumn("label", label(found).cast("double")), "secret-features")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    order = F.xxhash64("doc_id", "word_no", "no", "secret")
    # A bounded sample in one sorted partition: the forest's draws depend on order.
    train = store(found.where(F.col("label").isNotNull() & (fold != 0)).orderBy(order, "doc_id", "word_no", "no").limit(TRAIN_ROWS)
                  .coalesce(1), "secret-train")
    n = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two numbers
    if len(n) == 2:
        hashed = FeatureHasher(inputCols=WORDS, outputCol="near", numFeatures=HASHED)
        whole = VectorAssembler(inputCols=[*NUMBERS, "near"], outputCol="features")
        tidy = lambda df: whole.transform(hashed.transform(df.withColumns({w: F.lower(F.regexp_replace(w, r"[0-9]+", "9")) for w in WORDS})))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
        model = forest.fit(tidy(train).select("label", "features").coalesce(1))
        scored = model.transform(tidy(found)).withColumn("score", F.round(vector_to_array("probability")[1], 9))
    else:
        share = n.get(1.0, 0) / sum(n.values()) if n else 1.0
        scored = found.withColumn("score", F.lit(share))
    return scored.select("doc_id", F.col("word_no").cast("long").alias("word_no"), F.col("no").cast("long").alias("no"),
                         F.sha2("secret", 256).alias("secret_sha256"), F.col("length").cast("long").alias("length"), "score",
                         (F.col("score") >= 0.5).alias("is_secret"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all ``documents``."""
    return scan_secrets(table(spark, sf_dir, "documents"))
