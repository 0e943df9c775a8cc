"""Email column expressions: correction, validation, classification, keys.

All of these are built-in Spark expressions; no Python runs per row.  The
staged DataFrame forms (``with_gibberish``, ``with_email_check``) use only
regex, string and array functions and run in generated code; the
self-contained Column forms bind shared values with a one-element
``transform`` (interpreted, but compact).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custfold import config as C
from custfold.functions.common import let

# Address shape required by the master build.  ``\z`` rather than ``$``:
# Java's ``$`` also matches before a trailing newline.
MASTER_EMAIL_RE = r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}\z"
DIGITS_ONLY_RE = r"^[0-9]+\z"
# Both rules in one pattern: a filter that is pushed below the projection of a
# corrected address then repeats that expression once, not once per rule.
MASTER_ADDRESS_RE = r"^(?![0-9]+@)[^@\s]+@[^@\s]+\.[A-Za-z]{2,}\z"
# White space as Python's ``str`` methods and patterns see it.
PY_SPACE = r"\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The same characters one by one (for ``trim``, which is cheaper than a pattern).
PY_SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
             + "\u2028\u2029\u202f\u205f\u3000")
# The same address shape under that white space (the point-of-sale check).
POS_EMAIL_RE = rf"^[^@{PY_SPACE}]+@[^@{PY_SPACE}]+\.[A-Za-z]{{2,}}\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_literal(mapping: dict) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def py_strip(c) -> Column:
    """Whitespace strip on both ends (rules that came from Python ``strip``,
    which strips every Unicode space)."""
    return F.btrim(_col(c), F.lit(PY_SPACES))


def fix_domain(c, corrections: dict | None = None) -> Column:
    """Lower/trim and replace a mistyped domain; values without ``@`` pass.

    Only the text before the second ``@`` survives (``a@b.com@c`` ->
    ``a@b.com``), as in the rule being reproduced.
    """
    e = _col(c)
    corrections = C.DOMAIN_CORRECTIONS if corrections is None else corrections
    low = F.lower(F.trim(e))
    local = F.split_part(low, F.lit("@"), F.lit(1))
    domain = F.split_part(low, F.lit("@"), F.lit(2))
    fixed = F.try_element_at(_map_literal(corrections), domain) if corrections else F.lit(None)
    return (F.when(e.isNull() | ~e.contains("@"), e)
            .otherwise(F.concat(local, F.lit("@"), F.coalesce(fixed, domain))))


def is_valid_address(c) -> Column:
    """Not blank, of the form x@y.tld, and the local part not digits only."""
    return F.coalesce(_col(c).rlike(MASTER_ADDRESS_RE), F.lit(False))


def email_domain(c) -> Column:
    return F.lower(F.split_part(_col(c), F.lit("@"), F.lit(2)))


def is_blocked_domain(c, blocked=None) -> Column:
    return email_domain(c).isin(list(C.BLOCKED_DOMAINS if blocked is None else blocked))


def inbox_key(c) -> Column:
    """Normalised address reaching the same inbox (plus label and gmail dots)."""
    e = _col(c)
    local = F.split_part(F.lower(F.split_part(e, F.lit("@"), F.lit(1))), F.lit("+"), F.lit(1))
    domain = F.lower(F.split_part(e, F.lit("@"), F.lit(2)))
    is_gmail = domain.isin("gmail.com", "googlemail.com")
    local = F.when(is_gmail, F.replace(local, F.lit("."), F.lit(""))).otherwise(local)
    domain = F.when(is_gmail, F.lit("gmail.com")).otherwise(domain)
    return F.when(e.isNull() | ~e.contains("@"), F.lit(None).cast("string")) \
        .otherwise(F.concat(local, F.lit("@"), domain))


# ---------------------------------------------------------------------------
# Gibberish score over the local part.
# ---------------------------------------------------------------------------
_SIGNAL_WEIGHTS = C.GIBBERISH_SIGNALS


def gibberish_word(local) -> Column:
    """Local part cut at the first of ``._+-``, trailing digits removed."""
    w = F.regexp_replace(_col(local), r"[._+\-].*$", "")
    return F.regexp_replace(w, r"[0-9]+$", "")


_SEP = "\u0001"
# A run of equal 2-character units in a sorted, separator-joined list.
_RUN = r"(?:^|\x01)(..)(?:\x01\1)+(?=\x01|$)"
_RUN3 = r"(?:^|\x01)(..)(?:\x01\1){2,}(?=\x01|$)"


def _consonant_mask(w: Column) -> Column:
    """consonant -> 'c', anything else -> '.'."""
    return F.regexp_replace(F.regexp_replace(w, f"[{C.CONSONANTS}]", "c"), "[^c]", ".")


def _sorted_bigrams(w: Column) -> Column:
    """Overlapping bigrams (a zero-width lookahead per position), sorted and
    joined, so equal bigrams form runs a back-reference regex can count."""
    return F.array_join(F.array_sort(F.regexp_extract_all(w, F.lit(r"(?s)(?=(..))"), 1)), _SEP)


def _gibberish_flags(w: Column, n: Column, mask: Column, bigrams: Column) -> list[Column]:
    """The ten signal conditions, in rule order, from bound parts."""
    nn = F.when(n >= 6, n)                       # divisions only for 6+ chars
    cons = f"[{C.CONSONANTS}]"
    vowels = n - F.length(F.regexp_replace(w, f"[{C.VOWELS}]", ""))
    # Adjacent consonant pairs = consonants - runs of consonants.
    n_cons = F.length(mask) - F.length(F.replace(mask, F.lit("c"), F.lit("")))
    dotted = F.concat(F.lit("."), mask)
    runs = (F.length(dotted) - F.length(F.replace(dotted, F.lit(".c"), F.lit("")))) / 2
    pairs = n_cons - runs
    diversity = F.size(F.array_distinct(F.split(w, ""))) / nn
    repeated = F.size(F.regexp_extract_all(bigrams, F.lit("(?s)" + _RUN), 1))
    return [
        w.rlike(r"(?s)(.)\1{2,}"),
        w.rlike(r"(?s)^(.{1,2})\1{2,}"),
        vowels == 0,
        (vowels > 0) & (vowels / nn < 0.15),
        w.rlike(cons + "{5,}"),
        pairs / (nn - 1) > 0.6,
        diversity <= 0.4,
        (diversity > 0.4) & (diversity <= 0.5),
        repeated >= 2,
        (repeated == 1) & bigrams.rlike("(?s)" + _RUN3),
    ]


def _signals_of(flags: list[Column], n: Column) -> Column:
    names = [F.when(f, F.lit(name)) for f, (name, _) in zip(flags, _SIGNAL_WEIGHTS)]
    return F.when(n < 6, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*names)))


def _score_of(flags: list[Column], n: Column) -> Column:
    total = F.lit(0)
    for f, (_, weight) in zip(flags, _SIGNAL_WEIGHTS):
        total = total + F.when(f, F.lit(weight)).otherwise(F.lit(0))
    return F.when(n < 6, F.lit(0)).otherwise(total).cast("int")


def gibberish_signals(local) -> Column:
    """Array of signal names in rule order (empty when the word is short).

    Self-contained Column form; the word is bound once through a one-element
    ``transform`` so the regex chain is not repeated per signal.
    """
    word = gibberish_word(local)
    return let(word, lambda w: _signals_of(
        _gibberish_flags(w, F.length(w), _consonant_mask(w), _sorted_bigrams(w)), F.length(w)))


def with_gibberish(df: DataFrame, local_col: str, prefix: str = "gibberish") -> DataFrame:
    """Add ``<prefix>_signals`` and ``<prefix>_score``, computed in staged
    columns entirely inside generated code (regex and string functions).  Words
    of fewer than six characters have no signals, so no pattern is tried on them."""
    t = f"_{prefix}"
    out = df.withColumn(f"{t}_w", gibberish_word(F.col(local_col)))
    w = F.col(f"{t}_w")
    out = out.withColumns({f"{t}_n": F.length(w), f"{t}_w": F.when(F.length(w) >= 6, w)})
    out = out.withColumns({f"{t}_mask": _consonant_mask(w), f"{t}_big": _sorted_bigrams(w)})
    n = F.col(f"{t}_n")
    flags = _gibberish_flags(w, n, F.col(f"{t}_mask"), F.col(f"{t}_big"))
    out = out.withColumn(f"{t}_f", F.array(*flags))
    bound = [F.get(F.col(f"{t}_f"), i) for i in range(len(flags))]
    out = out.withColumns({f"{prefix}_signals": _signals_of(bound, n), f"{prefix}_score": _score_of(bound, n)})
    return out.drop(f"{t}_w", f"{t}_n", f"{t}_mask", f"{t}_big", f"{t}_f")


def gibberish_score_of(signals: Column) -> Column:
    weights = _map_literal(dict(_SIGNAL_WEIGHTS))
    return F.aggregate(signals, F.lit(0),
                       lambda acc, s: acc + F.element_at(weights, s)).cast("int")


def _cheap_reason(r: Column, stripped: Column, email: Column, domain: Column) -> Column:
    """The reason from every check except the gibberish score (which has
    the lowest priority); NULL when those checks pass."""
    return (F.when(r.isNull() | (stripped == ""), F.lit("missing"))
            .when(~email.rlike(POS_EMAIL_RE), F.lit("bad_format"))
            .when(email.isin(C.PLACEHOLDER_ADDRESSES), F.lit("placeholder"))
            .when(domain.isin(C.INTERNAL_DOMAINS), F.lit("internal_domain"))
            .when(domain.isin(C.DISPOSABLE_DOMAINS), F.lit("disposable")))


def _reason(r: Column, stripped: Column, email: Column, domain: Column,
            signals: Column, score: Column) -> Column:
    """First failing check wins; the gibberish score comes last."""
    return F.coalesce(_cheap_reason(r, stripped, email, domain),
                      F.when(score >= C.GIBBERISH_REJECT_AT,
                             F.concat(F.lit("gibberish:"), F.array_join(signals, ","))))


def classify_email(raw) -> Column:
    """struct(email, email_ok, email_reason): first failing check wins."""
    r = _col(raw).cast("string")

    def decide(e):
        stripped, email = e["s"], e["e"]
        domain = F.substring_index(email, "@", -1)
        local = F.substring_index(email, "@", 1)
        missing = e["raw_null"] | (stripped == "")

        def with_signals(signals):
            reason = _reason(F.when(e["raw_null"], F.lit(None)).otherwise(F.lit("")), stripped, email,
                             domain, signals, gibberish_score_of(signals))
            return let(reason, lambda rs: F.struct(
                F.when(missing, F.lit(None).cast("string")).otherwise(email).alias("email"),
                rs.isNull().alias("email_ok"), rs.alias("email_reason")))

        return let(gibberish_signals(local), with_signals)

    stripped = py_strip(r)
    return let(F.struct(r.isNull().alias("raw_null"), stripped.alias("s")),
               lambda v: let(F.struct(v["raw_null"].alias("raw_null"), v["s"].alias("s"),
                                      F.lower(v["s"]).alias("e")), decide))


def with_email_check(df: DataFrame, raw_col: str = "email") -> DataFrame:
    """Replace ``raw_col`` by the cleaned email and add ``email_ok``,
    ``email_reason`` and ``email_reason_pre`` (the reason before the
    gibberish score).  Computed in staged columns, each once per row and
    inside generated code; filters on ``email_reason_pre`` stay small when
    pushed down."""
    out = df.withColumn("_ec_raw", F.col(raw_col).cast("string"))
    out = out.withColumn("_ec_strip", py_strip(F.col("_ec_raw")))
    out = out.withColumn("_ec_email", F.lower(F.col("_ec_strip")))
    out = out.withColumn("_ec_local", F.substring_index(F.col("_ec_email"), "@", 1)) \
        .withColumn("_ec_domain", F.substring_index(F.col("_ec_email"), "@", -1))
    out = out.withColumn("email_reason_pre", _cheap_reason(F.col("_ec_raw"), F.col("_ec_strip"),
                                                           F.col("_ec_email"), F.col("_ec_domain")))
    pre = F.col("email_reason_pre")
    # The score counts only where every other check passes.
    out = with_gibberish(out.withColumn("_ec_local", F.when(pre.isNull(), F.col("_ec_local"))), "_ec_local", "_ec_g")
    reason = F.when(pre.isNotNull(), pre).when(
        F.col("_ec_g_score") >= C.GIBBERISH_REJECT_AT,
        F.concat(F.lit("gibberish:"), F.array_join(F.col("_ec_g_signals"), ",")))
    missing = F.col("_ec_raw").isNull() | (F.col("_ec_strip") == "")
    out = out.withColumn("email_reason", reason) \
        .withColumn(raw_col, F.when(missing, F.lit(None).cast("string")).otherwise(F.col("_ec_email"))) \
        .withColumn("email_ok", F.col("email_reason").isNull())
    return out.drop("_ec_raw", "_ec_strip", "_ec_email", "_ec_local", "_ec_domain",
                    "_ec_g_signals", "_ec_g_score")


def has_reason(raw, reasons) -> Column:
    """Whether the reason that ``with_email_check`` would give is one of the
    domain lists of ``reasons`` (``internal_domain``, ``disposable``): a test on the
    address alone, with the raw value evaluated once unless the domain is listed
    (only then the pattern is tried).  None where a reason needs more than that."""
    lists = {"internal_domain": C.INTERNAL_DOMAINS, "disposable": [d for d in C.DISPOSABLE_DOMAINS if d not in C.INTERNAL_DOMAINS]}
    if not set(reasons) <= set(lists):
        return None
    domains = [d for r in reasons for d in lists[r]]
    addresses = [a for a in C.PLACEHOLDER_ADDRESSES if a.rsplit("@", 1)[-1] in domains]
    if not domains:
        return F.lit(False)
    but = "".join(f"(?!{re.escape(a)}\\z)" for a in addresses)
    pattern = rf"^{but}[^@{PY_SPACE}]+@(?:" + "|".join(re.escape(d) for d in domains) + r")\z"
    email = F.lower(py_strip(_col(raw).cast("string")))
    return F.coalesce(F.substring_index(email, "@", -1).isin(domains) & email.rlike(pattern), F.lit(False))


def reason_class(reason) -> Column:
    return F.split_part(_col(reason), F.lit(":"), F.lit(1))
