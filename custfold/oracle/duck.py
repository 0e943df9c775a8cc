"""DuckDB oracle: an independent SQL statement of every rule.

Written directly from the rules (not generated from the Spark code): joins
to VALUES tables instead of literal maps, windows instead of aggregates,
list lambdas instead of staged columns.  ``with_ctes(names, body)`` builds
a statement from the named CTEs (and their dependencies) plus a body.
"""

from __future__ import annotations

from custfold import config as C
from custfold.sources.fixture_sql import FIXTURE_SQL


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


AS_OF = f"DATE '{C.AS_OF.isoformat()}'"
ADULT_CUTOFF = f"DATE '{C.AS_OF.replace(year=C.AS_OF.year - C.MIN_AGE).isoformat()}'"
OLDEST = f"DATE '{C.AS_OF.replace(year=C.AS_OF.year - C.MAX_AGE).isoformat()}'"
RUN_TS = f"TIMESTAMP '{C.RUN_TS.isoformat(sep=' ')}'"
# trim() over the listed characters (every space Python's strip removes)
SPACES = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))
STRIP = "trim({x}, " + SPACES.replace("{", "").replace("}", "") + ")"
EMAIL_RE = "'^[^@[:space:]]+@[^@[:space:]]+\\.[A-Za-z]{2,}$'"
BRANDS = _in_list(C.BRANDS)


def strip(x: str) -> str:
    return STRIP.format(x=x)


def clean_birthday(d: str) -> str:
    return f"(CASE WHEN {d} > {AS_OF} OR {d} < {OLDEST} THEN NULL ELSE {d} END)"


def adult(d: str) -> str:
    cb = clean_birthday(d)
    return f"({cb} IS NULL OR {cb} <= {ADULT_CUTOFF})"


def adult_at(d: str, as_of) -> str:
    """The age gate for another run date (a ``datetime.date``)."""
    cut = f"DATE '{as_of.replace(year=as_of.year - C.MIN_AGE).isoformat()}'"
    old = f"DATE '{as_of.replace(year=as_of.year - C.MAX_AGE).isoformat()}'"
    cb = f"(CASE WHEN {d} > DATE '{as_of.isoformat()}' OR {d} < {old} THEN NULL ELSE {d} END)"
    return f"({cb} IS NULL OR {cb} <= {cut})"


def clean_name(x: str) -> str:
    return (f"(CASE WHEN lower(trim(coalesce({x}, ''))) IN {_in_list(C.NAME_PLACEHOLDERS)} "
            f"THEN NULL ELSE trim({x}) END)")


def clean_tags(t: str) -> str:
    u = f"list_transform({t}, lambda v: upper(trim(coalesce(v, ''))))"
    kept = f"list_filter({u}, lambda x, i: x <> '' AND list_position({u}, x) = i)"
    return f"(CASE WHEN len({kept}) = 0 THEN NULL ELSE {kept} END)"


def inbox_key(e: str) -> str:
    local = f"split_part(lower(split_part({e}, '@', 1)), '+', 1)"
    dom = f"lower(split_part({e}, '@', 2))"
    return (f"(CASE WHEN {e} IS NULL OR position('@' IN {e}) = 0 THEN NULL "
            f"WHEN {dom} IN ('gmail.com', 'googlemail.com') THEN replace({local}, '.', '') || '@gmail.com' "
            f"ELSE {local} || '@' || {dom} END)")


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(str(v)) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({', '.join(cols)})"


def market_tags(m: str) -> str:
    """parse_market over a column, as nested expressions."""
    clean = f"regexp_replace(lower(trim(split_part({m}, '?', 1))), '-+$', '')"
    brand = f"split_part({clean}, '-', 1)"
    rest = f"substr({clean}, length({brand}) + 2)"
    slugs = sorted(C.COUNTRY_MAP, key=len, reverse=True)
    country = "CASE " + " ".join(
        f"WHEN {rest} = {_q(s)} OR starts_with({rest}, {_q(s + '-')}) THEN {_q(C.COUNTRY_MAP[s])}"
        for s in slugs) + f" ELSE split_part({rest}, '-', 1) END"
    venue = "CASE " + " ".join(
        f"WHEN {rest} = {_q(s)} THEN NULL WHEN starts_with({rest}, {_q(s + '-')}) "
        f"THEN substr({rest}, {len(s) + 2})" for s in slugs) + \
        f" ELSE substr({rest}, length(split_part({rest}, '-', 1)) + 2) END"
    return (f"(CASE WHEN {m} IS NULL OR trim({m}) = '' THEN []::VARCHAR[] "
            f"ELSE [upper({brand}), upper({country})] || "
            f"CASE WHEN coalesce({venue}, '') = '' THEN []::VARCHAR[] ELSE [upper({venue})] END END)")


def _gib_signals(w: str) -> str:
    n = f"length({w})"
    cons = C.CONSONANTS
    vowels = f"({n} - length(regexp_replace({w}, '[aeiouy]', '', 'g')))"
    pairs = (f"len(list_filter(range(1, {n}), lambda i: contains('{cons}', substr({w}, i, 1)) "
             f"AND contains('{cons}', substr({w}, i + 1, 1))))")
    rep_char = (f"len(list_filter(range(1, {n} - 1), lambda i: substr({w}, i, 1) = substr({w}, i + 1, 1) "
                f"AND substr({w}, i, 1) = substr({w}, i + 2, 1))) > 0")
    rep_unit = (f"(substr({w}, 1, 3) = repeat(substr({w}, 1, 1), 3) "
                f"OR substr({w}, 1, 6) = repeat(substr({w}, 1, 2), 3))")
    div = f"(len(list_distinct(string_split({w}, ''))) / {n})"
    hist = f"map_values(list_aggregate(list_transform(range(1, {n}), lambda i: substr({w}, i, 2)), 'histogram'))"
    repeated = f"len(list_filter({hist}, lambda c: c >= 2))"
    maxc = f"list_max({hist})"
    items = [
        (rep_char, "repeat_char"), (rep_unit, "repeat_unit"),
        (f"{vowels} = 0", "no_vowels"), (f"{vowels} > 0 AND {vowels} / {n} < 0.15", "low_vowels"),
        (f"regexp_matches({w}, '[{cons}]{{5,}}')", "consonant_run"),
        (f"{pairs} / ({n} - 1) > 0.6", "cc_density"),
        (f"{div} <= 0.4", "low_diversity"), (f"{div} > 0.4 AND {div} <= 0.5", "mid_diversity"),
        (f"{repeated} >= 2", "repeat_bigrams"), (f"{repeated} = 1 AND {maxc} >= 3", "repeat_bigram_x3"),
    ]
    arr = "[" + ", ".join(f"CASE WHEN {c} THEN '{name}' END" for c, name in items) + "]"
    return f"(CASE WHEN {n} < 6 THEN []::VARCHAR[] ELSE list_filter({arr}, lambda x: x IS NOT NULL) END)"


_WEIGHTS = {"repeat_char": 2, "repeat_unit": 3, "no_vowels": 3, "low_vowels": 2, "consonant_run": 2,
            "cc_density": 2, "low_diversity": 3, "mid_diversity": 2, "repeat_bigrams": 2,
            "repeat_bigram_x3": 2}


def gib_score(sig: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _WEIGHTS.items())
    return f"coalesce(list_sum(list_transform({sig}, lambda s: CASE s {cases} END)), 0)"


# ---------------------------------------------------------------------------
# CTE library: name -> (dependencies, SQL)
# ---------------------------------------------------------------------------
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, sql):
    CTES[name] = (deps, sql)


for _name, _sql in FIXTURE_SQL.items():
    cte(_name, [], _sql.strip())

cte("domain_corrections", [], _values(sorted(C.DOMAIN_CORRECTIONS.items()), ["wrong", "correct"]))

# -- email check on the POS feed --------------------------------------------
cte("revel_g0", ["revel_raw"], f"""
SELECT _seq, resource_uri, _brand, first_name, last_name, email, email_opt_in, updated_date,
  {strip('CAST(email AS VARCHAR)')} AS e_strip,
  lower({strip('CAST(email AS VARCHAR)')}) AS e_low
FROM revel_raw""")
cte("revel_g1", ["revel_g0"], f"""
SELECT *, split_part(e_low, '@', 1) AS e_local, split_part(e_low, '@', 2) AS e_dom,
  regexp_replace(regexp_replace(split_part(e_low, '@', 1), '[._+\\-].*$', ''), '[0-9]+$', '') AS g_word
FROM revel_g0""")
cte("revel_g2", ["revel_g1"], f"SELECT *, {_gib_signals('g_word')} AS g_sig FROM revel_g1")
cte("revel_typed", ["revel_g2"], f"""
SELECT {strip("CAST(coalesce(nullif(resource_uri, ''), NULL) AS VARCHAR)")} AS revel_id,
  _brand AS brand, first_name, last_name,
  CASE WHEN email IS NULL OR e_strip = '' THEN NULL ELSE e_low END AS email,
  coalesce(email_opt_in, false) AS email_opt_in,
  TRY_CAST(CAST(updated_date AS VARCHAR) AS TIMESTAMP) AS updated_date,
  CASE WHEN email IS NULL OR e_strip = '' THEN 'missing'
       WHEN NOT regexp_matches(e_low, '^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{{2,}}$') OR length(translate(e_low, {SPACES}, '')) < length(e_low) THEN 'bad_format'
       WHEN e_low IN {_in_list(C.PLACEHOLDER_ADDRESSES)} THEN 'placeholder'
       WHEN e_dom IN {_in_list(C.INTERNAL_DOMAINS)} THEN 'internal_domain'
       WHEN e_dom IN {_in_list(C.DISPOSABLE_DOMAINS)} THEN 'disposable'
       WHEN {gib_score('g_sig')} >= {C.GIBBERISH_REJECT_AT} THEN 'gibberish:' || array_to_string(g_sig, ',')
  END AS email_reason,
  _seq
FROM revel_g2""")
cte("revel_kept", ["revel_typed"], f"""
SELECT *, email_reason IS NULL AS email_ok FROM revel_typed
WHERE revel_id IS NOT NULL AND revel_id <> ''
  AND coalesce(split_part(email_reason, ':', 1) NOT IN {_in_list(C.DISCARD_REASONS)}, true)""")
cte("revel_customers", ["revel_kept"], f"""
SELECT revel_id, brand, first_name, last_name, email, email_ok, email_opt_in, updated_date,
  email_reason, {RUN_TS} AS updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY revel_id ORDER BY _seq DESC) AS rn FROM revel_kept) q
WHERE rn = 1""")

# -- newsletter signups -----------------------------------------------------
_site_case = "CASE " + " ".join(f"WHEN {{s}} = {_q(k)} THEN {_q(v)}" for k, v in C.SITE_BRANDS.items()) + " END"
cte("signup_checked", ["signup_events"], f"""
SELECT seq, ts, em AS email, br AS brand, co AS country, st AS site, page, first_name, last_name,
  CASE WHEN em = '' OR position('@' IN em) = 0 THEN 'a valid email is required'
       WHEN br NOT IN {BRANDS} THEN 'unknown site or brand: ' || CASE WHEN st <> '' THEN st ELSE br END
  END AS reject_reason
FROM (
  SELECT event_id AS seq, ts,
    lower({strip("coalesce(email, '')")}) AS em,
    lower({strip("coalesce(site, '')")}) AS st,
    upper({strip("coalesce(nullif(brand, ''), " + _site_case.format(s="lower(" + strip("coalesce(site, '')") + ")") + ", '')")}) AS br,
    upper({strip("coalesce(nullif(country, ''), 'UAE')")}) AS co,
    nullif({strip('page')}, '') AS page,
    nullif({strip('first_name')}, '') AS first_name,
    nullif({strip('last_name')}, '') AS last_name
  FROM signup_events) q""")
def newsletter_sql(batch: str = "true") -> str:
    return f"""
SELECT email,
  arg_min(brand, seq) FILTER (WHERE brand IS NOT NULL) AS brand,
  arg_min(country, seq) FILTER (WHERE country IS NOT NULL) AS country,
  'NEWSLETTER' AS src_system,
  arg_min_null(site, seq) AS site, arg_min_null(page, seq) AS page,
  arg_max(first_name, seq) FILTER (WHERE first_name IS NOT NULL) AS first_name,
  arg_max(last_name, seq) FILTER (WHERE last_name IS NOT NULL) AS last_name,
  CAST(NULL AS VARCHAR) AS como_status, CAST(NULL AS VARCHAR) AS como_detail,
  CAST(NULL AS TIMESTAMP) AS como_at,
  arg_min_null(ts, seq) AS signed_up_at, {RUN_TS} AS updated_at
FROM signup_checked WHERE reject_reason IS NULL AND {batch} GROUP BY email"""


cte("newsletter_signups", ["signup_checked"], newsletter_sql())


# -- canonical rows per source ----------------------------------------------
def _canon(name, src, rank, pk, email, first, last, bday, tag, extra, where_extra="true"):
    fixed = (f"CASE WHEN {email} IS NULL OR position('@' IN {email}) = 0 THEN {email} "
             f"ELSE split_part(lower(trim({email})), '@', 1) || '@' || "
             f"coalesce(dc.correct, split_part(lower(trim({email})), '@', 2)) END")
    cte(name + "_e", [src, "domain_corrections"], f"""
SELECT s.*, {fixed} AS e1, {bday} AS bday_raw
FROM {src} s LEFT JOIN domain_corrections dc ON dc.wrong = split_part(lower(trim(s.{email})), '@', 2)""")
    cte(name, [name + "_e"], f"""
SELECT lower(trim(e1)) AS email, {rank} AS rnk, CAST({pk} AS VARCHAR) AS pk,
  {clean_name(first) if first else 'CAST(NULL AS VARCHAR)'} AS first_name,
  {clean_name(last) if last else 'CAST(NULL AS VARCHAR)'} AS last_name,
  CAST(NULL AS VARCHAR) AS nationality,
  {clean_birthday('bday_raw')} AS birthday,
  {clean_tags(f"[{_q(tag)}] || coalesce({extra}, []::VARCHAR[])")} AS tags,
  true AS allow_email, {_q(src)} AS src
FROM {name}_e
WHERE e1 IS NOT NULL AND trim(e1) <> '' AND regexp_matches(e1, {EMAIL_RE})
  AND NOT regexp_matches(split_part(e1, '@', 1), '^[0-9]+$')
  AND lower(split_part(e1, '@', 2)) NOT IN {_in_list(C.BLOCKED_DOMAINS)}
  AND ({where_extra})
  AND (bday_raw IS NULL OR {adult('bday_raw')})""")


WIFI_BDAY = ("CASE WHEN regexp_matches(dob, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') "
             "THEN TRY_CAST(substr(dob, 1, 10) AS DATE) END")
_canon("c_news", "newsletter_signups", 1, "email", "email", "first_name", "last_name",
       "CAST(NULL AS DATE)", "NEWSLETTER", "[country, brand]")
_canon("c_wifi", "wifi_guests", 2, "doc_id", "email", "fname", "lname", WIFI_BDAY, "WIFI",
       market_tags("lastmarket"))
_canon("c_revel", "revel_customers", 3, "revel_id", "email", "first_name", "last_name",
       "CAST(NULL AS DATE)", "REVEL", "['UAE', brand]", "email_ok")

cte("canon", ["c_news", "c_wifi", "c_revel"], """
SELECT * FROM c_news UNION ALL SELECT * FROM c_wifi UNION ALL SELECT * FROM c_revel""")
cte("canon_one", ["canon"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY email, rnk ORDER BY pk) AS rn FROM canon) q WHERE rn = 1""")


def _fold(name, deps, src):
    cte(name, deps, f"""
SELECT email,
  arg_min(first_name, rnk) FILTER (WHERE first_name IS NOT NULL) AS first_name,
  arg_min(last_name, rnk) FILTER (WHERE last_name IS NOT NULL) AS last_name,
  arg_min(nationality, rnk) FILTER (WHERE nationality IS NOT NULL) AS nationality,
  arg_min(birthday, rnk) FILTER (WHERE birthday IS NOT NULL) AS birthday,
  arg_min(allow_email, rnk) FILTER (WHERE allow_email IS NOT NULL) AS allow_email,
  {clean_tags("flatten(list(coalesce(tags, []::VARCHAR[]) ORDER BY rnk))")} AS tags,
  list_sort(list_distinct(flatten(list(srcs)))) AS sources,
  bool_or(rnk = 0) AS had_prior,
  bool_or(rnk = 0 AND needs_push) AS prior_needs_push
FROM {src} GROUP BY email""")


cte("canon_src", ["canon_one"], """
SELECT email, rnk, first_name, last_name, nationality, birthday, allow_email, tags, [src] AS srcs,
  CAST(NULL AS BOOLEAN) AS needs_push FROM canon_one""")
_fold("merged_full", ["canon_src"], "canon_src")
cte("prior_src", ["prior_master"], """
SELECT email, 0 AS rnk, first_name, last_name, nationality, birthday, allow_email, tags,
  coalesce(sources, []::VARCHAR[]) AS srcs, needs_push FROM prior_master""")
cte("canon_prior", ["canon_src", "prior_src"], "SELECT * FROM prior_src UNION ALL SELECT * FROM canon_src")
_fold("merged_inc0", ["canon_prior"], "canon_prior")
cte("merged_inc", ["merged_inc0", "prior_master"], """
SELECT m.* EXCLUDE (had_prior, prior_needs_push),
  CASE WHEN NOT m.had_prior THEN 'inserted' WHEN gained THEN 'updated' ELSE 'unchanged' END AS change,
  CASE WHEN NOT m.had_prior THEN true ELSE m.prior_needs_push OR gained END AS needs_push
FROM (SELECT m.*,
  coalesce(m.had_prior AND (
       (p.first_name IS NULL AND m.first_name IS NOT NULL)
    OR (p.last_name IS NULL AND m.last_name IS NOT NULL)
    OR (p.nationality IS NULL AND m.nationality IS NOT NULL)
    OR (p.birthday IS NULL AND m.birthday IS NOT NULL)
    OR (p.allow_email IS NULL AND m.allow_email IS NOT NULL)
    OR len(list_filter(m.tags, lambda t: NOT list_contains(coalesce(p.tags, []::VARCHAR[]), t))) > 0
    OR len(list_filter(m.sources, lambda t: NOT list_contains(coalesce(p.sources, []::VARCHAR[]), t))) > 0),
    false) AS gained
  FROM merged_inc0 m LEFT JOIN prior_master p ON p.email = m.email) m""")


def _finish(name, src, needs_push_expr):
    country_tags = _in_list(C.COUNTRY_MAP.values())
    all_known = _in_list(C.SOURCE_TAGS + C.BRANDS + list(C.COUNTRY_MAP.values()))
    cte(name + "_dims", [src], f"""
SELECT email, first_name, last_name, nationality, birthday, tags,
  list_filter(tags, lambda t: t IN {_in_list(C.SOURCE_TAGS)})[1] AS src_system,
  list_filter(tags, lambda t: t IN {BRANDS})[1] AS brand,
  list_filter(tags, lambda t: t IN {country_tags})[1] AS country,
  list_filter(tags, lambda t: t NOT IN {all_known})[1] AS venue,
  allow_email, sources, {needs_push_expr} AS needs_push
FROM {src} WHERE {adult('birthday')}""")
    cte(name + "_keyed", [name + "_dims"], f"""
SELECT *, {inbox_key('email')} AS email_key FROM {name}_dims""")
    cte(name, [name + "_keyed"], f"""
SELECT k.email, k.first_name, k.last_name, k.nationality, k.birthday, k.tags, k.src_system, k.brand,
  k.country, k.venue, k.allow_email, k.email_key,
  CASE WHEN r.rn > 1 THEN r.keeper END AS duplicate_of,
  CASE WHEN r.rn > 1 THEN 'same inbox as ' || r.keeper END AS dup_reason,
  k.sources,
  CASE WHEN r.rn > 1 THEN false ELSE k.needs_push END AS needs_push
FROM {name}_keyed k LEFT JOIN (
  SELECT email,
    row_number() OVER w AS rn, first_value(email) OVER w AS keeper
  FROM {name}_keyed WHERE email_key IS NOT NULL
  WINDOW w AS (PARTITION BY email_key ORDER BY
    (first_name IS NOT NULL)::INT + (last_name IS NOT NULL)::INT + (birthday IS NOT NULL)::INT DESC,
    length(email), email)) r ON r.email = k.email""")


_finish("master", "merged_full", "true")
_finish("master_inc", "merged_inc", "needs_push")

cte("minor_ledger", ["wifi_guests"], f"""
SELECT DISTINCT lower(trim(email)) AS email, 'wifi_guests' AS source_table, {RUN_TS} AS excluded_at
FROM (SELECT email, {WIFI_BDAY} AS b FROM wifi_guests) q
WHERE email IS NOT NULL AND trim(email) <> '' AND b IS NOT NULL AND NOT {adult('b')}""")

cte("push_state_t", ["push_state"], "SELECT * FROM push_state")


#: Statement -> (names, body), to build the same report over another master.
BUILT: dict[str, tuple[list[str], str]] = {}


def over_prior(statement: str) -> str:
    """The same statement over the master that was merged with a prior."""
    names, body = BUILT[statement]
    head = with_ctes([n if n != "master" else "master_inc" for n in names], "")
    return f"{head.rstrip()},\nmaster AS (SELECT * FROM master_inc)\n{body.strip()}"


def with_ctes(names, body: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    statement = _with_ctes(names, body)
    BUILT[statement] = (list(names), body)
    return statement


def _with_ctes(names, body: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


def master_cols(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return (f"{p}email, {p}first_name, {p}last_name, {p}nationality, {p}birthday, "
            f"array_to_string({p}tags, ',') AS tags, {p}src_system, {p}brand, {p}country, {p}venue, "
            f"{p}allow_email, {p}email_key, {p}duplicate_of, {p}dup_reason, "
            f"array_to_string({p}sources, ',') AS sources, {p}needs_push")

cte("merged_strict", ["merged_full", "minor_ledger", "domain_corrections"], """
SELECT * FROM merged_full WHERE email NOT IN (
  SELECT lower(trim(CASE WHEN position('@' IN l.email) = 0 THEN l.email
                         ELSE split_part(l.email, '@', 1) || '@' || coalesce(dc.correct, split_part(l.email, '@', 2))
                    END))
  FROM minor_ledger l LEFT JOIN domain_corrections dc ON dc.wrong = split_part(l.email, '@', 2))""")
_finish("master_strict", "merged_strict", "true")
