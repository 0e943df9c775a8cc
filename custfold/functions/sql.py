"""The scalar rules as SQL functions.

``register_rules`` creates them in a session (``CREATE TEMPORARY FUNCTION ...
RETURN``), so that a registry cell, a report or a user's query is plain SQL.
The bodies are SQL expressions: the analyzer inlines them, so they are pruned,
pushed and compiled like any expression, and no Python runs.

Lists and dates are literals of the body.  Registering again with other
dimensions replaces the functions for plans built afterwards.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import SparkSession

from custfold import config as C
from custfold.config import Dimensions
from custfold.functions.email import MASTER_ADDRESS_RE

_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")" if values else "(NULL)"


def _map(pairs: dict) -> str:
    items = [x for k, v in pairs.items() for x in (text(k), text(v))]
    return f"map({', '.join(items)})" if items else "CAST(map() AS MAP<STRING, STRING>)"


def rules(dims: Dimensions | None = None, as_of: _dt.date = C.AS_OF) -> dict[str, tuple[str, str, str]]:
    """Name -> (parameters, result type, body)."""
    dims = dims or Dimensions()
    today = f"DATE '{as_of.isoformat()}'"
    slugs = sorted(dims.countries, key=len, reverse=True)
    country = text("^(" + "|".join(re.escape(s) for s in slugs) + r")(?:-|\z)")
    tag_of = _map(dims.countries)
    none = "CAST(array() AS ARRAY<STRING>)"
    gmail = "lower(split_part(e, '@', 2)) IN ('gmail.com', 'googlemail.com')"
    local = "split_part(lower(split_part(e, '@', 1)), '+', 1)"
    return {
        "fix_domain": ("e STRING", "STRING", f"""CASE WHEN e IS NULL OR NOT contains(e, '@') THEN e ELSE concat(split_part(lower(trim(e)), '@', 1), '@',
            coalesce(try_element_at({_map(dims.corrections)}, split_part(lower(trim(e)), '@', 2)), split_part(lower(trim(e)), '@', 2))) END"""),
        "is_valid_address": ("e STRING", "BOOLEAN", f"coalesce(e RLIKE {text(MASTER_ADDRESS_RE)}, false)"),
        "is_blocked_domain": ("e STRING", "BOOLEAN", f"coalesce(lower(split_part(e, '@', 2)) IN {_list(dims.blocked)}, false)"),
        "clean_name": ("v STRING", "STRING", f"CASE WHEN lower(trim(coalesce(v, ''))) IN {_list(C.NAME_PLACEHOLDERS)} THEN NULL ELSE trim(v) END"),
        "clean_nationality": ("v STRING", "STRING", "nullif(trim(v), '')"),
        "parse_birthday": ("v STRING", "DATE", f"CASE WHEN v RLIKE {text(_DAY)} THEN try_to_date(substring(v, 1, 10), 'yyyy-MM-dd') END"),
        "plausible_birthday": ("d DATE", "DATE", f"CASE WHEN d > {today} OR d < add_months({today}, {-12 * C.MAX_AGE}) THEN NULL ELSE d END"),
        "is_adult": ("d DATE", "BOOLEAN", f"NOT coalesce(d BETWEEN date_add(add_months({today}, {-12 * C.MIN_AGE}), 1) AND {today}, false)"),
        # Each one-element transform binds a value that is used several times.
        "parse_market": ("m STRING", "ARRAY<STRING>", f"""CASE WHEN m IS NULL OR trim(m) = '' THEN {none} ELSE element_at(
            transform(transform(transform(transform(array(regexp_replace(lower(trim(split_part(m, '?', 1))), '-+$', '')),
                c -> named_struct('brand', split_part(c, '-', 1), 'rest', substring(c, length(split_part(c, '-', 1)) + 2))),
                c -> named_struct('brand', c.brand, 'rest', c.rest, 'slug', regexp_extract(c.rest, {country}, 1), 'segment', split_part(c.rest, '-', 1))),
                c -> named_struct('brand', c.brand, 'country', CASE WHEN c.slug <> '' THEN try_element_at({tag_of}, c.slug) ELSE c.segment END,
                    'venue', substring(c.rest, length(CASE WHEN c.slug <> '' THEN c.slug ELSE c.segment END) + 2))),
                c -> concat(array(upper(c.brand), upper(c.country)), CASE WHEN c.venue = '' THEN {none} ELSE array(upper(c.venue)) END)), 1) END"""),
        "clean_tags": ("t ARRAY<STRING>", "ARRAY<STRING>", """nullif(array_distinct(filter(transform(t, x -> upper(trim(x))), x -> x IS NOT NULL AND x <> '')), CAST(array() AS ARRAY<STRING>))"""),
        "inbox_key": ("e STRING", "STRING", f"""CASE WHEN e IS NULL OR NOT contains(e, '@') THEN NULL
            ELSE concat(CASE WHEN {gmail} THEN replace({local}, '.', '') ELSE {local} END, '@',
                CASE WHEN {gmail} THEN 'gmail.com' ELSE lower(split_part(e, '@', 2)) END) END"""),
    }


def register_rules(spark: SparkSession, dims: Dimensions | None = None, as_of: _dt.date = C.AS_OF) -> list[str]:
    """Create the functions in this session; returns their names."""
    made = rules(dims, as_of)
    wanted = {n: f"CREATE OR REPLACE TEMPORARY FUNCTION {n}({p}) RETURNS {t} RETURN {body}" for n, (p, t, body) in made.items()}
    held = _REGISTERED.setdefault((spark.sparkContext.applicationId, spark._jsparkSession.hashCode()), {})
    for name, statement in wanted.items():
        if held.get(name) != statement:
            spark.sql(statement)
            held[name] = statement
    return list(wanted)


#: Session -> function -> statement last run, so that a repeated call costs nothing.
_REGISTERED: dict[tuple, dict[str, str]] = {}
