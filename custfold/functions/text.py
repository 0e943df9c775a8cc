"""Name, date, market and tag column expressions."""

from __future__ import annotations

import datetime as _dt
import re as _re

from pyspark.sql import Column
from pyspark.sql import functions as F

from custfold import config as C
from custfold.functions.email import py_strip
from custfold.functions.common import let


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c) -> Column:
    """Placeholder words -> NULL, otherwise trimmed with case kept."""
    v = _col(c)
    return (F.when(F.lower(F.trim(F.coalesce(v, F.lit("")))).isin(C.NAME_PLACEHOLDERS),
                   F.lit(None).cast("string"))
            .otherwise(F.trim(v)))


def clean_nationality(c) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def blank_to_null(c) -> Column:
    """Python-style ``(x or '').strip() or None``."""
    s = py_strip(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def parse_birthday(c) -> Column:
    """Text starting ``yyyy-MM-dd`` -> that date; impossible dates -> NULL."""
    s = _col(c)
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"),
                  F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))


def _years_before(as_of: _dt.date, years: int) -> Column:
    # add_months clamps Feb-29 to Feb-28 like an interval subtraction.
    return F.add_months(F.lit(as_of), -12 * years)


def clean_birthday(c, as_of: _dt.date = C.AS_OF) -> Column:
    """Future or more than 110 years ago -> NULL."""
    d = _col(c)
    return (F.when(d > F.lit(as_of), F.lit(None).cast("date"))
            .when(d < _years_before(as_of, C.MAX_AGE), F.lit(None).cast("date"))
            .otherwise(d))


def is_adult(c, as_of: _dt.date = C.AS_OF, min_age: int = C.MIN_AGE) -> Column:
    """Unknown or implausible birthday passes; else born on/before as_of - 18y."""
    # An implausible birthday lies outside the range that makes a minor.
    minor = _col(c).between(F.date_add(_years_before(as_of, min_age), 1), F.lit(as_of))
    return ~F.coalesce(minor, F.lit(False))


def clean_tags(c) -> Column:
    """Trim, upper, drop blanks, dedupe keeping first occurrence; empty -> NULL."""
    t = F.transform(_col(c), lambda v: F.upper(F.trim(v)))
    kept = F.array_distinct(F.filter(t, lambda v: v.isNotNull() & (v != "")))
    return F.when(F.size(kept) > 0, kept)


def parse_market(c, country_map: dict | None = None) -> Column:
    """``{brand}-{country slug}-{venue}`` -> [BRAND, COUNTRY(, VENUE)].

    Slugs are tried longest first (one alternation regex, alternatives in
    that order); an unknown country is taken to be the next ``-`` segment.
    NULL or blank input gives an empty array.
    """
    m = _col(c)
    cmap = C.COUNTRY_MAP if country_map is None else country_map
    slugs = sorted(cmap, key=len, reverse=True)
    pattern = "^(" + "|".join(_re.escape(x) for x in slugs) + r")(?:-|\z)"
    tag_of = F.create_map(*[x for k in slugs for x in (F.lit(k), F.lit(cmap[k]))])
    clean = F.regexp_replace(F.lower(F.trim(F.split_part(m, F.lit("?"), F.lit(1)))), "-+$", "")

    def parts(v):
        brand, rest = v["brand"], v["rest"]
        slug = F.regexp_extract(rest, pattern, 1)
        seg = F.split_part(rest, F.lit("-"), F.lit(1))
        matched = slug != ""
        country = F.when(matched, F.try_element_at(tag_of, slug)).otherwise(seg)
        venue = F.when(matched, F.substring(rest, F.length(slug) + 2, 1 << 30)) \
            .otherwise(F.substring(rest, F.length(seg) + 2, 1 << 30))
        head = F.array(F.upper(brand), F.upper(country))
        return F.when(F.coalesce(venue, F.lit("")) == "", head) \
            .otherwise(F.concat(head, F.array(F.upper(venue))))

    def split(cl):
        brand = F.split_part(cl, F.lit("-"), F.lit(1))
        return F.struct(brand.alias("brand"), F.substring(cl, F.length(brand) + 2, 1 << 30).alias("rest"))

    tags = let(let(clean, split), parts)
    return F.when(m.isNull() | (F.trim(m) == ""), F.array().cast("array<string>")).otherwise(tags)


def first_tag_in(tags, values) -> Column:
    """First element of ``tags`` that is in ``values`` (array order)."""
    return F.get(F.filter(_col(tags), lambda t: t.isin(list(values))), 0)


def first_tag_not_in(tags, values) -> Column:
    return F.get(F.filter(_col(tags), lambda t: ~t.isin(list(values))), 0)
