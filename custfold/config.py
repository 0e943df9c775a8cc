"""Configuration: fixed lists, run parameters and the source registry.

Everything in the "fixed values" blocks must equal the behaviour being
reproduced; it is configuration data, not logic.  Lists are small and
bounded, so operators compile them into expressions (``isin`` / CASE
chains) instead of joining dimension tables at run time.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Optional

# ---------------------------------------------------------------------------
# Run parameters.  "today" and "now" are parameters so that every query is
# deterministic; the fixtures fix them to these values.
# ---------------------------------------------------------------------------
AS_OF = _dt.date(2024, 2, 1)
RUN_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
MIN_AGE = 18
MAX_AGE = 110

# ---------------------------------------------------------------------------
# Mistyped domains and their corrections (wrong -> correct).
# ---------------------------------------------------------------------------
DOMAIN_CORRECTIONS = {
    "gmial.com": "gmail.com", "gmai.com": "gmail.com",
    "gmail.con": "gmail.com", "gmail.co": "gmail.com",
    "gmail.cm": "gmail.com", "gmail.om": "gmail.com",
    "gamil.com": "gmail.com", "gamil.vom": "gmail.com",
    "gmaill.com": "gmail.com", "gmail.comm": "gmail.com",
    "gmali.com": "gmail.com", "gmail.co.m": "gmail.com",
    "3gmail.com": "gmail.com", "gmial.co": "gmail.com",
    "gmaul.com": "gmail.com", "gmeil.com": "gmail.com",
    "gmail.cin": "gmail.com", "gmail.vom": "gmail.com",
    "gnail.com": "gmail.com", "ymail.con": "ymail.com",
    "hotmial.com": "hotmail.com", "hotmail.con": "hotmail.com",
    "hotmail.co": "hotmail.com", "hotmai.com": "hotmail.com",
    "hotmail.vom": "hotmail.com", "hotmall.com": "hotmail.com",
    "homail.com": "hotmail.com", "hotmaill.com": "hotmail.com",
    "yaho.com": "yahoo.com", "yahoo.con": "yahoo.com",
    "yahooo.com": "yahoo.com", "yahoo.co": "yahoo.com",
    "yahoo.vom": "yahoo.com",
    "outlok.com": "outlook.com", "outlook.con": "outlook.com",
    "outlook.co": "outlook.com", "icloud.con": "icloud.com",
    "iclould.com": "icloud.com", "icloud.co": "icloud.com",
    "live.con": "live.com",
}

# Domains never allowed into the master table.
BLOCKED_DOMAINS = ["grubtech.com", "yolkbrands.com"]

# Country slug in a market string -> country tag.
COUNTRY_MAP = {
    "united-arab-emirates": "UAE",
    "jordan": "JORDAN",
    "saudi-arabia": "KSA",
    "kuwait": "KUWAIT",
    "qatar": "QATAR",
    "bahrain": "BAHRAIN",
    "oman": "OMAN",
}

# Placeholder words treated as "no name" (compared lower/trim).
NAME_PLACEHOLDERS = [
    "", "-", ".", "n/a", "na", "none", "null", "unknown",
    "no name", "noname", "test", "guest", "customer", "xxx", "???",
]

# Tag classes used to split tags into dimensions.
SOURCE_TAGS = ["WIFI", "REVEL"]
BRANDS = ["PICKL", "BONBIRD", "SOUTHPOUR"]

# Website -> brand for newsletter signups.
SITE_BRANDS = {
    "pickl": "PICKL",
    "eatpickl": "PICKL",
    "bonbird": "BONBIRD",
    "southpour": "SOUTHPOUR",
}
DEFAULT_SIGNUP_COUNTRY = "UAE"

# Email quality lists for the point-of-sale feed.
DISPOSABLE_DOMAINS = [
    "mailinator.com", "guerrillamail.com", "grr.la", "sharklasers.com",
    "spam4.me", "tempmail.com", "temp-mail.org", "temp-mail.io",
    "tempmail.net", "tempmailo.com", "tempinbox.com", "10minutemail.com",
    "10minutemail.net", "20minutemail.com", "trashmail.com", "trashmail.me",
    "dispostable.com", "maildrop.cc", "fakeinbox.com", "mailnull.com",
    "spamgourmet.com", "discard.email", "discardmail.com", "getnada.com",
    "nada.email", "throwawaymail.com", "mailnesia.com", "yopmail.com",
    "yopmail.fr", "mytrashmail.com", "mailcatch.com", "emailondeck.com",
    "harakirimail.com", "mintemail.com", "mohmal.com", "mytemp.email",
    "spam.la", "tempemail.com", "tempemail.net", "wegwerfmail.de",
    "zoemail.com", "mvrht.com", "anonbox.net", "burnermail.io", "33mail.com",
    "tempr.email", "1secmail.com", "1secmail.net", "1secmail.org",
    "dropmail.me", "emailfake.com", "fakemail.net", "mail-temp.com",
    "tempmail.plus", "minuteinbox.com", "mail7.io", "mailsac.com",
]
INTERNAL_DOMAINS = ["grubtech.com", "yolkbrands.com"]
PLACEHOLDER_ADDRESSES = [
    "test@test.com", "a@a.com", "no@no.com", "none@none.com",
    "noemail@noemail.com", "n/a@n/a.com", "x@x.com", "abc@abc.com",
    "test@gmail.com", "noemail@gmail.com", "na@na.com", "asd@asd.com",
]
DISCARD_REASONS = ["internal_domain"]
GIBBERISH_REJECT_AT = 5
# Signals of the gibberish score, in rule order, and their weights.
GIBBERISH_SIGNALS = [
    ("repeat_char", 2), ("repeat_unit", 3), ("no_vowels", 3),
    ("low_vowels", 2), ("consonant_run", 2), ("cc_density", 2),
    ("low_diversity", 3), ("mid_diversity", 2), ("repeat_bigrams", 2),
    ("repeat_bigram_x3", 2),
]
CONSONANTS = "bcdfghjklmnpqrstvwxz"
VOWELS = "aeiouy"

# Push platform response codes and limits.
CODE_CUSTOMER_NOT_FOUND = "4001012"
CODE_ALREADY_EXISTS = "4000000"
PUSH_RATE_LIMIT = 500          # calls per minute per account
PUSH_DEFAULT_DELAY = 0.5       # seconds per call when no rate is given
CALLS_PER_QUEUED = 1.5         # planning rule: lookup plus create
PREFLIGHT_SAMPLE = 25

# CSV export headings.
EXPORT_HEADINGS = ["Email Address", "First Name", "Last Name",
                   "Nationality", "Birthday", "Tag", "AllowEmail"]


# ---------------------------------------------------------------------------
# Source registry.  Each cell is a Spark SQL snippet evaluated against the
# source table; the scalar rules are SQL functions in it.  ``None`` means the
# source lacks that field.
# ---------------------------------------------------------------------------
Expr = Optional[str]


@dataclass(frozen=True)
class SourceSpec:
    source_table: str
    email_expr: str
    source_tag: str
    first_name_expr: Expr = None
    last_name_expr: Expr = None
    nationality_expr: Expr = None
    birthday_expr: Expr = None
    extra_tags_expr: Expr = None
    allow_email_expr: Expr = None
    where_extra: Optional[str] = None
    priority: int = 100
    enabled: bool = True
    # Tie-break for "one row per email within a source" (the reference
    # leaves it arbitrary); the source's primary key.
    key_expr: str = "email"
    extra: dict = field(default_factory=dict, hash=False, compare=False)


WIFI_BIRTHDAY_EXPR = (
    "CASE WHEN dob RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}' "
    "THEN try_cast(substring(dob, 1, 10) AS DATE) END"
)

@dataclass(frozen=True)
class Dimensions:
    """The tables users edit: domain corrections, blocked domains, countries.

    They are bounded configuration and become expressions of the build.
    """
    corrections: dict = field(default_factory=lambda: dict(DOMAIN_CORRECTIONS))
    blocked: tuple = tuple(BLOCKED_DOMAINS)
    countries: dict = field(default_factory=lambda: dict(COUNTRY_MAP))

    @classmethod
    def from_tables(cls, corrections=None, blocked=None, countries=None, most: int = 10_000):
        """From DataFrames ``(wrong, correct)``, ``(domain)`` and ``(slug,
        tag)``; a table of more than ``most`` rows is refused."""
        def rows(df):
            got = df.limit(most + 1).collect()
            if len(got) > most:
                raise ValueError(f"a dimension table holds more than {most} rows")
            return got
        kept = {}
        if corrections is not None:
            kept["corrections"] = {r[0]: r[1] for r in rows(corrections.select("wrong", "correct"))}
        if blocked is not None:
            kept["blocked"] = tuple(r[0] for r in rows(blocked.select("domain")))
        if countries is not None:
            kept["countries"] = {r[0]: r[1] for r in rows(countries.select("slug", "tag"))}
        return cls(**kept)


DEFAULT_REGISTRY = [
    SourceSpec(
        source_table="newsletter_signups", email_expr="email",
        first_name_expr="first_name", last_name_expr="last_name",
        source_tag="NEWSLETTER", extra_tags_expr="array(country, brand)",
        allow_email_expr="true", priority=5, key_expr="email",
    ),
    SourceSpec(
        source_table="wifi_guests", email_expr="email",
        first_name_expr="fname", last_name_expr="lname",
        birthday_expr=WIFI_BIRTHDAY_EXPR, source_tag="WIFI",
        extra_tags_expr="parse_market(lastmarket)", allow_email_expr="true",
        priority=10, key_expr="doc_id",
    ),
    SourceSpec(
        source_table="revel_customers", email_expr="email",
        first_name_expr="first_name", last_name_expr="last_name",
        source_tag="REVEL", extra_tags_expr="array('UAE', brand)",
        allow_email_expr="true", where_extra="email_ok", priority=20,
        key_expr="revel_id",
    ),
]


def ordered_specs(registry=None):
    """Enabled specs in merge order: (priority, source_table)."""
    specs = DEFAULT_REGISTRY if registry is None else registry
    return sorted((s for s in specs if s.enabled),
                  key=lambda s: (s.priority, s.source_table))


# Detail texts of push outcomes and names of the pre-flight
# checks, as they are stored and shown.
DETAIL_LEFT_ALONE = "already in Como - left alone"
DETAIL_NOT_CHECKED = "couldn't check whether they exist"
DETAIL_CREATED = "created"
DETAIL_UPDATED = "updated"
DETAIL_ALREADY = "already in Como"
PREFLIGHT_CHECKS = (
    "No two queued records share an inbox",
    "Nobody already in Como is queued again",
    "No records flagged as duplicates are queued",
    "Every queued record has a brand tag",
)
