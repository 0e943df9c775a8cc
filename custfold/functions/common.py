"""Small helpers shared by the column-expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(v)``.

    Written as a one-element ``transform``: when the optimizer substitutes
    a column into a pushed-down filter, a value referenced many times stays
    one copy instead of being repeated per reference.
    """
    return F.get(F.transform(F.array(value), body), 0)


def ts_ntz(value) -> Column:
    """A ``datetime`` as a TIMESTAMP_NTZ literal, independent of the session
    and process time zones (cast from its ISO text)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
