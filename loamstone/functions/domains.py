"""Normal form of a site's domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters trimmed from either end.
BLANKS = " \t\r\n\x0b\x0c "


def plain_domain(domain: Column) -> Column:
    """Trimmed, lower-cased, without a leading `www.` and a trailing dot; null where nothing is left."""
    v = F.lower(F.trim(domain, F.lit(BLANKS)))
    v = F.regexp_replace(v, r"^www\.|\.$", "")
    return F.when(F.length(v) > 0, v)
