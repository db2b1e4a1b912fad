"""Time buckets that split a user's history into bounded pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_bucket(ts: Column, hours: int = 6) -> Column:
    """Number of the ``hours``-wide bucket since 1970, free of any time zone.

    Six hours keep the rows per user and bucket few enough for one task even for a
    user with a large share of all rows, and still merge the rows of ordinary users.
    """
    number = F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)
    return F.floor(number / hours)
