"""Hash keys. Dates and timestamps are formatted explicitly, so keys do not depend on the host."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def text_of(moment: Column) -> Column:
    """A timestamp as text with microseconds."""
    return F.date_format(moment, TIMESTAMP_FORMAT)


def mask_pii(column: Column) -> Column:
    return F.sha2(column.cast("string"), 256)


def surrogate_key(*columns: Column) -> Column:
    """MD5 over the columns as text, a fixed marker standing for NULL."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("_null_")) for c in columns]))


def md5_key(*columns: Column) -> Column:
    """MD5 over the columns as text; NULL as soon as one is NULL."""
    parts: list[Column] = []
    for column in columns:
        parts += [F.lit("|"), column.cast("string")]
    return F.md5(F.concat(*parts[1:]))


def hash_bucket(column: Column, buckets: int) -> Column:
    """Stable bucket 0 .. buckets-1."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")
