"""Results in types that compare equal across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Moments and lists as text, whole numbers as BIGINT, decimals as DOUBLE; named columns rounded."""
    digits = digits or {}
    out = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        elif isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0):
            column = column.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        if field.name in digits:
            column = F.round(column, digits[field.name])
        out.append(column.alias(field.name))
    return df.select(*out)
