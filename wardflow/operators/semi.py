"""Arrays and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import iff


def flatten(df: DataFrame, array: str, value: str = "item", index: str = "pos") -> DataFrame:
    """One row per element with its 0-based index; a NULL or empty array gives no row."""
    others = [c for c in df.columns if c != array]
    return _opened(df, others, F.col(array), value, index)


def flatten_keep(df: DataFrame, array: str, value: str = "item", index: str = "pos") -> DataFrame:
    """As `flatten`, keeping the array column as well."""
    return _opened(df, ["*"], F.col(array), value, index)


def _opened(df: DataFrame, others: list[str], array: Column, value: str, index: str) -> DataFrame:
    # Before a plain posexplode the planner puts a filter on the array, and moves it below the
    # parsing of the document: each document would be parsed three times.
    return df.select(*others, F.posexplode_outer(array).alias(index, value)).filter(F.col(index).isNotNull())


def flatten_product(
    df: DataFrame, lead: str, seconds: Sequence[str], keep: Column, limit: int | None = None
) -> DataFrame:
    """Every element of `lead` that passes `keep`, combined with every element of the other arrays.

    Elements arrive as structs named after their array, indexes as `<array>_pos`. `keep` speaks of
    column `lead` and is applied before the other arrays are opened. With `limit`, only the first
    `limit` combinations (in index order) of each leading element are built: the second array is cut
    to the first `limit` elements on either side, which cannot lose one of them.
    """
    arrays = [lead, *seconds]
    out = df.withColumns({f"__{a}": F.col(a) for a in arrays}).drop(*arrays)
    for array in arrays:
        source = F.col(f"__{array}")
        if limit is not None and array != lead:
            source = F.slice(source, 1, limit)
        out = _opened(out, ["*"], source, array, f"{array}_pos").drop(f"__{array}")
        if array == lead:
            out = out.filter(keep)
    return out


def object_keys(text: Column) -> Column:
    """Keys of a JSON object given as text."""
    return F.json_object_keys(text)


def is_array(text: Column) -> Column:
    """Whether JSON text is an array."""
    return F.coalesce(F.ltrim(text).startswith("["), F.lit(False))


def build_document(**fields: Column) -> Column:
    """JSON text of an object; NULL fields are left out, as an object constructor does."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def completeness(fields: Sequence[str]) -> tuple[Column, Column]:
    """How many of the fields are present, and that as a percentage with one decimal."""
    present = sum((iff(F.col(f).isNotNull(), 1, 0) for f in fields), F.lit(0))
    return present, F.round(present / float(len(fields)) * 100, 1)
