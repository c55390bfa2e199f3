"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import fresh_path

#: The white space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"

#: A key that holds more than this share of the rows is joined by broadcast: at most 1000 such keys exist.
HOT_SHARE = 0.001

#: Spark's setting by which the files of a query's shuffles go when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffled files go as soon as their query ends.

    Otherwise they stay until the driver happens to collect its garbage, so that those of many queries add up.
    A DataFrame made within it should be written or collected once: doing so again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Scratch:
    """Relations written to the shared folder, as by `settle`, that are removed when nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def settle(self, df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
        """The relation written, with options of Parquet's, and read back."""
        path = fresh_path(self.spark, "scratch")
        self.paths.append(path)
        df.write.options(**(options or {})).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Removes what was written."""
        context = self.spark.sparkContext
        for name in self.paths:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.paths.clear()


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds at most `limit` bytes of a text column, or a single row."""
    for batch in batches:
        at = held = 0
        for k, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if held and held + size > limit:
                yield batch.slice(at, k - at)
                at, held = k, 0
            held += size
        if at < batch.num_rows:
            yield batch.slice(at)


def words_of(text: Column) -> Column:
    """The words of a text, between white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def join_by_key(big: DataFrame, small: DataFrame, key: str, rows: str) -> DataFrame:
    """Left join to a relation with unique keys, without a hot key landing in one task.

    `small` has one row per key and in `rows` the number of rows that `big` holds for it. Keys above
    `HOT_SHARE` of all rows, at most 1 / HOT_SHARE of them, are broadcast and joined in place; only
    the remaining rows are shuffled. `small` should be settled, as it is read three times.
    NULL keys match nothing. The column `rows` is left out of the result.
    """
    total = small.agg(F.sum(rows)).first()[0] or 0
    hot = small.filter(F.col(rows) > F.lit(total * HOT_SHARE)).drop(rows)
    cold = small.filter(F.col(rows) <= F.lit(total * HOT_SHARE)).drop(rows)
    found = [c for c in hot.columns if c != key]
    if hot.isEmpty():
        return big.join(cold, key, "left")
    marked = big.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left")
    done = marked.filter("__hot").drop("__hot")
    rest = marked.filter("__hot IS NULL").drop("__hot", *found).join(cold, key, "left")
    return done.unionByName(rest)
