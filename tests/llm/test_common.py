"""Joins on hot keys, scratch relations and the guard of the entry point."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from wardflow.llm import common


def test_join_by_key_splits_hot_keys(spark):
    big = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), F.col("id").cast("string"))
        ).alias("key")
    )
    small = big.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    small = small.filter("key = 'hot' OR last % 2 = 0")
    joined = common.join_by_key(big, small, "key", "n")
    plan = joined._jdf.queryExecution().toString()
    assert "Union" in plan
    got = {r["id"]: r["last"] for r in joined.collect()}
    want = {r["key"]: r["last"] for r in small.collect()}
    assert got == {r["id"]: want.get(r["key"]) for r in big.collect()}
    assert sorted(joined.columns) == ["id", "key", "last"]
    assert common.join_by_key(big.limit(0), small.limit(0), "key", "n").count() == 0


def test_scratch_is_removed(spark):
    scratch = common.Scratch(spark)
    kept = scratch.settle(spark.range(5))
    assert kept.count() == 5
    path = scratch.paths[0].removeprefix("file://")
    assert os.path.isdir(path)
    scratch.clear()
    assert not os.path.exists(path)


def test_words_and_let(spark):
    row = spark.createDataFrame([(" a\tb\x0b c ", None)], "t string, u string").select(
        common.words_of(F.col("t")).alias("w"),
        common.words_of(F.col("u")).alias("none"),
        common.let(F.col("t"), lambda t: F.length(t) * F.length(t)).alias("n"),
    ).first()
    assert (row["w"], row["none"], row["n"]) == (["a", "b", "c"], [], 64)


def test_library_works_without_the_text_operators(tmp_path):
    """Neither folder nor pipeline there: the entry point still imports and hands out the rest."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('wardflow.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert names == set(e.oracle_sql()) and 'cond_agg' in names and 'pipeline' not in names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
