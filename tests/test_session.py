"""Settled relations and their removal."""

from pathlib import Path

import pytest

from wardflow.session import remove, settle, settling, shared_dir


def settled(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("settled-*")}


def test_settled_relations_go_with_their_block(spark):
    before = settled(spark)
    kept = settle(spark.range(3))
    outside = settled(spark)
    assert len(outside) == len(before) + 1
    with settling(spark):
        outer = settle(spark.range(5))
        with settling(spark):
            assert settle(spark.range(7)).count() == 7
            assert len(settled(spark)) == len(outside) + 2
        # The inner block has removed its own relation only.
        assert outer.count() == 5 and len(settled(spark)) == len(outside) + 1
    assert settled(spark) == outside and kept.count() == 3


def test_settled_relations_go_after_an_error(spark):
    before = settled(spark)
    with pytest.raises(ValueError, match="stop"), settling(spark):
        settle(spark.range(3))
        raise ValueError("stop")
    assert settled(spark) == before
    settle(spark.range(1))
    assert len(settled(spark)) == len(before) + 1
    remove(spark, f"{shared_dir(spark)}/not-there")
