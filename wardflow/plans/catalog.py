"""All models by name, and a helper that composes them.

A model's parameters name its inputs: landing tables, seeds or other models.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.params import Params
from wardflow.plans import advanced, intermediate, marts, staging
from wardflow.session import settling
from wardflow.sources import seeds
from wardflow.sources.tables import LAYERS, publish_table, publish_view

_PREFIXES = {"staging": "stg_", "intermediate": "int_", "advanced": "adv_", "marts": ("dim_", "fct_", "snp_")}


def _models() -> dict[str, tuple[str, Callable]]:
    found = {}
    for module in (staging, intermediate, advanced, marts):
        folder = module.__name__.rsplit(".", 1)[1]
        for name, function in vars(module).items():
            if name.startswith(_PREFIXES[folder]) and inspect.isfunction(function):
                found[name] = (folder, function)
    return found


MODELS = _models()

SEEDS = {"facility_reference": seeds.facility_reference, "icd10_reference": seeds.icd10_reference}


def inputs_of(name: str) -> list[str]:
    """Relations a model reads; optional arguments left aside."""
    parameters = inspect.signature(MODELS[name][1]).parameters.values()
    return [p.name for p in parameters if p.name not in ("params", "spark") and p.default is p.empty]


def build(name: str, spark: SparkSession, relations: dict[str, DataFrame], params: Params) -> DataFrame:
    """The model's DataFrame. `relations` holds landing tables and collects built models.

    A seed found in `relations` takes the place of the one that comes with the library.
    """
    if name not in relations and name in SEEDS:
        relations[name] = SEEDS[name](spark)
    if name not in relations:
        function = MODELS[name][1]
        arguments = {i: build(i, spark, relations, params) for i in inputs_of(name)}
        if "spark" in inspect.signature(function).parameters:
            arguments["spark"] = spark
        relations[name] = function(**arguments, params=params)
    return relations[name]


def publish(name: str, spark: SparkSession, relations: dict[str, DataFrame], params: Params, root: str) -> DataFrame:
    """Build a model and store it as its layer does: staging as a view, everything else as a table.

    The stored table takes the model's place in `relations`, so later models read it from disk
    rather than computing it again.
    """
    for needed in inputs_of(name):
        if needed not in relations and needed not in SEEDS:
            publish(needed, spark, relations, params, root)
    folder = MODELS[name][0]
    if folder == "staging":
        # A view stays lazy: what it reads has to stay.
        publish_view(build(name, spark, relations, params), name, LAYERS[folder])
    elif name in relations:
        relations[name] = spark.read.parquet(publish_table(relations[name], root, LAYERS[folder], name))
    else:
        # All inputs are published, so that nothing but the model itself is built here.
        with settling(spark):
            path = publish_table(build(name, spark, relations, params), root, LAYERS[folder], name)
        relations[name] = spark.read.parquet(path)
    return relations[name]
