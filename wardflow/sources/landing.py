"""Landing tables: one JSON document per row plus an ingest envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = ["_ingested_at", "_source_file", "_batch_id"]

TABLES = ["raw_patients", "raw_encounters", "raw_lab_results", "raw_claims", "raw_facility_ops"]

FACILITY_SCHEMA = (
    "facility_id string, facility_name string, facility_type string, state string, bed_count int, cms_rating int"
)
ICD10_SCHEMA = "icd10_code string, description string, category string, drg_weight double"


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A landing table from parquet/orc (already with envelope), or from JSON-lines text files."""
    if fmt == "text":
        lines = spark.read.text(path)
        return lines.select(
            F.col("value").alias("raw_data"),
            F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_ingested_at"),
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_name").alias("_batch_id"),
        )
    table = spark.read.format(fmt).load(path)
    return table.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV reference table with a header; the schema is declared, not inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_variant(landing: DataFrame, path: str) -> DataFrame:
    """The landing table stored once with its documents as VARIANT, and read back.

    Spark shreds the documents it writes: paths with values of one type become Parquet columns of their
    own, so that `parse` reads the fields it asks for and no whole document. Malformed text fails.
    """
    stored = landing.withColumn("raw_data", F.parse_json("raw_data"))
    stored.write.option("compression", "zstd").parquet(path)
    return read_landing(landing.sparkSession, path)


def parse(landing: DataFrame, schema: str) -> DataFrame:
    """The wanted document fields as columns, parsed once, next to the envelope.

    `schema` names only the fields a model reads, and every leaf as string: models cast each leaf
    strictly or safely as they need. JSON null and a missing key both come out as NULL. Fields of a
    document column of type VARIANT are asked for path by path, which the scan answers with their columns.
    """
    envelope = [c for c in ENVELOPE if c in landing.columns]
    if isinstance(landing.schema["raw_data"].dataType, T.VariantType):
        wanted = T.StructType.fromDDL(schema)
        fields = [F.try_variant_get("raw_data", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in wanted]
        return landing.select(*fields, *envelope)
    return landing.select(F.from_json("raw_data", schema).alias("doc"), *envelope).select("doc.*", *envelope)
