"""Model package: fitted pipeline, threshold and feature contract in one versioned directory."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from txguard.functions.features import HIGH_RISK_MERCHANTS
from txguard.schema import FEATURE_VERSION, FEATURES

_METADATA = T.StructType(
    [
        T.StructField("threshold", T.DoubleType()),
        T.StructField("feature_version", T.StringType()),
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
        T.StructField("feature_schema", T.StringType()),
        T.StructField("output_schema", T.StringType()),
        T.StructField("high_risk_merchants", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Package:
    model: PipelineModel
    threshold: float
    feature_version: str = "unknown"
    feature_columns: tuple[str, ...] = tuple(FEATURES)
    feature_schema: str | None = None
    output_schema: str | None = None
    high_risk: tuple[str, ...] = tuple(HIGH_RISK_MERCHANTS)

    def require_same_list(self, high_risk: Sequence[str] | None) -> None:
        """Scoring must use the merchants that the model was trained with."""
        if high_risk is not None and set(high_risk) != set(self.high_risk):
            raise ValueError(f"the model was trained with other high-risk merchants: {', '.join(self.high_risk)}")


# What scoring adds to the inputs: the other half of the signature.
OUTPUT_SCHEMA = T.StructType(
    [T.StructField("fraud_probability", T.DoubleType()), T.StructField("prediction", T.IntegerType())]
)


def save_package(
    spark: SparkSession,
    path: str,
    model: PipelineModel,
    threshold: float,
    feature_schema: T.StructType | None = None,
    high_risk: Sequence[str] = HIGH_RISK_MERCHANTS,
) -> str:
    """Write the model, then the metadata row: a directory without metadata is an unfinished save."""
    model.write().overwrite().save(f"{path}/model")
    schema_json = json.dumps(feature_schema.jsonValue()) if feature_schema is not None else None
    output_json = json.dumps(OUTPUT_SCHEMA.jsonValue())
    row = (float(threshold), FEATURE_VERSION, list(FEATURES), schema_json, output_json, list(high_risk))
    metadata = spark.createDataFrame([row], _METADATA).coalesce(1)
    metadata.write.mode("overwrite").json(f"{path}/metadata")
    return path


def load_package(spark: SparkSession, path: str) -> Package:
    if not _exists(spark, path):
        raise FileNotFoundError(f"no model package at {path}")
    if not _exists(spark, f"{path}/metadata"):
        raise ValueError(f"{path} is not a complete model package")
    if not _exists(spark, f"{path}/model"):
        raise ValueError(f"the package at {path} has no model")
    row = spark.read.schema(_METADATA).json(f"{path}/metadata").first()
    if row is None:
        raise ValueError(f"{path} is not a complete model package")
    if row.threshold is None:
        raise ValueError(f"the package at {path} has no threshold")
    columns = tuple(row.feature_columns or ())
    if columns != tuple(FEATURES):
        raise ValueError(f"the package at {path} was trained on other features: {', '.join(columns)}")
    return Package(
        PipelineModel.load(f"{path}/model"),
        row.threshold,
        row.feature_version or "unknown",
        columns,
        row.feature_schema,
        row.output_schema,
        tuple(HIGH_RISK_MERCHANTS if row.high_risk_merchants is None else row.high_risk_merchants),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)
