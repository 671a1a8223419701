"""Fitted pipelines on shared storage: one folder per family, one for the champion."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

CHAMPION = "best_model"


def save_model(model: PipelineModel, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str = CHAMPION) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}")


def has_model(spark: SparkSession, root: str, name: str = CHAMPION) -> bool:
    try:
        spark.read.text(f"{root.rstrip('/')}/{name}/metadata").limit(1).count()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
