"""Saved models (S8): one folder per task and model name."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def model_path(folder: str, task: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{task}_{name.lower()}"


def save_model(model: PipelineModel, folder: str, task: str, name: str) -> str:
    """Write the whole pipeline: imputation or scaling, feature list, learner, labels."""
    path = model_path(folder, task, name)
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, task: str, name: str) -> PipelineModel:
    """Read the model of that very name; nothing is picked by pattern."""
    return PipelineModel.load(model_path(folder, task, name))
