"""Saved models: writing, reading back, and the registry that maps a message key to its model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.clustering import KMeansModel

from keyscore.records import StreamConfig

LOADERS = {
    "pipeline": PipelineModel,
    "lr": LogisticRegressionModel,
    "svc": LinearSVCModel,
    "rf": RandomForestClassificationModel,
    "gbt": GBTClassificationModel,
    "kmeans": KMeansModel,
    "softmax": LogisticRegressionModel,
    "forest": PipelineModel,
}


def artefact_path(base: str, kind: str, name: str) -> str:
    return f"{base}/{kind}-spark-{name}"


def save_model(model, path: str):
    """Write a model or fitted feature stages, replacing what was there; a kernel machine is written as text."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(path)
    return path


def load_model(kind: str, path: str):
    """A saved model; ``rbf`` is a kernel machine's text."""
    if kind == "rbf":
        from keyscore.operators.scoring import SvmTextModel

        return SvmTextModel.load(path)
    return LOADERS[kind].load(path)


@dataclass(frozen=True)
class Entry:
    """What one message key selects: its configuration, fitted feature stages and model."""

    config: StreamConfig
    features: PipelineModel
    model: object


def load_registry(config: Iterable[StreamConfig], base: str, kind: str = "svc") -> dict[str, Entry]:
    """Feature stages and one model per configured stream, keyed by what its messages carry."""
    return {
        cfg.key: Entry(
            cfg,
            load_model("pipeline", artefact_path(base, "pipeline", cfg.name)),
            load_model(kind, artefact_path(base, kind, cfg.name)),
        )
        for cfg in config
    }


def load_models(kinds: Mapping[str, str], base: str, name: str) -> dict[str, object]:
    """Several models of one stream: message key -> model, from key -> kind."""
    return {key: load_model(kind, artefact_path(base, kind, name)) for key, kind in kinds.items()}
