"""A folder of model versions that is read while models are added to it."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from postgrove.plans.training import load_model, save_model
from postgrove.sources.commits import CommitLog, Store


class ModelFolder:
    """Models by version; the newest is in use until a newer one is whole.

    A model is written to a folder of its own and then named in a log, so a reader sees it
    whole or not at all, and two writers get two versions.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self.log = CommitLog(Store(spark, self.path))
        self._loaded: tuple[int, PipelineModel] | None = None

    def add(self, model: PipelineModel) -> int:
        """Save a model and put it in use; returns its version."""
        folder = f"models/{uuid.uuid4().hex}"
        save_model(model, f"{self.path}/{folder}")
        return self.log.append(lambda seen: {"kind": "model", "folder": folder})["number"]

    def use(self, version: int) -> int:
        """Put an earlier version in use again; returns the number of that decision."""
        return self.log.append(lambda seen: {"kind": "model", "folder": self._folder(seen, version)})["number"]

    @staticmethod
    def _folder(seen: list[dict], version: int) -> str:
        for entry in seen:
            if entry["number"] == version and entry["kind"] == "model":
                return entry["folder"]
        raise ValueError(f"no version {version}")

    def newest(self) -> tuple[int, PipelineModel]:
        """The version in use and its model, loaded only if it has changed."""
        versions = [entry for entry in self.log.entries() if entry["kind"] == "model"]
        if not versions:
            raise ValueError(f"no model in {self.path}")
        last = versions[-1]
        if self._loaded is None or self._loaded[0] != last["number"]:
            self._loaded = last["number"], load_model(f"{self.path}/{last['folder']}")
        return self._loaded
