"""Stored steps of a long run, with a manifest: a run that was stopped goes on from the last one."""

from __future__ import annotations

import hashlib
import json
import threading
import time
from collections.abc import Callable
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.sources.staging import stage


class Steps:
    """Results by name: tables, small values and fitted pipelines.

    ``given`` (inputs and parameters) names the run: a call with the same ones finds its steps, any other starts anew. A
    step counts as done when its line of the manifest is there, which is written after its data. Without a folder nothing
    is kept: tables are staged, values and models are computed.
    """

    def __init__(self, spark: SparkSession | None = None, folder: str | None = None, given: dict | None = None):
        self.spark, self.done, self.lock = spark, {}, threading.Lock()
        self.root = None
        if folder is not None:
            key = hashlib.sha256(json.dumps(given or {}, sort_keys=True, default=str).encode()).hexdigest()[:16]
            self.root = f"{folder}/{key}"
            if self._exists(f"{self.root}/manifest"):
                self.done = {r.step: r.value for r in spark.read.schema(self.LINE).json(f"{self.root}/manifest").where("step is not null").collect()}

    LINE = "step string, value string, finished double"

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _mark(self, name: str, value: str | None = None) -> None:
        with self.lock:
            line = self.spark.createDataFrame([(name, value, time.time())], self.LINE)
            line.coalesce(1).write.mode("append").json(f"{self.root}/manifest")
            self.done[name] = value

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if self.root is None:
            return stage(build(), name)
        path = f"{self.root}/{name}"
        if name not in self.done:
            build().write.mode("overwrite").parquet(path)
            self._mark(name)
        return self.spark.read.parquet(path)

    def value(self, name: str, build: Callable[[], Any]) -> Any:
        """A result that JSON can hold."""
        if self.root is None:
            return build()
        if name not in self.done:
            self._mark(name, json.dumps(build()))
        return json.loads(self.done[name])

    def model(self, name: str, build: Callable[[], PipelineModel]) -> PipelineModel:
        if self.root is None:
            return build()
        path = f"{self.root}/{name}"
        if name not in self.done:
            build().write().overwrite().save(path)
            self._mark(name)
        return PipelineModel.load(path)

    def manifest(self) -> DataFrame:
        """``step, value, finished``, in the order in which the steps were done."""
        return self.spark.read.schema(self.LINE).json(f"{self.root}/manifest").orderBy(F.col("finished"))
