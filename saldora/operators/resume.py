"""Runs that continue where they stopped: every step is a table or a model in one folder.

A step counts as done when its entry in the run's manifest is there, which is written after
the step's own files; what a lost driver left behind without an entry is made again. The folder
belongs to one set of settings.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from saldora.session import local_frame


class RunError(ValueError):
    """The folder holds a run with other settings."""


class Run:
    def __init__(self, spark: SparkSession, folder: str, settings: dict) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.made: list[str] = []  # steps that this call had to do
        wanted = json.dumps(settings, sort_keys=True)
        have = self._entry("settings")
        if have is None:
            self._enter("settings", wanted)
        elif have != wanted:
            raise RunError(f"{folder} holds a run with other settings: {have}")

    def path(self, name: str) -> str:
        return f"{self.folder}/steps/{name}"

    def _entry(self, name: str) -> str | None:
        try:
            return self.spark.read.schema("entry string").parquet(f"{self.folder}/manifest/{name}").first()["entry"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        except TypeError:  # a folder without a row: the entry was not finished
            return None

    def _enter(self, name: str, entry: str) -> None:
        local_frame(self.spark, [(entry,)], "entry string").write.mode("overwrite").parquet(f"{self.folder}/manifest/{name}")

    def done(self, name: str) -> bool:
        return self._entry(name) is not None

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, read from the folder."""
        if not self.done(name):
            make().write.mode("overwrite").parquet(self.path(name))
            self._enter(name, "table")
            self.made.append(name)
        return self.spark.read.parquet(self.path(name))

    def model(self, name: str, make: Callable[[], Any], load: Callable[[str], Any]) -> Any:
        """The step's Spark model, as saved."""
        if not self.done(name):
            make().write().overwrite().save(self.path(name))
            self._enter(name, "model")
            self.made.append(name)
        return load(self.path(name))

    def value(self, name: str, make: Callable[[], str]) -> str:
        """The step's result as a text."""
        entry = self._entry(name)
        if entry is None:
            entry = make()
            self._enter(name, entry)
            self.made.append(name)
        return entry
