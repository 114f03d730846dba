"""Append-only tables of small rows, kept readable by compaction.

A log is a folder of parts: ``new/`` holds what writers append, ``full-<n>/`` what
compactions wrote, and ``state`` names the parts that count: the newest
compacted part and, by name, the appended files that it already holds. A
compaction writes its part first and then replaces ``state``, the only step
that readers notice, so a reader sees every row once before, during and after
it. What is no longer named is deleted one compaction later: readers that began
before the switch can finish. Any number of writers may append; one at a time
compacts.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import delete_path, list_files, path_exists, read_json_doc, write_json

# Appended files after which a compaction is due.
COMPACT_FILES = 64


class LogTable:
    """An append-only table at ``path`` with a fixed schema; ``key`` keeps the last row of each key at compactions."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str] | None = None, order: str | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order = key, order

    def _state(self) -> dict:
        # written under a new name each time: a reader never meets a half-replaced document
        found = sorted(n for n in list_files(self.spark, self.path) if n.startswith("state-"))
        return read_json_doc(self.spark, f"{self.path}/{found[-1]}") if found else {"n": 0, "full": None, "held": []}

    def _fresh(self, state: dict) -> list[str]:
        held = set(state["held"])
        return [n for n in list_files(self.spark, f"{self.path}/new") if n.endswith(".parquet") and n not in held]

    def append(self, rows: DataFrame) -> None:
        """Add rows (one file); compact when enough files have gathered."""
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/new")
        if len(self._fresh(self._state())) >= COMPACT_FILES:
            self.compact()

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/new")

    def read(self) -> DataFrame:
        """All rows; none before the first append."""
        state = self._state()
        return self._rows(state, self._fresh(state) if self.exists() else [])

    def _rows(self, state: dict, fresh: list[str]) -> DataFrame:
        paths = [f"{self.path}/new/{n}" for n in fresh]
        if state["full"]:
            paths.append(f"{self.path}/{state['full']}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def compact(self) -> None:
        """Write all rows as one part, switch to it, delete what the switch before left behind."""
        state = self._state()
        fresh = self._fresh(state) if self.exists() else []
        if not fresh:
            return
        rows = self._rows(state, fresh)
        if self.key:
            last = rows.groupBy(*self.key).agg(F.max_by(F.struct("*"), self.order).alias("r"))
            rows = last.select("r.*")
        full = f"full-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(f"{self.path}/{full}")
        there = set(list_files(self.spark, f"{self.path}/new"))
        old = [name for name in state["held"] if name in there]
        n = state["n"] + 1
        write_json(self.spark, {"n": n, "full": full, "held": [*old, *fresh], "before": state["full"]},
                   f"{self.path}/state-{n:012d}")
        # what the switch before this one replaced: its readers have had until now
        for name in old:
            delete_path(self.spark, f"{self.path}/new/{name}")
        if state.get("before"):
            delete_path(self.spark, f"{self.path}/{state['before']}")
        for name in list_files(self.spark, self.path):
            if name.startswith("state-") and name < f"state-{n - 1:012d}":
                delete_path(self.spark, f"{self.path}/{name}")
