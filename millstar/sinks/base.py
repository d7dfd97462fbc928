"""Pluggable sinks.

A sink writes one DataFrame under a name and returns where it went.  Writes are
ordinary distributed ``DataFrame.write`` jobs: every task writes its own part
file and Spark's commit protocol makes a retried task (lost executor) safe.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame


class Sink(ABC):
    @abstractmethod
    def write(self, df: DataFrame, name: str) -> str:
        """Write one table; return its destination."""

    def write_all(self, tables: Mapping[str, DataFrame], parallel: int = 1) -> dict[str, str]:
        """Write several tables; ``{name: destination}``.

        ``parallel > 1`` submits the independent write jobs from a thread pool.
        """
        items = list(tables.items())
        if parallel > 1 and len(items) > 1:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                return dict(pool.map(lambda kv: (kv[0], self.write(kv[1], kv[0])), items))
        return {name: self.write(df, name) for name, df in items}


class ParquetSink(Sink):
    def __init__(self, base_path: str, mode: str = "overwrite"):
        self.base_path = base_path.rstrip("/")
        self.mode = mode

    def write(self, df: DataFrame, name: str) -> str:
        path = f"{self.base_path}/{name}"
        df.write.mode(self.mode).parquet(path)
        return path
