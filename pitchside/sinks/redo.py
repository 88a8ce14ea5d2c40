"""Overwrites of partitions that can be finished after a crash.

Spark swaps overwritten partitions one after the other when the job commits. If the driver dies in
between, a partition may be gone. So the new content is first written beside the table, then marked
as open, then applied, then marked as closed. A later run applies open content again before it reads
the table. Applying twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Applies staged contents, given by name.
Apply = Callable[[dict[str, DataFrame]], None]

_MARK = T.StructType([T.StructField("open", T.BooleanType())])


class Redo:
    """Staged contents that are applied together, kept in their own folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str, names: Sequence[str] = ("content",)):
        self.spark = spark
        self.contents = {name: f"{path}/{name}" for name in names}
        self.mark = f"{path}/mark"

    def is_open(self) -> bool:
        try:
            mark = self.spark.read.schema(_MARK).parquet(self.mark)
        except AnalysisException:  # no such folder
            return False
        return not mark.where("open").isEmpty()

    def _set(self, is_open: bool) -> None:
        row = self.spark.range(1).select(F.lit(is_open).alias("open"))
        row.coalesce(1).write.mode("overwrite").parquet(self.mark)

    def finish(self, apply: Apply) -> None:
        """Apply contents that an earlier run left open."""
        if self.is_open():
            apply({name: self.spark.read.parquet(path) for name, path in self.contents.items()})
            self._set(False)

    def run(self, contents: Mapping[str, DataFrame], apply: Apply) -> None:
        """Write all contents, then apply them."""
        for name, content in contents.items():
            content.write.mode("overwrite").parquet(self.contents[name])
        self._set(True)
        apply({
            name: self.spark.read.schema(content.schema).parquet(self.contents[name])
            for name, content in contents.items()
        })
        self._set(False)
