"""A table in cells that loads replace one by one, each load at once or not at all.

A load writes new versions of the cells it changes and, last, one small file that lists
them. Readers take every cell from the latest listed load, so a load that was stopped shows
nowhere and is simply run again under the same number; nothing in use is ever overwritten.
Versions no longer listed as latest may be removed by any expiry job.

::

    <path>/rows/__load=3/__cell=2024-01-16.07/   rows of a cell as of load 3
    <path>/<side>/__load=3/                      side tables, which only grow
    <path>/cells/__load=3/                       cells written by load 3, and the columns; it ends the load
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

LOAD, CELL = "__load", "__cell"
_PLACE = StructType([StructField(LOAD, IntegerType()), StructField(CELL, StringType())])


class CellTable:
    """``path`` must be in storage that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def latest(self) -> dict[str, int]:
        """The load that wrote each cell last. As many entries as cells: the layout bounds them, not the rows."""
        schema = StructType([StructField(CELL, StringType()), StructField(LOAD, IntegerType())])
        try:
            listed = self.spark.read.schema(schema).parquet(f"{self.path}/cells")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return dict(listed.groupBy(CELL).agg(F.max(LOAD)).collect())

    def rows(self, latest: dict[str, int], cells: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of ``cells`` (all without it) with their cell; only those cells' folders are read. None before the first load."""
        if not latest:
            return None
        listed = self.spark.read.parquet(f"{self.path}/cells/{LOAD}={max(latest.values())}")
        columns = StructType.fromJson(json.loads(listed.first()["columns"]))
        by_load: dict[int, list[str]] = defaultdict(list)
        for cell in latest if cells is None else cells:
            if cell in latest:
                by_load[latest[cell]].append(cell)
        chosen = F.lit(False)
        for load, names in by_load.items():
            chosen = chosen | ((F.col(LOAD) == load) & F.col(CELL).isin(names))
        return self.spark.read.schema(StructType([*columns, *_PLACE])).parquet(f"{self.path}/rows").filter(chosen).drop(LOAD)

    def side(self, name: str, latest: dict[str, int]) -> DataFrame | None:
        """Rows of a side table from all finished loads."""
        if not latest:
            return None
        done = max(latest.values())
        parts = self.spark.read.option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        return parts.filter(F.col(LOAD) <= done).drop(LOAD)

    def write(
        self,
        rows: DataFrame,
        cells: Sequence[str],
        sides: dict[str, DataFrame],
        latest: dict[str, int],
        scattered: DataFrame | None = None,
    ) -> None:
        """Replace ``cells``, those that ``rows`` (with their cell) hold, and add to the side tables, as one load.

        ``rows`` lie together by cell; ``scattered`` rows, with the same columns, do not.
        """
        load = max(latest.values(), default=0) + 1
        for name, side in sides.items():
            side.write.mode("overwrite").parquet(f"{self.path}/{name}/{LOAD}={load}")
        # Rows meet by cell, so a cell is one file; adaptive execution splits a large one.
        by_cell = rows if scattered is None else rows.unionByName(scattered.hint("rebalance", F.col(CELL)))
        by_cell.write.mode("overwrite").partitionBy(CELL).parquet(f"{self.path}/rows/{LOAD}={load}")
        columns = rows.drop(CELL).schema.json()
        listed = self.spark.createDataFrame([(cell, columns) for cell in cells], f"{CELL} string, columns string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells/{LOAD}={load}")
