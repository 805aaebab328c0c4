"""Delta refresh of additive models: stored partials by batch, so that a batch is added, replaced or taken back alone.

A state table holds ``Partials`` of each batch of facts, in folders by batch and billing period. To apply a batch, only
its own facts are read: they are added up and written over what the batch had before (the retraction of an earlier
version is that its partials are gone). The model of a period is the sum of all batches' partials of that period, so
a refresh merges the periods that the batch touches, in its old or its new version, and no other period is
read or written. Compare ``write_incremental``, which rebuilds a period from all of its facts.

Writes are dynamic partition overwrites and can be repeated. A folder can't be emptied by them, so where a batch or
the model has nothing left in a period that it had, one row with a line count of 0 is written, which readers skip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from costlake.operators.partials import Partials
from costlake.sources.sinks import PARTITION, write_incremental

BATCH = "batch"
LINES = "line_count"


def _in_periods(df: DataFrame, periods: list[str | None]) -> DataFrame:
    known = [p for p in periods if p is not None]
    c = F.col(PARTITION)
    return df.where(c.isin(known) | c.isNull() if None in periods else c.isin(known))


class DeltaTable:
    """The state of one model and, beside it, the model itself; ``measures`` must count lines as ``line_count``."""

    def __init__(self, spark: SparkSession, path: str, partials: Partials) -> None:
        if PARTITION not in partials.keys or LINES not in [m.name for m in partials.measures]:
            raise ValueError(f"partials need the key {PARTITION} and the measure {LINES}")
        self.spark, self.partials = spark, partials
        self.state_path, self.model_path = f"{path}/state", f"{path}/model"

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path).withColumn(PARTITION, F.col(PARTITION).cast("string"))
        except AnalysisException:  # no table yet
            return None

    def _emptied(self, like: DataFrame, periods: list[str | None]) -> DataFrame:
        """Rows that stand for nothing, one for each period."""
        rows = self.spark.createDataFrame([(p,) for p in periods], f"{PARTITION} string")
        fields = [f for f in like.schema.fields if f.name != PARTITION]
        return rows.select(*[(F.lit(0) if f.name == LINES else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields], PARTITION)

    def apply(self, batch: str, facts: DataFrame) -> list[str | None]:
        """Store the partials of a batch in place of its earlier version; returns the periods that this changes."""
        new = self.partials.of(facts).withColumn(BATCH, F.lit(batch))
        state = self._read(self.state_path)
        # names of folders: some for each batch, however many rows it has
        before = set() if state is None else {r[0] for r in state.where((F.col(BATCH) == batch) & (F.col(LINES) > 0)).select(PARTITION).distinct().collect()}
        if before:
            gone = self._emptied(new.drop(BATCH), sorted(before, key=str)).withColumn(BATCH, F.lit(batch))
            new = new.unionByName(gone)
        (new.hint("rebalance", PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH, PARTITION).parquet(self.state_path))
        written = self._read(self.state_path).where((F.col(BATCH) == batch) & (F.col(LINES) > 0)).select(PARTITION).distinct()
        return sorted(before | {r[0] for r in written.collect()}, key=str)

    def merged(self, periods: list[str | None] | None = None) -> DataFrame:
        """All batches' partials added up, of all periods or some."""
        state = self._read(self.state_path)
        if periods is not None:
            state = _in_periods(state, periods)
        return self.partials.merged(state.where(F.col(LINES) > 0))

    def refresh(self, batch: str, facts: DataFrame) -> None:
        """Apply a batch and write the periods of the model that it changes."""
        periods = self.apply(batch, facts)
        if periods:
            new = self.merged(periods)
            write_incremental(new.unionByName(self._emptied(new, periods)), self.model_path)

    def model(self) -> DataFrame:
        """The model as written: merged partials by key."""
        return self._read(self.model_path).where(F.col(LINES) > 0)
