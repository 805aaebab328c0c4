"""The streaming incremental refresh writes the same partitions a batch rebuild produces."""

import os
import tempfile

from pyspark.sql import functions as F

from costlake.operators.normalize import dedupe_line_items
from costlake.plans.io import with_copies
from costlake.plans.registry import DRIVER_AS_OF, CostModels
from costlake.sources.fixture import cur_source
from costlake.sources.sinks import write_incremental
from costlake.streaming import start_incremental_refresh
from costlake.streaming.dedupe import current, start_dedupe
from tests.conftest import SF_SMALL


def test_streaming_refresh_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="costlake-stream-")
    landing, out, ckpt = (os.path.join(root, x) for x in ("landing", "out", "ckpt"))
    write_incremental(cur_source(spark, SF_SMALL).where("billing_period >= '2001-01'"), landing, mode="overwrite")
    q = start_incremental_refresh(spark, landing, out, ckpt, DRIVER_AS_OF, models=("service_daily",))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(out, "service_daily"))
    exp = CostModels(spark, spark.read.parquet(landing), as_of=DRIVER_AS_OF).service_daily
    cols = sorted(exp.columns)
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0
    assert exp.select(*cols).exceptAll(got.select(*cols)).count() == 0


def _same(got, want):
    cols = [c for c in want.columns if c != "resource_tags"]
    both = [df.select(*cols, F.to_json(F.array_sort(F.map_entries("resource_tags"))).alias("tags")) for df in (got, want)]
    return both[0].exceptAll(both[1]).count() == 0 and both[1].exceptAll(both[0]).count() == 0


def test_streaming_dedupe_is_the_batch_result(spark, models, tmp_path):
    """Shuffled deliveries with repeated and corrected lines; the state's windows pass between them; a restart goes on."""
    lines = with_copies(models.bronze.limit(1500).checkpoint()).checkpoint()
    landing, changes, checkpoint = (f"file://{tmp_path}/{x}" for x in ("landing", "changes", "checkpoint"))
    parts = lines.withColumn("_part", F.pmod(F.xxhash64("unblended_cost", "usage_type", "account_id"), F.lit(4))).checkpoint()
    seen = lines.limit(0)
    for part in (2, 0, 3, 1):
        delivery = parts.where(F.col("_part") == part).drop("_part")
        delivery.repartition(2).write.mode("append").parquet(landing)
        seen = seen.unionByName(delivery)
        stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        query = start_dedupe(stream, changes, checkpoint, window="1 second")
        query.awaitTermination(300)
        assert query.exception() is None
        assert _same(current(spark, changes, models.bronze), dedupe_line_items(seen))
    rows = spark.read.parquet(changes)
    assert rows.select("_window").distinct().count() > 2  # an identity's copies came in several windows
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
