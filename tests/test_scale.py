"""Steps that many queries share: tasks grow in number with the input, and nothing is computed or shuffled twice."""

import glob
import os
import time

from pyspark.sql import functions as F

from costlake import queries
from costlake.operators.normalize import dedupe_line_items, deduped_lines, keyed_lines, restored_lines
from costlake.operators.slices import SLICES, by_slices
from costlake.plans import io
from costlake.session import configure
from costlake.sources.fixture import cur_source
from costlake.streaming.dedupe import current, start_dedupe
from tests.conftest import SF_SMALL


def test_lines_are_not_shaped_in_a_fixed_number_of_tasks(spark, capsys):
    cur_source(spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert "REPARTITION_BY_COL" in plan and "REPARTITION_BY_NUM" not in plan


def test_surrogate_key_is_not_shuffled(models, capsys):
    deduped_lines(keyed_lines(models.bronze)).explain()
    assert "sha2" not in capsys.readouterr().out


def test_wide_projections_are_compiled(spark):
    """The JVM compiles no method of over 8000 bytes of bytecode: above that, stages aren't fused into one method."""
    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_instance_types_by_account_are_not_expanded(models):
    df = queries.QUERIES["gold_instance_type_account_monthly"](models)
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_stream_keeps_no_state(spark, models, tmp_path):
    line = models.bronze.limit(3).checkpoint()
    changes, checkpoint = f"file://{tmp_path}/changes", f"file://{tmp_path}/checkpoint"
    for cost in (1, 3, 2):  # three deliveries of the same lines
        corrected = F.lit(cost).cast(line.schema["unblended_cost"].dataType)
        line.withColumn("unblended_cost", corrected).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/landing")
        stream = spark.readStream.schema(line.schema).parquet(f"file://{tmp_path}/landing")
        start_dedupe(stream, changes, checkpoint).awaitTermination(120)
    assert not os.path.exists(f"{tmp_path}/checkpoint/state")
    rows = current(spark, changes, line).select("duplicate_count").collect()
    assert [r[0] for r in rows] == [3, 3, 3]


def test_a_sink_computes_its_model_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([("2000-01", 1), ("2001-05", 2), ("2001-07", 3)], "billing_period string, n int")
    model = rows.withColumn("m", F.udf(counted, "int")("n"))
    got = io.table_round_trip(model)
    assert sorted(r.m for r in got.collect()) == [1, 2, 3] and seen.value == 3


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(files.size()) if (f := files.apply(i).getName()).startswith("shuffle_")}


def test_dedupe_frees_whole_lines_slice_by_slice(spark, models, capsys):
    lines = io.with_copies(models.bronze.limit(400).checkpoint())
    before = _shuffle_files(spark)
    one = dedupe_line_items(lines)
    for _ in range(50):  # freed when a slice's query ends, asynchronously
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    one.explain()
    assert "Exchange" not in capsys.readouterr().out
    want = restored_lines(deduped_lines(keyed_lines(lines)), lines)
    got, want = ({(r.surrogate_key, r.unblended_cost, r.duplicate_count) for r in df.collect()} for df in (one, want))
    assert got == want and len(got) == 400


def test_slices_give_what_the_whole_gives(spark):
    rows = spark.createDataFrame([(k, None if k % 3 else "x", v) for k in (None, *range(40)) if k is not None for v in (1, 2, 2)]
                                 + [(None, None, 5), (None, None, 6)], "k int, t string, v int")
    count = lambda df: df.groupBy("k", "t").agg(F.max("v").alias("v"), F.count("*").alias("n"))
    got, want = ([tuple(r) for r in df.collect()] for df in (by_slices(rows, ["k", "t"], count, "test"), count(rows)))
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 41 and SLICES > 1
    assert by_slices(rows.limit(0), ["k", "t"], count, "test").collect() == []


def test_deliveries_land_once(spark, models, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "new_table", lambda _, name: f"{tmp_path}/{name}")
    bronze = models.bronze.limit(200).checkpoint()
    got = io.deduped_by_stream(bronze)
    assert sorted(map(str, got.collect())) == sorted(map(str, io.deduped(bronze).collect()))
    kept = {os.path.relpath(os.path.dirname(f), tmp_path).split("/_delivery")[0] for f in glob.glob(f"{tmp_path}/dedupe/**/*.parquet", recursive=True)}
    assert {k for k in kept if "changes" not in k} == {"dedupe/landing"}
    assert spark.read.parquet(f"{tmp_path}/dedupe/landing").count() == io.with_copies(bronze).count()
    assert len(glob.glob(f"{tmp_path}/dedupe/changes/epoch=*")) == 3
