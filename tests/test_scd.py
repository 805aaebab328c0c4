"""Bucketed SCD2 snapshot: equal to the plain merge over random histories, no shuffle of the snapshot, few slices rewritten."""

import datetime as dt
import glob
import os
import random

from costlake.operators.freshness import snapshot_scd2
from costlake.plans.scd import BucketedSnapshot

SCHEMA = "k long, v string, updated timestamp"


def at(day):
    return dt.datetime(2024, 1, day)


def test_equals_the_plain_merge(spark, tmp_path):
    rng, plain, versions = random.Random(6), None, {}
    first = spark.createDataFrame([], SCHEMA)
    snapshot = BucketedSnapshot(spark, f"file://{tmp_path}/s", first.schema, "k", "updated")
    for day in range(1, 6):
        rows = []
        for k in rng.sample(range(60), 25):
            # unchanged, older, newer or without a time
            versions[k] = rng.choice([versions.get(k, at(1)), at(max(1, day - 1)), at(day), at(day)])
            rows.append((k, f"v{day}", rng.choice([versions[k]] * 4 + [None])))
        batch = spark.createDataFrame(rows, SCHEMA)
        # the plain merge takes the state as it was, so cut its lineage
        plain = snapshot_scd2(plain, batch, "k", "updated", at(day)).checkpoint()
        snapshot.merge(batch, at(day), f"day{day}")
        assert sorted(map(tuple, snapshot.current().collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        before = sorted(map(tuple, snapshot.current().collect()), key=str)
        snapshot.merge(batch, at(day), f"day{day}")  # repeated
        assert sorted(map(tuple, snapshot.current().collect()), key=str) == before


def test_snapshot_side_is_not_shuffled(spark, tmp_path):
    rows = [(k, "a", at(1)) for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    snapshot = BucketedSnapshot(spark, f"file://{tmp_path}/s", df.schema, "k", "updated")
    assert snapshot.merge(df, at(1), "one") == 16
    plan = snapshot.changes(spark.createDataFrame([(3, "b", at(2))], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Exchange" in line or "FileScan" in line]
    depth = {line: len(line) - len(line.lstrip(" :+-")) for line in lines}
    scans = [line for line in lines if "FileScan" in line]
    assert len(scans) == 1 and "Bucketed: true" in plan
    # exchanges stand above the batch only: none lies above the scan on its own branch
    above = [line for line in lines[:lines.index(scans[0])] if "Exchange" in line and depth[line] < depth[scans[0]]]
    assert all(line.lstrip().startswith(":") for line in above)


def test_only_changed_slices_are_rewritten(spark, tmp_path):
    df = spark.createDataFrame([(k, "a", at(1)) for k in range(500)], SCHEMA)
    snapshot = BucketedSnapshot(spark, f"file://{tmp_path}/s", df.schema, "k", "updated")
    snapshot.merge(df, at(1), "one")
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/s/open/dbt_slice=*/*.parquet")}
    changed = spark.createDataFrame([(3, "b", at(2)), (700, "new", at(2)), (4, "same", at(1))], SCHEMA)
    touched = {r[0] for r in snapshot.with_slice(changed.where("k in (3, 700)")).select("dbt_slice").distinct().collect()}
    assert snapshot.merge(changed, at(2), "two") == len(touched)
    gone = {f.split("dbt_slice=")[1].split("/")[0] for f, t in files.items() if not os.path.exists(f) or os.stat(f).st_mtime_ns != t}
    assert gone == {str(s) for s in touched}
    assert snapshot.current().count() == 502
    assert snapshot.merge(spark.createDataFrame([(3, "b", at(2))], SCHEMA), at(3), "three") == 0
    closed = snapshot.current().where("dbt_valid_to is not null").collect()
    assert [(r.k, r.dbt_valid_from, r.dbt_valid_to) for r in closed] == [(3, at(1), at(2))]
