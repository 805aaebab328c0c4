"""Source/sink operators as jobs over the billing export (bronze conform, tags, billing period,
period window, calendar, tag keys, incremental partition overwrite)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.operators.calendar import days_per_period
from costlake.operators.partials import LG_K, QUANTILE_K, Partials, distinct, distinct_error, lines, quantile, quantiles, rank_error
from costlake.operators.normalize import dedupe_line_items
from costlake.operators.slices import CODEC, new_table
from costlake.operators.tags import tag_keys
from costlake.plans.compute import TYPE_KEYS, utilization_over_time, utilization_partials
from costlake.plans.core import COSTS, invoice_from_partials, invoice_lines, invoice_partials, service_partials
from costlake.plans.refresh import DeltaTable
from costlake.session import own_tables
from costlake.sources.cur import CUR_COLUMNS, conform_schema
from costlake.sources.evolution import EvolvingTable
from costlake.sources.period import billing_period_range, period_filter
from costlake.streaming.dedupe import current, start_dedupe
from costlake.sources.sinks import audit_store_failures, read_evolved, sink_append, sink_table, sink_view, write_incremental

#: Where the sink jobs cut a model into two batches.
SPLIT_PERIOD = "2001-06"

def bronze_projection(bronze: DataFrame) -> DataFrame:
    """All columns of the conformed export but the tag map, which ``tag_pairs`` shows."""
    return bronze.drop("resource_tags")


def conform_map_layout(raw: DataFrame) -> DataFrame:
    """The export in its newer layout (product attributes as one ``product`` map), conformed."""
    keys = [src[len("product['"):-2] for _, src, _, _ in CUR_COLUMNS if src.startswith("product['")]
    flat = [k for k in keys if f"product_{k}" in raw.columns]
    pairs = [x for k in flat for x in (F.lit(k), F.col(f"product_{k}").cast("string"))]
    return conform_schema(raw.withColumn("product", F.create_map(*pairs)).drop(*[f"product_{k}" for k in flat]))


def tag_pairs(bronze: DataFrame) -> DataFrame:
    """Line count per (tag key, tag value) of the unified tag map (NULL value = key present, untagged)."""
    return (bronze.select(F.explode("resource_tags").alias("tag_key", "tag_value"))
            .groupBy("tag_key", "tag_value").agg(F.count(F.lit(1)).alias("line_count")))


def billing_period_from_year_month(raw: DataFrame) -> DataFrame:
    """Export of the older layout (``year``/``month`` partitions instead of ``billing_period``):
    conform it and count lines per derived billing period."""
    older = (raw.withColumn("year", F.substring("billing_period", 1, 4))
             .withColumn("month", F.substring("billing_period", 6, 2).cast("int").cast("string"))
             .drop("billing_period"))
    return conform_schema(older).groupBy("billing_period").agg(F.count(F.lit(1)).alias("line_count"))


def period_window_costs(silver: DataFrame, as_of: _dt.date, lookback_months: int = 6) -> DataFrame:
    """Effective cost per billing period of the default incremental window (last N months)."""
    rng = billing_period_range(as_of, lookback_months)
    return (period_filter(silver, rng).groupBy("billing_period")
            .agg(F.sum("effective_cost").alias("total_effective_cost"), F.count(F.lit(1)).alias("line_count")))


def date_spine_months(silver: DataFrame, as_of: _dt.date) -> DataFrame:
    return days_per_period(silver, "month", as_of).select(F.col("_period").alias("month"),
                                                         F.col("_ct_days").alias("ct_days"))


def discovered_tag_keys(silver: DataFrame) -> DataFrame:
    return tag_keys(silver)


def _once(df: DataFrame, name: str) -> DataFrame:
    """What several writes of one run read, computed once and kept as a table in the shared checkpoint folder."""
    path = new_table(df.sparkSession, f"{name}-source")
    sink_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def view_round_trip(model: DataFrame) -> DataFrame:
    """The model as a session view, read back by name."""
    name = f"costlake_view_{uuid.uuid4().hex[:12]}"
    sink_view(model, name)
    return model.sparkSession.table(name)


def table_round_trip(model: DataFrame) -> DataFrame:
    """The model written twice as a full table; the second write replaces the first."""
    path, model = new_table(model.sparkSession, "table"), _once(model, "table")
    sink_table(model.where(F.col("billing_period") < SPLIT_PERIOD), path)
    sink_table(model, path)
    return model.sparkSession.read.parquet(path)


def append_round_trip(model: DataFrame) -> DataFrame:
    """The model appended in two batches."""
    path, model = new_table(model.sparkSession, "append"), _once(model, "append")
    sink_append(model.where(F.col("billing_period") < SPLIT_PERIOD), path)
    sink_append(model.where(F.col("billing_period") >= SPLIT_PERIOD), path)
    return model.sparkSession.read.parquet(path)


def evolved_round_trip(model: DataFrame) -> DataFrame:
    """A table whose first batch lacks a column of the second: old rows read NULL there."""
    path, model = new_table(model.sparkSession, "evolved"), _once(model, "evolved")
    sink_append(model.where(F.col("billing_period") < SPLIT_PERIOD).drop("service_category"), path)
    sink_append(model.where(F.col("billing_period") >= SPLIT_PERIOD), path)
    return read_evolved(model.sparkSession, path).select(*model.columns)


def evolved_types_round_trip(model: DataFrame) -> DataFrame:
    """Four batches of one table: whole costs as INT and days as DATE, then as BIGINT with times, as DECIMAL, and as DECIMAL
    of another scale without a column. They read as DECIMAL and TIMESTAMP, with every value that was written."""
    model = _once(model, "types")
    table = EvolvingTable(model.sparkSession, new_table(model.sparkSession, "types"))
    cost, period = F.col("total_effective_cost"), F.col("billing_period")
    table.append(model.where(period < "1997-01").withColumns({"total_effective_cost": F.round(cost, 0).cast("int"), "usage_date": F.to_date("usage_date")}))
    table.append(model.where((period >= "1997-01") & (period < "1998-07")).withColumn("total_effective_cost", F.round(cost, 0).cast("bigint")))
    table.append(model.where((period >= "1998-07") & (period < SPLIT_PERIOD)).withColumn("total_effective_cost", cost.cast("decimal(16,4)")))
    table.append(model.where(period >= SPLIT_PERIOD).withColumn("total_effective_cost", F.round(cost, 1).cast("decimal(12,1)")).drop("service_category"))
    return table.read()


def audit_round_trip(failures: dict[str, DataFrame]) -> DataFrame:
    """Failing rows stored in two runs, the first with a check that passes in the second; rows per check."""
    spark = next(iter(failures.values())).sparkSession
    path = new_table(spark, "audit")
    audit_store_failures({**failures, "fixed_since": next(iter(failures.values()))}, path)
    audit_store_failures(failures, path)
    return spark.read.parquet(path).groupBy(F.col("check").cast("string").alias("check")).agg(F.count("row").alias("failures"))


def _batches(facts: DataFrame, key: str = "account_id") -> list[tuple[str, DataFrame]]:
    """The facts as three batches by account, as an export that comes in one delivery for each group of accounts."""
    part = F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(3))
    return [(f"delivery-{k}", facts.where(part == k)) for k in range(3)]


def delta_round_trip(facts: DataFrame, partials: Partials, costs: list[str], name: str) -> DeltaTable:
    """Three batches applied one by one, and a fourth that replaces the second.

    The second comes first with doubled costs and only half of its periods, some of them shifted into periods that
    its corrected version doesn't have; the corrected version takes all of that back.
    """
    facts = _once(facts, name)
    table = DeltaTable(facts.sparkSession, new_table(facts.sparkSession, name), partials)
    (a, first), (b, second), (c, third) = _batches(facts)
    wrong = second.where(F.col("billing_period") < SPLIT_PERIOD).withColumns(
        {m: (F.col(m) * 2).cast(second.schema[m].dataType) for m in costs}
        | {"billing_period": F.concat(F.lit("19"), F.substring("billing_period", 3, 5))})
    for batch, rows in ((a, first), (b, wrong), (c, third), (b, second)):
        table.refresh(batch, rows)
    return table


def delta_service_daily(cost_daily: DataFrame) -> DataFrame:
    """Daily service cost by delta refreshes; equals the model built from all facts."""
    costs = ["total_effective_cost", "total_billed_cost", "total_list_cost"]
    facts = cost_daily.select(*service_partials().keys, *costs)
    table = delta_round_trip(facts, service_partials(), costs, "delta-service")
    return table.model().drop("line_count")


def delta_invoices(silver: DataFrame) -> DataFrame:
    """Invoices by delta refreshes: costs and distinct-count sketches are merged from the batches' partials."""
    facts = invoice_lines(silver).select(*invoice_partials().keys, "account_id", "service_code", "region_id", "resource_id", *COSTS)
    table = delta_round_trip(facts, invoice_partials(), list(COSTS), "delta-invoices")
    return invoice_from_partials(table.model())


def delta_utilization(resource_monthly: DataFrame) -> DataFrame:
    """Utilisation percentiles of instance types over all periods and accounts, merged from sketches by both."""
    resource_monthly = _once(resource_monthly, "delta-utilization")
    table = DeltaTable(resource_monthly.sparkSession, new_table(resource_monthly.sparkSession, "delta-utilization"), utilization_partials())
    for batch, rows in _batches(resource_monthly):
        table.refresh(batch, rows)
    return utilization_over_time(table.partials.merged(table.model(), TYPE_KEYS))


def sketch_accuracy(silver: DataFrame, lg_k: int = LG_K, k: int = QUANTILE_K) -> DataFrame:
    """Per billing period: exact counts, whether sketches are within their stated error of them, and whether merged halves are.

    Distinct resources within three standard errors, and the rank of the median line cost within the rank error;
    the halves are the odd and even accounts, whose union must estimate what the union of one sketch does.
    """
    measures = [lines(), distinct("resources", F.concat("account_id", "resource_id"), lg_k), quantiles("costs", "effective_cost", k)]
    by_period, by_half = Partials(["billing_period"], measures), Partials(["billing_period", "half"], measures)
    rows = silver.withColumn("half", F.pmod(F.crc32(F.col("account_id").cast("binary")), F.lit(2)))
    whole = by_period.of(rows)
    halves = by_period.merged(by_half.of(rows))
    exact = rows.groupBy("billing_period").agg(F.countDistinct(F.concat("account_id", "resource_id")).alias("exact_resources"),
                                               F.count("effective_cost").alias("n_costs"))

    def read(df: DataFrame, name: str) -> DataFrame:
        one = df.groupBy("billing_period").agg(measures[1].merge, measures[2].merge)  # a union of one: the same estimator
        return one.select(F.col("billing_period").alias("p"), measures[1].final.alias(f"{name}_resources"),
                          quantile("costs", 0.5).alias(f"{name}_median"))

    key = F.col("billing_period").eqNullSafe(F.col("p"))
    both = exact.join(read(whole, "whole"), key).drop("p").join(read(halves, "halves"), key).drop("p")
    off = [F.abs(F.col(f"{n}_resources") - F.col("exact_resources")) <= 3 * distinct_error(lg_k) * F.col("exact_resources") for n in ("whole", "halves")]
    medians = both.select(F.col("billing_period").alias("p"), "whole_median", "halves_median")
    cost = F.col("effective_cost").cast("double")
    ranks = rows.join(medians, key).groupBy("p").agg(*[
        F.struct(F.count_if(cost < F.col(f"{n}_median")).alias("below"), F.count_if(cost <= F.col(f"{n}_median")).alias("upto")).alias(f"{n}_rank")
        for n in ("whole", "halves")])
    slack = F.lit(rank_error(k)) * F.col("n_costs") + 1
    near = [(F.col(f"{n}_rank.below") <= 0.5 * F.col("n_costs") + slack) & (F.col(f"{n}_rank.upto") >= 0.5 * F.col("n_costs") - slack)
            for n in ("whole", "halves")]
    return both.join(ranks, key).select(
        "billing_period", "exact_resources", "n_costs", off[0].alias("resources_within"), off[1].alias("merged_resources_within"),
        (F.col("whole_resources") == F.col("halves_resources")).alias("merge_is_whole"), near[0].alias("median_within"),
        near[1].alias("merged_median_within"))


#: What the deduplicated lines are compared by: their identity, and what the line that stays brings.
DEDUPED = ["payer_account_id", "identity_line_item_id", "usage_date", "account_id", "charge_type", "product_code", "usage_type", "operation",
           "resource_id", "item_description", "pricing_term", "pricing_unit", "product_sku", "unblended_cost", "usage_amount", "invoice_id",
           "instance_type", "public_on_demand_cost", "billing_period", "duplicate_count"]


def deduped(bronze: DataFrame) -> DataFrame:
    return dedupe_line_items(with_copies(bronze)).select(*DEDUPED)


def with_copies(bronze: DataFrame) -> DataFrame:
    """The lines as several deliveries would bring them: some twice, some of these with a corrected cost."""
    times = F.when(F.col("account_id") < "000000000009", 3).when(F.col("account_id") < "000000000017", 2).otherwise(1)
    copies = bronze.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    corrected = F.when(F.col("_copy") == 3, F.col("unblended_cost") + 1).otherwise(F.col("unblended_cost"))
    return copies.withColumn("unblended_cost", corrected.cast(bronze.schema["unblended_cost"].dataType)).drop("_copy")


#: Bytes of columnar files that a micro-batch reads at most: its shuffle, freed after it, is some ten times as large.
BATCH_BYTES = 128 << 20


def deduped_by_stream(bronze: DataFrame, deliveries: int = 6) -> DataFrame:
    """The same lines landed in shuffled deliveries and streamed, two deliveries for each run of the stream.

    A line's delivery is drawn in the task that reads the line and is a folder of files that the tasks write: no line
    crosses the network to be delivered. A run of the stream sees the folders that have landed by then, those that
    earlier runs have read among them.
    """
    spark = bronze.sparkSession
    folder = new_table(spark, "dedupe")
    lines = with_copies(bronze)
    with own_tables(spark):
        (lines.withColumn("_delivery", F.floor(F.rand(3) * deliveries).cast("int")).write.option("compression", CODEC)
         .partitionBy("_delivery").parquet(f"{folder}/landing"))
    for landed in range(2, deliveries + 2, 2):
        names = ",".join(str(k) for k in range(min(landed, deliveries)))
        stream = (spark.readStream.schema(lines.schema).option("maxBytesPerTrigger", BATCH_BYTES)
                  .parquet(f"{folder}/landing/_delivery={{{names}}}"))
        start_dedupe(stream, f"{folder}/changes", f"{folder}/checkpoint").awaitTermination()  # goes on after the last run
    return current(spark, f"{folder}/changes", bronze).select(*DEDUPED)


def seed_usage(silver: DataFrame, seeds: dict[str, DataFrame]) -> DataFrame:
    """Lines and cost by region, product code and instance family, with the seed rows that describe them (NULL: none does).

    One pass adds up lines by all three; the seeds, some hundred rows each, are joined to the sums.
    """
    family = F.col("instance_type_family")
    product = F.when(F.col("service_code").isin("AmazonEC2", "AmazonElastiCache", "AmazonRDS", "AmazonES"), F.col("service_code")).otherwise("AmazonEC2")
    keys = F.inline(F.array(*[F.struct(F.lit(seed).alias("seed"), F.col(key).alias("key"), of.cast("string").alias("product")) for seed, key, of in (
        ("region", "region_id", F.lit(None)), ("product", "service_code", F.lit(None)), ("family", "instance_type_family", F.col("product")))]))
    sums = (silver.select("region_id", "service_code", F.when(family != "", family).alias("instance_type_family"), product.alias("product"), "effective_cost")
            .groupBy("region_id", "service_code", "instance_type_family", "product")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("effective_cost").alias("cost"))
            .select("n", "cost", keys).where("key is not null")
            .groupBy("seed", "key", "product").agg(F.sum("n").alias("line_count"), F.sum("cost").alias("total_effective_cost")))
    about = [
        seeds["regions"].select(F.lit("region").alias("s"), F.col("region_id").alias("k"), F.lit(None).cast("string").alias("p"),
                                F.concat_ws(" | ", "region_name", "region_country", "region_city", "region_timezone").alias("attributes")),
        seeds["products"].select(F.lit("product"), "product_code", F.lit(None).cast("string"), F.concat_ws(" | ", "service_nice_name", "service_category")),
        seeds["modernization"].select(F.lit("family"), "family", "product", F.concat_ws(
            " | ", "generation", "instance_processor", "latest_intel", "latest_amd", "latest_graviton", "previous_intel")),
    ]
    described = about[0].union(about[1]).union(about[2])
    on = (F.col("seed") == F.col("s")) & (F.col("key") == F.col("k")) & F.col("product").eqNullSafe(F.col("p"))
    return sums.join(described, on, "left").select("seed", "key", "product", "line_count", "total_effective_cost", "attributes")


def incremental_round_trip(service_daily: DataFrame, as_of: _dt.date, name: str = "service_daily") -> DataFrame:
    """Full refresh of the model into a billing_period-partitioned table in the shared checkpoint
    folder, then an incremental refresh of the last six periods (dynamic partition overwrite), and the
    table read back: it must equal the model."""
    path, service_daily = new_table(service_daily.sparkSession, name), _once(service_daily, name)
    write_incremental(service_daily, path, mode="overwrite")
    write_incremental(period_filter(service_daily, billing_period_range(as_of)), path, mode="dynamic")
    return service_daily.sparkSession.read.parquet(path).select(*service_daily.columns)
