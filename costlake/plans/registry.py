"""Model DAG: one object per refresh that builds (and memoises) each model's DataFrame.

Shared intermediates (bronze -> silver -> cost_daily -> ...) are plain DataFrames, so a model pulls
in exactly the plan it needs and Catalyst prunes columns/partitions through the whole chain.
``materialize()`` writes any of them to shared storage (see ``sources.sinks``) for "smart" mode.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.operators.calendar import shared
from costlake.plans import core, serve, silver as silver_plans, tag
from costlake.session import configure
from costlake.sources.cur import conform_schema, flat_tag_keys
from costlake.sources.fixture import cur_source
from costlake.sources.period import PeriodRange, period_filter
from costlake.sources.seeds import load_seed

# as_of of the driver tables: the day after the last usage date (fixed for oracle parity)
DRIVER_AS_OF = _dt.date(2001, 11, 5)


def to_double(df: DataFrame) -> DataFrame:
    """Output boundary: exact DECIMAL money columns become DOUBLE (the published types)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.StructType) and any(isinstance(s.dataType, T.DecimalType)
                                                           for s in f.dataType.fields):
            cols.append(F.struct(*[F.col(f"{f.name}.{s.name}").cast("double").alias(s.name)
                                   if isinstance(s.dataType, T.DecimalType) else F.col(f"{f.name}.{s.name}")
                                   for s in f.dataType.fields]).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class CostModels:
    def __init__(self, spark: SparkSession, raw_cur: DataFrame, as_of: _dt.date,
                 period: PeriodRange | None = None, tag_keys: list[str] | None = None,
                 seed_paths: dict[str, str] | None = None):
        self.spark = configure(spark)
        self.raw = raw_cur
        self.as_of = as_of
        self.period = period
        self.tag_keys = tag_keys
        self.seed_paths = seed_paths or {}

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, **kw) -> "CostModels":
        kw.setdefault("as_of", DRIVER_AS_OF)
        m = cls(spark, cur_source(spark, sf_dir), **kw)
        m.sf_dir = sf_dir
        return m

    @classmethod
    def from_path(cls, spark: SparkSession, path: str, as_of: _dt.date | None = None, **kw) -> "CostModels":
        raw = spark.read.parquet(path)
        if as_of is None:
            last = raw.agg(F.max("line_item_usage_start_date")).first()[0]
            as_of = (last.date() if hasattr(last, "date") else last) + _dt.timedelta(days=1)
        return cls(spark, raw, as_of=as_of, **kw)

    def seed(self, name: str) -> DataFrame:
        return load_seed(self.spark, name, self.seed_paths.get(name))

    # ---- bronze / silver -------------------------------------------------------------------
    @cached_property
    def bronze(self) -> DataFrame:
        return conform_schema(self.raw)

    @cached_property
    def silver(self) -> DataFrame:
        return silver_plans.cur_enhanced(self.bronze, self.seed("products"), self.seed("regions"), self.period)

    @cached_property
    def silver_with_split(self) -> DataFrame:
        return silver_plans.cur_enhanced(self.bronze, self.seed("products"), self.seed("regions"), self.period,
                                         drop_split=False)

    @cached_property
    def cost_daily(self) -> DataFrame:
        return silver_plans.cost_daily(self.silver, self.period)

    # ---- core --------------------------------------------------------------------------------
    @cached_property
    def service_daily(self) -> DataFrame:
        return core.service_daily(self.cost_daily, self.period)

    @cached_property
    def region_monthly(self) -> DataFrame:
        return core.region_monthly(self.cost_daily, self.period)

    @cached_property
    def service_monthly(self) -> DataFrame:
        return core.service_monthly(self.service_daily, self.as_of, self.period)

    @cached_property
    def invoice_monthly(self) -> DataFrame:
        return core.invoice_monthly(self.silver, self.period)

    @cached_property
    def resource_tag_daily(self) -> DataFrame:
        return core.resource_tag_daily(self.silver, self.period, self.tag_keys or flat_tag_keys(self.raw.schema))

    @cached_property
    def resource_monthly(self) -> DataFrame:
        return core.resource_monthly(self.resource_tag_daily, self.as_of, self.period)

    # ---- tag -----------------------------------------------------------------------------------
    @cached_property
    def tag_cost_daily(self) -> DataFrame:
        return tag.tag_cost_daily(self.silver, self.period, self.tag_keys)

    @cached_property
    def tag_cost_monthly(self) -> DataFrame:
        return tag.tag_cost_monthly(self.tag_cost_daily, self.period)

    @cached_property
    def tag_key_coverage_monthly(self) -> DataFrame:
        return tag.tag_key_coverage_monthly(self.tag_cost_daily, self.period)

    # ---- serve ---------------------------------------------------------------------------------
    @cached_property
    def account_metadata(self) -> DataFrame:
        return serve.account_metadata(self.silver, last_updated=self.as_of.isoformat())

    @cached_property
    def cost_service_account_daily(self) -> DataFrame:
        # costs and names from the same sums, whose exchange runs once
        lines = shared(serve.account_lines(period_filter(self.silver, self.period)))
        metadata = serve.account_metadata(lines, last_updated=self.as_of.isoformat())
        return serve.cost_service_account_daily(serve.service_days(lines), metadata)
