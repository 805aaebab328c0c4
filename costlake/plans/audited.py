"""The serve models written and checked in one pass over the line items.

``AuditedServe`` adds the lines up once, to a daily table by service, account and account names; the metadata and the
serve model come from that small table. Row checks are counted while the serve model is written (observed metrics of
the write, no job of their own), and checks that compare rows run on the written tables. The rows that fail a check are
looked up only when they are asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from costlake.operators import checks
from costlake.plans.serve import COSTS, account_lines, account_metadata, cost_service_account_daily, service_days
from costlake.session import ensure_checkpoint_dir

#: Checks that a row passes or fails by itself: condition of failing, and the report of failing rows.
ROW_CHECKS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "cost_hierarchy": ("total_list_cost < total_billed_cost and total_effective_cost is not null"
                       " or total_billed_cost < total_effective_cost and total_list_cost is not null", checks.check_cost_hierarchy),
    "negative_costs": ("total_effective_cost < 0 or total_billed_cost < 0 or total_list_cost < 0", checks.check_negative_costs),
    "period_consistency": ("billing_period <> date_format(usage_date, 'yyyy-MM')", checks.check_period_consistency),
    "service_code_not_null": ("service_code is null", lambda df: checks.check_not_null(df, "service_code")),
    "cost_below_10000": ("total_effective_cost < 0 or total_effective_cost > 10000",
                         lambda df: checks.check_values_between(df, "total_effective_cost", 0, 10000)),
    "list_covers_effective": ("not coalesce(total_list_cost >= total_effective_cost, false)",
                              lambda df: checks.check_expression(df, "total_list_cost >= total_effective_cost")),
    "category_known": ("service_category = 'none'", lambda df: df.where("service_category = 'none'")),
}


class AuditedServe:
    """Serve models of a silver frame in a folder, by default a new one in the shared folder, with their failures."""

    def __init__(self, silver: DataFrame, last_updated: str, path: str | None = None) -> None:
        spark = silver.sparkSession
        path = path or f"{ensure_checkpoint_dir(spark)}/tables/audited-{uuid.uuid4().hex[:12]}"

        def stored(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            return spark.read.parquet(f"{path}/{name}")

        self.daily = stored(account_lines(silver), "daily")
        self.metadata = stored(account_metadata(self.daily, last_updated), "account_metadata")
        serve = cost_service_account_daily(service_days(self.daily), self.metadata)
        serve = serve.withColumns({c: F.col(c).cast("double") for c in COSTS})
        seen = Observation()
        counts = [F.count_if(F.coalesce(F.expr(fails), F.lit(False))).alias(name) for name, (fails, _) in ROW_CHECKS.items()]
        self.serve = stored(serve.observe(seen, *counts, F.count(F.lit(1)).alias("rows")), "serve")
        self.rows = self.serve.count()
        found = seen.get
        if found["rows"] != self.rows:  # a lost executor's tasks ran again and were observed twice
            found = self.serve.agg(*counts).first().asDict()
        self.row_failures = {name: found[name] for name in ROW_CHECKS}
        #: Checks of the written tables against each other.
        self.table_checks: dict[str, Callable[[], DataFrame]] = {
            "account_metadata": lambda: checks.check_account_metadata(self.serve, self.metadata),
            "one_name_per_account": lambda: checks.check_unique(self.metadata, "account_id", where="account_type = 'linked'"),
            "one_row_per_service_day": lambda: checks.check_unique_combination(self.serve, ["usage_date", "account_id", "service_code"]),
            "payers_are_no_linked_accounts": lambda: checks.check_relationships(
                self.metadata.where("account_type = 'payer'"), "account_id", self.metadata.where("account_type = 'linked'"), "account_id"),
        }

    def failing(self, name: str) -> DataFrame:
        """The rows that fail a check, from the written tables."""
        return ROW_CHECKS[name][1](self.serve) if name in ROW_CHECKS else self.table_checks[name]()

    def gate(self, severities: dict[str, checks.Severity]) -> DataFrame:
        """Failures and pass, warn or error of the given checks: observed counts, and counts of the table checks."""
        tables = {name: self.table_checks[name]() for name in severities if name in self.table_checks}
        observed = {name: self.row_failures[name] for name in severities if name in ROW_CHECKS}
        return checks.severity_gate(self.serve.sparkSession, tables, severities, observed)
