"""The serve models and their checks: one pass over the lines, observed counts equal to the failing rows."""

from pyspark.sql import functions as F

from costlake.operators import checks
from costlake.operators.checks import Severity
from costlake.plans import serve
from costlake.plans.audited import ROW_CHECKS, AuditedServe


def _count(total):
    def run(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    return run


def test_lines_are_read_once(spark, models):
    lines = models.silver.select("usage_date", "account_id", "account_name", "payer_account_id", "payer_account_name", "billing_entity", "service_code",
                                 "service_name", "service_category", "effective_cost", "billed_cost", "list_cost", "billing_period").checkpoint()
    total = spark.sparkContext.accumulator(0)
    built = AuditedServe(lines.mapInArrow(_count(total), lines.schema), "2001-11-05")
    built.gate({name: Severity() for name in [*ROW_CHECKS, *built.table_checks]}).collect()
    assert total.value == lines.count() > 0


def test_counts_are_those_of_the_failing_rows(spark, models):
    built = AuditedServe(models.silver, "2001-11-05")
    assert built.rows == models.cost_service_account_daily.count()
    for name, n in built.row_failures.items():
        assert built.failing(name).count() == n, name
    gate = {r.check: r for r in built.gate({name: Severity("error", ">= 1", ">= 1") for name in [*ROW_CHECKS, *built.table_checks]}).collect()}
    for name in [*ROW_CHECKS, *built.table_checks]:
        n = built.failing(name).count()
        assert (gate[name].failures, gate[name].status) == (n, "error" if n else "pass")
    assert sum(r.failures > 0 for r in gate.values()) >= 5 and sum(r.failures == 0 for r in gate.values()) >= 2


def test_models_are_those_of_the_plain_plans(spark, models):
    built = AuditedServe(models.silver, "2001-11-05")
    plain = serve.account_metadata(models.silver, "2001-11-05")
    assert built.metadata.exceptAll(plain).count() == 0 and plain.exceptAll(built.metadata).count() == 0
    rows = models.cost_service_account_daily.withColumns({c: F.col(c).cast("double") for c in ("total_effective_cost", "total_billed_cost", "total_list_cost")})
    assert built.serve.exceptAll(rows).count() == 0 and rows.exceptAll(built.serve).count() == 0


def test_gate_levels(spark):
    counts = {"none": 0, "few": 3, "many": 70}
    sev = {k: Severity("error", ">= 50", ">= 1") for k in counts}
    sev["warned"] = Severity("warn", ">= 1", ">= 5")
    bad = spark.range(9)
    got = {r.check: (r.failures, r.severity, r.status) for r in checks.severity_gate(spark, {"warned": bad}, sev, counts).collect()}
    assert got == {"none": (0, "error", "pass"), "few": (3, "error", "warn"), "many": (70, "error", "error"), "warned": (9, "warn", "warn")}
    only = checks.severity_gate(spark, {"warned": spark.range(2)}, sev).collect()
    assert [(r.check, r.status) for r in only] == [("warned", "pass")]
