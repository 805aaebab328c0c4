"""Usage classification jobs: label lines by rule sets and roll cost up per label.

Plan: (1) keep the lines a rule set applies to and pre-aggregate them by the rule inputs (usage
type, operation, ...) with map-side partial sums -- billions of lines collapse to the catalogue of
distinct signatures; (2) evaluate the CASE chain once per signature (the large generated expression
never runs per line); (3) re-aggregate per label. No join and no broadcast is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions.classify import compile_condition, compile_rules, input_columns
from costlake.functions.classify.catalog import FAMILIES, RULE_SETS, unified_rules
from costlake.functions.classify.index import with_labels

MEASURES = [("effective_cost", "total_effective_cost"), ("usage_amount", "total_usage_amount")]


def labelled_sums(rows: DataFrame, keys: list[Column], inputs: list[str], label: Column, out_col: str, sums: list[str]) -> DataFrame:
    """Sums by keys and a label: lines are added up by the label's inputs first, so the rule chain runs once
    per distinct input of a key, not per line, and stays out of the aggregate over the lines.

    ``keys``: columns with a name of their own (plain or aliased). ``sums``: columns to add up, kept by name.
    """
    first = rows.groupBy(*keys, *[F.col(i).alias(f"_in_{i}") for i in inputs]).agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    names = first.columns[:len(keys)]
    lines = first.select(*names, *[F.col(f"_in_{i}").alias(i) for i in inputs if i not in names],
                         *[F.col(f"_sum_{s}") for s in sums])
    labelled = lines.withColumn(out_col, label)
    return labelled.groupBy(*names, out_col).agg(*[F.sum(f"_sum_{s}").alias(s) for s in sums])


def _signature_rollup(rows: DataFrame, keys: list[str], label) -> DataFrame:
    sig = rows.groupBy(*keys).agg(*[F.sum(m).alias(n) for m, n in MEASURES], F.count(F.lit(1)).alias("line_count"))
    labelled = sig.withColumn("usage_category", label)
    out_keys = [k for k in ("rule_set", "service_code") if k in keys]
    return (labelled.groupBy(*out_keys, "usage_category")
            .agg(*[F.sum(n).alias(n) for _, n in MEASURES], F.sum("line_count").alias("line_count")))


def usage_category_rollup(df: DataFrame, family: str) -> DataFrame:
    """Cost per (rule set, service, usage category) for every rule set of a family."""
    names = FAMILIES[family]
    applies = F.filter(F.array(*[F.when(compile_condition(RULE_SETS[n][0]), F.lit(n)) for n in names]),
                       lambda x: x.isNotNull())
    inputs = ["service_code"]
    for n in names:
        cond, rules, default = RULE_SETS[n]
        for c in input_columns(rules, default) + input_columns([(cond, "x")]):
            if c not in inputs:
                inputs.append(c)
    rows = df.select(F.explode(applies).alias("rule_set"), *inputs, *[m for m, _ in MEASURES])
    rs = F.col("rule_set")
    label = None
    for n in names:
        _, rules, default = RULE_SETS[n]
        e = compile_rules(rules, default)
        label = F.when(rs == n, e) if label is None else label.when(rs == n, e)
    return _signature_rollup(rows, ["rule_set", *inputs], label)


def _dispatched(df: DataFrame) -> DataFrame:
    """Lines added up by the inputs of the unified rules."""
    rules, default = unified_rules()
    inputs = input_columns(rules, default)
    if "service_code" not in inputs:
        inputs.insert(0, "service_code")
    return df.groupBy(*inputs).agg(*[F.sum(m).alias(n) for m, n in MEASURES], F.count(F.lit(1)).alias("line_count"))


def _by_category(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("service_code", "usage_category").agg(
        *[F.sum(n).alias(n) for _, n in MEASURES], F.sum("line_count").alias("line_count"))


def classify_all(df: DataFrame) -> DataFrame:
    """The unified usage-category map over every line: cost per (service, usage category)."""
    return _by_category(_dispatched(df).withColumn("usage_category", compile_rules(*unified_rules())))


def classify_all_indexed(df: DataFrame) -> DataFrame:
    """``classify_all`` by the rule index: a signature is tested against the few rules that its literals point to,
    where the CASE chain tests up to all of them. Of use where distinct signatures are many (usage types that carry
    instance types, resources' own names) or rule sets grow by a user's own."""
    return _by_category(with_labels(_dispatched(df), unified_rules, "usage_category"))


def on_rule_samples(df: DataFrame, samples: list[dict]) -> DataFrame:
    """The lines with the rule inputs of samples, dealt out evenly by a hash of the line: every rule has lines.

    ``samples``: inputs by name, the same names in each; the table is as long as the rule tables.
    """
    names = list(samples[0])
    rows = df.sparkSession.createDataFrame([(k, *[s[c] for c in names]) for k, s in enumerate(samples)],
                                           ", ".join(["_sample long", *[f"`{c}` string" for c in names]]))
    of_line = F.md5(F.concat_ws(":", F.date_format("usage_date", "yyyyMMdd"), "account_id", "service_code", "usage_type", "resource_id").cast("binary"))
    line = df.select(F.pmod(F.conv(F.substring(of_line, 1, 8), 16, 10).cast("long"), F.lit(len(samples))).alias("_sample"), *[m for m, _ in MEASURES])
    return line.join(F.broadcast(rows), "_sample").drop("_sample")
