"""Usage classification: ordered rule lists (first match wins) stored as data.

A rule is ``(condition, label)``. Conditions are nested tuples:

    ("like", col, pattern)      SQL LIKE
    ("rlike", col, regex)       regular expression search
    ("eq", col, value)          equality
    ("in", col, [values])       membership
    ("or", c1, c2, ...)  ("and", c1, c2, ...)  ("not", c)

``col`` is a column name, ``("split_part", name, delim, n)`` or ``("lower", name)``. A label is a string, ``None``,
or ``("col", name)`` (fall back to a column's value).

``compile_rules`` builds one ``CASE WHEN`` Column (codegen'd, no UDF). For large rule sets applied
to big tables, ``classify_by_signature`` classifies the distinct input signatures once and joins the
label back, which keeps the generated code small and the per-row work to a hash lookup.
``to_sql`` renders the same rules as SQL text (used by the DuckDB oracle tests).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(spec, colmap) -> Column:
    if isinstance(spec, tuple) and spec[0] == "split_part":
        _, name, delim, n = spec
        return F.split_part(F.col(colmap.get(name, name)), F.lit(delim), F.lit(n))
    if isinstance(spec, tuple) and spec[0] == "lower":
        return F.lower(F.col(colmap.get(spec[1], spec[1])))
    return F.col(colmap.get(spec, spec))


def compile_condition(cond, colmap=None) -> Column:
    colmap = colmap or {}
    op = cond[0]
    if op == "like":
        return _col(cond[1], colmap).like(cond[2])
    if op == "rlike":
        return _col(cond[1], colmap).rlike(cond[2])
    if op == "eq":
        return _col(cond[1], colmap) == F.lit(cond[2])
    if op == "in":
        return _col(cond[1], colmap).isin(list(cond[2]))
    if op == "or":
        out = compile_condition(cond[1], colmap)
        for c in cond[2:]:
            out = out | compile_condition(c, colmap)
        return out
    if op == "and":
        out = compile_condition(cond[1], colmap)
        for c in cond[2:]:
            out = out & compile_condition(c, colmap)
        return out
    if op == "not":
        return ~compile_condition(cond[1], colmap)
    raise ValueError(f"unknown condition {op}")


def _label(label, colmap) -> Column:
    if isinstance(label, tuple) and label[0] == "rules":
        return compile_rules(label[1], label[2], colmap)
    if isinstance(label, tuple) and label[0] == "col":
        return F.col(colmap.get(label[1], label[1]))
    if isinstance(label, tuple) and label[0] == "concat":
        return F.concat(*[_label(x, colmap) if isinstance(x, tuple) else F.lit(x) for x in label[1:]])
    return F.lit(label).cast("string")


def compile_rules(rules, default, colmap=None) -> Column:
    colmap = colmap or {}
    out = None
    for cond, label in rules:
        c, v = compile_condition(cond, colmap), _label(label, colmap)
        out = F.when(c, v) if out is None else out.when(c, v)
    return out.otherwise(_label(default, colmap)) if out is not None else _label(default, colmap)


def input_columns(rules, default=None) -> list[str]:
    seen: list[str] = []

    def add(name):
        if name not in seen:
            seen.append(name)

    def walk(cond):
        if cond[0] in ("like", "rlike", "eq", "in"):
            spec = cond[1]
            add(spec[1] if isinstance(spec, tuple) else spec)
        else:
            for c in cond[1:]:
                walk(c)

    def walk_label(label):
        if isinstance(label, tuple) and label[0] == "rules":
            for c2, l2 in label[1]:
                walk(c2)
                walk_label(l2)
            walk_label(label[2])
        elif isinstance(label, tuple) and label[0] == "col":
            add(label[1])
        elif isinstance(label, tuple) and label[0] == "concat":
            for x in label[1:]:
                walk_label(x)

    for cond, label in rules:
        walk(cond)
        walk_label(label)
    walk_label(default)
    return seen


def classify_by_signature(df: DataFrame, rules, default, out_col: str, colmap=None) -> DataFrame:
    """Label rows by classifying their distinct input signatures and joining the label back.

    The signature table has one row per distinct combination of the rule inputs (usage types x
    operations ...: thousands, not billions); NULL-safe join keys keep NULL inputs.
    """
    colmap = colmap or {}
    cols = [colmap.get(c, c) for c in input_columns(rules, default)]
    sig = df.select(*cols).distinct()
    sig = sig.select(*cols, compile_rules(rules, default, colmap).alias(out_col))
    renamed = sig.select(*[F.col(c).alias(f"_sig_{c}") for c in cols], out_col)
    cond = None
    for c in cols:
        e = df[c].eqNullSafe(renamed[f"_sig_{c}"])
        cond = e if cond is None else cond & e
    # no broadcast hint: the signature table's size comes from the data, so Spark's runtime size
    # check (AQE) picks a broadcast hash join when it is small and a shuffle join otherwise
    return df.join(renamed, cond, "left").drop(*[f"_sig_{c}" for c in cols])


# ---- SQL rendering (oracle) -----------------------------------------------------------------

def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _sql_col(spec, colmap) -> str:
    if isinstance(spec, tuple) and spec[0] == "split_part":
        _, name, delim, n = spec
        return f"split_part({colmap.get(name, name)}, {_q(delim)}, {n})"
    if isinstance(spec, tuple) and spec[0] == "lower":
        return f"lower({colmap.get(spec[1], spec[1])})"
    return colmap.get(spec, spec)


def condition_sql(cond, colmap=None) -> str:
    colmap = colmap or {}
    op = cond[0]
    if op == "like":
        return f"{_sql_col(cond[1], colmap)} LIKE {_q(cond[2])}"
    if op == "rlike":
        return f"regexp_matches({_sql_col(cond[1], colmap)}, {_q(cond[2])})"
    if op == "eq":
        return f"{_sql_col(cond[1], colmap)} = {_q(cond[2])}"
    if op == "in":
        return f"{_sql_col(cond[1], colmap)} IN ({', '.join(_q(v) for v in cond[2])})"
    if op in ("or", "and"):
        return "(" + f" {op.upper()} ".join(condition_sql(c, colmap) for c in cond[1:]) + ")"
    if op == "not":
        return f"NOT ({condition_sql(cond[1], colmap)})"
    raise ValueError(op)


def _label_sql(label, colmap) -> str:
    if isinstance(label, tuple) and label[0] == "rules":
        return to_sql(label[1], label[2], colmap)
    if label is None:
        return "CAST(NULL AS VARCHAR)"
    if isinstance(label, tuple) and label[0] == "col":
        return colmap.get(label[1], label[1])
    if isinstance(label, tuple) and label[0] == "concat":
        return "(" + " || ".join(_label_sql(x, colmap) if isinstance(x, tuple) else _q(x) for x in label[1:]) + ")"
    return _q(label)


def to_sql(rules, default, colmap=None) -> str:
    colmap = colmap or {}
    whens = " ".join(f"WHEN {condition_sql(c, colmap)} THEN {_label_sql(v, colmap)}" for c, v in rules)
    return f"(CASE {whens} ELSE {_label_sql(default, colmap)} END)"


def like_rules(column: str, pairs) -> list:
    """Rules of the common shape "column LIKE pattern -> label", in order."""
    return [(("like", column, p), label) for p, label in pairs]
