"""Column helpers: the NULL / '' rules of the billing export, safe division, ARN parsing.

All helpers return built-in Column expressions (JVM side, codegen'd); nothing here is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif(c: ColumnOrName, value) -> Column:
    """SQL NULLIF: NULL when equal to ``value`` else the column."""
    c = col(c)
    return F.when(c == F.lit(value), F.lit(None)).otherwise(c)


def blank_to_null(c: ColumnOrName) -> Column:
    return nullif(c, "")


def none_if_blank(c: ColumnOrName, *sentinels: str) -> Column:
    """coalesce(nullif(nullif(c, ''), s1 ...), 'none')."""
    out = blank_to_null(c)
    for s in sentinels:
        out = nullif(out, s)
    return F.coalesce(out, F.lit("none"))


def first_non_blank(*cols: ColumnOrName, default=None) -> Column:
    parts = [blank_to_null(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Double division that is NULL on a zero or NULL denominator (never raises under ANSI)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def split_part_null(c: ColumnOrName, delim: str, n: int) -> Column:
    """split_part that is NULL (not '') when the part does not exist, as in Trino."""
    return blank_to_null(F.split_part(col(c), F.lit(delim), F.lit(n)))


def regexp_extract_null(c: ColumnOrName, pattern: str, idx: int) -> Column:
    """regexp_extract that is NULL when the pattern does not match (Spark gives '')."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


# ARN shapes: arn:partition:service:region:account:resource-id, .../type/id, .../type:id
ARN_ID_PATTERN = r"^arn:[^:]*:[^:]*:[^:]*:[^:]*:(?:[^/:]*[/:])?(.*)$"


def arn_prefix_removal(c: ColumnOrName) -> Column:
    """Resource id behind an ARN; non-ARN text passes through; NULL and '' are kept."""
    c = col(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c == "", F.lit(""))
        .when(~c.like("arn:%"), c)
        .otherwise(F.regexp_extract(c, ARN_ID_PATTERN, 1))
    )


def like_any(c: ColumnOrName, patterns) -> Column:
    c = col(c)
    out = None
    for p in patterns:
        e = c.like(p)
        out = e if out is None else (out | e)
    return out


def sum_when(cond: Column, value: ColumnOrName, otherwise=0) -> Column:
    """sum(case when cond then value else otherwise end)."""
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(otherwise)))


def dbl(c: ColumnOrName) -> Column:
    return col(c).cast("double")


def round_half_up(c: ColumnOrName, scale: int) -> Column:
    """Round a double HALF_UP on its 10-decimal representation (engine-independent at ties)."""
    return F.round(col(c).cast("decimal(38,10)"), scale).cast("double")


def round_dbl(c: ColumnOrName, scale: int) -> Column:
    """round() then double: aggregates are summed exactly (decimal inputs) and rounded last."""
    return F.round(col(c), scale).cast("double")
