"""Tag-map operators: key discovery, flattening to columns, per-key cost rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_keys(df: DataFrame, tags_col: str = "resource_tags") -> DataFrame:
    """Distinct non-blank keys of the tag map (distributed partial+final aggregate)."""
    m = F.col(tags_col)
    return (df.where(m.isNotNull() & (F.size(m) > 0))
            .select(F.explode(F.map_keys(m)).alias("tag_key"))
            .where(F.col("tag_key").isNotNull() & (F.col("tag_key") != ""))
            .distinct())


def discover_tag_keys(df: DataFrame, tags_col: str = "resource_tags") -> list[str]:
    """All tag keys as a sorted Python list, for models with one column per key. Only the distinct keys
    (column names of the result, not rows) reach the driver; a caller narrows by giving keys itself."""
    return sorted(r["tag_key"] for r in tag_keys(df, tags_col).collect())


def flatten_tags(df: DataFrame, keys: list[str], tags_col: str = "resource_tags",
                 prefix: str = "resource_tags_") -> DataFrame:
    return df.select("*", *[F.element_at(F.col(tags_col), F.lit(k)).alias(f"{prefix}{k}") for k in keys])


def tag_set(tags_col: str = "resource_tags") -> Column:
    """The tag map as sorted entries without blank keys: unlike a map it can be grouped by, equal tags are one group."""
    tags = F.col(tags_col)
    # a lambda runs interpreted: only maps that do have a blank key are filtered. Keys differ, so entries are sorted by them
    named = F.when(F.array_contains(F.map_keys(tags), ""), F.map_filter(tags, lambda k, v: k != "")).otherwise(tags)
    empty = F.array().cast("array<struct<key:string,value:string>>")
    return F.coalesce(F.sort_array(F.map_entries(named)), empty)


def keys_of(df: DataFrame, set_col: str) -> Column:
    """All keys of a column of tag sets, sorted, as a scalar subquery: it runs with the query, not when the plan is built.

    One array as long as there are tag keys, which name the result's rows or columns.
    """
    found = df.select(F.explode(set_col).alias("_tag")).select(F.col("_tag.key").alias("_key")).distinct()
    return found.agg(F.array_sort(F.collect_set("_key"))).scalar()


def explode_tag_keys(df: DataFrame, set_col: str, keys: list[str] | None = None, lines: DataFrame | None = None) -> DataFrame:
    """One row per (row, key) with the key's value in the row's tag set (NULL = untagged); a generator, not a join.

    ``keys``: given ones, else all keys that any row has. ``lines``: what ``df`` adds up by tag set; its keys are the
    same, and found there without a shuffle of anything but keys.
    """
    every = keys_of(df if lines is None else lines, set_col) if keys is None else F.array(*[F.lit(k) for k in keys])
    # the map is made once for each row, before the generator
    rows = df.withColumn("_map", F.map_from_entries(set_col)).select("*", F.explode(every).alias("tag_key"))
    return rows.withColumn("tag_value", F.element_at("_map", F.col("tag_key"))).drop(set_col, "_map")
