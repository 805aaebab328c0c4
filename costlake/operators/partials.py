"""Partial aggregates that can be stored and merged: sums, extremes, counts, and distinct-count and quantile sketches.

A measure has three forms: ``partial`` adds up facts, ``merge`` adds up stored partial values (of batches, days or finer
keys), ``final`` reads the result. Sums of DECIMAL are exact in any order. Distinct counts are HyperLogLog sketches and
quantiles are KLL sketches, both as binary columns; a merge of parts has the error that one sketch of all rows has:

* distinct counts: relative standard error 1.04 / sqrt(2 ** lg_k), 0.8 % at the default of 14; sets of some
  hundred values are counted exactly but for rare hash collisions;
* quantiles: a returned value's rank is off by ``rank_error(k)`` of the rows at most, with 99 % confidence, 0.45 %
  at the default k of 1000; groups of up to k rows are exact (the value at rank ceil(p * n)).

A table of partials is as small as its keys: what is merged upwards reads no facts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
QUANTILE_K = 1000


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / (1 << lg_k) ** 0.5


def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of a quantile, 99 % confidence (the sketch library's published fit)."""
    return 2.296 / k ** 0.9021


@dataclass(frozen=True)
class Measure:
    name: str
    partial: Column
    merge: Column
    final: Column


def total(name: str, value: str | Column) -> Measure:
    c = F.col(name)
    return Measure(name, F.sum(value).alias(name), F.sum(c).alias(name), c)


def lines(name: str = "line_count") -> Measure:
    return Measure(name, F.count(F.lit(1)).alias(name), F.sum(name).alias(name), F.col(name))


def largest(name: str, value: str | Column) -> Measure:
    return Measure(name, F.max(value).alias(name), F.max(name).alias(name), F.col(name))


def smallest(name: str, value: str | Column) -> Measure:
    return Measure(name, F.min(value).alias(name), F.min(name).alias(name), F.col(name))


def distinct(name: str, value: str | Column, lg_k: int = LG_K) -> Measure:
    """Distinct values but NULL; 0 where there are none."""
    c = F.col(name)
    return Measure(name, F.hll_sketch_agg(value, lg_k).alias(name), F.hll_union_agg(c).alias(name),
                   F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).cast("long").alias(name))


def quantiles(name: str, value: str | Column, k: int = QUANTILE_K) -> Measure:
    """A sketch of the values but NULL; ``quantile`` reads it."""
    v = F.col(value) if isinstance(value, str) else value
    return Measure(name, F.kll_sketch_agg_double(v.cast("double"), k).alias(name), F.kll_merge_agg_double(F.col(name), k).alias(name), F.col(name))


def quantile(sketch: str | Column, p: float) -> Column:
    """The value at rank ceil(p * n) of a KLL sketch; NULL if it has seen no value."""
    c = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(p)))


@dataclass(frozen=True)
class Partials:
    """Measures by keys, as partials of some facts, merged partials and final values."""

    keys: list[str]
    measures: list[Measure]

    def of(self, facts: DataFrame, *more: str) -> DataFrame:
        """One row per key (and ``more`` columns) of the facts."""
        return facts.groupBy(*self.keys, *more).agg(*[m.partial for m in self.measures])

    def merged(self, partials: DataFrame, keys: list[str] | None = None) -> DataFrame:
        """Partials added up by ``keys``: all of them, or fewer for a coarser grain."""
        return partials.groupBy(*(self.keys if keys is None else keys)).agg(*[m.merge for m in self.measures])

    def final(self, merged: DataFrame) -> DataFrame:
        names = {m.name for m in self.measures}
        return merged.select(*[c for c in merged.columns if c not in names], *[m.final.alias(m.name) for m in self.measures])
