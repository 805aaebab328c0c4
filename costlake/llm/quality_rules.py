"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

1. ``features`` counts words, symbols, repeated lines and repeated word windows of every whole text.
2. ``sketches`` turns each document's ratios into logarithmic buckets and counts documents by (language,
   source, ratio, bucket). The counts are the sketch: a quantile is known within the bucket's width
   (``GAMMA``), two sketches merge by adding counts, and the result does not depend on the order of rows.
   Counting is pre-aggregated in the map tasks, so a hot source costs no more than any other.
3. ``thresholds`` merges sketches upwards (source -> language -> corpus) and puts the upper fence of each
   ratio at ``median + REACH * max(spread, upper quartile - median)``; groups of fewer than ``min_docs``
   documents take the fence of their language, and small languages that of the corpus. Below the median
   the same holds for the mean word length. ``spread`` is the least spread that counts, so that a group of
   nearly equal documents does not reject on trifles.
4. ``judge`` joins each document to its group's fences and filters.

Besides, two base rules hold everywhere: fewer than 50 words, or over half of the words in 3-word windows
that occur twice, fail.

Null or empty texts have no words and fail the base rules. Null languages and sources are groups of their
own. Repeated rows count as often as they occur and get the same verdict. An empty table gives no rows.
Extra columns are ignored by the query and kept by ``filtered``; columns of any names may be there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.frames import added, arrow_map, stored, texts, with_new
from costlake.llm.text import BLANK, U, chunks, mix

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: Ratio -> (its expression over the features, the least spread that counts, whether it has a lower fence).
RATIOS = {
    "symbols": ("n_symbols / n_words", 0.05, False),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.1, False),
    "repeats": ("n_repeat_words / n_words", 0.075, False),
    "word_length": ("word_chars / n_words", 0.25, True),
    "upper": ("n_upper / greatest(word_chars, 1)", 0.05, False),
}
REACH = 6.0
GAMMA = 1.02
LEAST = 1e-3


def count_features(docs: list[bytes]) -> dict[str, np.ndarray]:
    """The features of some texts (UTF-8)."""
    out = {f: np.zeros(len(docs), np.int64) for f in FEATURES}
    for at, words in chunks(docs, False):
        n, raw, begins = len(words.docs), words.bytes, words.begins
        to = slice(at, at + n)
        first = words.first

        def per_doc(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[begins[1:]] - total[begins[:-1]]  # noqa: B023

        out["n_words"][to] = np.diff(first)
        out["word_chars"][to] = per_doc(((raw & 0xC0) != 0x80) & ~BLANK[raw])
        out["n_symbols"][to] = per_doc(SYMBOLS[raw])
        out["n_upper"][to] = per_doc(UPPER[raw])
        for i, doc in enumerate(words.docs):
            lines = [line for line in doc.split(b"\n") if line.strip()]
            out["n_lines"][at + i] = len(lines)
            out["n_dup_lines"][at + i] = len(lines) - len(set(lines))
        # 3-word windows, with the text's number mixed in, so that one sort serves all texts.
        grams = words.grams(3)
        if not len(grams):
            continue
        doc_of = np.repeat(np.arange(n), np.diff(first))
        inside = np.flatnonzero(doc_of[:-2] == doc_of[2:])
        with np.errstate(over="ignore"):
            own = mix(grams[inside] + (doc_of[inside].astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
        order = np.argsort(own)
        same = own[order][1:] == own[order][:-1]
        twice = np.zeros(len(own), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(doc_of), bool)
        hits = inside[twice]
        for j in range(3):
            covered[hits + j] = True
        out["n_repeat_words"][to] = np.bincount(doc_of[covered], minlength=n)
    return out


def _features(text_at: int, prefix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = count_features(texts(batch.column(text_at)))
            yield with_new(batch, [(prefix + f, pa.array(counted[f])) for f in FEATURES])

    return run


def with_features(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """The rows of docs with their texts' features behind them, named with ``prefix``."""
    schema = added(docs, ", ".join(f"{prefix}{f} long" for f in FEATURES))
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    return arrow_map(docs, _features(at, prefix), schema)


def sketches(features: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts by (lang, source, ratio, bucket): the mergeable sketches. Texts without words are left out."""
    each = [F.struct(F.lit(name).alias("ratio"), F.expr(expr).cast("double").alias("value"))
            for name, (expr, _, _) in RATIOS.items()]
    rows = features.where("n_words > 0").select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.explode(F.array(*each)).alias("r"))
    bucket = F.when(F.col("r.value") <= LEAST, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.log(F.col("r.value") / LEAST) / float(np.log(GAMMA))))).cast("int")
    return rows.groupBy("lang", "source", F.col("r.ratio").alias("ratio"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches added up to the coarser groups ``by``."""
    return sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: list[str], at: dict[str, float]) -> DataFrame:
    """One row for each group and ratio: docs, and a column for each quantile of ``at``."""
    # A window holds one group's buckets of one ratio: some hundred rows at most, whatever the group's size.
    group = Window.partitionBy(*by, "ratio")
    rows = sketch.withColumn("docs", F.sum("n").over(group)).withColumn(
        "up_to", F.sum("n").over(group.orderBy("bucket")))
    value = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(LEAST * F.pow(F.lit(GAMMA), F.col("bucket") - 0.5))
    found = [F.min(F.when(F.col("up_to") >= F.col("docs") * q, value)).alias(name) for name, q in at.items()]
    return rows.groupBy(*by, "ratio").agg(F.max("docs").alias("docs"), *found)


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """One row for each group: docs, and the fences of each ratio as <ratio>_max (and <ratio>_min)."""
    q = quantiles(sketch, by, {"low": 0.25, "mid": 0.5, "high": 0.75})
    columns: list[Column] = [F.max("docs").alias("docs")]
    for name, (_, spread, lower) in RATIOS.items():
        own = F.col("ratio") == name
        up = F.col("mid") + REACH * F.greatest(F.lit(spread), F.col("high") - F.col("mid"))
        columns.append(F.max(F.when(own, up)).alias(f"{name}_max"))
        if lower:
            down = F.col("mid") - REACH * F.greatest(F.lit(spread), F.col("mid") - F.col("low"))
            columns.append(F.max(F.when(own, down)).alias(f"{name}_min"))
    return q.groupBy(*by).agg(*columns)


FENCES = [f"{n}_max" for n in RATIOS] + [f"{n}_min" for n, r in RATIOS.items() if r[2]]


def thresholds(features: DataFrame, min_docs: int = 100, lang: str = "lang", source: str = "source") -> DataFrame:
    """A stored table: a row for each (lang, source) with its fences (see the module), named t_<name>."""
    fine = stored(sketches(features, lang, source), "sketches")
    by_source = fences(fine, ["lang", "source"])
    by_lang = fences(merged(fine, "lang"), ["lang"]).select(
        F.col("lang").alias("l_lang"), F.col("docs").alias("l_docs"), *[F.col(c).alias(f"l_{c}") for c in FENCES])
    corpus = fences(merged(fine), []).first()  # one row of a few numbers, none for an empty table
    rows = by_source.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    pick = [F.when(F.col("docs") >= min_docs, F.col(c)).when(F.col("l_docs") >= min_docs, F.col(f"l_{c}"))
            .otherwise(F.lit(corpus[c] if corpus else None)).alias(f"t_{c}") for c in FENCES]
    # Stored: its size is then known to the planner, which broadcasts it below the session's threshold.
    return stored(rows.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *pick), "fences")


def _base(prefix: str = "") -> Column:
    n, rep = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 50) | (100 * rep > 50 * n)


def _outside(prefix: str = "") -> Column:
    """Whether a ratio lies beyond its fences; documents that fail the base rules need none."""
    bad = F.lit(False)
    for name, (expr, _, lower) in RATIOS.items():
        for f in FEATURES:
            expr = expr.replace(f, f"`{prefix}{f}`") if prefix else expr
        # nullif: texts without words have no ratios
        value = F.expr(expr.replace(f"/ `{prefix}n_words`", f"/ nullif(`{prefix}n_words`, 0)") if prefix
                       else expr.replace("/ n_words", "/ nullif(n_words, 0)"))
        bad = bad | (value > F.col(f"t_{name}_max"))
        if lower:
            bad = bad | (value < F.col(f"t_{name}_min"))
    return F.coalesce(bad, F.lit(False))


def judge(features: DataFrame, fence: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """The rows with base_failed and kept (names with ``prefix``) behind them."""
    own = features.columns
    joined = features.join(fence, F.col(f"`{lang}`").eqNullSafe(F.col("t_lang")) & F.col(f"`{source}`").eqNullSafe(F.col("t_source")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in own], _base(prefix).alias(prefix + "base_failed"),
                         (~_base(prefix) & ~_outside(prefix)).alias(prefix + "kept"))


def verdicts(docs: DataFrame, min_docs: int = 100, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang",
             source: str = "source") -> DataFrame:
    """One row for each document: its features, base_failed and kept."""
    rows = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([id_col, lang, source, text_col])])
    counted = with_features(rows, text_col).drop(text_col)
    counted = stored(counted, "features")
    return judge(counted, thresholds(counted, min_docs, lang, source), lang, source)


def filtered(docs: DataFrame, min_docs: int = 100, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.col(f"`{text_col}`").alias("text"))
    fence = thresholds(with_features(rows).drop("text"), min_docs)
    prefix = "_q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    judged = judge(with_features(docs, text_col, prefix), fence, lang, source, prefix)
    return judged.where(F.col(prefix + "kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
