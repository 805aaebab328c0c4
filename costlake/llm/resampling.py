"""Target-distribution importance resampling: hashed n-gram counts, gains of buckets, a weighted draw without replacement.

A text is lower-cased in A-Z, everything but letters, digits and non-ASCII characters separates words, and runs of
separators become single spaces. Overlapped regex scanning then gives the features: for each length from 1 to ``n``
one ``finditer(..., overlapped=True)`` with lookarounds for word boundaries emits the spans of all runs of so many
words, and the CRC of each span's bytes is its bucket. Counts of all documents and of all target texts give each
bucket a gain, the floored logarithm of the two smoothed shares' quotient; a document's weight is the floored mean of
its features' gains. Gumbel noise from a hash of seed and id turns the highest scores into a draw without replacement.

Results in special cases: null and empty texts have no features and weight 0; a text below ``least_words`` words
has a score but is not drawn. Repeated rows are rows of their own (with equal scores), null ids hash as an empty id
and come last among equal scores. Ties go to the smaller id. An empty table gives no rows, an empty target
only smoothing counts. Texts of any length are scanned in one pass; a text takes memory in proportion to
its length. Other columns, also of clashing names, are not read.

At scale: texts are scanned once, and their buckets (two bytes each) are written as a table to the shared folder; the
counts and the weights are numpy passes over it, without a shuffle but for one counter for each bucket and task. The
driver gets one row for each bucket, whose number is a parameter. Ranks are numbered in ranges of the order, with
a prefix sum over the ranges' row counts; a salt behind the id parts rows that are all equal.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map, partitions, stored, texts

#: What stands for each byte: letters lower-cased, digits and bytes of non-ASCII characters as they are, else a space.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SEPARATORS = regex.compile(rb" +")


def patterns(n: int) -> list[regex.Pattern]:
    """For each length from 1 to n, what finds a run of so many words with nothing but spaces around it."""
    return [regex.compile(rb"(?<![^ ])" + rb" ".join([rb"[^ ]+"] * k) + rb"(?![^ ])") for k in range(1, n + 1)]


def collapsed(text: bytes) -> bytes:
    """The text's words with single spaces between them."""
    return SEPARATORS.sub(b" ", text.translate(FOLD)).strip(b" ")


def _scan(n: int, buckets: int):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, crc = patterns(n), zlib.crc32
        for batch in batches:
            words, count, found = [], [], []
            for text in texts(batch.column(1)):
                text = collapsed(text)
                words.append(text.count(b" ") + 1 if text else 0)
                codes = [crc(m[0]) for r in runs for m in r.finditer(text, overlapped=True)]
                count.append(len(codes))
                found.append((np.array(codes, np.uint32) % np.uint32(buckets)).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(count, pa.int64()), pa.array(found, pa.binary())],
                names=["id", "n_words", "n_features", "buckets"])

    return run


def features(df: DataFrame, n: int = 2, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of df: id, n_words, n_features, buckets (two bytes each, four if there are over 65,536).

    Written to the shared folder, so that the passes over it scan no text again.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return stored(arrow_map(rows, _scan(n, buckets), f"id {kind}, n_words long, n_features long, buckets binary"), "features")


def _codes(column: pa.Array, buckets: int) -> np.ndarray:
    """All buckets of a column of ``features``, one text's after the other's."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16 if buckets <= 1 << 16 else np.uint32)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, since numpy works with eight bytes for each of their features."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in _slices(batches):
            total += np.bincount(_codes(batch.column(0), buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])

    return run


def counts(found: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """Features in each bucket over all rows of ``features``: an array of ``buckets`` numbers."""
    each = arrow_map(found.select("buckets"), _count(buckets), "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        total[row.bucket] = row.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share of the target over that of the corpus."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, key: str) -> int:
    """floor(-1000 * ln(-ln u)) for a number u between 0 and 1 that seed and id determine."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(gain: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            n = batch.column(2).to_numpy()
            ends = np.concatenate([[0], np.cumsum(gain[_codes(batch.column(3), len(gain))])])
            at = np.concatenate([[0], np.cumsum(n)])
            weight = (ends[at[1:]] - ends[at[:-1]]) // np.maximum(n, 1)
            score = weight + np.fromiter((noise(seed, k or "") for k in batch.column(4).to_pylist()), np.int64, len(n))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight), pa.array(score)],
                                             names=["id", "n_words", "n_features", "weight", "score"])

    return run


def scored(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id",
           text_col: str = "text", target_id: str = "item_id", target_text: str = "text") -> DataFrame:
    """A row for each row of docs: id, n_words, n_features, weight, score."""
    found = features(docs, n, buckets, id_col, text_col)
    gain = gains(counts(found, buckets), counts(features(target, n, buckets, target_id, target_text), buckets))
    kind = found.schema["id"].dataType.simpleString()
    return arrow_map(found.withColumn("key", F.col("id").cast("string")), _weigh(gain, seed),
                     f"id {kind}, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, n: int = 2, buckets: int = 10_000,
              seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id",
              target_text: str = "text") -> DataFrame:
    """A row for each row of docs: id, n_features, weight, score, rank.

    Of the N rows with ``least_words`` words or more, the floor(percent * N / 100) highest scores are drawn;
    rank is their place in that order, null for all others.
    """
    rows = scored(docs, target, n, buckets, seed, id_col, text_col, target_id, target_text)
    rows = rows.withColumn("may", F.col("n_words") >= least_words).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("id"), F.asc("salt")]
    ranged = rows.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order).drop("salt")
    numbered = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "ranges")
    # the numbers hold the range in their upper bits, and the place in it in the lower 33
    numbered = numbered.withColumn("range", F.shiftright("at", 33))
    sizes = numbered.groupBy("range").agg(F.count("*").alias("rows"), F.count_if("may").alias("may_be"))
    drawn = percent * (sizes.agg(F.coalesce(F.sum("may_be"), F.lit(0))).first()[0]) // 100
    before = sizes.select("range", (F.sum("rows").over(Window.orderBy("range")) - F.col("rows")).alias("before"))
    # one row for each range: as many as shuffle partitions
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return numbered.join(F.broadcast(before), "range").select(
        F.col("id").alias(id_col), "n_features", "weight", "score",
        F.when(F.col("may") & (place <= drawn), place).cast("long").alias("rank"))


def selected(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of docs, with all their columns, whose id is drawn by ``resampled``."""
    ids = resampled(docs, target, id_col=id_col, **how).where(F.col("rank").isNotNull()).select(id_col)
    return docs.join(ids, id_col, "left_semi")
