"""Extendible hashing of rows into shards below a byte limit, with DataFrame functions only.

The directory is indexed by the first bits of a key's hash. A bucket whose rows are larger than the limit
splits on the next bit; all others stay as they are. So the shard of a row is the shortest prefix of its
hash whose bucket fits, and a bucket is split as often as it has ancestors above the limit.

The bits come in rounds. A round adds up bytes by a prefix of some more bits (pre-aggregated in the map
tasks), adds these cells up to all shorter prefixes of the round, and counts each cell's ancestors above
the limit. Rows of cells that are still too large go to the next round, all others are done; so a
round reads only what is oversized. The first round has enough bits for all but unusual data.

Hash words: 60 bits of the MD5 of the key; behind them 60 bits of a hash of the whole row, and 60 of its
position. The second and third word part a hot key that no bit of the first can split: a key with a third
of all rows is spread over as many shards as it needs, and so are equal rows.

A single row above the limit is a shard of its own. A null key has the hash of an empty one. Null text
counts 0 bytes. Repeated rows are rows of their own. An empty table gives no rows. Extra columns of any
name are left out of the result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.frames import row_hash, stored

WORD = 60
WORDS = 3
MASK = (1 << WORD) - 1


def hash_words(df: DataFrame, key: str) -> list[Column]:
    """The words of a row's hash, 60 bits each."""
    digits = F.substring(F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 1, WORD // 4)
    return [F.conv(digits, 16, 10).cast("long"), row_hash(df).bitwiseAND(MASK),
            F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(MASK)]


def _prefix(depth: Column | int, word: int) -> Column:
    """The bits of a word that belong to a prefix of ``depth`` bits; 0 if none do."""
    h = F.col(f"h{word}")
    if isinstance(depth, int):
        bits = min(max(depth - word * WORD, 0), WORD)
        return F.shiftright(h, WORD - bits) if bits else F.lit(0).cast("long")
    bits = F.least(F.greatest(depth - word * WORD, F.lit(0)), F.lit(WORD))
    # shiftright takes a number of bits that differs by row only in SQL
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", h, (F.lit(WORD) - bits).cast("int")))


def _bits(depth: str = "depth") -> Column:
    """A prefix as a string of 0 and 1."""
    text = F.concat(*[F.lpad(F.bin(F.col(f"h{w}")), WORD, "0") for w in range(WORDS)])
    return F.call_function("substring", text, F.lit(1), F.col(depth).cast("int"))


def shards(df: DataFrame, limit: int, key: str = "doc_id", text_col: str = "text", first_bits: int | None = None) -> DataFrame:
    """One row for each row of df: key, n_bytes, shard (its prefix as 0s and 1s), depth, shard_bytes, shard_rows.

    ``limit``: bytes of text (UTF-8) that a shard may hold. ``first_bits``: bits of the first round, by
    default what the total size needs and four more.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")
    words = hash_words(df, key)
    rows = stored(df.select(F.col(f"`{key}`").alias("key"), size.alias("n_bytes"),
                            *[w.alias(f"h{i}") for i, w in enumerate(words)]), "hashes")
    if first_bits is None:
        total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        first_bits = min(30, 4 + max(0, math.ceil(math.log2(max(1, total) / limit))))
    done, active, low, high = [], rows, 0, first_bits
    own = [f"h{w}" for w in range(WORDS)]
    while True:
        # Cells: the prefixes of ``high`` bits. A cell keeps its bits at the top of the hash words.
        cell = [c.alias(h) for c, h in zip(_cell(high), own, strict=True)]
        cells = active.select(*cell, "n_bytes").groupBy(*own).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        spread = cells.withColumn("d", F.explode(F.sequence(F.lit(low), F.lit(high))))
        node = [_prefix(F.col("d"), w).alias(f"p{w}") for w in range(WORDS)]
        keys = ["d", *[f"p{w}" for w in range(WORDS)]]
        spread = spread.select(*own, "bytes", "rows", "d", *node)
        nodes = spread.groupBy(*keys).agg(F.sum("bytes").alias("node_bytes"), F.sum("rows").alias("node_rows"))
        over = (F.col("node_bytes") > limit) & (F.col("node_rows") > 1)
        # Ancestors above the limit come first, then the leaf: the largest bucket that fits.
        split = spread.select(*own, *keys).join(nodes, keys).groupBy(*own).agg(
            (F.sum(over.cast("int")) + low).alias("depth"),
            F.max(F.when(~over, F.col("node_bytes"))).alias("shard_bytes"),
            F.max(F.when(~over, F.col("node_rows"))).alias("shard_rows"))
        split = stored(split.select(*[F.col(h).alias(f"c{h}") for h in own], "depth", "shard_bytes", "shard_rows"), "cells")
        at = reduce(lambda a, b: a & b, [c == F.col(f"ch{w}") for w, c in enumerate(_cell(high))])
        placed = active.join(split, at).select("key", "n_bytes", *own, "depth", "shard_bytes", "shard_rows")
        last = high >= WORD * WORDS
        done.append(placed if last else placed.where(F.col("depth") <= high))
        if last or split.where(F.col("depth") > high).limit(1).count() == 0:
            break
        active = stored(placed.where(F.col("depth") > high).select("key", "n_bytes", *own), "oversized")
        low, high = high + 1, min(high + 8, WORD * WORDS)
    return reduce(DataFrame.unionAll, done).select(
        F.col("key").alias(key), "n_bytes", _bits().alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_rows")


def _cell(high: int) -> list[Column]:
    return [F.call_function("shiftleft", _prefix(high, w), F.lit(WORD - min(max(high - w * WORD, 0), WORD))) for w in range(WORDS)]


def directory(placed: DataFrame) -> DataFrame:
    """The directory of ``shards``: one entry for each shard, its prefix, local depth, bytes and rows.

    An index of ``max(depth)`` bits (the global depth) points to the one shard whose prefix it begins with.
    """
    return placed.groupBy("shard", "depth").agg(F.max("shard_bytes").alias("shard_bytes"), F.max("shard_rows").alias("shard_rows"))
