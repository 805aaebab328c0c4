"""Homomorphic multiset hash of a text's paragraphs, with DataFrame functions only.

A text is a multiset of paragraphs (lines), a paragraph a multiset of pieces: at most eight words, ending
with a sentence. Each has a wide vector of hash bits; a text's fingerprint is the sum of the vectors, lane
by lane modulo a power of two:

* 8 lanes of 32 bits, sums of hashes of whole paragraphs modulo 2**32. They tell texts apart: equal
  multisets have equal sums, others differ but for a chance of 2**-128 a pair.
* 256 lanes of 32 bits, sums of single hash bits of the pieces, and the number of pieces. From them the
  likeness of two texts is estimated. A text has fewer than 2**31 bytes, so no lane wraps.

Sums do not depend on order, and inserting or deleting a paragraph adds or subtracts its vector
(``combine``), so a fingerprint follows edits without the text.

Likeness. With bits as +1 and -1, the products of two texts' lanes have as mean the number of equal pairs
of pieces; ``2 ab / (aa + bb)`` of these estimates is 1 for equal and about 0 for unrelated texts; 256 lanes
give a standard error of about 0.08. It is cut to 0..1. Two texts without pieces have likeness 1, one
without and one with 0.

The next document: rows lie in buckets of ascending ids (equal width between the least and the greatest
id; at most some hundreds for each shuffle partition), a window in each bucket finds the next row, and the
buckets' first rows, one for each bucket, are the next ones of the last rows. No window holds more than a bucket. One
shuffle moves the texts; the sums go by the same key and need none.

Null text is empty. Null ids come first; ties (repeated ids) go by text. With a single row the next row is
the row itself. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.frames import partitions, stored

LANES = 256
HASHES = LANES // 64
#: One bit in each of a long's four 16-bit fields, in which the bits of a block are added.
FIELDS = 0x0001000100010001
#: The first and third of these fields.
HALVES = 0x0000FFFF0000FFFF
#: One bit in each of a long's two lanes.
ONES = 0x0000000100000001
#: Pieces whose bits are added within one long: no field can reach its neighbour.
BLOCK = 1 << 14
#: Up to seven words that do not end a sentence, then one of any kind; within a line.
PIECE = r"(?:\S*[^\s.!?][^\S\n]+){0,7}\S+"
LOW32 = 0xFFFFFFFF


def _packed(piece: Column) -> list[Column]:
    """The pieces' bits as sums over a block's rows: LANES / 4 longs with four fields each."""
    out, h = [], F.xxhash64(piece)
    for k in range(HASHES):
        if k:
            h = F.xxhash64(h, F.lit(k))
        for shift in range(16):
            out.append(F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(FIELDS)))
    return out


def _paragraph_lanes(text: Column) -> list[Column]:
    """Eight sums of 32-bit hashes over the lines of a text, modulo 2**32."""
    lines, modulus = F.split(text, "\n"), F.lit(LOW32).cast("long")

    def hashes(k: int) -> Column:
        return F.transform(lines, lambda line: F.xxhash64(line, F.lit(k)))

    def lane(k: int, shift: int) -> Column:
        return F.aggregate(hashes(k), F.lit(0).cast("long"), lambda total, h: (
            total + F.shiftrightunsigned(h, shift).bitwiseAND(modulus)).bitwiseAND(modulus))

    return [lane(k, shift) for k in range(4) for shift in (0, 32)]


def sums(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row for each row of ``rows`` (``keys`` must tell them apart): keys, paragraph lanes ``p`` (array of
    8 longs), ``n`` pieces and ``packed`` (array of 128 longs, two lanes each). If rows are dealt out by some
    of the keys, this needs no shuffle."""
    # The paragraph lanes first: behind the generator they would be made anew for each piece.
    whole = rows.select(*keys, F.array(*_paragraph_lanes(F.col(text))).alias("p"), F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0)).alias("pieces"))
    marked = whole.select(*keys, "p", F.posexplode_outer("pieces").alias("pos", "piece"))
    block = F.coalesce(F.floor(F.col("pos") / BLOCK), F.lit(0)).cast("int")
    names = [f"s{i}" for i in range(LANES // 4)]
    by_block = marked.groupBy(*keys, "p", block.alias("block")).agg(
        F.count("piece").alias("n"), *[c.alias(name) for name, c in zip(names, _packed(F.col("piece")), strict=True)])
    # The blocks of a text: one, but for texts of over 16,384 pieces.
    blocks = by_block.select(*keys, "p", "n", F.array(*[F.coalesce(F.col(s), F.lit(0).cast("long")) for s in names]).alias("packed"))
    together = blocks.groupBy(*keys, "p").agg(F.sum("n").alias("n"), F.collect_list("packed").alias("all"))
    return together.select(*keys, "p", "n", F.when(F.size("all") == 1, _wide(F.col("all")[0])).otherwise(
        F.aggregate("all", F.array_repeat(F.lit(0).cast("long"), LANES // 2), lambda a, b: F.zip_with(a, _wide(b), _add))).alias("packed"))


def _wide(fields: Column) -> Column:
    """A block's longs of four 16-bit fields as longs of two 32-bit lanes: first and third fields, then the others."""
    return F.concat(F.transform(fields, lambda x: x.bitwiseAND(HALVES)),
                    F.transform(fields, lambda x: F.shiftrightunsigned(x, 16).bitwiseAND(HALVES)))


def _add(a: Column, b: Column) -> Column:
    """Two 32-bit lanes each, added modulo 2**32: apart, so that no carry gets over."""
    low = (a.bitwiseAND(LOW32) + b.bitwiseAND(LOW32)).bitwiseAND(LOW32)
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32)
    return low.bitwiseOR(F.shiftleft(high, 32))


def encoded(p: Column, n: Column, packed: Column) -> Column:
    """A fingerprint as a string (base64 of all lanes)."""
    parts = [F.transform(p, lambda x: F.lpad(F.hex(x), 8, "0")), F.array(F.lpad(F.hex(n), 8, "0")),
             F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0"))]
    return F.translate(F.base64(F.unhex(F.array_join(F.concat(*parts), ""))), "\r\n", "")


def combine(p: Column, n: Column, packed: Column, q: Column, m: Column, other: Column, sign: int = 1) -> tuple[Column, Column, Column]:
    """The lanes after inserting (sign 1) or deleting (-1) a part with lanes q, m, other."""
    modulus = F.lit(LOW32).cast("long")
    if sign < 0:
        q, m = F.transform(q, lambda x: (LOW32 + 1 - x).bitwiseAND(modulus)), -m
        # Two's complement of each lane: all bits flipped, plus one.
        other = F.transform(other, lambda x: _add(F.bitwise_not(x), F.lit(ONES)))
    return F.zip_with(p, q, lambda a, b: (a + b).bitwiseAND(modulus)), n + m, F.zip_with(packed, other, _add)


def _lanes(n: Column, packed: Column) -> Column:
    """The lanes as sums of +1 and -1."""
    return F.concat(F.transform(packed, lambda x: 2 * x.bitwiseAND(LOW32) - n), F.transform(packed, lambda x: 2 * F.shiftrightunsigned(x, 32) - n))


def _product(a: Column, b: Column) -> Column:
    # As doubles: sums of squares of long texts' lanes may pass 2**63.
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda t, x: t + x)


def likeness(n: Column, a: Column, aa: Column, m: Column, b: Column, bb: Column) -> Column:
    """From the numbers of pieces, the +1/-1 lanes and their own products."""
    value = F.least(F.greatest(2 * _product(a, b) / F.nullif(aa + bb, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.when((n == 0) & (m == 0), F.lit(1.0)).when((n == 0) | (m == 0), F.lit(0.0)).otherwise(F.coalesce(value, F.lit(0.0)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (string) and lanes (p, n, packed) of each row's whole text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"),
                       F.monotonically_increasing_id().alias("row"))
    out = sums(rows, ["id", "row"], "t")
    return out.select(F.col("id").alias(id_col), encoded(F.col("p"), F.col("n"), F.col("packed")).alias("fingerprint"), "p", "n", "packed")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_partition: int = 8) -> DataFrame:
    """Each text's fingerprint beside that of its edited text and its likeness to it and to the next text.

    The edited text has its last floor(n / 4) code points replaced by the first as many (or all) of the next
    one. Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    buckets = per_partition * partitions(docs)
    width = 1 if low is None else max(1, -(-(high - low + 1) // buckets))
    bucket = F.coalesce(F.floor((F.col("id") - F.lit(low)) / width), F.lit(-1)).cast("long") if low is not None else F.lit(-1).cast("long")
    rows = rows.withColumn("bucket", bucket)

    # The first row of each bucket: the one behind the last row of the bucket before. At most ``buckets`` + 1 rows.
    least = stored(rows.groupBy("bucket").agg(F.min("id").alias("first_id")), "first-ids")
    firsts = rows.join(least.select(F.col("bucket").alias("b"), "first_id"),
                       (F.col("bucket") == F.col("b")) & F.col("id").eqNullSafe(F.col("first_id")), "left_semi")
    firsts = firsts.groupBy("bucket").agg(F.min("t").alias("first"))
    around = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = firsts.withColumn("behind", F.coalesce(F.lead("first").over(Window.orderBy("bucket")), F.first("first").over(around)))
    behind = stored(behind.select(F.col("bucket").alias("b"), "behind"), "behind")

    within = Window.partitionBy("bucket").orderBy(F.col("id").asc_nulls_first(), "t")
    rows = rows.repartition(partitions(docs), "bucket").withColumn("row", F.row_number().over(within)).withColumn("lead", F.lead("t").over(within))
    rows = rows.join(behind, F.col("bucket") == F.col("b"), "left")
    last = F.col("lead").isNull()
    n = F.length("t")
    cut = F.floor(n / 4).cast("int")
    after = F.coalesce("lead", "behind")
    rows = rows.select("bucket", "row", "id", "t", n.cast("long").alias("n_chars"), F.when(last, F.col("behind")).alias("beyond"),
                       F.concat(F.call_function("left", F.col("t"), n - cut), F.call_function("left", after, cut)).alias("e"))
    sides = [F.struct(F.lit(0).alias("side"), F.col("t").alias("text")), F.struct(F.lit(1).alias("side"), F.col("e").alias("text"))]
    beyond = F.struct(F.lit(2).alias("side"), F.col("beyond").alias("text"))
    keys = ["bucket", "row", "id", "n_chars", "sha", "side"]
    each = rows.select("bucket", "row", "id", "n_chars", F.sha2(F.col("e").cast("binary"), 256).alias("sha"), F.explode(
        F.when(F.col("beyond").isNull(), F.array(*sides)).otherwise(F.array(*sides, beyond))).alias("s"))
    each = each.select("bucket", "row", "id", "n_chars", "sha", F.col("s.side").alias("side"), F.col("s.text").alias("text"))
    own = sums(each, keys, "text")
    own = own.withColumn("lanes", _lanes(F.col("n"), F.col("packed"))).withColumn("norm", _product(F.col("lanes"), F.col("lanes")))
    fp = encoded(F.col("p"), F.col("n"), F.col("packed"))
    whole = own.groupBy("bucket", "row", "id", "n_chars", "sha").agg(*[
        F.max(F.when(F.col("side") == i, F.struct("n", "norm", "lanes", *([fp.alias("fp")] if i < 2 else [])))).alias(name)
        for i, name in enumerate(("o", "e", "x"))])
    order = Window.partitionBy("bucket").orderBy("row")
    whole = whole.withColumn("next", F.coalesce(F.lead(F.struct("o.n", "o.norm", "o.lanes")).over(order), F.col("x")))

    def near(b: str) -> Column:
        return likeness(F.col("o.n"), F.col("o.lanes"), F.col("o.norm"), F.col(f"{b}.n"), F.col(f"{b}.lanes"), F.col(f"{b}.norm"))

    return whole.select(F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), F.col("o.fp").alias("fingerprint"),
                        F.col("e.fp").alias("edited_fingerprint"), near("e").alias("near_edited"), near("next").alias("near_next"))
