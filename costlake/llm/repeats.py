"""Repeated substrings of a corpus by prefix-free parsing.

A byte of a text is removed if a string of ``LENGTH`` bytes covers it that also starts earlier in the corpus
(a smaller id, or the same text and an earlier start).

Parsing. The hash of the eight bytes at each position rolls over the text; a position triggers if it has the
least hash of ``GAP`` successive ones. Triggers cut the text into phrases of at most ``GAP`` bytes. A window
of ``LENGTH`` bytes belongs to the first position of least hash among its first ``GAP``, so equal windows
belong to triggers at the same distance: each is the suffix of a phrase followed by what the parse goes on
with, and no window is a prefix of another.

Dictionary. A trigger's entry is all bytes of its windows: the end of the phrase before and the parse
behind, up to the window's length. Equal entries are one dictionary word; repetitive text collapses here, as
all occurrences but the first of a word are marked at once, without a look at their bytes. Words are
grouped by the bytes that all windows of a trigger share; a word alone in its group has nothing repeated.

Corpus order. The words of a group that are left are put in the order of their parse suffixes (the bytes
from the trigger on), with the lengths of common prefixes: the suffix array of the parse, as deep as windows
reach. For each distance, runs of that order with a long enough common prefix, split by the phrase suffixes
before the trigger, are the sets of equal windows; all but the first in corpus order are marked.

Jobs: (1) parse, dealt out by group key, sorted and streamed; (2) the bytes of the words that are left, by a
join on the id; (3) their order, group by group; (4) marks joined to the texts. A group of more than
``LARGE`` words (the edge of a passage that very many texts share) is not held in one task: its windows are
spread by their own hashes, pre-aggregated to the first start, and compared with that.

Nulls are empty texts; texts shorter than ``LENGTH`` lose nothing. Order: null ids first, then ids; rows of
one id by a hash of their text; repeated rows (same id and text) count once and get the same result. An
empty table gives no rows. Extra columns are kept by ``deduplicated`` and ignored by ``removed``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map, free_name, partitions, stored, texts
from costlake.llm.text import BASE, U, mix, powers, randoms

LENGTH = 100
GAP = 63  # at most 63: the marks of a trigger's windows are the bits of a long
SHARED = LENGTH + 1 - GAP  # bytes behind a trigger that all its windows hold
SLICE = 1 << 21
LARGE = 100_000
_VALUES = randoms(256, 3)
_TRIGGER = U(0x9FB21C651E98DF25)
_inverse = np.ones(1, U)


def inverse_powers(n: int) -> np.ndarray:
    """BASE**0, BASE**-1 ... modulo 2**64."""
    global _inverse
    step = U(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        while len(_inverse) < n:
            _inverse = np.concatenate([_inverse, _inverse * (_inverse[-1] * step)])
    return _inverse[:n]


class Hashes:
    """Hashes of substrings of some bytes."""

    def __init__(self, raw: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(raw) + 1, U)
            np.cumsum(_VALUES[raw] * powers(len(raw)), out=self.sums[1:])
        self.inverse = inverse_powers(len(raw) + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[begin]) * self.inverse[begin] + (end - begin).astype(U))


def owners(raw: np.ndarray) -> np.ndarray:
    """For each position with GAP positions of eight bytes from it on: the first of least hash among them."""
    n = len(raw) - 7
    if n < GAP:
        return np.zeros(0, np.int64)
    eight = np.lib.stride_tricks.as_strided(raw.view(np.uint8), (n, 8), (1, 1))
    eight = np.ascontiguousarray(eight).view(U).ravel()
    with np.errstate(over="ignore"):
        value = (eight ^ (eight >> U(29))) * _TRIGGER
    value = (value & ~U(0xFFFFFFFF)) | np.arange(n, dtype=U)  # the hash's upper half, then the position
    blocks = -(-n // GAP)
    padded = np.full(blocks * GAP, ~U(0))
    padded[:n] = value
    padded = padded.reshape(blocks, GAP)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - GAP + 1], ahead[GAP - 1:n])
    return (least & U(0xFFFFFFFF)).astype(np.int64)


def slices(docs: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray]]:
    """Texts in groups of about SLICE bytes; longer ones in overlapping slices. Yields the texts' numbers, their
    slices' first bytes, the joined bytes and where each slice begins in them (and the end)."""
    number, first, parts, size = [], [], [], 0
    for i, doc in enumerate(docs):
        if len(doc) < LENGTH:
            continue
        for at in range(0, len(doc) - LENGTH + 1, SLICE):
            part = doc[at:at + SLICE + LENGTH - 1]
            if parts and size + len(part) > SLICE:
                yield number, first, b"".join(parts), np.cumsum([0, *map(len, parts)])
                number, first, parts, size = [], [], [], 0
            number.append(i)
            first.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield number, first, b"".join(parts), np.cumsum([0, *map(len, parts)])


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each trigger: its group, the hash of its dictionary word, id and place.

    place: the position, and the greatest and least distance to it of a window's start, in 6 bits each. Of a
    word that occurs several times in one group of texts only the first occurrence goes on under its group; the
    others are repeats already, come with a place below zero (-1 - place) and are spread, so that a very common
    line doesn't make a hot key.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for number, first, joined, begin in slices(texts(batch.column(1))):
            raw = np.frombuffer(joined, np.uint8)
            owner = owners(raw)
            # Starts of windows that lie within their slice.
            ends = np.repeat(begin[1:], np.diff(begin))
            starts = np.flatnonzero(np.arange(len(raw)) + LENGTH <= ends)
            own = owner[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)
            low = starts[new]
            high = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]
            at = own[new]
            hashes = Hashes(raw)
            group = hashes.of(at, at + SHARED)
            with np.errstate(over="ignore"):
                word = mix(hashes.of(low, high + LENGTH) + ((at - low) * 64 + (at - high)).astype(U) * U(0x9E3779B97F4A7C15))
            part = np.searchsorted(begin, low, side="right") - 1
            place = ((at - begin[part] + np.array(first)[part]) << 12) | ((at - low) << 6) | (at - high)
            ident = ids[np.array(number)[part]]
            order = np.lexsort((place, ident, word))
            again = order[1:][word[order[1:]] == word[order[:-1]]]
            with np.errstate(over="ignore"):
                group[again] = mix(ident[again].view(U) * U(0x9E3779B97F4A7C15) + place[again].view(U))
            place[again] = -1 - place[again]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group.view(np.int64)), pa.array(word.view(np.int64)), pa.array(ident, pa.int64()), pa.array(place)],
                names=["g", "w", "id", "place"])


def dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (g, w, id, place): later occurrences of a word (again), and the first ones of
    words that share their group with others."""
    held = None  # of the group that the rows so far end with: g, its last word, and its first row if that word is alone
    for batch in batches:
        g, w, ident, place = (batch.column(i).to_numpy() for i in range(4))
        known = place < 0
        if known.any():
            yield pa.RecordBatch.from_arrays([pa.array(g[known]), pa.array(ident[known]), pa.array(-1 - place[known]), pa.array(np.ones(known.sum(), bool))],
                                             names=["g", "id", "place", "again"])
            g, w, ident, place = g[~known], w[~known], ident[~known], place[~known]
        n = len(g)
        if not n:
            continue
        new_g, new_w = np.ones(n, bool), np.ones(n, bool)
        new_g[1:] = g[1:] != g[:-1]
        new_w[1:] = new_g[1:] | (w[1:] != w[:-1])
        if held:
            new_g[0] = g[0] != held[0]
            new_w[0] = new_g[0] or w[0] != held[1]
        begin = np.flatnonzero(new_g)
        # Words that begin in this batch, by stretches of one group; the stretch before the first new group goes
        # on with the held group.
        stretch = np.cumsum(new_g)
        words = np.bincount(stretch, weights=new_w, minlength=len(begin) + 1).astype(np.int64)
        several = words > 1
        late = None
        if held and words[0]:
            several[0] = True  # the held group has another word now
            late = held[2]
        first = new_w & several[stretch]
        again = ~new_w
        # The last group may go on: if it has one word so far, its first row waits.
        if len(begin):
            k = int(begin[-1])
            alone = (int(g[k]), int(ident[k]), int(place[k])) if words[-1] == 1 else None
            held = (int(g[-1]), int(w[-1]), alone)
        else:
            held = (held[0], int(w[-1]), None if words[0] else held[2])
        out = first | again
        gs, ids, places, agains = g[out], ident[out], place[out], again[out]
        if late:
            gs, ids = np.concatenate([[late[0]], gs]), np.concatenate([[late[1]], ids])
            places, agains = np.concatenate([[late[2]], places]), np.concatenate([[False], agains])
        if len(gs):
            yield pa.RecordBatch.from_arrays([pa.array(gs), pa.array(ids), pa.array(places), pa.array(agains)],
                                             names=["g", "id", "place", "again"])


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a text with its words' groups and places: a row for each with the bytes before and behind the trigger."""
    for batch in batches:
        g, ids, places, before, behind = [], [], [], [], []
        for ident, doc, words in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            for word in words:
                place = word["place"]
                at, most = place >> 12, place >> 6 & 63
                g.append(word["g"])
                ids.append(ident)
                places.append(place)
                before.append(doc[at - most:at][::-1])
                behind.append(doc[at:at + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(ids, pa.int64()), pa.array(places, pa.int64()),
                                          pa.array(before, pa.binary()), pa.array(behind, pa.binary())],
                                         names=["g", "id", "place", "before", "behind"])


def _matrix(values: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(len(values), width)


def equal_windows(g: np.ndarray, ids: np.ndarray, place: np.ndarray, before: list[bytes], behind: list[bytes]) -> np.ndarray:
    """For each word of some whole groups, a bit for each distance at which its window occurs in an earlier word."""
    n = len(g)
    right, left = _matrix(behind, LENGTH), _matrix(before, GAP)
    # The order of the parse suffixes within each group, and the common prefix with the one before.
    key = np.concatenate([np.ascontiguousarray(g.astype(">i8")).view(np.uint8).reshape(n, 8), right], axis=1)
    order = np.argsort(np.ascontiguousarray(key).view(f"S{LENGTH + 8}").ravel(), kind="stable")
    g, ids, place, right, left = g[order], ids[order], place[order], right[order], left[order]
    differs = right[1:] != right[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), LENGTH)
    common[g[1:] != g[:-1]] = -1
    at, most, least = place >> 12, place >> 6 & 63, place & 63
    rank = np.empty(n, np.int64)
    rank[np.lexsort((at, ids))] = np.arange(n)  # corpus order
    marks, suffix = np.zeros(n, U), np.zeros(n, U)
    for distance in range(GAP):
        if distance:  # the phrase suffix of that many bytes
            with np.errstate(over="ignore"):
                suffix += _VALUES[left[:, distance - 1]] * powers(GAP)[distance]
        own = np.flatnonzero((least <= distance) & (distance <= most))
        if len(own) < 2:
            continue
        run = np.concatenate([[0], np.cumsum(common < LENGTH - distance)])[own]
        by = np.lexsort((rank[own], suffix[own], run))
        same = (run[by][1:] == run[by][:-1]) & (suffix[own][by][1:] == suffix[own][by][:-1])
        marks[own[by[1:][same]]] |= U(1 << distance)
    out = np.empty(n, U)
    out[order] = marks
    return out


def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of the words of whole groups, from rows sorted by group."""
    def done(rows: pa.Table) -> pa.RecordBatch:
        g, ids, place = (rows.column(i).to_numpy() for i in range(3))
        marks = equal_windows(g, ids, place, rows.column(3).to_pylist(), rows.column(4).to_pylist())
        some = marks != 0
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(place[some] >> 12), pa.array(marks[some].view(np.int64))],
                                          names=["id", "at", "marks"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        g = rows.column(0).to_numpy()
        cut = int(np.searchsorted(g, g[-1])) if len(g) else 0  # the last group may go on
        if cut:
            yield done(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield done(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of a word: its hash, id, the trigger's position and the distance."""
    for batch in batches:
        ids, place = (batch.column(i).to_numpy() for i in (1, 2))
        before, behind = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        out: list[tuple] = []
        for i, (b, r) in enumerate(zip(before, behind, strict=True)):
            most, least = int(place[i]) >> 6 & 63, int(place[i]) & 63
            raw = np.frombuffer(b[::-1] + r, np.uint8)
            distance = np.arange(least, most + 1)
            begin = len(b) - distance
            out.append((Hashes(raw).of(begin, begin + LENGTH), np.full(len(distance), ids[i]), np.full(len(distance), place[i] >> 12), distance))
        if out:
            h, ident, at, distance = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ident), pa.array(at), pa.array(distance)],
                                             names=["h", "id", "at", "distance"])


def _spread(words: DataFrame) -> DataFrame:
    """Marks of the words of very large groups: windows by their own hashes, against the first start of each."""
    rows = stored(arrow_map(words, _windows, "h long, id long, at long, distance long"), "windows")
    start = F.struct(F.col("id"), (F.col("at") - F.col("distance")).alias("p"))
    first = rows.groupBy("h").agg(F.min(start).alias("first")).select(F.col("h").alias("k"), "first")
    later = rows.join(first, F.col("h") == F.col("k")).where(start != F.col("first"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("distance").cast("int"))
    return later.groupBy("id", "at").agg(F.bit_or(bit).alias("marks"))


def marks(rows: DataFrame, large: int = LARGE) -> DataFrame:
    """id, at, marks: bit d of a row says that the window that starts d bytes before ``at`` occurs earlier.

    ``rows``: id (long, all different), text.
    """
    n_parts = partitions(rows)
    triggers = arrow_map(rows, parse, "g long, w long, id long, place long")
    sorted_rows = triggers.repartition(n_parts, "g").sortWithinPartitions("g", "w", "id", "place")
    found = stored(arrow_map(sorted_rows, dictionary, "g long, id long, place long, again boolean"), "words")
    least, most = F.col("place").bitwiseAND(63).cast("int"), F.shiftright("place", 6).bitwiseAND(63).cast("int")
    top = F.call_function("shiftleft", F.lit(1).cast("long"), most)
    every = top - F.call_function("shiftleft", F.lit(1).cast("long"), least) + top  # bits least to most
    again = found.where("again").select("id", F.shiftright("place", 12).alias("at"), every.alias("marks"))

    # A text's words number at most as its bytes, so a list of them is no larger than some times the text.
    left = found.where("NOT again").groupBy("id").agg(F.collect_list(F.struct("g", "place")).alias("words"))
    some = rows.join(left.withColumnRenamed("id", "i"), F.col("id") == F.col("i")).select("id", "text", "words")
    words = stored(arrow_map(some, contexts, "g long, id long, place long, before binary, behind binary"), "contexts")
    full = words.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > large).select(F.col("g").alias("k"))
    full = stored(full, "large")
    if full.limit(1).count():
        rest = words.join(full, F.col("g") == F.col("k"), "left_anti")
        spread = _spread(words.join(full, F.col("g") == F.col("k"), "left_semi"))
    else:
        rest, spread = words, None
    by_group = rest.repartition(n_parts, "g").sortWithinPartitions("g")
    out = again.unionByName(arrow_map(by_group, ordered, "id long, at long, marks long"))
    return out.unionByName(spread) if spread is not None else out


def covered(n: int, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of n bytes the marked windows cover."""
    row, distance = np.nonzero((bits[:, None] >> np.arange(GAP, dtype=U)) & U(1))
    starts = at[row] - distance
    steps = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(starts + LENGTH, minlength=n + 1)[:n + 1]
    return np.cumsum(steps)[:n] > 0


def _kept(doc: bytes, found: list | None) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed and runs of them."""
    if not found:
        return doc, 0, 0
    at = np.fromiter((f["at"] for f in found), np.int64, len(found))
    bits = np.fromiter((f["marks"] for f in found), np.int64, len(found)).view(U)
    gone = covered(len(doc), at, bits)
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(doc, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for doc, found in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            rest, n, spans = _kept(doc, found)
            for column, value in zip(out, (len(doc), n, spans, hashlib.sha256(rest).hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())],
                                         names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cleaned(text_at: int, chars_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            rest, chars = [], []
            for text, doc, found in zip(columns[text_at].to_pylist(), texts(columns[text_at]), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                # A code point of which bytes are gone goes with them.
                own = text if not found else _kept(doc, found)[0].decode("utf-8", "ignore")
                rest.append(own)
                chars.append(len(own or ""))
            if chars_at is not None:
                old = columns[chars_at].to_pylist()
                chars = [c if t is not None and c != len(t) else o for c, o, t in zip(chars, old, columns[text_at].to_pylist(), strict=True)]
                columns[chars_at] = pa.array(chars, columns[chars_at].type)
            columns[text_at] = pa.array(rest, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return run


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows (id, text) with different ids in corpus order, and, where the ids of docs are not all different and
    given, a table from (own id, text hash) to them."""
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    odd = own.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").limit(1).count()
    if not odd:
        return own, None
    key = ["id", "hash"]
    rows = own.withColumn("hash", F.xxhash64("text"))
    # Numbers by ranges: a range's first number is the sum of the ranges before.
    ranged = rows.select(*key).distinct().repartitionByRange(partitions(docs), F.col("id").asc_nulls_first(), "hash")
    ranged = ranged.sortWithinPartitions(F.col("id").asc_nulls_first(), "hash")
    ranged = stored(ranged.withColumn("m", F.monotonically_increasing_id()), "ids")
    split = ranged.withColumn("part", F.shiftright("m", 33))
    sizes = split.groupBy("part").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("part").alias("q"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    table = split.join(F.broadcast(sizes), F.col("part") == F.col("q")).select(  # a row for each range
        F.col("id").alias("own"), F.col("hash").alias("own_hash"), (F.col("first") + F.col("m").bitwiseAND((1 << 33) - 1)).alias("number"))
    table = stored(table, "numbers")
    one = rows.join(table, F.col("id").eqNullSafe(F.col("own")) & (F.col("hash") == F.col("own_hash")))
    return stored(one.dropDuplicates(["number"]).select(F.col("number").alias("id"), "text"), "numbered"), table


def _lists(found: DataFrame) -> DataFrame:
    return found.groupBy(F.col("id").alias("i")).agg(F.collect_list(F.struct("at", "marks")).alias("found"))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the digest of the remaining bytes of each row."""
    rows, table = numbered(docs, id_col, text_col)
    found = _lists(marks(rows, large))
    joined = rows.join(found, F.col("id") == F.col("i"), "left").select("id", "text", "found")
    out = arrow_map(joined, _digest, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    kind = docs.schema[id_col].dataType
    if table is not None:
        back = docs.select(F.col(f"`{id_col}`").cast("long").alias("own_id"),
                           F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("h"))
        out = back.join(table, F.col("own_id").eqNullSafe(F.col("own")) & (F.col("h") == F.col("own_hash"))).join(
            out, F.col("number") == F.col("id")).select(F.col("own_id").alias("id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                 large: int = LARGE) -> DataFrame:
    """The rows of docs with the removed bytes cut out of their texts, and the number of code points set anew."""
    rows, table = numbered(docs, id_col, text_col)
    found = _lists(marks(rows, large))
    list_col = free_name(docs, "found")
    names = [F.col(f"`{c}`") for c in docs.columns]
    key, number = free_name(docs, "found_key"), free_name(docs, "found_number")
    if table is None:
        keyed = docs.withColumn(key, F.col(f"`{id_col}`").cast("long"))
    else:
        table = table.select(F.col("own").alias(number + "o"), F.col("own_hash").alias(number + "h"), F.col("number").alias(key))
        text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
        keyed = docs.join(table, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(number + "o")) & (F.xxhash64(text) == F.col(number + "h")))
    lists = found.select(F.col("i").alias(number), F.col("found").alias(list_col))
    joined = keyed.join(lists, F.col(key) == F.col(number), "left").select(*names, list_col)
    lower = [c.lower() for c in docs.columns]
    chars_at = lower.index(chars_col.lower()) if chars_col and chars_col.lower() in lower else None
    return arrow_map(joined, _cleaned(lower.index(text_col.lower()), chars_at), docs.schema)
