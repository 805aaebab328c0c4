"""Mixture-controlled packing: deficit round-robin over source queues, into windows of a fixed length.

Each source is a queue of its documents' tokens. The queues are served in turns of one quantum (a divisor
of the window): quantum ``j`` of a source is due when the mixture, run at the target proportions, has
given the source half of it, that is at time ``(j + 1/2) / weight``. Serving quanta in the order of their
due times is deficit round-robin with the deficit of each source carried over exactly, as the fraction of
a quantum it is owed: after any number of windows, in any partition, a source is within one quantum of its
share. With no weights given, a source's weight is its token count, and every window holds the
corpus's own mixture; with weights, a drained source leaves its share to the others. What is left of a
source after its last whole quantum joins one queue of remainders, so only the very last quantum of all
can be short, and only the last window holds padding.

Jobs:

1. Tokens: one pass encodes every document and writes (source, tokens before it in this task and source,
   ids as 16 or 32 bits) to a table in the shared folder. Tokens are counted by task and source on the way.
2. Offsets: token counts by (task, source) - small - give each task's place in each queue.
3. Pieces: a second pass over the table cuts the documents at quantum borders and takes checksums; it
   needs no shuffle of tokens, only the small offset table joined by (task, source).
4. Windows: quanta (a few numbers each) are range-partitioned by due time and numbered by a prefix sum over
   the ranges; eight quanta of 128 make a window of 1024.

A queue's order is the order of the input's partitions and rows. A hot source is spread over all tasks;
no task holds a source or the list of documents.

Ties in due time go by source. Null texts are empty (a document of one closing id); a null source is a
source of its own; repeated rows are packed as often as they occur. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.frames import arrow_map, partitions, stored

_ENCODERS: dict[str, object] = {}
#: A run of white space that is encoded apart: the look-ahead of the pattern takes stack for each character of a
#: run, and tiktoken panics on about a million. Those of White_Space, as the pattern's own class.
LONG = 100_000
RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the
    others for code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """A tiktoken encoding with the vocabulary of a byte-level BPE file of ``tokenizers``.

    Its ids are those of ``tokenizers`` (a test holds one against the other), at a quarter of the time. The file's
    added tokens are special tokens, found in texts as ``tokenizers`` finds them. Made once in each Python worker.
    """
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        added = model.get("added_tokens", [])
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens are matched as they stand only")
        special = {t["content"]: t["id"] for t in added}
        stand = _byte_of()
        ranks = {bytes(stand[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        _ENCODERS[path] = tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def encode(model, text: str) -> list[int]:
    """The ids of a text of any length, added tokens included."""
    if len(text) < LONG:
        return model.encode(text, allowed_special="all")
    out, at, added = [], 0, tuple(model.special_tokens_set)
    for run in RUN.finditer(text):
        a, b = run.span()
        if b - a < LONG:
            continue
        # The pattern leaves the last character of a run to what follows it, but for an added token.
        b -= b < len(text) and not text.startswith(added, b)
        out += model.encode(text[at:a], allowed_special="all")
        out += model._encode_single_piece(text[a:b])
        at = b
    return out + model.encode(text[at:], allowed_special="all")


def tokens(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
           source_col: str | None = "source") -> DataFrame:
    """A stored table with a row for each document: doc_id, source, task, before (tokens of that source
    earlier in the task), n (tokens with the closing id) and ids (little-endian unsigned 32-bit numbers,
    or 16-bit ones while all ids of the vocabulary fit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        kind = "<u2" if model.n_vocab <= 1 << 16 else "<u4"
        task, queues = TaskContext.get().partitionId(), {}
        for batch in batches:
            before, n, ids = [], [], []
            for source, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = np.asarray([*encode(model, text or ""), end_id], kind)
                before.append(queues.get(source, 0))
                queues[source] = before[-1] + len(own)
                n.append(len(own))
                ids.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([task] * len(n), pa.int32()), pa.array(before, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "source", "task", "before", "n", "ids"])

    source = F.col(f"`{source_col}`").cast("string") if source_col else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), source.alias("source"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(arrow_map(rows, run, f"doc_id {kind}, source string, task int, before long, n long, ids binary"), "tokens")


def _cut(quantum: int, wide: bool):
    """Pieces of each document: from its place in its queue, cut at the borders of quanta."""
    kind = "<u4" if wide else "<u2"
    names = ["doc_id", "source", "rest", "quantum", "at", "start", "length", "ids_crc32", "doc_tokens", "due"]
    types = [None, pa.string(), pa.bool_(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            rows = zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True)
            for doc, source, raw, at, whole, rest_at, weight in rows:
                ids = np.frombuffer(raw, kind).astype("<u4")
                n, start = len(ids), 0
                while start < n:
                    place, rest, end = at + start, False, n
                    if place >= whole:  # behind the source's last whole quantum
                        place, rest = rest_at + place - whole, True
                    else:
                        end = min(end, whole - at)
                    end = min(end, start + quantum - place % quantum)
                    due = float("inf") if rest else (place // quantum + 0.5) / weight
                    values = (doc, None if rest else source, rest, place // quantum, place % quantum, start, end - start,
                              zlib.crc32(ids[start:end]), n, due)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    start = end
            arrays = [pa.array(c, t or batch.schema.field(0).type) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def pack(docs: DataFrame, path: str, window: int = 1024, quantum: int = 128, weights: dict[str | None, float] | None = None,
         end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """Pieces of all documents: doc_id, source (null: the queue of remainders), start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    ``weights``: positive target proportions by source; a source that is not in it gets their mean. None:
    the sources' own token counts. ``quantum`` must divide ``window``.
    """
    if window % quantum:
        raise ValueError("the quantum must divide the window")
    table = tokens(docs, path, end_id, id_col, text_col, source_col)

    # Places of tasks in their queues. A row for each (task, source): the running sums go by source.
    counts = table.groupBy("source", "task").agg(F.sum("n").alias("n"))
    base = counts.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("task")) - F.col("n"))
    totals = counts.groupBy("source").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("whole", F.col("total") - F.col("total") % quantum)
    if weights is None:
        weight = F.greatest(F.col("whole") / quantum, F.lit(1.0))
    else:
        mean = sum(weights.values()) / len(weights) if weights else 1.0
        weight = F.lit(float(mean))
        for source, share in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(share))).otherwise(weight)
    # One row for each source: where its remainder lies in the queue of remainders.
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("t_source"), "whole", weight.alias("weight"),
        F.coalesce(F.sum(F.col("total") - F.col("whole")).over(before), F.lit(0)).cast("long").alias("rest_at"))
    # Stored, so that its size is known: Spark broadcasts it below its threshold, else it sorts and merges.
    places = stored(base.join(totals, base["source"].eqNullSafe(totals["t_source"])).select(
        F.col("source").alias("p_source"), F.col("task").alias("p_task"), "base", "whole", "rest_at", "weight"), "places")

    placed = table.join(places, table["source"].eqNullSafe(places["p_source"]) & (table["task"] == places["p_task"]))
    kind = table.schema["doc_id"].dataType.simpleString()
    pieces = stored(arrow_map(
        placed.select("doc_id", "source", "ids", (F.col("base") + F.col("before")).alias("at"), "whole", "rest_at", "weight"),
        _cut(quantum, encoder(path).n_vocab > 1 << 16),
        f"doc_id {kind}, source string, rest boolean, quantum long, at int, start long, length long, ids_crc32 long, "
        "doc_tokens long, due double"), "cuts")

    # Quanta in the order of due times, numbered by ranges; the pieces of a quantum stay together.
    key = [F.col(c) for c in ("due", "rest", "source", "quantum")]
    ordered = pieces.repartitionByRange(partitions(docs), *key).sortWithinPartitions(*key, "at")
    numbered = stored(arrow_map(ordered, _number, (
        f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, at int, range int, number long")),
        "pieces")
    sizes = numbered.groupBy("range").agg((F.max("number") + 1).alias("n"))  # a row for each range of the shuffle
    first = sizes.select(F.col("range").alias("r"), (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("first"))
    per = window // quantum
    rank = F.col("first") + F.col("number")
    # Only the last quantum of all can be short, so a quantum's place in its window is a multiple of the quantum.
    return numbered.join(F.broadcast(first), F.col("range") == F.col("r")).select(
        F.col("doc_id").alias(id_col), "source", "start", "length", "ids_crc32", "doc_tokens",
        F.floor(rank / per).cast("long").alias("sequence_id"),
        ((rank % per) * quantum + F.col("at")).cast("long").alias("offset"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the quanta of a sorted partition; a quantum begins with the piece at place 0."""
    task, n = TaskContext.get().partitionId(), -1
    for batch in batches:
        at = batch.column(4).to_numpy(zero_copy_only=False)
        number = n + np.cumsum(at == 0)
        if len(number):
            n = int(number[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(batch.column(i) for i in (5, 6, 7, 8)), batch.column(4),
             pa.array(np.full(len(at), task, np.int32)), pa.array(number.astype(np.int64))],
            names=["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "at", "range", "number"])
