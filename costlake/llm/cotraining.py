"""Quality classifier by co-training two views of a document.

The text view sees hashed words, their beginnings and endings, and how repetitive and how upper-case the text is; the metadata
view sees language, source, length and line lengths only. A document is good if it is labelled of quality and
not toxic. Both views are logistic regressions on hashed features.

Fitting uses at most ``max_labelled`` labelled documents, chosen by a hash of the id, one row of each; a quarter
is held out. In each round both views are fitted and calibrated on the held-out part (Platt scaling); then each
view scores all unlabelled documents on Spark, and those it is most confident of, a tenth of ``pool`` for each class,
join the other view's training set. Only these reach the driver; each task keeps as many, so their number is bounded
at any size. Equal documents are told once. The unlabelled documents' features are made once, into a table of about
half the texts' size. At last the two calibrated views are combined by a logistic regression on the held-out part. Only telling features have a weight: those seen in three
training documents or more whose share of bad documents differs from the whole by 3.5 standard errors. Weights
add up over a text whatever its length, so one insult among thousands of plain words counts as in a short text.

Scoring covers all documents in one pass; the models (about 2 MB) go along with the tasks. A document is kept
if its probability of being good is 0.5 or more.

Without labels, or with labels of one class only, there is no model: scores are 1 and all are kept. Null or
empty texts have the features of an empty text; null metadata are values of their own. A document with
several labels counts as bad if one of them does. Labels of unknown documents are ignored. Repeated rows get
equal scores; an empty table gives no rows. ``filtered`` keeps the columns the documents came with, of any
names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.frames import added, arrow_map, release, stored, texts, with_new
from costlake.llm.text import U, chunks, mix

TEXT_BITS, META_BITS = 18, 13
LEAST_SEEN, SURE = 3, 3.5
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


@dataclass
class View:
    """Rows of binary features: those of row i are index[start[i]:start[i + 1]]."""

    start: np.ndarray
    index: np.ndarray

    @staticmethod
    def of(parts: list[np.ndarray]) -> View:
        return View(np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64),
                    np.concatenate(parts) if parts else np.zeros(0, np.int32))

    def logits(self, weights: np.ndarray) -> np.ndarray:
        """Row sums of weights; the last weight is the intercept."""
        total = np.concatenate([[0.0], np.cumsum(weights[self.index], dtype=np.float64)])
        return total[self.start[1:]] - total[self.start[:-1]] + weights[-1]


def _bucket(value: np.ndarray, steps: int) -> np.ndarray:
    return np.minimum((value * steps).astype(np.int64), steps)


def text_features(docs: list[bytes]) -> list[np.ndarray]:
    """The sorted feature numbers of each text."""
    out: list[np.ndarray] = []
    size = U((1 << TEXT_BITS) - 1)
    for _, words in chunks(docs, True):
        n = len(words.docs)
        counts = np.diff(words.first)
        doc = np.repeat(np.arange(n), counts)
        raw, end = words.bytes.astype(U), words.ends
        with np.errstate(over="ignore"):
            # The last three bytes of each word (fewer: what stands there), whatever the word.
            tail = mix((raw[end - 1] << U(16) | raw[np.maximum(end - 2, 0)] << U(8) | raw[np.maximum(end - 3, 0)]) + U(1 << 40))
            # The first four and five bytes, A-Z folded: words of one stem share them.
            starts = []
            for k in (4, 5):
                at = np.minimum(words.starts[:, None] + np.arange(k), len(raw) - 1) if len(doc) else np.zeros((0, k), np.int64)
                head = np.where(np.arange(k) < (words.ends - words.starts)[:, None], FOLD[words.bytes[at]], 0).astype(U)
                starts.append(mix((head << (U(8) * np.arange(k, dtype=U))).sum(axis=1, dtype=U) + U(k) * U(1 << 42)))
        single = np.zeros(len(doc), bool)
        single[1:] = (words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])
        upper = (words.bytes[words.starts] >= 0x41) & (words.bytes[words.starts] <= 0x5A) if len(doc) else single
        per = np.maximum(counts, 1)
        shape = []
        for k, flags in enumerate((single, upper, words.ends - words.starts > 12)):
            share = np.bincount(doc[flags], minlength=n) / per
            shape.append(mix((_bucket(share, 10) + (k + 1) * 1000).astype(U) + U(1 << 41)))
        distinct = np.concatenate([words.hashes & size, tail & size, *(s & size for s in starts), *(s & size for s in shape)])
        of = np.concatenate([doc] * 4 + [np.arange(n)] * 3)
        # sorted and without repeats; sorting is several times as fast as numpy's unique, and faster in 32 bits
        kind = np.uint32 if n <= 1 << (32 - TEXT_BITS) else np.int64
        pairs = np.sort(of.astype(kind) << kind(TEXT_BITS) | distinct.astype(kind))
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])].astype(np.int64)
        at = np.searchsorted(pairs >> TEXT_BITS, np.arange(n + 1))
        index = (pairs & ((1 << TEXT_BITS) - 1)).astype(np.int32)
        out += [index[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def meta_features(docs: list[bytes], lang: list, source: list, chars: list) -> list[np.ndarray]:
    """The feature numbers of each document's metadata."""
    out = []
    for doc, la, so, n in zip(docs, lang, source, chars, strict=True):
        lines = doc.count(b"\n") + 1
        size = -1 if n is None else int(n).bit_length()
        line = (len(doc) // lines).bit_length()
        names = (f"l{la}", f"s{so}", f"ls{la}/{so}", f"n{size}", f"i{lines.bit_length()}", f"w{line}", f"nw{size}/{line}")
        out.append(np.unique(np.array([zlib.crc32(x.encode()) & ((1 << META_BITS) - 1) for x in names], np.int32)))
    return out


def telling(parts: list[np.ndarray], good: np.ndarray, bits: int) -> np.ndarray:
    """The features whose share of bad documents differs from the whole by SURE standard errors or more."""
    n, seen, bad = len(good), np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    for part, fine in zip(parts, good, strict=True):
        seen[part] += 1  # a document has each feature once
        if not fine:
            bad[part] += 1
    share = 1 - good.mean()
    error = np.sqrt(np.maximum(seen * share * (1 - share) * (1 - seen / n), 1e-9))
    return (seen >= LEAST_SEEN) & (np.abs(bad - seen * share) >= SURE * error)


def fit(parts: list[np.ndarray], good: np.ndarray, bits: int, rounds: int = 100, shrink: float = 1e-4) -> np.ndarray:
    """Logistic regression on the telling features by full-batch AdaGrad; the last weight is the intercept."""
    keep = telling(parts, good, bits)
    n, view = len(good), View.of([p[keep[p]] for p in parts])
    weights, squares, size = np.zeros((1 << bits) + 1), np.full((1 << bits) + 1, 1e-8), np.diff(view.start)
    for _ in range(rounds):
        error = _p(view.logits(weights)) - good
        step = np.append(np.bincount(view.index, weights=np.repeat(error, size), minlength=1 << bits) / n + shrink * weights[:-1], error.mean())
        squares += step * step
        weights -= 0.3 * step / np.sqrt(squares)
    return weights


def logits(parts: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """``View.logits`` of rows of features, most of which have no weight: only the others are put together."""
    some = weights != 0
    return View.of([p[some[p]] for p in parts]).logits(weights)


def calibrate(columns: list[np.ndarray], good: np.ndarray, shrink: float = 1e-3) -> np.ndarray:
    """A small logistic regression (Newton steps): weights of the columns and the intercept."""
    x = np.stack([*columns, np.ones(len(good))], axis=1)
    # Targets a little within 0 and 1, as for Platt scaling, so that perfect separation stays finite.
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - target) + shrink * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + shrink * np.eye(x.shape[1])
        move = np.linalg.solve(curve, slope)
        weights -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return weights


def _p(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Model:
    """Weights of both views, their calibrations and the combination."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray
    #: Of the fit, for inspection: pseudo-labels that each view gave, by round.
    exchanged: tuple = ()

    def scores(self, text: View, meta: View) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = text.logits(self.text) * self.text_scale[0] + self.text_scale[1]
        m = meta.logits(self.meta) * self.meta_scale[0] + self.meta_scale[1]
        return _p(t), _p(m), _p(t * self.both[0] + m * self.both[1] + self.both[2])


#: Of a round: the models, their scales and the keys that each view knows, to the documents each view tells the
#: other of: (view, label) -> (key, features of the other view).
Told = dict[tuple[int, bool], list[tuple[int, np.ndarray]]]


def cotrain(text: list[np.ndarray], meta: list[np.ndarray], good: np.ndarray, held: np.ndarray,
            tell: Callable[[list, list, list[set[int]]], Told], rounds: int = 3) -> Model:
    """Fits the views on labelled documents that are not held, and on what they tell each other of the others."""
    views, bits, train, rest = (text, meta), (TEXT_BITS, META_BITS), np.flatnonzero(~held), np.flatnonzero(held)
    held_out = [[v[i] for i in rest] for v in views]
    known: list[dict] = [{}, {}]  # by view: key -> its features, label
    told = []
    for turn in range(rounds + 1):
        models, scales = [], []
        for k in (0, 1):
            rows = [views[k][i] for i in train] + [x[0] for x in known[k].values()]
            label = np.concatenate([good[train], np.array([x[1] for x in known[k].values()], bool)])
            models.append(fit(rows, label, bits[k]))
            scales.append(calibrate([logits(held_out[k], models[k])], good[held]))
        if turn == rounds:
            break
        found = tell(models, scales, [set(x) for x in known])
        for (k, value), rows in found.items():
            known[1 - k].update({key: (features, value) for key, features in rows})
        told.append(tuple(len(rows) for rows in found.values()))
    calibrated = [logits(held_out[k], models[k]) * scales[k][0] + scales[k][1] for k in (0, 1)]
    both = calibrate(calibrated, good[held])
    return Model(models[0].astype(np.float32), models[1].astype(np.float32), scales[0], scales[1], both, tuple(told))


def _coded(features: np.ndarray) -> bytes:
    """Sorted feature numbers as three planes of bytes of their differences, which compress well."""
    step = np.diff(features, prepend=0).astype("<u4")
    return step.view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _decoded(data: bytes) -> np.ndarray:
    step = np.frombuffer(data, np.uint8).reshape(3, -1).astype(np.int32)
    return np.cumsum(step[0] | step[1] << 8 | step[2] << 16, dtype=np.int32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, key and the features of text and metadata, from id, c0 to c3 and key."""
    for batch in batches:
        docs = texts(batch.column(1))
        t = [_coded(x) for x in text_features(docs)]
        m = [_coded(x) for x in meta_features(docs, *(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(5), pa.array(t, pa.binary()), pa.array(m, pa.binary())],
                                         names=["id", "key", "t", "m"])


def _confident(models: list, scales: list, known: list[set[int]], most: int, sure: float):
    """slot (2 * view + label), belief, key, t, m of the documents a task's views are most confident of and the
    other view doesn't know: at most ``most`` in each slot, and only with a probability of ``sure`` or more."""
    have = [np.fromiter(x, np.int64, len(x)) for x in known]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict] = [{} for _ in range(4)]
        least = [sure] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            for k in (0, 1):
                view = View.of([_decoded(x) for x in batch.column(1 + k).to_pylist()])
                p = _p(view.logits(models[k]) * scales[k][0] + scales[k][1])
                new = ~np.isin(keys, have[1 - k])
                for value, belief in ((0, 1 - p), (1, p)):
                    slot = 2 * k + value
                    for i in np.flatnonzero(new & (belief >= least[slot])).tolist():
                        best[slot][int(keys[i])] = (float(belief[i]), batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                    if len(best[slot]) > most:
                        best[slot] = dict(sorted(best[slot].items(), key=lambda x: (-x[1][0], x[0]))[:most])
                        least[slot] = min(x[0] for x in best[slot].values())
        rows = [(slot, key, *x) for slot in range(4) for key, x in best[slot].items()]
        slots, keys, belief, t, m = zip(*rows, strict=True) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(belief, pa.float64()), pa.array(keys, pa.int64()),
                                          pa.array(t, pa.binary()), pa.array(m, pa.binary())], names=["slot", "belief", "key", "t", "m"])

    return run


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000, pool: int = 4000, id_col: str = "doc_id",
          text_col: str = "text", lang: str = "lang", source: str = "source", chars: str = "n_chars",
          per_round: float = 0.1, sure: float = 0.98) -> Model | None:
    """Fits the model on a bounded sample of the labels (doc_id, quality, toxic) and on all unlabelled documents.

    Each round a view gives at most ``per_round`` of ``pool`` documents for each class, and only those it gives a
    probability of ``sure`` or more.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(17))
    every = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(
        ((F.coalesce(F.min("quality"), F.lit(1)) == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good"))
    # A bounded table: the planner knows its size once it is stored.
    one = stored(every.orderBy(order, "doc_id").limit(max_labelled).select(F.col("doc_id").alias("l_id"), "good"), "labels")
    content = ["c0", "c1", "c2", "c3"]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate((text_col, lang, source))],
                       F.col(f"`{chars}`").cast("long").alias("c3"))
    kind, key = rows.schema["doc_id"].dataType.simpleString(), F.xxhash64(*content).alias("key")
    # One row of each labelled id, whatever rows the id has; added up within tasks first.
    sample = rows.join(one, F.col("doc_id") == F.col("l_id")).groupBy("doc_id").agg(
        F.min_by(F.struct(*content), F.xxhash64(*content)).alias("c"))
    sample = arrow_map(sample.select("doc_id", "c.*", order.alias("key")), _features, f"id {kind}, key long, t binary, m binary")
    got = sample.join(one, F.col("id") == F.col("l_id")).select(F.col("key").alias("order"), "good", "t", "m").toArrow()  # max_labelled rows at most
    if not got.num_rows:
        return None
    # row by row: the driver's memory holds the features once more, not several copies of the table
    at = pc.sort_indices(got, [("order", "ascending")]).to_numpy()
    good, order_of = (got.column(c).to_numpy()[at] for c in ("good", "order"))
    text, meta = ([_decoded(got.column(c)[i].as_py()) for i in at.tolist()] for c in ("t", "m"))
    del got
    release()
    held = mix(order_of.view(U)) % U(4) == U(0)
    if not (good[~held].any() and (~good[~held]).any() and good[held].any() and (~good[held]).any()):
        return None

    features = arrow_map(rows.select("doc_id", *content, key), _features, f"id {kind}, key long, t binary, m binary")
    # dealt out by id at every size: the plan does not change where the labels outgrow a broadcast
    features = stored(features.join(every.hint("merge"), F.col("id") == F.col("doc_id"), "left_anti").select("key", "t", "m"), "features")
    most = max(1, int(per_round * pool))

    def tell(models: list, scales: list, known: list[set[int]]) -> Told:
        small = [model.astype(np.float32) for model in models]
        found = stored(arrow_map(features, _confident(small, scales, known, most, sure), "slot int, belief double, key long, t binary, m binary"), "told")
        out: Told = {}
        for k in (0, 1):
            for value in (True, False):
                # Several tasks may have copies of one document. The other view's features are all that is asked for.
                own = found.where(F.col("slot") == 2 * k + value).groupBy("key").agg(F.max("belief").alias("belief"), F.first("tm"[1 - k]).alias("features"))
                top = own.orderBy(F.col("belief").desc(), "key").limit(most).collect()  # bounded
                out[k, value] = [(r.key, _decoded(r.features)) for r in top]
        release()
        return out

    return cotrain(text, meta, good, held, tell)


def _scores(model: Model | None, at: tuple[int, ...], prefix: str, only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if model is None:
                found = (np.ones(n),) * 3
            else:
                docs = texts(batch.column(at[0]))
                found = model.scores(View.of(text_features(docs)), View.of(meta_features(docs, *(batch.column(i).to_pylist() for i in at[1:])))) \
                    if n else (np.ones(0),) * 3
            new = [(prefix + name, pa.array(values)) for name, values in zip(("text_score", "meta_score", "score"), found, strict=True)]
            if only:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(a for _, a in new)], names=["id", *(n for n, _ in new)])
            else:
                yield with_new(batch, new)

    return run


def scored(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang",
           source: str = "source", chars: str = "n_chars", least: float = 0.5) -> DataFrame:
    """id, text_score, meta_score, score (the combined probability of a good document) and kept of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate((text_col, lang, source))],
                       F.col(f"`{chars}`").cast("long").alias("c3"))
    out = arrow_map(rows, _scores(model, (1, 2, 3, 4), "", True), f"id {kind}, text_score double, meta_score double, score double")
    return out.withColumn("kept", F.col("score") >= least).withColumnRenamed("id", id_col)


def filtered(docs: DataFrame, model: Model | None, text_col: str = "text", lang: str = "lang", source: str = "source",
             chars: str = "n_chars", least: float = 0.5) -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    prefix = "_c_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    lower = [c.lower() for c in docs.columns]
    at = tuple(lower.index(c.lower()) for c in (text_col, lang, source, chars))
    rows = arrow_map(docs, _scores(model, at, prefix, False), added(docs, ", ".join(f"{prefix}{c} double" for c in ("text_score", "meta_score", "score"))))
    return rows.where(F.col(prefix + "score") >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
