"""Quality verdicts: counted base rules, then a calibrated logistic regression on hashed word and character n-grams.

The model is fitted on labelled rows (labels.quality), at most about TRAIN_ROWS of them, chosen by a hash of
doc_id. Three quarters fit the weights, one quarter the calibration (a sigmoid over the score). Scoring runs over
Arrow batches: a document's score is the mean weight of its words, of its word pairs and of its character n-grams, added up, so memory
does not follow a text's length beyond the batch itself. A document is kept if the calibrated probability of good
quality reaches KEEP_AT.

Edge cases: null text counts as empty: no words, base_failed, not kept; repeated rows give a row each; a null or
missing label is no training row, of several labels for a doc_id the largest counts; without labels of both kinds
the model says 1.0 for every document and the base rules alone decide; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import GOLDEN, SPACE, buffer_of, docs_of, hash_sample, lean, mix, prefix_hash, range_hash, slices, table, window_hash, word_spans

#: Bound on the labelled rows to fit on.
TRAIN_ROWS = 3000
#: Bits of each feature family's hash; word and character n-gram sizes.
BITS, WORD_GRAMS, CHAR_GRAMS = 15, (1, 2), (3, 4)
KEEP_AT = 0.5
MIN_WORDS, MAX_REPEAT_SHARE, WINDOW = 20, 30, 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FEATURES = 1 + (len(WORD_GRAMS) + len(CHAR_GRAMS) << BITS)
#: Feature values that one step of fitting handles; bounds its temporary memory.
FIT_SLICE = 1 << 19


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The number of set flags in each row's range."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def base_counts(data: np.ndarray, off: np.ndarray, spans: tuple, words: np.ndarray, prefix: np.ndarray) -> dict[str, np.ndarray]:
    """Exact counts of each row; rows lie end to end in data."""
    n = len(off) - 1
    _, _, doc = spans
    letter = ~SPACE[data]
    out = {"n_words": np.bincount(doc, minlength=n), "word_chars": per_row(letter & ((data & 0xC0) != 0x80), off), "n_symbols": per_row(SYMBOLS[data], off)}

    newline = np.flatnonzero(data == 10)
    start, end = np.sort(np.concatenate([off[:-1], newline + 1])), np.sort(np.concatenate([newline, off[1:]]))
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(letter, out=filled[1:])
    has = filled[end] > filled[start]
    start, end = start[has], end[has]
    line_doc = np.searchsorted(off, start, "right") - 1
    key = mix(range_hash(prefix, start, end) + line_doc.astype(np.uint64) * np.uint64(GOLDEN))
    first = np.unique(key, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[first], minlength=n)

    window = window_hash(words, WINDOW)
    inside = np.flatnonzero(doc[: len(window)] == doc[WINDOW - 1 :]) if len(window) else np.zeros(0, np.int64)
    key = mix(window[inside] + doc[inside].astype(np.uint64) * np.uint64(GOLDEN))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, inside[again], 1)
    np.add.at(edge, inside[again] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)
    return out


def features(data: np.ndarray, off: np.ndarray, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family, the feature of each occurrence and its row, in row order."""
    family = lambda k, gram: 1 + (k << BITS) + (gram >> np.uint64(64 - BITS)).astype(np.int64)
    for k, size in enumerate(WORD_GRAMS):
        gram = words if size == 1 else window_hash(words, size)
        inside = doc[: len(gram)] == doc[size - 1 :] if len(gram) else np.zeros(0, bool)
        yield family(k, gram[inside]), doc[: len(gram)][inside]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    head = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=head[1:])
    row = np.repeat(np.arange(len(off) - 1), np.diff(head[off]))
    for k, size in enumerate(CHAR_GRAMS, len(WORD_GRAMS)):
        gram = window_hash(points, size)
        inside = row[: len(gram)] == row[size - 1 :] if len(gram) else np.zeros(0, bool)
        yield family(k, gram[inside]), row[: len(gram)][inside]


@dataclass
class Model:
    weights: np.ndarray  # float32; of feature 0, the constant, first
    slope: float = 1.0
    shift: float = 0.0
    always: bool = False

    def probability(self, raw: np.ndarray) -> np.ndarray:
        if self.always:
            return np.ones(len(raw))
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -50, 50)))


def raw_scores(model: Model, data: np.ndarray, off: np.ndarray, words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    out = np.full(n, float(model.weights[0]))
    for index, row in features(data, off, words, doc):
        count = np.bincount(row, minlength=n)
        out += np.bincount(row, weights=model.weights[index], minlength=n) / np.maximum(count, 1)
    return out


def _opened(part: pa.RecordBatch, column: int):
    data, off = buffer_of(part.column(column))
    spans = word_spans(data, off)
    prefix = prefix_hash(data)
    return data, off, spans, prefix, range_hash(prefix, spans[0], spans[1])


_ROWS = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("index", pa.binary()), ("value", pa.binary())])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        data, off, spans, _, words = _opened(part, part.schema.get_field_index("text"))
        n = part.num_rows
        keys, values = [np.arange(n) * FEATURES], [np.ones(n)]
        for index, row in features(data, off, words, spans[2]):
            key, count = np.unique(row * FEATURES + index, return_counts=True)
            keys.append(key)
            values.append(count / np.bincount(row, minlength=n)[key // FEATURES])
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order].astype(np.float32)
        edge = np.searchsorted(key, np.arange(n + 1) * FEATURES)
        index = (key % FEATURES).astype(np.int32)
        pairs = [(index[a:b].tobytes(), value[a:b].tobytes()) for a, b in zip(edge, edge[1:])]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], schema=_ROWS)


def fit_rows(labels: np.ndarray, index: list[np.ndarray], value: list[np.ndarray], steps: int = 120, rate: float = 0.15, ridge: float = 1e-4) -> Model:
    """Full-batch Adam on features scaled by their root mean square, then a sigmoid on the fourth row of each four."""
    calibrate = np.arange(len(labels)) % 4 == 3
    fit = np.flatnonzero(~calibrate)
    y = labels.astype(float)
    if len(set(y[fit])) < 2 or len(set(y[calibrate])) < 2:
        return Model(np.zeros(FEATURES, np.float32), always=True)
    size = np.array([len(index[i]) for i in fit])
    cut = np.flatnonzero(np.diff(np.cumsum(size) // FIT_SLICE, prepend=-1))  # first row of each slice
    parts = [fit[a:b] for a, b in zip(cut, np.append(cut[1:], len(fit)))]
    square = np.zeros(FEATURES)
    for part in parts:
        square += np.bincount(np.concatenate([index[i] for i in part]), weights=np.concatenate([value[i] for i in part]) ** 2, minlength=FEATURES)
    scale = 1 / (np.sqrt(square / len(fit)) + 1e-3)
    w, m, v = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES)
    share = y[fit].mean()
    for t in range(1, steps + 1):
        g = ridge * w
        for part in parts:
            col, val = np.concatenate([index[i] for i in part]), np.concatenate([value[i] for i in part])
            val = val * scale[col]
            n = np.array([len(index[i]) for i in part])
            norm = 1 / np.sqrt(n)  # each row's terms add up to a bounded score
            z = np.add.reduceat(w[col] * val, np.cumsum(n) - n) * norm
            weight = np.where(y[part] > 0, 0.5 / share, 0.5 / (1 - share)) / len(fit)
            g += np.bincount(col, weights=val * np.repeat((1 / (1 + np.exp(-z)) - y[part]) * weight * norm, n), minlength=FEATURES)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) / np.sqrt(t)
    model = Model((w * scale).astype(np.float32))
    held = np.flatnonzero(calibrate)
    x = np.array([model.weights[index[i]] @ value[i] for i in held])
    a, b = 1.0 / (x.std() + 1e-9), 0.0
    x0, s0 = x.mean(), x.std() + 1e-9
    x = (x - x0) / s0
    good, bad = y[held].sum(), (1 - y[held]).sum()
    target = np.where(y[held] > 0, (good + 1) / (good + 2), 1 / (bad + 2))  # Platt's smoothed targets
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * x + b)))
        h = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * x).sum(), (p - target).sum()])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.slope, model.shift = a / s0, b - a * x0 / s0
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fits on the documents that labels covers; the labels of the sample, at most about rows, are broadcast."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    known = hash_sample(known, "doc_id", rows)
    sample = docs_of(docs).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    got = sample.mapInArrow(lean(_vectors), "doc_id long, label int, index binary, value binary").toArrow()
    if not got.num_rows:
        return Model(np.zeros(FEATURES, np.float32), always=True)
    ids, kind = got.column("doc_id").to_numpy(), got.column("label").to_numpy()
    index, value = [np.frombuffer(x.as_py(), np.int32) for x in got.column("index")], [np.frombuffer(x.as_py(), np.float32) for x in got.column("value")]
    order = sorted(range(len(ids)), key=lambda i: (hash_id(ids[i]), ids[i], len(index[i]), kind[i]))
    return fit_rows((kind[order] > 0).astype(int), [index[i] for i in order], [value[i] for i in order])


def hash_id(x: int) -> int:
    return int(mix(np.array([x], np.int64).view(np.uint64))[0])


_SCORES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, p_good double"


def _score(model, keep_at: float, passing: int | None):
    names = [x.split()[0] for x in _SCORES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for part in slices(batches):
            data, off, spans, prefix, words = _opened(part, part.schema.get_field_index("text"))
            out = base_counts(data, off, spans, words, prefix)
            out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_SHARE * out["n_words"])
            out["p_good"] = m.probability(raw_scores(m, data, off, words, spans[2]))
            out["kept"] = ~out["base_failed"] & (out["p_good"] >= keep_at)
            if passing is None:
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(out[k]) for k in names[1:])], names=names)
            else:
                yield part.filter(pa.array(out["kept"]))

    return run


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """A row for each document: counts, base_failed, kept, p_good."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    return docs_of(docs).mapInArrow(lean(_score(model, keep_at, None)), _SCORES)


def keep(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of docs, with all their columns, that pass."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    return docs.where("text is not null").mapInArrow(lean(_score(model, keep_at, 1)), docs.schema)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
