"""Language spans: script ranges narrow the candidates, Viterbi over per-word scores labels each word.

A word is a run of letters. Its score for a language is the sum, over its character trigrams (word edges included,
lower case), of the trigram's smoothed log probability in that language less the mean over languages. A language
is a candidate for a word if at least SCRIPT_SHARE of the language's letters are of the script of the word's first
letter. The best label sequence pays SWITCH for each change of language. A document's language is the one whose
spans hold the most letters, and the score is their share of its letters.

The trigram counts come from about TRAIN_DOCS documents, chosen by a hash of doc_id among those that may be
learned from. Long documents are cut into runs of RUN words that are solved for every label before the run and
then joined, which gives the same path as one pass.

Edge cases: null text, or one without a letter, gives `und` with score 0 and no spans; ties go to the language
that sorts first; repeated rows give a row each; without training rows every document is `und`; a null doc_id is
never held out; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import buffer_of, docs_of, hash_sample, lean, mix, slices, table

TRAIN_DOCS = 8000
BITS = 16
SWITCH = 12.0
SCRIPT_SHARE = 0.01
RUN = 512
#: For keep(): the least share of a document's letters that its language must hold, and how far, in natural logarithms, the
#: mean log probability of its letters may lie under that of the language's training rows: FAR, and more for short texts,
#: whose means spread: SPREAD over the root of the number of letters.
LEAST_SHARE, FAR, SPREAD = 0.6, 3.0, 12.0
#: First code points of the script ranges of Unicode's block chart, with the script of each range.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2C80, "other"),
    (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
]
NAMES = sorted({s for _, s in SCRIPTS})


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, its lower case, its script."""
    points = range(0x110000)
    letter = np.fromiter((chr(c).isalpha() for c in points), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(letter):
        x = chr(c).lower()
        if len(x) == 1:
            lower[c] = ord(x)
    starts = np.array([s for s, _ in SCRIPTS])
    kind = np.array([NAMES.index(s) for _, s in SCRIPTS], np.uint8)
    return letter, lower, kind[np.searchsorted(starts, np.arange(0x110000), "right") - 1]


def letters_of(data: np.ndarray, off: np.ndarray):
    """Of rows end to end: trigram of each letter; each word's first letter (among letters), row, script, start and end (code points in the row)."""
    letter, lower, script = tables()
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    head = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=head[1:])
    edge = head[off]
    is_letter = letter[points]
    at = np.flatnonzero(is_letter)
    low = lower[points[at]].astype(np.uint64)
    row = np.searchsorted(edge, at, "right") - 1
    joined = np.zeros(len(at) + 1, bool)  # with the letter before
    if len(at):
        joined[1:-1] = (np.diff(at) == 1) & (np.diff(row) == 0)
    before, after = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    before[1:], after[:-1] = np.where(joined[1:-1], low[:-1], 0), np.where(joined[1:-1], low[1:], 0)
    gram = (mix(before * np.uint64(0x1F123BB5) + low * np.uint64(0x9E3779B97F4A7C15) + after * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS)).astype(np.int64)
    first = np.flatnonzero(~joined[:-1])
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    base = edge[row[first]] if len(first) else first
    return gram, first, row[first], script[points[at[first]]], at[first] - base, at[last] - base + 1


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray  # trigram x language, float32
    allowed: np.ndarray  # script x language
    base: np.ndarray  # trigram: what weight leaves out of the log probability
    typical: np.ndarray  # language: mean log probability of a letter of the training rows


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for part in slices(batches):
        data, off = buffer_of(part.column(1))
        gram, first, row, script, _, _ = letters_of(data, off)
        size = np.diff(np.append(first, len(gram)))
        langs = np.array(part.column(2).to_pylist(), object)
        letter_row, letter_script = np.repeat(row, size), np.repeat(script, size)
        for lang in sorted(set(langs)):
            mine = (langs == lang)[letter_row] if len(gram) else np.zeros(0, bool)
            have = total.setdefault(lang, np.zeros((1 << BITS) + len(NAMES), np.int64))
            have[: 1 << BITS] += np.bincount(gram[mine], minlength=1 << BITS)
            have[1 << BITS :] += np.bincount(letter_script[mine], minlength=len(NAMES))
    for lang, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], names=["lang", "slot", "n"])


def fit(docs: DataFrame, rows: int = TRAIN_DOCS) -> Model:
    """Learns from doc_id, text and lang of docs, which must hold only rows to learn from. What comes to the driver is bounded by the number of languages times the number of trigram slots."""
    known = docs.where("lang is not null")
    share = hash_sample(known, "doc_id", rows)
    part = share.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string"))
    got = part.mapInArrow(lean(_count), "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(got["lang"]))
    counts = np.zeros(((1 << BITS) + len(NAMES), max(len(langs), 1)))
    for k, lang in enumerate(langs):
        mine = got[got["lang"] == lang]
        counts[mine["slot"].to_numpy(), k] = mine["n"].to_numpy()
    grams, scripts = counts[: 1 << BITS], counts[1 << BITS :]
    logp = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * (1 << BITS)))
    weight = (logp - logp.mean(1, keepdims=True)).astype(np.float32)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed |= ~allowed.any(1, keepdims=True)
    base = logp.mean(1).astype(np.float32)
    return Model(langs, weight, allowed, base, (grams * logp).sum(0) / np.maximum(grams.sum(0), 1))


def _runs(score: np.ndarray, start: np.ndarray, length: np.ndarray, free: bool, switch: float):
    """Best sums of each run by label before it (one, without price, if free) and label at its end; and back pointers."""
    n, k = len(start), score.shape[1]
    ways = 1 if free else k
    best = np.zeros((n, ways, k), np.float32)
    back = np.zeros((int(length.max(initial=0)), n, ways, k), np.uint8)
    if not free and n:
        best -= np.float32(switch) * (1 - np.eye(k, dtype=np.float32))[None]
    for t in range(len(back)):
        m = int(np.searchsorted(-length, -t, "left"))  # longest first
        now = best[:m]
        if t:
            top = now.argmax(2)
            jump = np.take_along_axis(now, top[:, :, None], 2) - np.float32(switch)
            stay = now >= jump
            back[t, :m] = np.where(stay, np.arange(k, dtype=np.uint8), top[:, :, None].astype(np.uint8))
            now = np.where(stay, now, jump)
        best[:m] = now + score[start[:m] + t][:, None, :]
    return best, back


def viterbi(score: np.ndarray, row: np.ndarray, switch: float = SWITCH, run: int = RUN) -> np.ndarray:
    """The label of each word on the best path of its row; rows are consecutive."""
    w, k = score.shape
    if not w:
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    size = np.diff(np.append(first, w))
    parts = -(-size // run)
    owner = np.repeat(np.arange(len(first)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first[owner] + nth * run
    length = np.minimum(run, size[owner] - nth * run)
    groups = []
    for free in (True, False):
        mine = np.flatnonzero((nth == 0) == free)
        mine = mine[np.argsort(-length[mine], kind="stable")]
        groups.append((mine, *_runs(score, start[mine], length[mine], free, switch)))
    place = np.empty(len(owner), np.int64)
    for mine, _, _ in groups:
        place[mine] = np.arange(len(mine))
    total = np.zeros((len(owner), k), np.float32)
    came = np.zeros((len(owner), k), np.int64)
    head = np.cumsum(parts) - parts
    total[groups[0][0]] = groups[0][1][:, 0]
    for j in range(1, int(parts.max())):
        at = head[parts > j] + j
        ways = total[at - 1][:, :, None] + groups[1][1][place[at]]
        came[at], total[at] = ways.argmax(1), ways.max(1)
    end = np.zeros(len(owner), np.int64)
    end[head + parts - 1] = total[head + parts - 1].argmax(1)
    for j in range(int(parts.max()) - 1, 0, -1):
        at = head[parts > j] + j
        end[at - 1] = came[at, end[at]]
    label = np.empty(w, np.int64)
    for (mine, _, back), free in zip(groups, (True, False), strict=True):
        if not len(mine):
            continue
        here = end[mine].copy()
        way = np.zeros(len(mine), np.int64) if free else end[mine - 1]
        lens = length[mine]
        for t in range(len(back) - 1, -1, -1):
            m = int(np.searchsorted(-lens, -t, "left"))
            label[start[mine[:m]] + t] = here[:m]
            if t:
                here[:m] = back[t, np.arange(m), way[:m], here[:m]]
    return label


_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])


def label_rows(model: Model, data: np.ndarray, off: np.ndarray, switch: float = SWITCH):
    """Language and score of each row, and its spans as (row, language, start, end) arrays."""
    n, k = len(off) - 1, max(len(model.langs), 1)
    gram, first, row, script, start, end = letters_of(data, off)
    pred, share = np.full(n, -1), np.zeros(n)
    if not len(first) or not model.langs:
        z = np.zeros(0, np.int64)
        return pred, share, (z, z, z, z)
    score = np.add.reduceat(model.weight[gram], first, axis=0)
    score[~model.allowed[script]] -= 50
    label = viterbi(score, row, switch)
    size = np.diff(np.append(first, len(gram)))
    held = np.bincount(row * k + label, weights=size, minlength=n * k).reshape(n, k)
    some = held.sum(1) > 0
    pred[some] = held[some].argmax(1)
    share[some] = held[some].max(1) / held[some].sum(1)
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (label[1:] != label[:-1])))
    last = np.append(new[1:], len(row)) - 1
    return pred, share, (row[new], label[new], start[new], end[last])


def likeness(model: Model, data: np.ndarray, off: np.ndarray, pred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: how far its letters' mean log probability in its language lies under the training rows', and its number of letters."""
    n = len(off) - 1
    gram, first, row, _, _, _ = letters_of(data, off)
    if not len(first):
        return np.zeros(n), np.zeros(n, np.int64)
    at = np.repeat(row, np.diff(np.append(first, len(gram))))
    size = np.bincount(at, minlength=n)
    total = np.bincount(at, weights=model.weight[gram, pred[at]] + model.base[gram], minlength=n)
    return model.typical[pred] - total / np.maximum(size, 1), size


def _identify(model, switch: float, passing: tuple | None, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        names = np.array([*m.langs, "und"], object)
        for part in slices(batches, limit=1_000_000):
            data, off = buffer_of(part.column(part.schema.get_field_index("text")))
            pred, share, (row, lang, start, end) = label_rows(m, data, off, switch)
            if passing is not None:
                least, wanted, far = passing
                under, size = likeness(m, data, off, pred)
                ok = (pred >= 0) & (share >= least) & (under <= far + SPREAD / np.sqrt(np.maximum(size, 1)))
                yield part.filter(pa.array(ok & np.isin(pred, [i for i, x in enumerate(m.langs) if wanted is None or x in wanted])))
                continue
            spans = pa.nulls(part.num_rows, _OUT.field("spans").type)
            if with_spans:
                flat = pa.StructArray.from_arrays([pa.array(names[lang], pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], fields=list(_SPAN))
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32()), flat)
                spans = spans.cast(_OUT.field("spans").type)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[pred], pa.string()), pa.array(share), spans], schema=_OUT)

    return run


def may_learn(docs: DataFrame) -> DataFrame:
    """Rows outside the held-out fold."""
    return docs.where(~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, switch: float = SWITCH, with_spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score, spans (language, first and last code point of each)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs_of(docs).mapInArrow(lean(_identify(sent, switch, None, with_spans)), "doc_id long, lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>")


def keep(docs: DataFrame, model: Model, wanted: list[str] | None = None, least: float = LEAST_SHARE, far: float = FAR, switch: float = SWITCH) -> DataFrame:
    """The rows of docs, with all their columns, whose language is one of wanted (any learned one if None), holds at least
    that share of the letters, and is likely enough for text in it: mixtures, gibberish, languages that were never learned
    and texts without a letter go."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.where("text is not null").mapInArrow(lean(_identify(sent, switch, (least, wanted, far), False)), docs.schema)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = identify(docs, fit(may_learn(docs)))
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
