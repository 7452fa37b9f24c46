"""Reading level of texts from the grades at which their words are acquired.

* A word's acquisition grade is the interpolated median of its graded distribution: its mean relative frequency in the labelled texts of each level,
  each level weighing the same. Words of fewer than ``min_texts`` labelled texts have no grade.
* A text is described by quantiles (and the mean) of the grades of its known words; a ridge regression of the labels on these quantiles calibrates
  them, and the level is the calibrated score rounded to 1..5. The calibration is cross-fitted: each labelled text is described by grades learnt from the
  other folds of the sample, as a text without a label is, and the grades of all folds together score the corpus.
* English prose is text with at least ``min_words`` words of letters, mostly letters, whose words are largely known to the graded vocabulary, and
  whose stated language, if any, is English. Tables, logs and other languages fall out without a list of formats.

Distribution: the labelled sample is bounded (``max_labelled`` texts, those with the least hash of their id). Grades are aggregated by word with a map-side
combine; what reaches the driver is the graded vocabulary of that sample and its quantile rows, both bounded by the sample. Scoring is one Arrow pass over
the whole texts without a shuffle.

Defined results: null, empty and blank texts have 0 words, no score and no level; the same text always gets the same level; labels of unknown texts, null
labels and repeated label rows (of one text the greatest level) do no harm; without any labels nothing gets a level.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 5
QUANTILES = (0.1, 0.25, 0.4, 0.5, 0.6, 0.75, 0.9)
MAX_LABELLED = 20_000
MIN_TEXTS = 2
MIN_WORDS = 30
MIN_LETTERS = 0.6
MIN_KNOWN = 0.5
RIDGE = 1e-2
FOLDS = 5

_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->|<[!?][^<>]*>", re.DOTALL)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_SPACE = re.compile(r"\s+")
#: Marks without width that may stand inside a word.
_INVISIBLE = dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x00AD))


def plain(text: str) -> str:
    """Lower case without markup, entities, invisible marks and accents."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_INVISIBLE))
        text = "".join(c for c in text if not unicodedata.combining(c)).replace("’", "'")
    return text


def words(text: str | None) -> tuple[list[str], float]:
    """Words of letters and the share of letters among the visible characters."""
    if not text:
        return [], 0.0
    text = plain(text)
    found = _WORD.findall(text)
    visible = len(_SPACE.sub("", text))
    return found, sum(map(len, found)) / visible if visible else 0.0


@dataclass
class Model:
    """Grades by word and the calibration of quantiles; ``beta`` is empty if there was nothing to learn from."""

    grades: dict[str, float]
    center: np.ndarray = field(default_factory=lambda: np.zeros(0))
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def describe(self, found: list[str]) -> tuple[np.ndarray | None, int]:
        """Quantiles and mean of the grades of the known words, and how many there are."""
        get = self.grades.get
        known = [g for w in found if (g := get(w)) is not None]
        if not known:
            return None, 0
        a = np.sort(np.array(known))
        at = np.array(QUANTILES) * (len(a) - 1)
        low = at.astype(int)
        high = np.minimum(low + 1, len(a) - 1)
        return np.append(a[low] + (a[high] - a[low]) * (at - low), a.mean()), len(a)

    def score(self, described: np.ndarray | None) -> float | None:
        if described is None or not len(self.beta):
            return None
        return float(self.beta[0] + (described - self.center) @ self.beta[1:])


def grade(mean_share: np.ndarray) -> np.ndarray:
    """Interpolated median level of each row of weights by level."""
    p = mean_share / mean_share.sum(axis=1, keepdims=True)
    upto = np.cumsum(p, axis=1)
    k = (upto < 0.5 - 1e-12).sum(axis=1).clip(max=p.shape[1] - 1)
    rows = np.arange(len(p))
    before = np.where(k > 0, upto[rows, np.maximum(k - 1, 0)], 0.0)
    return k + 0.5 + (0.5 - before) / np.maximum(p[rows, k], 1e-12)


def calibrate(described: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Center and ridge coefficients of labels on quantiles."""
    center = described.mean(axis=0)
    a = np.column_stack([np.ones(len(described)), described - center])
    penalty = RIDGE * np.eye(a.shape[1])
    penalty[0, 0] = 0
    return center, np.linalg.solve(a.T @ a + penalty, a.T @ labels)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        level, fold, out_level, out_fold, out_word, out_share = batch.column("level").to_pylist(), batch.column("fold").to_pylist(), [], [], [], []
        for lv, f, text in zip(level, fold, batch.column("text").to_pylist(), strict=True):
            found = words(text)[0]
            for w, k in Counter(found).items():
                out_level.append(lv)
                out_fold.append(f)
                out_word.append(w)
                out_share.append(k / len(found))
        yield pa.RecordBatch.from_arrays([pa.array(out_word, pa.string()), pa.array(out_level, pa.int32()), pa.array(out_fold, pa.int32()), pa.array(out_share, pa.float64())], names=["word", "level", "fold", "share"])


def _graded(names: list[str], texts: np.ndarray, sums: np.ndarray, sizes: np.ndarray, min_texts: int) -> dict[str, float]:
    """Grades of the words of at least ``min_texts`` texts; ``sums`` has a row per word and a column per level."""
    weights = sums / np.maximum(sizes, 1)
    fit = np.flatnonzero((texts >= min_texts) & (weights.sum(axis=1) > 0))
    return dict(zip([names[i] for i in fit], np.round(grade(weights[fit]), 4).tolist(), strict=True)) if len(fit) else {}


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, min_texts: int = MIN_TEXTS, folds: int = FOLDS) -> Model:
    """The model of a bounded labelled sample. ``docs`` has (doc_id, text), ``labels`` has (doc_id, reading_level)."""
    known = labels.filter(f"doc_id is not null and reading_level between 1 and {LEVELS}").groupBy("doc_id").agg(F.max("reading_level").cast("int").alias("level"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(folds)).cast("int"))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("level", "fold", "text")  # at most max_labelled small rows
    texts = texts.persist(StorageLevel.DISK_ONLY)
    shared = None
    try:
        sizes = np.zeros((folds, LEVELS))
        for r in texts.groupBy("fold", "level").agg(F.count("*").alias("n")).collect():  # a row per fold and level
            sizes[r["fold"], r["level"] - 1] = r["n"]
        if not sizes.any():
            return Model({})
        parts = [F.sum(F.when((F.col("level") == lv) & (F.col("fold") == f), F.col("share")).otherwise(0.0)).alias(f"s{f}_{lv}") for f in range(folds) for lv in range(1, LEVELS + 1)]
        counts = [F.count_if(F.col("fold") == f).alias(f"n{f}") for f in range(folds)]
        table = texts.mapInArrow(_shares, "word string, level int, fold int, share double").groupBy("word").agg(F.count("*").alias("texts"), *counts, *parts).filter(F.col("texts") >= min_texts).toArrow()
        names = table.column("word").to_pylist()
        seen_in = np.column_stack([table.column(f"n{f}").to_numpy() for f in range(folds)]).reshape(len(names), folds)
        sums = np.column_stack([table.column(f"s{f}_{lv}").to_numpy() for f in range(folds) for lv in range(1, LEVELS + 1)]).reshape(len(names), folds, LEVELS)
        model = Model(_graded(names, seen_in.sum(axis=1), sums.sum(axis=1), sizes.sum(axis=0), min_texts))
        apart = [Model(_graded(names, seen_in.sum(axis=1) - seen_in[:, f], sums.sum(axis=1) - sums[:, f], sizes.sum(axis=0) - sizes[f], min_texts)) for f in range(folds)]
        columns = [f"f{i}" for i in range(len(QUANTILES) + 1)]
        shared = docs.sparkSession.sparkContext.broadcast(apart)

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                each = zip(batch.column("level").to_pylist(), batch.column("fold").to_pylist(), batch.column("text").to_pylist(), strict=True)
                rows = [(lv, d) for lv, f, t in each if (d := own[f].describe(words(t)[0])[0]) is not None]
                values = np.array([d for _, d in rows]).reshape(len(rows), len(columns))
                yield pa.RecordBatch.from_arrays([pa.array([lv for lv, _ in rows], pa.int32()), *[pa.array(values[:, i]) for i in range(len(columns))]], names=["level", *columns])

        seen = texts.mapInArrow(describe, "level int, " + ", ".join(f"{n} double" for n in columns)).toArrow()
    finally:
        texts.unpersist()
        if shared is not None:
            shared.unpersist()
    if seen.num_rows:
        x = np.column_stack([seen.column(n).to_numpy() for n in columns])
        y = seen.column("level").to_numpy().astype(float)
        order = np.lexsort([*x.T, y])  # sums in one order, whatever order the rows came in
        model.center, model.beta = calibrate(x[order], y[order])
    return model


def levels(docs: DataFrame, model: Model, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, known_share, letter_share, english_prose, score, level) of each text; ``docs`` has (doc_id, text, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out: list[tuple] = []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found, letters = words(text)
                described, known = own.describe(found)
                score = own.score(described)
                share = known / len(found) if found else 0.0
                english = lang is None or lang.strip().lower()[:2] in ("en", "")
                prose = english and len(found) >= min_words and letters >= MIN_LETTERS and share >= MIN_KNOWN
                out.append((len(found), share, letters, prose, score, None if score is None else int(min(LEVELS, max(1, round(score))))))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.bool_(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", "n_words", "known_share", "letter_share", "english_prose", "score", "level"])

    schema = f"doc_id {kind}, n_words int, known_share double, letter_share double, english_prose boolean, score double, level int"
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(run, schema)
