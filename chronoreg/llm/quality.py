"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (toxic), 1 (poor) and 2 (good). One weight vector over hashed words is shared by all grades; ordered
thresholds cut its score: P(grade <= k) = sigmoid(threshold_k - score). So each document gets an expected grade and
the tail probabilities P(grade >= 1) and P(grade >= 2), by which documents are selected.

The model is fitted in the driver on a bounded sample of labelled rows, `TRAIN_ROWS`, taken by the order of a hash of
doc_id; the sample's hashed words are all that is collected. Scoring is one pass of tasks over whole texts, without a
shuffle.

Defined results: a null or empty text, or one without known words, is judged by the thresholds alone; labels without
both ratings are left out; repeated rows are scored each; without any labelled row nothing is rejected; other columns
are kept by :func:`keep_good` and ignored by :func:`score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common

GRADES = 3
#: Hashed words, labelled rows used for fitting, and the rows of these that must hold a word for it to get a weight.
BITS = 18
TRAIN_ROWS = 12_000
LEAST_ROWS = 12
STEPS = 200
PENALTY = 8.0  # of a whole sample: few rows are held back more than many
PULL = 0.3  # holds the thresholds near the shares of the grades
#: P(grade >= 2) from which a document is kept.
KEEP = 0.6

_SOLID = np.zeros(256, bool)  # letters and digits, and every byte of a character beyond ASCII
for _low, _high in ((48, 58), (97, 123), (128, 256)):
    _SOLID[_low:_high] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: tuple[float, float]

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= 1) and P(grade >= 2), a column each."""
        return 1 / (1 + np.exp(np.clip(np.asarray(self.thresholds)[None, :] - score[:, None], -500, 500)))


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed features of each row, row by row, and each row's offsets into them.

    A word gives two: itself without what trails its last letter or digit, and that trail. One more tells the order
    of magnitude of words that repeat the word before.
    """
    data, offsets = common.buffer(column)
    data = common.lowered(data)
    starts, ends, rows = common.word_spans(data, offsets)
    solid = np.maximum.accumulate(np.where(_SOLID[data], np.arange(1, len(data) + 1), 0)) if len(data) else np.zeros(0, np.int64)
    cores = np.clip(solid[ends - 1], starts, ends)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    has_core, has_trail = cores > starts, cores < ends
    words = common.span_hashes(data, starts, cores)[has_core]
    trails = ~common.span_hashes(data, cores, ends)[has_trail]
    again = np.flatnonzero((row[1:] == row[:-1]) & (ends - starts == np.roll(ends - starts, -1))[:-1]) if len(row) > 1 else np.zeros(0, np.int64)
    whole = common.span_hashes(data, starts, ends)
    again = np.bincount(row[again[whole[again] == whole[again + 1]]], minlength=len(rows) - 1)
    repeats = common.mix(np.log2(again[again > 0]).astype(np.uint64) + np.uint64(1))
    slots = (np.concatenate([words, trails, repeats]) >> np.uint64(64 - BITS)).astype(np.int64)
    keys = np.unique((np.concatenate([row[has_core], row[has_trail], np.flatnonzero(again)]) << BITS) | slots)
    return keys & ((1 << BITS) - 1), np.searchsorted(keys >> BITS, np.arange(len(rows)))


def fit(slots: np.ndarray, offsets: np.ndarray, grades: np.ndarray) -> Model:
    """Minimises the mean negative log-likelihood and an L2 penalty by Adam over all rows at once."""
    n = len(grades)
    if not n:
        return Model(np.zeros(1 << BITS, np.float32), (-40.0, -39.0))
    common_ = np.bincount(slots, minlength=1 << BITS) >= min(LEAST_ROWS, n)
    number = np.cumsum(common_) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    used = common_[slots]
    row, col = row[used], number[slots[used]]
    size = int(common_.sum())
    share = np.clip(np.bincount(grades, minlength=GRADES).cumsum()[:-1] / n, 1e-3, 1 - 1e-3)
    low = float(np.log(share[0] / (1 - share[0])))
    gap = float(np.log(max(np.log(share[1] / (1 - share[1])) - low, 0.1)))
    prior = (low, gap)  # so that a text without known words is judged by the share of each grade
    params = np.concatenate([np.zeros(size), prior])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, (low, gap) = params[:size], params[size:]
        score = np.bincount(row, weights=weights[col], minlength=n)
        cuts = np.array([-np.inf, low, low + np.exp(gap), np.inf])
        below, above = (1 / (1 + np.exp(np.clip(score - cuts[grades + i], -500, 500))) for i in (0, 1))
        inside = np.maximum(above - below, 1e-12)
        slope = (1 - above - below) / n  # of the loss by the score
        by_above, by_below = -above * (1 - above) / inside / n, below * (1 - below) / inside / n
        by_cut = [by_above[grades == k].sum() + by_below[grades == k + 1].sum() for k in range(GRADES - 1)]
        gradient = np.concatenate([np.bincount(col, weights=slope[row], minlength=size) + PENALTY / n * weights, [sum(by_cut) + PULL * (low - prior[0]), by_cut[1] * np.exp(gap) + PULL * (gap - prior[1])]])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        params = params - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    out = np.zeros(1 << BITS, np.float32)
    out[common_] = params[:size]
    return Model(out, (float(params[size]), float(params[size] + np.exp(params[size + 1]))))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fits on at most `rows` labelled documents."""
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .selectExpr("CAST(doc_id AS LONG) AS doc_id", "CASE WHEN toxic > 0 THEN 0 WHEN quality > 0 THEN 2 ELSE 1 END AS grade")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade")
        .limit(rows)
    )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            slots, offsets = _features(part.column(0))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(slots.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, part.column(1)], ["slots", "grade"])

    # The sample is bounded by `rows`, so it may be broadcast and its features collected.
    found = common.texts(docs).join(F.broadcast(sample), "doc_id").select("text", "grade").mapInArrow(kernel, "slots array<int>, grade int").toArrow()
    lists = found.column("slots").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    offsets = np.asarray(lists.offsets, np.int64) if len(lists) else np.zeros(1, np.int64)
    return fit(np.asarray(lists.flatten(), np.int64), offsets - offsets[0], np.asarray(found.column("grade"), np.int64))


def _tails(model: Model, column: pa.Array) -> np.ndarray:
    slots, offsets = _features(column)
    total = np.concatenate([[0.0], np.cumsum(model.weights[slots], dtype=np.float64)])
    return model.tails(total[offsets[1:]] - total[offsets[:-1]])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, expected_grade, p_fair, p_good): the expected grade, P(grade >= 1) and P(grade >= 2)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights, whatever the corpus

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            tails = _tails(shared.value, part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x) for x in (tails.sum(axis=1), tails[:, 0], tails[:, 1]))],
                ["doc_id", "expected_grade", "p_fair", "p_good"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(kernel, "doc_id long, expected_grade double, p_fair double, p_good double")


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of docs, unchanged, that are good with a probability of `keep` at least."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            yield part.filter(pa.array(_tails(shared.value, part.column(at))[:, 1] >= keep))

    return docs.mapInArrow(kernel, docs.schema)
