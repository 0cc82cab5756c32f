"""Substring dedup on words by level-wise doubling.

A window is `window` consecutive words of one document. Windows are looked at in lengths that double: `START` words,
twice as many, and so on below the asked length. A window's name at one length is made of the two names that it holds
at half that length; the asked length's, of two overlapping ones. At each length every asked window that is still a
candidate chooses the least name of that length inside it, so equal windows choose equal names, and only chosen names
are compared. A window whose chosen name one document alone holds ends there; what repeats is looked at in twice the
length, until the asked one is reached or no candidate survives. A window that also starts in a smaller document is
covered, and its words are removed. START is long enough that few windows repeat by chance: at one, two or four words
nearly all do, and nothing would end there.

Each level compares names by :mod:`exchange`, so a passage in a third of all documents meets in no single group. The
levels before the last send six bytes of a name, as they only pick candidates; the last one decides by all 64 bits.

Defined results: null or empty texts have no words and nothing removed; a document shorter than a window keeps its
words; of repeated rows of a doc_id the least text stays; rows without a doc_id take no part; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common, exchange

WINDOW = 13
#: Words of the first length.
START = 7
_CANDIDATE_BYTES = 6


def lengths(window: int) -> list[int]:
    """The lengths that are looked at before the asked one; the last is at least half of it."""
    out = [min(START, (window + 1) // 2)]
    while 2 * out[-1] < window:
        out.append(2 * out[-1])
    return out


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = common.buffer(column)
    starts, ends, rows = common.word_spans(data, offsets)
    return data, starts, ends, rows, common.span_hashes(data, starts, ends)


def _pair(names: np.ndarray, step: int) -> np.ndarray:
    """Names of what each name and the one `step` places on cover together."""
    one, two = names[: max(len(names) - step, 0)], names[step:]
    return common.mix(common.mix(one) + two * np.uint64(0xD6E8FEB86659FD93))


def names_of(hashes: np.ndarray, window: int, levels: list[int]) -> list[np.ndarray]:
    """The names of all windows of each level's length, and of the asked length."""
    out = [common.gram_hashes(hashes, levels[0])]
    for length in levels[1:]:
        out.append(_pair(out[-1], length // 2))
    return [*out, _pair(out[-1], window - levels[-1])]


def _survivors(names: list[np.ndarray], rows: np.ndarray, window: int, levels: list[int], lists: list[pa.Array]) -> np.ndarray:
    """Whether each window's chosen names are all in its row's lists, for as many levels as there are lists."""
    alive = np.ones(max(len(rows) and int(rows[-1]) - window + 1, 0), bool)
    for length, own, keys in zip(levels, names, lists, strict=False):
        row, place, first, last = exchange.runs(own, rows, window, length)
        some = exchange.member(row, exchange.cut(own[place], _CANDIDATE_BYTES), keys, _CANDIDATE_BYTES)
        edges = np.zeros(len(alive) + 1, np.int64)
        np.add.at(edges, first[some], 1)
        np.subtract.at(edges, last[some] + 1, 1)
        alive &= np.cumsum(edges[:-1]) > 0
    return alive


def _chosen(names: np.ndarray, rows: np.ndarray, window: int, length: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and chosen name of each run of windows that has one alive."""
    row, place, first, last = exchange.runs(names, rows, window, length)
    before = np.concatenate([[0], np.cumsum(alive)])
    some = before[last + 1] > before[first] if len(row) else np.zeros(0, bool)
    return row[some], names[place[some]]


def covered_windows(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Candidates (doc_id, packed text) and, for some of them, (doc_id, keys): names of windows that a smaller document holds."""
    count, levels = exchange.buckets(docs), lengths(window)

    def send(level: int):
        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in common.unpacked(batches) if level else common.slices(batches):
                _, _, _, rows, hashes = _words(part.column(1))
                names, docs_ = names_of(hashes, window, levels), np.asarray(part.column(0))
                alive = _survivors(names, rows, window, levels, part.columns[2:])
                if level < len(levels):
                    row, keys = _chosen(names[level], rows, window, levels[level], alive)
                    yield exchange.messages(keys, docs_[row], count, _CANDIDATE_BYTES)
                else:
                    starts = np.flatnonzero(alive)
                    yield exchange.messages(names[-1][starts], docs_[np.searchsorted(rows, starts, side="right") - 1], count, 8)

        return kernel

    candidates = docs
    for level in range(len(levels)):
        repeated = exchange.merge(candidates.mapInArrow(send(level), exchange.MESSAGE), _CANDIDATE_BYTES, later=False)
        lists = repeated.groupBy("doc_id").agg(F.collect_list("keys").alias(f"keys_{level}"))
        texts = candidates if level else common.packed_texts(docs)
        candidates = common.stage(texts.join(lists, "doc_id"))
        if level + 1 < len(levels) and not candidates.head(1):
            break  # no candidate survives, so no window is held twice
    else:
        covered = exchange.merge(candidates.mapInArrow(send(len(levels)), exchange.MESSAGE), 8, later=True)
        return candidates.select("doc_id", "text"), covered
    return candidates.select("doc_id", "text"), docs.sparkSession.createDataFrame([], exchange.ANSWER)


def _kept(hashes: np.ndarray, rows: np.ndarray, keys: pa.Array | None, window: int) -> np.ndarray:
    """Whether each word is kept."""
    inside = np.zeros(len(hashes) + 1, np.int64)
    if keys is not None:
        grams = names_of(hashes, window, lengths(window))[-1]
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[: len(grams)]
        starts = np.flatnonzero(np.arange(len(grams)) + window <= rows[1:][row])
        starts = starts[exchange.member(row[starts], grams[starts], keys, 8)]
        np.add.at(inside, starts, 1)
        np.subtract.at(inside, starts + window, 1)
    return np.cumsum(inside[:-1]) == 0


def _cleaned(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text), or with keys of rows (doc_id, packed text, keys)."""
    keyed = "keys" in rows.columns

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.unpacked(batches) if keyed else common.slices(batches):
            data, starts, ends, words, hashes = _words(part.column(1))
            kept = _kept(hashes, words, part.column(2) if keyed else None, window)
            raw = data.tobytes()
            texts = []
            for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
                chosen = kept[a:b]
                texts.append(b" ".join(raw[x:y] for x, y in zip(starts[a:b][chosen].tolist(), ends[a:b][chosen].tolist(), strict=True)))
            before = np.concatenate([[0], np.cumsum(~kept)])
            removed = before[words[1:]] - before[words[:-1]]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(words)), pa.array(removed), pa.array([t.decode() for t in texts], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return rows.mapInArrow(kernel, "doc_id long, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document: its words without covered ones, joined by a space."""
    docs = common.one_row_each(docs)
    candidates, covered = covered_windows(docs, window)
    lists = covered.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    changed = _cleaned(candidates.join(lists, "doc_id"), window)
    return _replaced(_cleaned(docs, window), changed)


def _replaced(rows: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows, with those of `changed` in place of the ones with the same doc_id."""
    other = changed.select("doc_id", F.struct(*changed.columns[1:]).alias("other"))
    names = [F.coalesce(F.col("other")[c], F.col(c)).alias(c) for c in rows.columns[1:]]
    return rows.join(other, "doc_id", "left").select("doc_id", *names)


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The contract's columns: as remove_repeats(), with the kept words' SHA-256."""
    docs = common.one_row_each(docs)
    candidates, covered = covered_windows(docs, window)
    lists = covered.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    hashed = lambda rows: _cleaned(rows, window).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return _replaced(hashed(docs), hashed(candidates.join(lists, "doc_id")))
