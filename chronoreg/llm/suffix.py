"""Substring dedup on bytes by deep-shallow suffix sorting.

A window is `window` consecutive bytes of one document. Sorting every suffix of a corpus would move each byte many
times, so a suffix is only sorted where another document holds something alike: each window chooses the gram (half a
window) with the least hash inside it, and grams that one document alone holds end there. Windows that chose one gram
are neighbours; the stretch of text that they cover is their run. A run that a smaller document holds in whole is
covered. What remains is one document for each distinct run; where several share a gram, their windows are ordered as
suffixes: a multikey quicksort on eight bytes at a time goes to a shallow depth, and blind tries order the groups
that are still tied down to the window's length. Windows that are equal there meet, and all but those of their
smallest document are covered.

A gram's runs meet in one bucket with one message a slice and distinct run, so copies and frequent passages add
nothing to it. A gram with more than `HOT` distinct runs (a phrase in very many documents, with other text around it)
would fill its bucket all the same: its runs are not sent there, but their windows one by one to the bucket of the
window's own bytes, and of equal windows of a slice only the smallest document's. So no sort takes more than the
windows that a hash deals to it and one window a slice of those that are equal. Bytes decide in every sort; a run that
is covered as a whole is known by 64 bits. Defined results: null or empty texts have nothing removed; texts shorter than a window stay; of repeated
rows of a doc_id the least text stays; rows without a doc_id take no part; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common, exchange

WINDOW = 50
#: Bytes that the multikey quicksort looks at; a multiple of eight.
SHALLOW = 16
_PART_BYTES = 1 << 18
_CANDIDATE_BYTES = 6
_KEY_BYTES = 8
_ANSWER_BYTES = 12  # a run's key, and a bit for each of its windows that is covered
_ALL, _ASK = 0xFFFFFFFF, 0
#: A run has window - gram + 1 windows at most, which must fit the mask.
MOST_WINDOW = 60
#: The mask of runs whose windows are dealt one by one; no window has this bit.
_DEAL = 1 << 31
#: Distinct runs of a gram that one bucket takes together.
HOT = 4096
_SENT = "bucket int, docs binary, keys binary, sizes binary, shifts binary, data binary"


def _found(column: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram's hash, gram's place, first window, last window) of each run of a slice of texts.

    Places are in the slice's bytes.  Rows are taken a few at a time, so that the arrays stay in the processor's cache.
    """
    data, offsets = common.buffer(column)
    gram = (window + 1) // 2
    parts, at = [], 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _PART_BYTES, side="right")) - 1)
        own = offsets[at : to + 1] - offsets[at]
        grams = common.byte_grams(data[offsets[at] : offsets[to]], gram)
        row, place, first, last = exchange.runs(grams, own, window, gram)
        parts.append((row + at, grams[place] if len(place) else np.zeros(0, np.uint64), *(x + offsets[at] for x in (place, first, last))))
        at = to
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


_RUN = np.dtype([("first", "<u4"), ("place", "u1"), ("last", "u1")])


class _Runs:
    """The runs that a slice of candidates (doc_id, text, runs) names, a packed list for each row."""

    def __init__(self, part: pa.RecordBatch, window: int):
        self.data, self.offsets = common.buffer(part.column(1))
        lists = part.column(2)
        sizes = [len(x.as_buffer()) // _RUN.itemsize for x in lists]
        runs = np.frombuffer(b"".join(x.as_py() for x in lists), _RUN)
        self.row = np.repeat(np.arange(len(lists)), sizes)
        self.first = runs["first"].astype(np.int64) + self.offsets[self.row]
        self.place, self.last = self.first + runs["place"], self.first + runs["last"]
        self.ends = self.last + window
        self.hashed = common.Spans(self.data)
        self.key = self.hashed(self.first, self.ends)
        self._gram = (window + 1) // 2

    def grams(self, some=slice(None)) -> np.ndarray:
        return self.hashed(self.place[some], self.place[some] + self._gram)


def _judge(sent: DataFrame, hot: int) -> DataFrame:
    """(doc_id, keys): runs that a smaller document holds (_ALL), and those to be compared window by window, either all
    of a gram together (_ASK) or, where it has more than `hot` of them, dealt by their windows (_DEAL)."""

    def kernel(table: pa.Table) -> pa.Table:
        parts: list[tuple] = [(np.zeros((0, 14), np.uint8), np.zeros(0, np.int64))]
        through: list[tuple] = []
        for _, kind, first, docs, keys in zip(*(c.to_pylist() for c in table.columns), strict=True):
            (through if kind == exchange.FOLLOWER else parts).append((np.frombuffer(keys, np.uint8).reshape(-1, 14), exchange.delta_docs(first, docs)))
        raw, docs = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        gram = exchange.unpacked(raw[:, 8:].tobytes(), 6)
        key = np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()
        order = np.lexsort((docs, key, gram))
        gram, key, docs = gram[order], key[order], docs[order]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])]) if len(gram) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        least = docs[heads][np.cumsum(new) - 1] if len(gram) else docs
        later = docs > least
        # Of the distinct runs of a gram, in their smallest documents, those of one gram that differ in run and document.
        group = np.cumsum(np.concatenate([[True], np.diff(gram[heads]) != 0])) - 1 if len(heads) else heads
        low, high = (np.full(int(group[-1]) + 1 if len(group) else 0, v) for v in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
        np.minimum.at(low, group, docs[heads])
        np.maximum.at(high, group, docs[heads])
        mixed = heads[(low < high)[group]] if len(heads) else heads
        many = (np.bincount(group) > hot)[group][(low < high)[group]] if len(heads) else np.zeros(0, bool)
        all_docs = np.concatenate([docs[later], docs[mixed], *(d for _, d in through)])
        all_keys = np.concatenate([key[later], key[mixed], *(np.ascontiguousarray(r[:, :8]).view("<u8").ravel() for r, _ in through)])
        masks = np.full(len(all_docs), _ALL, "<u4")
        masks[later.sum() : later.sum() + len(mixed)] = np.where(many, _DEAL, _ASK)
        return pa.Table.from_batches([exchange.answers(all_docs, _answer(all_keys, masks))])

    return sent.groupBy("bucket").applyInArrow(kernel, exchange.ANSWER)


def _answer(keys: np.ndarray, masks: np.ndarray) -> np.ndarray:
    return np.concatenate([keys.astype("<u8").view(np.uint8).reshape(-1, 8), masks.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1)


def _answered(found: _Runs, lists: pa.Array) -> np.ndarray:
    """The mask of each run, as far as the packed answers of its row name it (else _ASK)."""
    flat = lists.flatten()
    owner = np.repeat(np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets))), [len(x.as_buffer()) // _ANSWER_BYTES for x in flat])
    raw = np.frombuffer(b"".join(x.as_py() for x in flat), np.uint8).reshape(-1, _ANSWER_BYTES)
    key = np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()
    mask = np.ascontiguousarray(raw[:, 8:]).view("<u4").ravel()
    # Equal (row, key) get one number; a run may be named twice, then its masks add up.
    names = np.zeros(len(key) + len(found.key), dtype=[("row", np.int64), ("key", np.uint64)])
    names["row"], names["key"] = np.concatenate([owner, found.row]), np.concatenate([key, found.key])
    distinct, number = np.unique(names, return_inverse=True)
    total = np.zeros(len(distinct), np.uint32)
    np.bitwise_or.at(total, number[: len(key)], mask)
    named = np.zeros(len(distinct), bool)
    named[number[: len(key)]] = True
    own = number[len(key) :]
    found.named = named[own]
    return total[own]


def _send_runs(batches: Iterator[pa.RecordBatch], window: int, count: int) -> Iterator[pa.RecordBatch]:
    """The text of each run that is to be compared, once for each document; or of its windows, where they are dealt.

    A window's shift is its place in its run. One that a smaller document of the slice holds has no text: it is covered.
    """
    for part in common.unpacked(batches):
        found = _Runs(part, window)
        masks, ids = _answered(found, part.column(3)), np.asarray(part.column(0))
        once = np.zeros(len(found.key), bool)
        once[np.unique(np.stack([found.row.astype(np.uint64), found.key], axis=1), axis=0, return_index=True)[1]] = True
        asked = np.flatnonzero((masks == _ASK) & found.named & once)
        dealt = np.flatnonzero((masks & np.uint32(_DEAL) > 0) & (masks != _ALL) & once)
        starts, which = exchange.ranges(found.first[dealt], found.last[dealt])
        docs = ids[found.row[dealt]][which]
        own = np.ascontiguousarray(found.data[starts[:, None] + np.arange(window)]).view(f"V{window}").ravel() if len(starts) else np.zeros(0, f"V{window}")
        _, number = np.unique(own, return_inverse=True)
        least = np.full(int(number.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, number, docs)
        covered = docs > least[number]
        by_window = (found.hashed(starts, starts + window) % np.uint64(count)).astype(np.int64)
        bucket = np.concatenate([(found.grams(asked) % np.uint64(count)).astype(np.int64), np.where(covered, docs % count, by_window)])
        first = np.concatenate([found.first[asked], starts])
        sizes = np.concatenate([(found.ends - found.first)[asked], np.where(covered, 0, window)])
        shifts = np.concatenate([np.zeros(len(asked), np.int64), starts - found.first[dealt][which]])
        docs, keys = np.concatenate([ids[found.row[asked]], docs]), np.concatenate([found.key[asked], found.key[dealt][which]])
        order = np.argsort(bucket, kind="stable")
        bucket, first, sizes, shifts, docs, keys = (x[order] for x in (bucket, first, sizes, shifts, docs, keys))
        places, _ = exchange.ranges(first, first + sizes - 1)
        raw, before = found.data[places].tobytes(), np.concatenate([[0], np.cumsum(sizes)])
        edges = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
        rows = [
            (int(bucket[a]), docs[a:b].tobytes(), keys[a:b].tobytes(), sizes[a:b].astype("<u4").tobytes(), shifts[a:b].astype("u1").tobytes(), raw[before[a] : before[b]])
            for a, b in pairwise(edges)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        types = (pa.int32(), *[pa.binary()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in _SENT.split(", ")])


def shallow_groups(text: np.ndarray, suffixes: np.ndarray, depth: int) -> list[np.ndarray]:
    """The suffixes ordered by their first `depth` bytes, in groups that agree on these.

    A multikey quicksort whose characters are eight bytes: all groups of a level are partitioned by one sort.
    """
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    group = np.zeros(len(suffixes), np.int64)
    order = np.arange(len(suffixes))
    for at in range(0, depth, 8):
        character = np.zeros(len(suffixes), np.uint64)
        for i in range(8):
            character = (character << np.uint64(8)) | padded[suffixes + at + i].astype(np.uint64)
        order = order[np.lexsort((character[order], group[order]))]
        new = np.concatenate([[False], (np.diff(group[order]) != 0) | (np.diff(character[order]) != 0)])
        group[order] = np.cumsum(new)
    edges = np.flatnonzero(np.diff(group[order])) + 1
    return np.split(suffixes[order], edges) if len(order) else []


class BlindTrie:
    """Orders suffixes that agree on their first bytes: inner nodes know the depth at which they branch, and no text.

    An inner node is (depth, {byte: child}), a leaf the list of the suffixes that agree down to `limit`.
    """

    def __init__(self, text: bytes, limit: int):
        self._text, self._limit, self._root = text, limit, None

    def _string(self, suffix: int) -> bytes:
        return self._text[suffix : suffix + self._limit]

    def add(self, suffix: int) -> None:
        if self._root is None:
            self._root = [suffix]
            return
        own = self._string(suffix)
        node = self._root
        while isinstance(node, tuple):  # blindly: only the branching bytes are looked at
            children = node[1]
            node = children.get(own[node[0]]) or next(iter(children.values()))
        other = self._string(node[0])
        if own == other:
            node.append(suffix)
            return
        apart = self._limit - ((int.from_bytes(own) ^ int.from_bytes(other)).bit_length() + 7) // 8
        above, node = None, self._root
        while isinstance(node, tuple) and node[0] < apart:
            above, node = node, node[1][own[node[0]]]
        if isinstance(node, tuple) and node[0] == apart:
            node[1][own[apart]] = [suffix]
            return
        branch = (apart, {other[apart]: node, own[apart]: [suffix]})
        if above is None:
            self._root = branch
        else:
            above[1][own[above[0]]] = branch

    def leaves(self) -> Iterator[list[int]]:
        """The groups of equal suffixes in order."""
        stack = [self._root] if self._root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node


def sorted_groups(text: np.ndarray, suffixes: np.ndarray, window: int, shallow: int = SHALLOW) -> Iterator[list[int]]:
    """The suffixes, each with `window` bytes, in order and in groups that agree on all of these."""
    raw = text.tobytes()
    for group in shallow_groups(text, suffixes, min(shallow, window // 8 * 8)):
        if len(group) == 1:
            yield group.tolist()
            continue
        if len(group) == 2:
            one, two = (raw[x : x + window] for x in group.tolist())
            yield from [group.tolist()] if one == two else [[x] for x in (group if one < two else group[::-1]).tolist()]
            continue
        trie = BlindTrie(raw, window)
        for suffix in group.tolist():
            trie.add(suffix)
        yield from trie.leaves()


def _compare(sent: DataFrame, window: int) -> DataFrame:
    """(doc_id, keys): the runs' windows that a smaller document holds."""

    def kernel(table: pa.Table) -> pa.Table:
        columns = (("docs", np.int64), ("keys", np.uint64), ("sizes", "<u4"), ("shifts", "u1"))
        docs, keys, sizes, shifts = (np.concatenate([np.frombuffer(x.as_py(), t) for x in table.column(c)]) for c, t in columns)
        text = np.frombuffer(b"".join(x.as_py() for x in table.column("data")), np.uint8)
        masks = np.zeros(len(docs), np.uint32)
        masks[sizes == 0] = np.uint32(1) << shifts[sizes == 0].astype(np.uint32)  # covered in their slice
        real = np.flatnonzero(sizes)
        begins = (np.cumsum(sizes.astype(np.int64)) - sizes)[real]
        suffixes, run = exchange.ranges(begins, begins + sizes[real] - window)
        owner = np.zeros(len(text), np.int64)
        owner[suffixes] = run
        for group in sorted_groups(text, suffixes, window):
            if len(group) > 1:
                members = [(int(docs[real[owner[s]]]), s) for s in group]
                least = min(members)[0]
                for doc, suffix in members:
                    if doc > least:
                        at = owner[suffix]
                        masks[real[at]] |= np.uint32(1 << (suffix - int(begins[at]) + int(shifts[real[at]])))
        some = masks > 0
        return pa.Table.from_batches([exchange.answers(docs[some], _answer(keys[some], masks[some]))])

    return sent.groupBy("bucket").applyInArrow(kernel, exchange.ANSWER)


def _covered(part: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slice's bytes, each row's offsets, and whether each byte is covered."""
    found = _Runs(part, window)
    masks = _answered(found, part.column(3))
    some = masks > 0
    starts, which = exchange.ranges(found.first[some], found.last[some])
    bit = starts - found.first[some][which]
    starts = starts[(masks[some][which] >> bit.astype(np.uint32)) & np.uint32(1) == 1]
    inside = np.zeros(len(found.data) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.subtract.at(inside, starts + window, 1)
    return found.data, found.offsets, np.cumsum(inside[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of the documents that lose bytes; kept is what remains of the text.

    n_spans counts maximal removed stretches. `window` must be from 16 to MOST_WINDOW.
    """
    if not 16 <= window <= MOST_WINDOW:
        raise ValueError(f"windows of {window} bytes are not supported: 16 to {MOST_WINDOW}")
    docs = common.one_row_each(docs)
    count = exchange.buckets(docs)

    def send_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            row, grams, *_ = _found(part.column(1), window)
            yield exchange.messages(grams, np.asarray(part.column(0))[row], count, _CANDIDATE_BYTES)

    def name_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for part in common.unpacked(batches):
            row, grams, place, first, last = _found(part.column(1), window)
            some = exchange.member(row, exchange.cut(grams, _CANDIDATE_BYTES), part.column(2), _CANDIDATE_BYTES)
            row, place, first, last = row[some], place[some], first[some], last[some]
            runs = np.zeros(len(row), _RUN)
            runs["first"], runs["place"], runs["last"] = first - common.buffer(part.column(1))[1][row], place - first, last - first
            edges = np.searchsorted(row, np.arange(part.num_rows + 1)).tolist()
            lists = [runs[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            frames = [compress(x.as_buffer()) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(frames, pa.binary()), pa.array(lists, pa.binary())], ["doc_id", "text", "runs"])

    def send_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.unpacked(batches):
            found = _Runs(part, window)
            grams = found.grams()
            extra = np.frombuffer(exchange.packed(grams, 6), np.uint8).reshape(-1, 6)
            yield exchange.messages(found.key, np.asarray(part.column(0))[found.row], count, _KEY_BYTES, by=grams, extra=extra)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.unpacked(batches):
            data, offsets, gone = _covered(part, window)
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            inner = offsets[1:-1][(offsets[1:-1] < len(data))]
            first[inner] = gone[inner]
            rows = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                rows.append((b - a, int(gone[a:b].sum()), int(first[a:b].sum()), data[a:b][~gone[a:b]].tobytes()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    lists = lambda rows: rows.groupBy("doc_id").agg(F.collect_list("keys").alias("answers"))
    shared = exchange.merge(docs.mapInArrow(send_grams, exchange.MESSAGE), _CANDIDATE_BYTES, later=False)
    named = common.packed_texts(docs).join(lists(shared), "doc_id").mapInArrow(name_runs, "doc_id long, text binary, runs binary")
    candidates = common.stage(named)
    judged = common.stage(_judge(candidates.mapInArrow(send_keys, exchange.MESSAGE), hot))
    sent = candidates.join(lists(judged), "doc_id").mapInArrow(lambda b: _send_runs(b, window, count), _SENT)
    compared = _compare(sent, window)
    return candidates.join(lists(judged.union(compared)), "doc_id").mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """The contract's columns for every document."""
    changed = remove_repeats(docs, window, hot).select("doc_id", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    other = changed.select(F.col("doc_id").alias("id"), "n_removed", "n_spans", F.col("kept_sha256").alias("sha"))
    rows = common.one_row_each(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(other, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_bytes", count("n_removed"), count("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256")
    )
