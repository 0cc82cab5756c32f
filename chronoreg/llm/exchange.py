"""Finding keys that several documents hold, with packed messages in place of a row for each key.

A task sends, for each slice of its texts, one message to each bucket of keys. Of the documents of a slice that hold a
key only the smallest (its lead) is sent to the key's bucket, so a key that a third of all documents hold arrives once
a slice; the slice knows of the others (its followers) that they are not the first, and their messages only pass
through buckets chosen by document. A bucket's messages are merged by one sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MESSAGE = "bucket int, kind int, first long, docs binary, keys binary"
ANSWER = "doc_id long, keys binary"
_NAMES = [f.split()[0] for f in MESSAGE.split(", ")]
LEAD, SHARED_LEAD, FOLLOWER = range(3)


def buckets(df: DataFrame) -> int:
    """Buckets for the session's shuffle: several for each partition, so that a bucket's merge needs little memory."""
    return 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed(keys: np.ndarray, width: int) -> bytes:
    """The upper `width` bytes of each 64-bit key."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def cut(keys: np.ndarray, width: int) -> np.ndarray:
    """What packing leaves of the keys."""
    return keys & ~np.uint64((1 << (64 - 8 * width)) - 1)


def _deltas(docs: np.ndarray) -> bytes:
    """Ascending docs as steps of the least width, which the first byte names."""
    steps = np.diff(docs, prepend=docs[:1])
    width = next(w for w in (1, 2, 4, 8) if int(steps.max(initial=0)) < 1 << (8 * w - (w == 8)))
    return bytes([width]) + steps.astype(f"<u{width}").tobytes()


def delta_docs(first: int, raw: bytes) -> np.ndarray:
    return first + np.cumsum(np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64))


def messages(keys: np.ndarray, docs: np.ndarray, count: int, width: int, by: np.ndarray | None = None, extra: np.ndarray | None = None) -> pa.RecordBatch:
    """The messages of one slice: `docs` holds the document of each key.

    Keys go to buckets by themselves, or by `by`, which equal keys must share; `extra` adds bytes to each key.
    """
    by = keys if by is None else by
    extra = np.zeros((len(keys), 0), np.uint8) if extra is None else extra
    rows: list[tuple] = []
    if len(keys):
        # A key goes to the bucket of its lower bits, its upper bytes are sent.
        order = np.lexsort((docs, keys))
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (np.diff(keys[order]) != 0) | (np.diff(docs[order]) != 0)
        order = order[fresh]
        keys, docs, by, extra = keys[order], docs[order], by[order], extra[order]
        head = np.ones(len(keys), bool)
        head[1:] = keys[1:] != keys[:-1]
        shared = head.copy()
        shared[:-1] &= ~head[1:]
        shared[-1] = False
        kind = np.where(~head, FOLLOWER, np.where(shared, SHARED_LEAD, LEAD))
        # The bucket of a follower follows from its document alone.
        bucket = np.where(head, (by % np.uint64(count)).astype(np.int64), docs % count)
        order = np.lexsort((docs, kind, bucket))
        keys, docs, kind, bucket = keys[order], docs[order], kind[order], bucket[order]
        edges = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(kind) != 0)) + 1
        raw = np.concatenate([np.frombuffer(packed(keys, width), np.uint8).reshape(-1, width), extra[order]], axis=1).tobytes()
        width += extra.shape[1]
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
            rows.append((int(bucket[a]), int(kind[a]), int(docs[a]), _deltas(docs[a:b]), raw[a * width : b * width]))
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)


def answers(docs: np.ndarray, payload: np.ndarray) -> pa.RecordBatch:
    """A row for each document with its part of the payload (one row of bytes for each entry)."""
    order = np.argsort(docs, kind="stable")
    docs, payload = docs[order], payload[order]
    starts = np.flatnonzero(np.diff(docs, prepend=docs[:1] - 1)) if len(docs) else np.zeros(0, np.int64)
    size = payload.shape[1] if payload.ndim == 2 else 1
    offsets = np.append(starts, len(docs)) * size
    raw = pa.py_buffer(np.ascontiguousarray(payload).tobytes())
    column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), raw])
    return pa.RecordBatch.from_arrays([pa.array(docs[starts]), column], ["doc_id", "keys"])


def merge(sent: DataFrame, width: int, later: bool) -> DataFrame:
    """(doc_id, keys): the packed keys that a document shares with another one; with `later`, with a smaller one.

    A document's keys may come in several rows.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_keys, all_docs, known = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        through_keys, through_docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for _, kind, first, docs, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, doc = unpacked(keys, width), delta_docs(first, docs)
                (through_keys if kind == FOLLOWER else all_keys).append(key)
                (through_docs if kind == FOLLOWER else all_docs).append(doc)
                if kind != FOLLOWER:
                    known.append(np.full(len(key), kind == SHARED_LEAD))
        keys, docs, known_ = np.concatenate(all_keys), np.concatenate(all_docs), np.concatenate(known)
        order = np.lexsort((docs, keys))
        keys, docs, known_ = keys[order], docs[order], known_[order]
        if len(keys):
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(heads, len(keys)))
            least = np.repeat(docs[heads], sizes)
            chosen = docs > least
            if not later:
                most = np.repeat(docs[np.append(heads[1:], len(keys)) - 1], sizes)
                chosen = known_ | (most > least)
            keys, docs = keys[chosen], docs[chosen]
        keys, docs = np.concatenate([keys, *through_keys]), np.concatenate([docs, *through_docs])
        yield answers(docs, np.frombuffer(packed(keys, width), np.uint8).reshape(-1, width))

    return sent.groupBy("bucket").applyInArrow(_of_table(kernel), ANSWER)


def _of_table(kernel):
    def on_table(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(kernel(iter(table.to_batches()))))

    return on_table


def member(rows: np.ndarray, keys: np.ndarray, lists: pa.Array, width: int) -> np.ndarray:
    """Whether each key is in the packed lists (a list of binaries per row) of its row."""
    flat = lists.flatten()
    owner = np.repeat(np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets))), [len(x.as_buffer()) // width for x in flat])
    known = unpacked(b"".join(x.as_py() for x in flat), width)
    order = np.lexsort((known, owner))
    owner, known = owner[order], known[order]
    # One sorted list of (row, key): a key is looked up by bisection inside its row's part.
    low, high = np.searchsorted(owner, rows), np.searchsorted(owner, rows, side="right")
    end = high.copy()
    while (going := low < high).any():
        middle = (low + high) // 2
        less = going & (known[np.minimum(middle, len(known) - 1)] < keys) if len(known) else going & False
        low, high = np.where(less, middle + 1, low), np.where(going & ~less, middle, high)
    return (low < end) & (known[np.minimum(low, max(len(known) - 1, 0))] == keys) if len(known) else np.zeros(len(keys), bool)


def runs(grams: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of each row grouped by their least gram: (row, gram's place, first window, last window).

    Equal windows choose equal grams wherever they stand, so windows that two documents share share a gram too; about
    two of window - gram + 2 grams are ever chosen.
    """
    n = int(offsets[-1])
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none
    bits = np.uint64(max(22, n.bit_length()))
    least = (grams[: n - gram + 1] >> bits << bits) | np.arange(n - gram + 1, dtype=np.uint64)
    span, width = 1, window - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if rest := width - span:
        least = np.minimum(least[:-rest], least[rest:])
    whole = np.ones(n - window + 1, bool)
    for end in offsets[1:-1].tolist():  # windows that begin in one row and end in another
        whole[max(0, end - window + 1) : end] = False
    starts = np.flatnonzero(whole)
    if not len(starts):
        return none, none, none, none
    place = (least[starts] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(starts) != 1)]))
    tails = np.append(heads[1:], len(starts)) - 1
    first = starts[heads]
    return np.searchsorted(offsets, first, side="right") - 1, place[heads], first, starts[tails]


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first..last, and the number of the range that each comes from."""
    sizes = last - first + 1
    which = np.repeat(np.arange(len(first)), sizes)
    return first[which] + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes), which
