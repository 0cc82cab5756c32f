"""Cross-tokenizer alignment: links between a byte-level and a piece vocabulary, counted by external spill counting.

Both tokenizers encode a space and the text. Byte offsets at which tokens of both end cut the tokens into groups, and
two tokens are linked where their bytes overlap. An id pair's count is the number of documents that hold it linked.

Neither vocabulary joins a character with a space or line end behind it, so texts are cut there into units, and equal
units are aligned once. The pairs are counted as an external sort counts: a task takes its documents in blocks,
counts the documents of each pair in the block, radix-partitions these records by a hash of the byte-level id, and
spills each part as a run of zstandard frames sorted by (byte-level id, piece id). A bucket's runs are merged by k-way
heaps, frame by frame; the merged pairs come ordered by their byte-level side, so its highest count is known when
the side's pairs end. Then the runs are read again and each gets back the counts of its own pairs, in its own order.
A block adds them up for its documents from their units. A pair that all documents hold is one record a block, so no
bucket grows with the documents that share it, and no document's links are shuffled.

Defined results: a null or empty text, or one whose tokens' bytes differ from a space and the text, has no tokens:
zeros and an empty digest; a document without tokens links nothing; of repeated rows of a doc_id the least text stays;
rows without a doc_id take no part; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common, vocabulary

#: Bytes of text in a block, records of a frame, and short units that a worker remembers.
BLOCK_BYTES = 4 << 20
FRAME = 1 << 13
KNOWN_UNITS = 300_000
KNOWN_BYTES = 48
SPACE = "▁"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_SPILL = "block long, bucket int, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, sha256: string>>, frames array<binary>"
_ANSWER = "block long, bucket int, frames array<binary>"

Unit = tuple[int, int, int, bytes, np.ndarray]  # tokens of either side, groups, the groups as text, the linked pairs


class Aligner:
    """Aligns units: a space or line end with what follows it."""

    def __init__(self, byte_tokenizer: str, pieces: str, ranks: str | None = None):
        import sentencepiece

        self._encode = vocabulary.Encoder(byte_tokenizer, ranks, special=False)
        self._bytes = self._encode.token_bytes()
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        ids = range(self._pieces.get_piece_size())
        names = [self._pieces.id_to_piece(i) for i in ids]
        self._piece_bytes = [bytes([int(n[3:5], 16)]) if self._pieces.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in zip(ids, names, strict=True)]
        self._space = self._pieces.piece_to_id(SPACE)
        self._sizes = [np.array([len(x) for x in side], np.int64) for side in (self._bytes, self._piece_bytes)]
        # Every id of either side as it is written, with a comma, the other side or the next group behind it.
        self._written = [b"%d%c" % (i, mark) for side in (self._bytes, self._piece_bytes) for i in range(len(side)) for mark in b",|;"]
        self._widths = np.array([len(x) for x in self._written], np.int64)
        self._known: dict[bytes, Unit | None] = {}
        #: The bytes before which a text may be cut, after a character that surely is no white space.
        self.cuts = b" " + b"\n" * (not any("\n" in n for n in names))

    def __call__(self, units: list[bytes]) -> list[Unit | None]:
        if len(self._known) > KNOWN_UNITS:
            self._known.clear()
        out = [self._known.get(u, ...) for u in units]
        new = [i for i, x in enumerate(out) if x is ...]
        texts = [units[i].decode() for i in new]
        for i, text, found in zip(new, texts, self._aligned([units[i] for i in new], self._encode(texts), self._piece_ids(texts)), strict=True):
            out[i] = found
            if len(text) <= KNOWN_BYTES:
                self._known[units[i]] = found
        return out

    def _piece_ids(self, texts: list[str]) -> list[list[int]]:
        """The library puts a space before a text, so one is taken away there; before a line end it stands alone."""
        found = self._pieces.encode([t.removeprefix(" ") for t in texts], num_threads=1) if texts else []
        return [[self._space] if t == " " else ids if t.startswith(" ") else ids[1:] for t, ids in zip(texts, found, strict=True)]

    def _aligned(self, units: list[bytes], ids: list[list[int]], others: list[list[int]]) -> list[Unit | None]:
        """All units at once, as one text: every byte offset where a token of either side ends closes one link."""
        out: list[Unit | None] = [None] * len(units)
        fine = [i for i, u in enumerate(units) if self._same(u, ids[i], self._bytes) and self._same(u, others[i], self._piece_bytes)]
        if not fine:
            return out
        lists = [[side[i] for i in fine] for side in (ids, others)]
        counts = [np.fromiter(map(len, side), np.int64, len(fine)) for side in lists]
        flat = [np.fromiter(chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip(lists, counts, strict=True)]
        ends = [np.cumsum(sizes[x]) for sizes, x in zip(self._sizes, flat, strict=True)]
        stops = np.cumsum(np.fromiter((len(units[i]) for i in fine), np.int64, len(fine)))
        offsets = np.sort(np.concatenate(ends), kind="stable")
        again = offsets[1:] == offsets[:-1]  # both sides end there
        closing, shared = offsets[np.append(True, ~again)], offsets[1:][again]
        one, two = (x[np.searchsorted(e, closing)].astype(np.uint64) for x, e in zip(flat, ends, strict=True))
        pairs = one << np.uint64(32) | two
        # The tokens as they are written: group by group, the byte-level side first.
        place = np.concatenate([2 * np.searchsorted(shared, e) + side for side, e in enumerate(ends)])
        order = np.argsort(place, kind="stable")
        place = place[order]
        last = np.append(place[1:] != place[:-1], True)
        written = np.concatenate([flat[0], flat[1] + len(self._bytes)])[order] * 3 + np.where(last, 1 + place % 2, 0)
        text = b"".join([self._written[i] for i in written.tolist()])
        text_ends = np.cumsum(self._widths[written])[np.cumsum(counts[0] + counts[1]) - 1].tolist()
        link_ends, group_ends = (np.searchsorted(x, stops, side="right") for x in (closing, shared))
        numbers = (counts[0], counts[1], np.diff(group_ends, prepend=0))
        for i, n_a, n_b, n_groups, (a, b), (x, y) in zip(fine, *(n.tolist() for n in numbers), pairwise([0, *text_ends]), pairwise([0, *link_ends.tolist()]), strict=True):
            out[i] = (n_a, n_b, n_groups, text[a : b - 1], pairs[x:y].copy())
        return out

    @staticmethod
    def _same(unit: bytes, ids: list[int], table: list[bytes]) -> bool:
        return b"".join([table[i] for i in ids]) == unit


def _units(data: np.ndarray, offsets: np.ndarray, cuts: bytes) -> np.ndarray:
    """Where each unit starts; every text starts one."""
    sure = (data > 0x20) & (data < 0x7F)
    sure[1:] |= (data[1:] & 0xC0 == 0x80) & (data[:-1] == 0xC3)  # U+00C0 to U+00FF
    cut = np.zeros(len(data), bool)
    cut[1:] = np.isin(data[1:], np.frombuffer(cuts, np.uint8)) & sure[:-1]
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


def _buckets_of(pairs: np.ndarray, count: int) -> np.ndarray:
    return (common.mix(pairs >> np.uint64(32)) % np.uint64(count)).astype(np.int64)


def _frames(values: np.ndarray) -> list[bytes]:
    """The numbers as zstandard frames of FRAME each, every byte place by itself."""
    compress = zstandard.ZstdCompressor(level=1).compress
    return [compress(np.ascontiguousarray(values[a : a + FRAME].view(np.uint8).reshape(-1, values.itemsize).T).tobytes()) for a in range(0, len(values), FRAME)]


def _unframed(frame: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _spilled(docs: DataFrame, byte_tokenizer: str, pieces: str, ranks: str | None, block_bytes: int) -> DataFrame:
    """For each block of documents a run of frames for each bucket (pairs, then their documents), and what the block
    keeps for itself in the rows without a bucket: its documents, and frames of their units and the units' pairs."""
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ["block", "bucket", "docs", "frames"]
    types = [pa.int64(), pa.int32(), pa.list_(pa.struct([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("sha256", pa.string())])), pa.list_(pa.binary())]

    def block_rows(align: Aligner, block: int, part: pa.RecordBatch) -> list[tuple]:
        raw, ends = common.buffer(part.column(1))
        raw = raw.tobytes()
        texts = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        there = np.array([bool(t) for t in texts])
        data = b"".join(b" " + t for t in texts if t)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts if t)])
        flat = np.frombuffer(data, np.uint8)
        starts = _units(flat, offsets, align.cuts) if data else np.zeros(0, np.int64)
        stops = np.append(starts, len(flat))[1:]
        first, number = common.distinct_spans(flat, starts, stops)
        units = align([data[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)])
        bounds = np.searchsorted(starts, offsets)
        # Documents with a unit whose bytes are not its tokens' bytes have no tokens.
        wrong = np.concatenate([[0], np.cumsum(np.array([u is None for u in units], bool)[number])])
        fine = wrong[bounds[1:]] == wrong[bounds[:-1]]
        none: Unit = (0, 0, 0, b"", np.zeros(0, np.uint64))
        units = [u or none for u in units]
        own = [np.concatenate([[0], np.cumsum(np.array([u[k] for u in units], np.int64)[number])]) for k in range(3)]
        own.append(np.concatenate([[0], np.cumsum(np.array([len(u[4]) for u in units], np.int64)[number])]))
        said = [u[3] for u in units]
        numbers = number.tolist()
        rows, kept = [], []  # a document's numbers, and the unit occurrences of those with tokens
        place = 0
        for doc, exists in zip(part.column(0).to_pylist(), there.tolist(), strict=True):
            if not exists or not fine[place]:
                rows.append({"doc_id": doc, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "sha256": ""})
                kept.append(np.zeros(0, np.int64))
            else:
                a, b = int(bounds[place]), int(bounds[place + 1])
                sums = [int(x[b] - x[a]) for x in own]
                rows.append(dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "sha256"), (doc, *sums, hashlib.sha256(b";".join([said[n] for n in numbers[a:b]])).hexdigest()), strict=True)))
                kept.append(np.sort(number[a:b]))
            place += exists
        # The block's pairs, ordered by bucket and pair, and the documents that hold each.
        sizes = np.array([len(u[4]) for u in units], np.int64)
        flat_pairs = np.concatenate([np.zeros(0, np.uint64), *(u[4] for u in units)])
        pairs, index = np.unique(flat_pairs, return_inverse=True)
        bucket = _buckets_of(pairs, count)
        order = np.argsort(bucket, kind="stable")
        pairs, bucket = pairs[order], bucket[order]
        renumbered = np.empty(len(order), np.int64)
        renumbered[order] = np.arange(len(order))
        index = renumbered[index]
        held = np.unique(np.repeat(np.arange(len(kept)), [len(k) for k in kept]) * max(len(units), 1) + np.concatenate([np.zeros(0, np.int64), *kept]))
        holder, unit = held // max(len(units), 1), held % max(len(units), 1)
        begins = np.cumsum(sizes) - sizes
        each = sizes[unit]
        spots = np.repeat(begins[unit] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        both = np.unique(np.repeat(holder, each) * max(len(pairs), 1) + index[spots])
        documents = np.bincount(both % max(len(pairs), 1), minlength=len(pairs)).astype(np.uint32)
        out = []
        edges = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
        for a, b in pairwise(edges):
            out.append((block, int(bucket[a]), None, [f for pair in zip(_frames(pairs[a:b]), _frames(documents[a:b]), strict=True) for f in pair]))
        lengths = np.array([len(k) for k in kept], np.uint32)
        occurrences = np.concatenate([np.zeros(0, np.int64), *kept]).astype(np.uint32)
        compress = zstandard.ZstdCompressor(level=1).compress
        state = [compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()) for x in (lengths, occurrences, sizes.astype(np.uint32), index.astype(np.uint32))]
        return [*out, (block, None, rows, state)]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(byte_tokenizer, pieces, ranks)
        block = TaskContext.get().partitionId() << 32
        for part in _gathered(batches, block_bytes):
            columns = zip(*block_rows(align, block, part), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema)
            block += 1

    return docs.mapInArrow(kernel, _SPILL)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `size` bytes of text, also where they come in smaller ones."""
    waiting, held = [], 0
    for part in common.slices(batches, size=size):
        waiting.append(part)
        held += len(common.buffer(part.column(1))[0])
        if held >= size // 2:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, held = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


class _Run:
    """A run that is read frame by frame."""

    def __init__(self, frames: list[bytes]):
        self._frames, self._next = frames, 0
        self.pairs, self.documents, self.at = np.zeros(0, np.uint64), np.zeros(0, np.uint32), 0
        self.advance()

    def advance(self) -> bool:
        """Whether there are records left; the next frame is read where one is used up."""
        if self.at == len(self.pairs) and self._next < len(self._frames):
            self.pairs, self.documents = _unframed(self._frames[self._next], "<u8"), _unframed(self._frames[self._next + 1], "<u4")
            self.at, self._next = 0, self._next + 2
        return self.at < len(self.pairs)

    def upto(self, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """The frame's records up to the bound, which are then used up."""
        a, self.at = self.at, int(np.searchsorted(self.pairs, np.uint64(bound), side="right"))
        return self.pairs[a : self.at], self.documents[a : self.at]


def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs in order with the sums of their documents, some at a time.

    One heap holds each open frame's first record that is left, the other one its last; all records up to the least
    last one can be added up.
    """
    opened = [r for r in map(_Run, runs) if r.at < len(r.pairs)]
    heads = [(int(r.pairs[0]), i) for i, r in enumerate(opened)]
    tails = [(int(r.pairs[-1]), i) for i, r in enumerate(opened)]
    heapify(heads)
    heapify(tails)
    while heads:
        bound = tails[0][0]
        taken = []
        while heads and heads[0][0] <= bound:
            _, i = heappop(heads)
            run = opened[i]
            taken.append(run.upto(bound))
            ended = run.at == len(run.pairs)
            if run.advance():
                heappush(heads, (int(run.pairs[run.at]), i))
                if ended:
                    heappush(tails, (int(run.pairs[-1]), i))
        while tails and tails[0][0] <= bound:
            heappop(tails)
        pairs, where = np.unique(np.concatenate([t[0] for t in taken]), return_inverse=True)
        # Sums of whole numbers below 2**53 are exact.
        yield pairs, np.bincount(where, weights=np.concatenate([t[1] for t in taken])).astype(np.uint64)


def _side_major(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs and, twice their count, plus one where no other pair of the byte-level id has a higher count."""
    late = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # of an id that may go on in the next part

    def finished(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        side = pairs >> np.uint64(32)
        heads = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        most = np.repeat(np.maximum.reduceat(counts, heads), np.diff(np.append(heads, len(pairs))))
        return pairs, counts * np.uint64(2) + (counts == most).astype(np.uint64)

    for part in parts:
        pairs, counts = (np.concatenate(x) for x in zip(late, part, strict=True))
        side = pairs >> np.uint64(32)
        open_from = int(np.searchsorted(side, side[-1]))
        late = pairs[open_from:], counts[open_from:]
        if open_from:
            yield finished(pairs[:open_from], counts[:open_from])
    if len(late[0]):
        yield finished(*late)


def _answered(table: pa.Table) -> pa.Table:
    """A bucket's runs merged, and for each run the numbers of its pairs in its order."""
    runs = table.column("frames").to_pylist()
    found = list(_side_major(merged(runs)))  # the bucket's different pairs, whatever the number of documents
    pairs, numbers = (np.concatenate([np.zeros(0, np.uint64), *(f[k] for f in found)]) for k in (0, 1))
    back = []
    for run in runs:
        own = np.concatenate([_unframed(f, "<u8") for f in run[::2]])
        back.append(_frames(numbers[np.searchsorted(pairs, own)]))
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "frames": pa.array(back, pa.list_(pa.binary()))})


def _summed(table: pa.Table) -> pa.Table:
    """A block's documents with the sums of its answers."""
    table = table.sort_by([("bucket", "ascending")])  # the block's own row has none and comes last
    rows = table.column("frames").to_pylist()
    docs = table.column("docs").to_pylist()[-1]
    numbers = np.concatenate([np.zeros(0, np.uint64), *(_unframed(f, "<u8") for r in rows[:-1] for f in r)])
    lengths, occurrences, sizes, index = (_unframed(f, "<u4").astype(np.int64) for f in rows[-1])
    ends = np.cumsum(np.append(0, sizes))
    sums = []
    for each in (numbers & np.uint64(1), numbers >> np.uint64(1)):
        by_unit = np.concatenate([[0], np.cumsum(each.astype(np.int64)[index])])
        by_occurrence = np.concatenate([[0], np.cumsum((by_unit[ends[1:]] - by_unit[ends[:-1]])[occurrences])])
        stops = np.cumsum(np.append(0, lengths))
        sums.append(by_occurrence[stops[1:]] - by_occurrence[stops[:-1]])
    found = {c: pa.array([d[c] for d in docs], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(found | {"n_best": sums[0], "count_sum": sums[1], "groups_sha256": pa.array([d["sha256"] for d in docs], pa.string())})


def align(docs: DataFrame, byte_tokenizer: str, pieces: str, ranks: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    The tokenizers' files must be readable for every worker; `ranks` gives the byte-level vocabulary a second time.
    n_best counts the links whose pair no other pair of the same byte-level id exceeds; count_sum adds up the counts.
    """
    spilled = common.stage(_spilled(common.one_row_each(docs), byte_tokenizer, pieces, ranks, block_bytes))
    answers = spilled.where("bucket IS NOT NULL").select("block", "bucket", "frames").groupBy("bucket").applyInArrow(_answered, _ANSWER)
    own = spilled.where("bucket IS NULL")
    both = own.unionByName(answers, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(_summed, RESULT)


def pairs(docs: DataFrame, byte_tokenizer: str, pieces: str, ranks: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b, documents, best) of every linked id pair: the table that the counts make."""
    spilled = _spilled(common.one_row_each(docs), byte_tokenizer, pieces, ranks, block_bytes).where("bucket IS NOT NULL")

    def counted(table: pa.Table) -> pa.Table:
        found = list(_side_major(merged(table.column("frames").to_pylist())))
        pair, number = (np.concatenate([np.zeros(0, np.uint64), *(f[k] for f in found)]) for k in (0, 1))
        columns = (pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF), number >> np.uint64(1))
        return pa.table([*(pa.array(c.astype(np.int64)) for c in columns), pa.array((number & np.uint64(1)).astype(bool))], ["a", "b", "documents", "best"])

    return spilled.select("bucket", "frames").groupBy("bucket").applyInArrow(counted, "a long, b long, documents long, best boolean")
