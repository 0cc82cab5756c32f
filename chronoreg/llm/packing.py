"""Packing documents into fixed-length sequences by exact-complement hashing.

Three steps. Tasks tokenize whole texts and cut what is longer than a sequence. Spark counts the pieces of each length:
at most one row per length reaches the driver, whatever the corpus. On these counts the plan is made: an index of
single, pair and triple sums of lengths gives each piece a combination that fills its gap exactly, as often as the
counts allow; the rest goes best-fit, longest first. A plan is a list of patterns (lengths, how often). Spark then
ranks the pieces of each length and a piece's rank names its sequence and offset. Ranks are counted in salted groups
whose sizes are summed up afterwards, so a length that a third of all pieces share is no single group.

Defined results: a null or empty text is a document of the end token alone; repeated rows are packed each; rows
without a doc_id take no part; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoreg.llm import common, vocabulary

SIZE = 1024
END_TOKEN = 2
#: Distinct units whose ids a worker remembers, and the longest unit that it remembers.
CACHE_UNITS = 1_000_000
CACHE_BYTES = 64

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # how many sequences, each with ((length, how often), ...)


class UnitTokenizer:
    """Tokenizes texts unit by unit: white space with what follows it, up to the next white space.

    The tokenizer's pre-tokenizer never joins a character with white space behind it, so a text may be cut there
    without a change of its ids. Equal units of a slice are tokenized once, and a worker remembers the ids of short
    units. Where the same vocabulary is also given as ranks, short units of plain characters go through the faster
    library; a test holds both to equal ids.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self._encode = vocabulary.Encoder(path, ranks)
        self._known: dict[bytes, bytes] = {}

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows as uint32, and each row's offsets into them."""
        data, offsets = common.buffer(column)
        starts = self._starts(data, offsets)
        ends = np.append(starts, len(data))[1:]
        first, inverse = common.distinct_spans(data, starts, ends)
        ids = self._ids(data, starts[first], ends[first])
        lengths = np.fromiter((len(x) >> 2 for x in ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        begins = np.cumsum(lengths) - lengths
        count = lengths[inverse]
        total = np.concatenate([[0], np.cumsum(count)])
        places = np.repeat(begins[inverse] - total[:-1], count) + np.arange(total[-1])
        return flat[places], total[np.searchsorted(starts, offsets)]

    @staticmethod
    def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data):
            return np.zeros(0, np.int64)
        # Cut before ASCII white space, only where the character before it is surely none: printable ASCII, or one of
        # U+00C0 to U+00FF.
        sure = (data > 0x20) & (data < 0x7F)
        sure[1:] |= (data[1:] & 0xC0 == 0x80) & (data[:-1] == 0xC3)
        cut = np.zeros(len(data), bool)
        cut[1:] = common.is_space(data[1:]) & sure[:-1]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(cut)

    def _ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        if len(self._known) > CACHE_UNITS:
            self._known.clear()
        known = self._known
        raw = data.tobytes()
        units = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        out = [known.get(u) for u in units]
        missing = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(missing, self._encode([units[i].decode() for i in missing]), strict=True):
            out[i] = array("I", ids).tobytes()
            if len(units[i]) <= CACHE_BYTES:
                known[units[i]] = out[i]
        return out


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's pieces.

    Only documents of more than `size` ids are cut; all their pieces but the first are full.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = UnitTokenizer(tokenizer, ranks)
        end = np.array([END_TOKEN], dtype="<u4")
        for part in common.slices(batches):
            ids, offsets = encode(part.column(1))
            rows: list[tuple] = []
            for doc, a, b in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = np.concatenate([ids[a:b], end])
                first = (len(own) - 1) % size + 1
                cuts = [0, *range(first, len(own) + 1, size)]
                for piece, (at, to) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    chunk = own[at:to]
                    rows.append((doc, piece, at, to - at, zlib.crc32(chunk.tobytes()), *([chunk.tolist()] if with_ids else [])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return common.texts(docs).mapInArrow(kernel, schema)


class SumIndex:
    """The single, pair and triple sums of the lengths, by their total, and what is still available of each length.

    A total's combinations are listed once, the longest length first. Availability only falls, so the first one that
    is available is taken as often as the counts allow and then never comes back.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self._lengths = np.flatnonzero(left)
        self._present = left > 0
        self._listed: dict[int, list[np.ndarray]] = {}

    def combinations(self, total: int) -> list[np.ndarray]:
        """Arrays of one, two and three columns: the lengths that sum to `total`, each row from the longest down."""
        if total not in self._listed:
            present, lengths = self._present, self._lengths[self._lengths < total][::-1]
            single = np.array([[total]] if total < len(present) and present[total] else np.zeros((0, 1)), np.int64)
            longer = lengths[2 * lengths >= total]
            pair = np.stack([longer, total - longer], axis=1)[present[total - longer]] if len(longer) else np.zeros((0, 2), np.int64)
            triples = [np.zeros((0, 3), np.int64)]
            for longest in lengths[3 * lengths >= total].tolist():
                rest = total - longest
                middle = lengths[(lengths <= min(longest, rest - 1)) & (2 * lengths >= rest)]
                middle = middle[present[rest - middle]] if len(middle) else middle
                triples.append(np.stack([np.full(len(middle), longest), middle, rest - middle], axis=1))
            # Pieces of one length are filled up one after the other, so the total at hand is the only one that is held.
            self._listed = {total: [single, pair, np.concatenate(triples)]}
        return self._listed[total]

    def filling(self, length: int, size: int) -> tuple[int, ...] | None:
        """The first combination that fills up a piece of `length` and is available beside it."""
        for place, rows in enumerate(self.combinations(size - length)):
            enough = np.ones(len(rows), bool)
            for column in rows.T:
                enough &= self.left[column] >= (rows == column[:, None]).sum(axis=1) + (column == length)
            if enough.any():
                first = int(np.argmax(enough))
                self._listed[size - length][place] = rows[first:]
                return tuple(rows[first].tolist())
        return None


def plan(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Patterns that place every piece: exact combinations first, then best fit, longest first."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    made: list[Pattern] = [(int(left[size]), ((size, 1),))] if left[size] else []
    left[size] = 0
    sums = SumIndex(left)
    for length in range(size - 1, 0, -1):
        while left[length] and (others := sums.filling(length, size)):
            need = Counter((length, *others))
            times = min(int(left[x]) // n for x, n in need.items())
            made.append((times, tuple(sorted(need.items(), reverse=True))))
            for x, n in need.items():
                left[x] -= n * times
    return made + _best_fit(left, size)


def _best_fit(left: np.ndarray, size: int) -> list[Pattern]:
    bins: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # by gap: how many alike, and what they hold
    for length in range(size - 1, 0, -1):
        n = int(left[length])
        while n:
            gap = next((g for g in range(length, size) if bins.get(g)), size)
            alike, holds = bins[gap].pop() if gap < size else (n, ())
            fit = min(gap // length, n)
            used = min(alike, n // fit)
            if used < alike and gap < size:
                bins[gap].append((alike - used, holds))
            bins[gap - fit * length].append((used, (*holds, (length, fit))))
            n -= used * fit
    return [group for groups in bins.values() for group in groups]


def _places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank behind the last, ranks a sequence, first sequence, offset) of each pattern's parts."""
    out, sequence, used = [], 0, Counter()
    for times, parts in patterns:
        offset = 0
        for length, n in parts:
            out.append((length, used[length], used[length] + times * n, n, sequence, offset))
            used[length] += times * n
            offset += length * n
        sequence += times
    return out


def pack(found: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with sequence_id and offset; `found` must be stored, as it is read twice."""
    spark = found.sparkSession
    counts = {r.length: r["count"] for r in found.groupBy("length").count().collect()}  # one row a length: `size` at most
    places = spark.createDataFrame(_places(plan(counts, size)), "length long, low long, high long, times long, base long, begin long")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    group = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    sums = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(sums), F.lit(0)).alias("before"))
    ranked = salted.withColumn("own", F.row_number().over(group) - 1).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own"))
    # A plan has a few parts a length, whatever the corpus, so it is small enough to broadcast.
    placed = ranked.join(F.broadcast(places), (ranked.length == places.length) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).drop(places.length)
    turn = F.col("rank") - F.col("low")
    return placed.select(
        *found.columns,
        (F.col("base") + F.floor(turn / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("begin") + F.pmod(turn, F.col("times")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their sequence and offset; with_ids adds the token ids themselves.

    `tokenizer` and `ranks` are files that every worker can open.
    """
    return pack(common.stage(pieces(docs, tokenizer, ranks, size, with_ids)), size)
