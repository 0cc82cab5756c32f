"""Helpers shared by the operators: reading tables, staging, and vectorised work on Arrow batches."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a kernel looks at together; bounds the memory of its arrays.
SLICE_BYTES = 1 << 21
#: The white space of the word rule ``[^\x20\x09-\x0D]+``.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes from which a span is hashed by itself, and what a word of so many bytes keeps of eight.
LONG_SPAN = 4096
_KEPT = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
#: An odd multiplier, so that it has an inverse modulo 2**64.
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row with a doc_id; a null text becomes empty."""
    return docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def one_row_each(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with one row for each doc_id: where ids repeat, the least text stays.

    Only the ids that repeat are grouped; where none does, the texts aren't shuffled.
    """
    rows = texts(docs)
    again = rows.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.head(1):
        return rows
    twice = rows.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return rows.join(again, "doc_id", "left_anti").union(twice)


def stage(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared scratch folder and read it back.

    This cuts lineage with files that outlive executors. The folder is ``spark.checkpoint.dir``; only where that is
    unset on a local master (tests) the warehouse takes its place. The files go when the application ends.
    """
    spark = df.sparkSession
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{top.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(np.asarray(lengths, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            floor = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, floor + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with each text as a zstandard frame, for texts that are shuffled or stored."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            data, offsets = buffer(part.column(1))
            raw = data.tobytes()
            frames = [compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(frames, pa.binary())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(kernel, "doc_id long, text binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """slices() of rows whose second column is from packed_texts(), with the texts' bytes in it."""
    decompress = zstandard.ZstdDecompressor().decompress
    for part in slices(batches, size=SLICE_BYTES // 2):
        column = pa.array([decompress(x.as_buffer()) for x in part.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column(0), column, *part.columns[2:]], part.schema.names)


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and each row's offsets into them."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    width = np.int64 if large else np.int32
    off = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[off[0] : off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, zeros behind the end."""
    raw = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", raw.data, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], eight bytes at a time: no polynomial, so no texts are known that collide."""
    return Spans(data)(starts, ends)


class Spans:
    """span_hashes() of one text buffer for several lists of spans."""

    def __init__(self, data: np.ndarray):
        self._data, self._eight = data, _eights(data)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        left = ends - starts
        out = mix(left.astype(np.uint64) * _GRAM)
        for i in np.flatnonzero(left > LONG_SPAN).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(self._data[starts[i] : ends[i]].tobytes(), digest_size=8).digest())
        at, left, rest = starts, np.where(left > LONG_SPAN, 0, left), None
        while True:
            more = np.flatnonzero(left > 0)
            if not len(more):
                return out
            if rest is not None or len(more) < len(left):
                at, left, rest = at[more], left[more], more if rest is None else rest[more]
            word = self._eight[at]
            word &= _KEPT[np.minimum(left, 8)]
            if rest is None:
                out = mix(out ^ word)
            else:
                out[rest] = mix(out[rest] ^ word)
            at, left = at + 8, left - 8


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """A quick hash of every n consecutive bytes, which picks candidates: some different ones share one.

    A polynomial modulo 2**64; whoever decides by a hash takes span_hashes().
    """
    count = len(data) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if len(_quick[0]) <= len(data):
        for i, base in enumerate((_GRAM, np.uint64(pow(int(_GRAM), -1, 1 << 64)))):
            powers = np.full(max(len(data), SLICE_BYTES) + 1, base, dtype=np.uint64)
            powers[0] = 1
            _quick[i] = np.cumprod(powers)
    power, inverse = _quick
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])
    return mix((prefix[n:] - prefix[:count]) * inverse[:count])


_quick: list[np.ndarray] = [np.ones(1, np.uint64)] * 2


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span's place of each different data[start:end], and for every span the number of its own.

    Hashes group the spans; then every byte is compared with the one that stands for it.
    """
    _, first, number = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    if _same_spans(data, starts, ends - starts, starts[first][number], (ends - starts)[first][number]):
        return first, number
    raw, numbers = data.tobytes(), {}
    number = np.array([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
    return np.unique(number, return_index=True)[1], number


def _same_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, others: np.ndarray, other_lengths: np.ndarray) -> bool:
    """Whether each span is byte by byte the other one: by its first and last eight bytes, longer ones in between too."""
    if not np.array_equal(lengths, other_lengths):
        return False
    eight = _eights(data)
    short = np.minimum(lengths, 8).astype(np.uint64)
    apart = (eight[starts] ^ eight[others]) << ((np.uint64(8) - short) * np.uint64(8) & np.uint64(63))
    if apart[short > 0].any():
        return False
    last = lengths > 8
    if (eight[(starts + lengths)[last] - 8] != eight[(others + lengths)[last] - 8]).any():
        return False
    for a, b, n in zip(starts[lengths > 16].tolist(), others[lengths > 16].tolist(), lengths[lengths > 16].tolist(), strict=True):
        if a != b and not np.array_equal(data[a : a + n], data[b : b + n]):
            return False
    return True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the offsets of each row into the list of words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive values (len(values) - n + 1 of them)."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out *= _GRAM
        out += values[i : i + count]
    return mix(out)
