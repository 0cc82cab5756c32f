"""Near-duplicate detection by fast similarity sketches, banding and exact verification.

A document's set holds the hashes of its distinct shingles. Its sketch has `rows * bands` coordinates, filled in
rounds: in round i every element is thrown into one bin with a value in [i, i + 1), and a bin keeps its least value.
A round costs one step per element, and a few rounds fill all bins of all but tiny sets; after as many rounds as
bins, round i serves bin i alone, so that every coordinate is filled for certain. Coordinates then agree with
probability J and their mean is concentrated as if they were independent.

Documents with equal sets stand together as one from the start. Bands of the sketches name buckets. In each bucket
everyone is first compared with the smallest document. With the links found and their components known, buckets that
still hold several components are compared as a whole, in blocks, so that no pair that could join two components is
left out. All comparisons are made on the full sets; only links leave a task.

Defined results: null text, no words: empty set, linked with nothing; fewer words than a shingle: all of them are one;
repeated rows of a doc_id count once (of different texts the one with the least set stays: fewest shingles, then by the
set's hash); rows without a doc_id take no part; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common, exchange
from chronoreg.llm.components import components

WORDS = 5
SIMILARITY = 0.8
#: Coordinates of a band, and the chance at most that a pair at the threshold shares no band.
ROWS = 7
MISS = 1e-6
#: Documents of a block, and elements of a matrix's block, where documents of one bucket are compared.
BLOCK = 1024
COLUMNS = 8192


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that a pair at the threshold escapes with probability `miss` at most."""
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, row by row, and each row's offsets into them."""
    data, offsets = common.buffer(column)
    data = common.lowered(data)
    starts, ends, rows = common.word_spans(data, offsets)
    hashes = common.span_hashes(data, starts, ends)
    grams = common.gram_hashes(hashes, words)
    sets = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(grams[a : b - words + 1]))
        else:
            sets.append(common.gram_hashes(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])


def sketches(values: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """A row of `size` coordinates for each set; the rows of empty sets mean nothing."""
    n = len(offsets) - 1
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * size, empty, np.uint64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    for turn in range(2 * size):
        if not len(row):
            break
        hashed = common.mix(values ^ common.mix(np.array([turn + 1], np.uint64)))
        bins = (hashed >> np.uint64(32)) % np.uint64(size) if turn < size else np.full(len(row), turn - size, np.uint64)
        np.minimum.at(out, row * size + bins.astype(np.int64), np.uint64(turn << 32) | (hashed & np.uint64(0xFFFFFFFF)))
        open_rows = (out.reshape(n, size) == empty).any(axis=1)[row]
        values, row = values[open_rows], row[open_rows]
    return out.reshape(n, size)


def band_keys(rows: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band's coordinates and number."""
    coordinates = rows.reshape(len(rows), bands, -1)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(rows), 1))
    for i in range(coordinates.shape[2]):
        keys = common.mix(keys ^ coordinates[:, :, i])
    return keys


def _set_keys(values: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """128 bits for each set that stand for it, as two columns."""
    sums = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix(values ^ np.uint64(seed)))]) for seed in (11, 13))
    return [pa.array((s[offsets[1:]] - s[offsets[:-1]]).view(np.int64)) for s in sums]


def _sketched(docs: DataFrame, words: int, bands: int) -> DataFrame:
    """(doc_id, n_shingles, set_high, set_low, keys): the set's size, 128 bits that stand for it, and its bands."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            values, offsets = shingle_sets(part.column(1), words)
            keys = band_keys(sketches(values, offsets, ROWS * bands), bands).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
            columns = [part.column(0), pa.array(np.diff(offsets)), *_set_keys(values, offsets), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_high", "set_low", "keys"])

    rows = docs.mapInArrow(kernel, "doc_id long, n_shingles long, set_high long, set_low long, keys array<long>")
    least = rows.groupBy("doc_id").agg(F.min(F.struct("n_shingles", "set_high", "set_low", "keys")).alias("least"))
    return least.select("doc_id", "least.*")


def _sets(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """(doc_id, set) of the wanted (doc_id, set_high, set_low): the sorted shingle hashes, eight bytes each."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            values, offsets = shingle_sets(part.column(1), words)
            raw = values.tobytes()
            sets = [raw[8 * a : 8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *_set_keys(values, offsets), pa.array(sets, pa.binary())], ["doc_id", "set_high", "set_low", "set"])

    some = docs.join(wanted, "doc_id", "left_semi").mapInArrow(kernel, "doc_id long, set_high long, set_low long, set binary")
    return some.join(wanted, ["doc_id", "set_high", "set_low"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "set")


def _linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    percent = round(similarity * 100)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(one) + len(two)
                common_ = both - len(np.union1d(one, two))
                keep.append(100 * common_ >= percent * (both - common_))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], ["a", "b"])

    one = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b").mapInArrow(kernel, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    component_id is the smallest doc_id that links reach; kept marks the documents that are their component's own.
    """
    percent = round(similarity * 100)
    docs = common.texts(docs)
    sketched = common.stage(_sketched(docs, words, bands_for(similarity)))
    same = ["n_shingles", "set_high", "set_low"]
    classes = sketched.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("first"))
    classes = common.stage(classes)  # so that both sides of the join can be split where a class is large
    members = common.stage(sketched.join(classes, same, "left").select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("first"), "set_high", "set_low", "keys"))
    single = members.where("n_shingles > 0 AND first = doc_id")
    banded = single.select("doc_id", "n_shingles", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last")).where("pivot < last").select("key", "pivot")
    buckets = common.stage(banded.join(shared, "key"))
    wanted = single.select("doc_id", "set_high", "set_low").join(buckets.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = common.stage(_sets(docs, words, wanted))

    pivots = buckets.select(F.col("doc_id").alias("pivot"), F.col("n_shingles").alias("n_pivot")).distinct()
    alike = f"100 * least(n_shingles, n_pivot) >= {percent} * greatest(n_shingles, n_pivot)"
    to_pivot = buckets.where("doc_id > pivot").select("pivot", "doc_id", "n_shingles").distinct().join(pivots, "pivot").where(alike)
    links = common.stage(_linked(to_pivot.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")), sets, similarity))

    labelled = _labelled(buckets, components(links))
    links = common.stage(links.union(_linked_across(common.stage(labelled), sets, similarity)))

    found = members.select("doc_id", "n_shingles", "first").join(components(links).withColumnRenamed("node", "first"), "first", "left")
    component = F.coalesce("component", "first")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))


def _labelled(buckets: DataFrame, found: DataFrame) -> DataFrame:
    return buckets.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _linked_across(labelled: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links (a, b) between different components within a bucket.

    Copies of a text share most of their buckets, so a bucket with the same documents as another one is left out. The
    others are cut into blocks of BLOCK documents, and each pair of blocks is compared by one task, which counts all
    intersections as a product of matrices and returns links alone.
    """
    summed = labelled.groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("documents"),
        F.min("component").alias("least"), F.max("component").alias("most"),
    )
    mixed = common.stage(summed.where("least < most").groupBy("n", "documents").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    dealt = labelled.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("blocks")))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "component")
    percent = round(similarity * 100)

    def links_of(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        docs, component = (np.asarray(cell.column(c)) for c in ("doc_id", "component"))
        shingles = [np.frombuffer(x.as_buffer(), np.uint64) for x in cell.column("set")]
        sizes = np.array([len(x) for x in shingles])
        both = common_counts(shingles)
        alike = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        one, two = np.nonzero(alike & (component[:, None] != component[None, :]) & (docs[:, None] < docs[None, :]))
        return docs[one], docs[two]

    def compare(table: pa.Table) -> pa.Table:
        """A task's call takes several cells, one after the other."""
        table = table.sort_by([(c, "ascending") for c in ("key", "i", "j")])
        names = np.stack([np.asarray(table.column(c)) for c in ("key", "i", "j")])
        edges = [0, *(np.flatnonzero((np.diff(names) != 0).any(axis=0)) + 1).tolist(), table.num_rows]
        found = [links_of(table.slice(a, b - a)) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        none = np.zeros(0, np.int64)
        return pa.table({c: np.concatenate([none, *(x[n] for x in found)]) for n, c in enumerate("ab")})

    dealt_cells = cells.withColumn("deal", F.pmod(F.xxhash64("key", "i", "j"), F.lit(exchange.buckets(cells))))
    return dealt_cells.join(sets, "doc_id").groupBy("deal").applyInArrow(compare, "a long, b long").distinct()


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets have in common."""
    values, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = count[number] > 1
    row, number = row[shared], (np.cumsum(count > 1) - 1)[number[shared]]
    total = np.diag([float(len(x)) for x in sets])
    off = ~np.eye(len(sets), dtype=bool)
    width = int((count > 1).sum())
    for low in range(0, width, COLUMNS):
        some = (number >= low) & (number < low + COLUMNS)
        held = np.zeros((len(sets), min(COLUMNS, width - low)), np.float32)
        held[row[some], number[some] - low] = 1
        total += (held @ held.T) * off
    return np.rint(total).astype(np.int64)


def without_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """The rows of docs, unchanged, whose document is the one that its component keeps; rows without a doc_id stay.

    Of rows that are equal in doc_id and text any one stays.
    """
    gone = near_duplicates(docs.select("doc_id", "text"), similarity, words).where("NOT kept").select(F.col("doc_id").alias("__gone"))
    kept = docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
    again = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__again"))
    again = common.stage(again)  # few ids or none, and then no text is shuffled for them
    twice = kept.join(again, kept["doc_id"] == again["__again"], "left_semi")
    return kept.join(again, kept["doc_id"] == again["__again"], "left_anti").union(twice.dropDuplicates(["doc_id", "text"]))


