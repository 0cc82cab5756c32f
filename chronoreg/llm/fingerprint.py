"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

The hashes of a text's word shingles are dealt once to bins by their upper bits, and each bin keeps its least hash.
Empty bins are filled by optimal densification: an empty bin tries the other bins in an order of its own, the same in
all documents, and takes the first that holds something. Of each bin the lower bits are packed into a hexadecimal
string. Two fingerprints agree in a bin by chance with probability C = 2**-bits, so their likeness is
(agreement - C) / (1 - C), cut off at 0.

The next document, for edited texts, is found on ids alone: they are partitioned by range, each range finds its own
neighbours, and one row a range closes the gaps. Texts move once by doc_id, and of each text the part that the
document before it needs; a fingerprint is made once and sent to its own row and to that of the document before. Only
the neighbours' ids are stored: on local file systems every part file that an executor writes starts processes.

Defined results: a null text is empty; an empty text or one of white space has an empty fingerprint, which is like
another empty one (1) and unlike all others (0); fewer words than a shingle are one shingle; of repeated rows of a
doc_id the least text stays; rows without a doc_id take no part; a single document is its own next; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoreg.llm import common

WORDS = 5
#: 2**BIN_BITS bins, of each of which STORED_BITS bits are stored (a multiple of four).
BIN_BITS = 7
STORED_BITS = 8
BINS = 1 << BIN_BITS
_VALUE_BITS = 63 - BIN_BITS
_EMPTY = (1 << _VALUE_BITS) - 1  # the largest value of a bin stands for an empty one
_DIGITS = STORED_BITS // 4
_CHANCE = 2.0**-STORED_BITS


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(i: int) -> Column:
    return F.lit(i).cast("long")


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """The hash of each shingle of consecutive words, at least 0."""
    split = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), lambda w: w != "")
    plus = lambda h: h.bitwiseAND(_number((1 << 63) - 1))

    def shingles(hashes: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(hashes) - (words - 1)), lambda i: plus(F.xxhash64(F.slice(hashes, i, F.lit(words)))))
        few = F.when(F.size(hashes) > 0, F.array(plus(F.xxhash64(hashes)))).otherwise(F.array().cast("array<long>"))
        return F.when(F.size(hashes) >= words, each).otherwise(few)

    return _let(F.transform(split, lambda w: F.xxhash64(w)), shingles)


def _least_of_bins(hashes: Column) -> Column:
    """The least value of each bin, _EMPTY where there is none; the marks are dealt and sorted like hashes."""
    bin_ = lambda h: F.shiftright(h, _VALUE_BITS)
    marks = F.transform(F.sequence(_number(0), _number(BINS - 1)), lambda j: F.shiftleft(j, _VALUE_BITS).bitwiseOR(_number(_EMPTY)))
    ordered = F.sort_array(F.concat(hashes, marks))
    heads = _let(ordered, lambda s: F.filter(s, lambda h, i: (i == 0) | (bin_(h) != bin_(F.get(s, i - 1)))))
    return F.transform(heads, lambda h: h.bitwiseAND(_number(_EMPTY)))


def _densified(least: Column) -> Column:
    """Each empty bin takes the value of the held bin that comes first in its own order of the bins."""

    def fill(values: Column) -> Column:
        held = F.filter(F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda x: x["v"] != _EMPTY)

        def chosen(j: Column, full: Column) -> Column:
            ranked = F.transform(full, lambda x: F.struct(F.xxhash64(j, x["i"]).alias("order"), x["v"].alias("v")))
            return F.array_min(ranked)["v"]

        return _let(held, lambda full: F.transform(values, lambda v, j: F.when(v != _EMPTY, v).otherwise(chosen(j, full))))

    return _let(least, fill)


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The packed lower bits of all bins in hexadecimal digits; empty for a text without words."""
    digits = lambda v: F.lpad(F.lower(F.hex(v.bitwiseAND(_number((1 << STORED_BITS) - 1)))), _DIGITS, "0")
    packed = lambda hashes: F.array_join(F.transform(_densified(_least_of_bins(hashes)), digits), "")
    return _let(shingle_hashes(text, words), lambda hashes: F.when(F.size(hashes) == 0, "").otherwise(packed(hashes)))


def likeness(one: Column, two: Column) -> Column:
    """The estimated similarity of two fingerprints, corrected for bits that agree by chance."""
    part = lambda f, i: F.substring(f, i * _DIGITS + 1, F.lit(_DIGITS))
    agree = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: part(one, i) == part(two, i))) / F.lit(BINS)
    corrected = F.greatest(F.lit(0.0), (agree - F.lit(_CHANCE)) / F.lit(1 - _CHANCE))
    return F.when(one == two, 1.0).when((one == "") | (two == ""), 0.0).otherwise(corrected)


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id, previous_id, ...) of distinct doc_ids: the neighbours in descending order, which is a ring."""
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy("part").orderBy(F.desc("doc_id"))
    ranges = ids.repartitionByRange(parts, F.desc("doc_id")).withColumn("part", F.spark_partition_id())
    ranges = ranges.withColumns({"next_id": F.lead("doc_id").over(inside), "previous_id": F.lag("doc_id").over(inside)})
    ranges = common.stage(ranges)  # since a repeated computation could draw other borders
    over = Window.orderBy("part")  # one row a range
    all_ = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = F.coalesce(F.lead("high").over(over), F.max("high").over(all_))
    before = F.coalesce(F.lag("low").over(over), F.min("low").over(all_))
    edges = ranges.groupBy("part").agg(F.max("doc_id").alias("high"), F.min("doc_id").alias("low"))
    closed = ranges.join(F.broadcast(edges.select("part", behind.alias("behind"), before.alias("before"))), "part")
    closed = closed.withColumns({"next_id": F.coalesce("next_id", "behind"), "previous_id": F.coalesce("previous_id", "before")})
    return closed.drop("part", "behind", "before")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has the last third of the code points, rounded down, replaced by as many first ones of the next
    document, or all that it has.
    """
    rows = common.one_row_each(docs)
    order = next_ids(rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars")))
    order = order.withColumn("cut", F.expr("CAST(n_chars div 3 AS INT)"))
    needed = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), F.col("cut"))
    heads = rows.join(needed, "doc_id").select(F.col("for_id").alias("doc_id"), F.left("text", F.col("cut")).alias("head"))
    edited = F.concat(F.left("text", (F.col("n_chars") - F.col("cut")).cast("int")), F.col("head"))
    both = rows.join(order, "doc_id").join(heads, "doc_id").select("doc_id", "previous_id", "n_chars", "text", edited.alias("edited"))
    made = both.select(
        "doc_id", "previous_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), words).alias("fingerprint"), fingerprint(F.col("edited"), words).alias("edited_fingerprint"),
    )
    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    absent = [F.lit(None).cast(made.schema[c].dataType).alias(c) for c in columns]
    own = F.struct("doc_id", *columns, F.lit(None).cast("string").alias("next_fingerprint"))
    sent = F.struct(F.col("previous_id").alias("doc_id"), *absent, F.col("fingerprint").alias("next_fingerprint"))
    # Each doc_id gets its own row and one that was sent.
    met = made.select(F.inline(F.array(own, sent))).groupBy("doc_id").agg(*(F.max(c).alias(c) for c in [*columns, "next_fingerprint"]))
    return met.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
