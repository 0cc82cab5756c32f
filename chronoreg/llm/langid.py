"""Language identification of web pages by Bayesian evidence fusion.

Four pieces of evidence meet for each page: the likelihood of its visible text under byte-trigram models, the language
that its markup declares, the suffix of its address, and how its host's other pages read. The text models are counted
from a bounded sample of labelled documents. What a declaration or a suffix is worth is not set by hand: the text's
verdicts, summed by grouped aggregation, tell how often each declaration goes with each language. A host's prior is its
own pages' sum, without the page itself, smoothed towards its domain, and that towards all pages. The grouped tables
are stored before they are joined back, so a host with a third of all pages is a skewed join that Spark splits.

Defined results: a null or empty page has no text evidence, a page without declaration or host none of theirs; repeated
rows get a row each and a null page_id stays null; without labelled documents the language is null; other columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common

#: Labelled documents for the text models, and hashed trigrams.
TRAIN_ROWS = 6000
BITS = 15
#: Overlapping trigrams tell less than independent ones: the share of their log-likelihood that counts.
TEMPER = 0.2
#: Rows that a prior weighs as much as.
SMOOTHING = 5.0

_OPENS = re.compile(rb"<!--|<(script|style)\b")
_CLOSES = {b"": re.compile(rb"-->"), b"script": re.compile(rb"</script\s*>"), b"style": re.compile(rb"</style\s*>")}
_TAG = re.compile(rb"<[^>]*>")
_HTML_TAG = re.compile(rb"<html\b([^>]*)", re.IGNORECASE)
_LANG = re.compile(rb"""\blang\s*=\s*["']?\s*([A-Za-z]{2,3})\b""", re.IGNORECASE)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # a row of log-probabilities of hashed trigrams for each language


def _trigrams(data: np.ndarray) -> np.ndarray:
    """The hashed trigram at each of len(data) - 2 places."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    low = common.lowered(data).astype(np.uint64)
    return (common.mix(low[:-2] << np.uint64(16) | low[1:-1] << np.uint64(8) | low[2:]) >> np.uint64(64 - BITS)).astype(np.int64)


def _in_rows(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place (exclusive) of each row's trigrams."""
    ends = np.maximum(offsets[1:] - 2, offsets[:-1])
    return np.minimum(offsets[:-1], n), np.minimum(ends, n)


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> TextModel:
    """Counts trigrams of at most `rows` documents (doc_id, text, lang)."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    sample = labelled.select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(rows)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            data, offsets = common.buffer(part.column(0))
            grams = _trigrams(data)
            lows, highs = _in_rows(offsets, len(grams))
            counts: dict[str, np.ndarray] = {}
            for lang, a, b in zip(part.column(1).to_pylist(), lows.tolist(), highs.tolist(), strict=True):
                counts[lang] = counts.get(lang, 0) + np.bincount(grams[a:b], minlength=1 << BITS)
            for lang, count in counts.items():
                slots = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots), pa.string()), pa.array(slots.astype(np.int32)), pa.array(count[slots])], ["lang", "slot", "n"])

    # The sample is bounded by `rows`; its sums are 2**BITS rows a language at most.
    chosen = labelled.join(F.broadcast(sample), ["doc_id", "lang"]).select("text", "lang")
    sums = chosen.mapInArrow(kernel, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    total: dict[str, np.ndarray] = {}
    for lang, slot, n in zip(*(sums.column(c).to_pylist() for c in ("lang", "slot", "n")), strict=True):
        total.setdefault(lang, np.zeros(1 << BITS))[slot] = n
    languages = tuple(sorted(total))
    table = np.array([total[x] + 0.5 for x in languages]).reshape(len(languages), 1 << BITS)
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)) if languages else table)


def visible(html: bytes) -> bytes:
    """The page without comments, scripts, styles and tags; what is not closed stays. One scan, however much is open."""
    lower = html.lower()
    closes = {kind: [m.span() for m in close.finditer(lower)] for kind, close in _CLOSES.items()}
    shown, at = [], 0
    for m in _OPENS.finditer(lower):
        if m.start() < at:
            continue
        spans = closes[m[1] or b""]
        nearest = bisect_left(spans, (m.end(), 0))
        if nearest < len(spans):
            shown.append(html[at : m.start()])
            at = spans[nearest][1]
    text = b" ".join([*shown, html[at:]])
    closed = text.rfind(b">") + 1  # behind it no tag ends
    return _TAG.sub(b" ", text[:closed]) + text[closed:]


def declared_language(html: bytes) -> str | None:
    """The lang attribute of the first html tag that has one."""
    found = (_LANG.search(m[1]) for m in _HTML_TAG.finditer(html))
    return next((m[1].decode().lower() for m in found if m), None)


def _evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, host, domain, suffix, declared, text): the log-likelihoods of the text, best language at 0."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # languages times 2**BITS numbers

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, "html"):
            raw = [(x or "").encode() for x in part.column(2).to_pylist()]
            declared = [declared_language(x) for x in raw]
            data, offsets = common.buffer(pa.array([visible(x) for x in raw], pa.binary()))
            grams = _trigrams(data)
            lows, highs = _in_rows(offsets, len(grams))
            sums = [np.concatenate([[0.0], np.cumsum(logs[grams])]) for logs in shared.value.logs]
            scores = np.stack([s[highs] - s[lows] for s in sums], axis=1) * TEMPER
            scores -= scores.max(axis=1, keepdims=True)
            hosts = [(m[1].lower().rstrip(".") if (m := _HOST.match(x or "")) else None) for x in part.column(1).to_pylist()]
            domains = [h and ".".join(h.split(".")[-2:]) for h in hosts]
            suffixes = [h and h.rsplit(".", 1)[-1] for h in hosts]
            columns = [part.column(0), *(pa.array(c, pa.string()) for c in (hosts, domains, suffixes, declared)), pa.array(scores.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "domain", "suffix", "declared", "text"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(kernel, "page_id long, host string, domain string, suffix string, declared string, text array<double>")


def _each(n: int, value) -> Column:
    return F.array(*(value(i) for i in range(n)))


def _softmax(logs: Column) -> Column:
    powers = lambda m: F.transform(logs, lambda x: F.exp(x - m))
    shares = lambda p: F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, b: a + b))
    return F.get(F.transform(F.array(F.array_max(logs)), lambda m: F.get(F.transform(F.array(powers(m)), shares), F.lit(0))), F.lit(0))


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, lang, probability, declared, host) of every page."""
    n = len(model.languages)
    if not n:
        nothing = (F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("probability", "double"), ("declared", "string"), ("host", "string")))
        return pages.select(F.col("page_id").cast("long").alias("page_id"), *nothing)
    rows = common.stage(_evidence(pages, model).withColumn("said", _softmax(F.col("text"))))
    sums = [F.sum(F.col("said")[i]) for i in range(n)]
    whole = rows.agg(F.count("*"), *sums).first()  # one number a language
    count, overall = whole[0], [((x or 0.0) + SMOOTHING / n) / (whole[0] + SMOOTHING) for x in whole[1:]]
    prior = F.array(*map(F.lit, overall))

    def grouped(key: str, name: str) -> DataFrame:
        return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(f"{name}_n"), F.array(*sums).alias(f"{name}_s"))

    def worth(key: str) -> DataFrame:
        """log P(value | language), up to what all languages share."""
        seen = lambda i: (F.col("v_s")[i] + SMOOTHING * F.col("v_n") / count) / (F.lit(overall[i] * count) + SMOOTHING)
        return common.stage(grouped(key, "v").select(key, _each(n, lambda i: F.ln(seen(i) * count / F.col("v_n"))).alias(f"{key}_log")))

    host, domain = common.stage(grouped("host", "host")), common.stage(grouped("domain", "domain"))
    joined = rows.join(worth("declared"), "declared", "left").join(worth("suffix"), "suffix", "left").join(domain, "domain", "left").join(host, "host", "left")

    def towards(name: str, i: int, base: Column) -> Column:
        """The share of language i among the group's other pages, smoothed towards base."""
        others = F.greatest(F.col(f"{name}_s")[i] - F.col("said")[i], F.lit(0.0))
        return F.coalesce((others + SMOOTHING * base) / (F.col(f"{name}_n") - 1 + SMOOTHING), base)

    total = lambda i: (
        F.col("text")[i]
        + F.coalesce(F.col("declared_log")[i], F.lit(0.0))
        + F.coalesce(F.col("suffix_log")[i], F.lit(0.0))
        + F.ln(towards("host", i, towards("domain", i, prior[i])))
    )
    found = joined.withColumn("fused", _softmax(_each(n, total)))
    best = F.array_position("fused", F.array_max("fused")).cast("int")
    names = F.array(*map(F.lit, model.languages))
    # Sums of doubles in any order may differ in the last digits.
    return found.select("page_id", F.get(names, best - 1).alias("lang"), F.round(F.array_max("fused"), 6).alias("probability"), "declared", "host")
