"""Mixing documents to target weights of soft domains, in DataFrame functions alone.

A naive Bayes classifier, counted by grouped aggregation over a labelled table, weighs for each document the evidence
of its words for each domain. Few labelled rows make such evidence too sure of itself, so each domain's is divided by a
temperature, those of `TEMPERATURES` under which labelled rows are likeliest when the counts leave out their own fold.
What share of the documents each domain has is not taken from the labels: it is estimated from the documents' evidence
(expectation maximisation), as the labelled rows may be another mixture than the documents at hand.

Documents whose evidence agrees in units of `UNIT` form a cell, so there are at most (2 * MOST / UNIT + 1) ** (domains
- 1) cells however many documents; the iterations read the staged cells alone. Rates r >= 0 are fitted so that the
expected tokens of the domains, sum(tokens * posterior * r), meet their targets: projected gradient descent on least
squares, scaled by the second moments of the cells whose rate is not 0. Of all solutions descent from r = 1 stays close
to the rates as they are. It ends when every domain is within `TOLERANCE` of its target, or comes no nearer; how far
the rates are from the targets is returned with them (`missed`, as a share of the mixture), and a miss is a warning.

Defined results: a null or empty text has no tokens and the evidence of a text without known words; labels that name no
domain are left out, and without any labelled row all domains are equally likely; targets are scaled to sum to 1; of
repeated rows of a doc_id the least text stays; rows without a doc_id take no part in the fit and :func:`mixed` keeps
them once; other columns are ignored by :func:`rates` and kept by :func:`mixed`.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common

#: Domains by conditions on the labelled table's rows (the first that holds counts), and their target weights.
DOMAINS = {"toxic": "toxic > 0", "poor": "quality = 0", "good": "quality > 0"}
TARGETS = {"toxic": 0.0, "poor": 0.02, "good": 0.98}
#: Runs of marks: neither letters, digits nor white space.
MARKS = r"([^\p{L}\p{M}\p{N}\s]+)"
#: Labelled rows used for counting, words in the classifier, and its smoothing.
TRAIN_ROWS = 20_000
VOCABULARY = 4096
LEAST_ROWS = 4
#: The evidence (in nats, over all labelled rows) that a word must bring: below it chance makes many.
LEAST_TOLD = 6.0
SMOOTHING = 10.0
#: The share of labelled rows up to which the lack of a word counts.
RARE = 0.05
#: Folds of the labelled rows, the temperatures that are tried on them, and how often for each domain.
FOLDS = 5
TURNS = 2
TEMPERATURES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0, 24.0, 32.0)
#: Evidence is rounded to such units (in nats) and reaches so far.
UNIT = 0.25
MOST = 20.0
#: Rounds that estimate the domains' shares, and documents that the labels' shares count for.
SHARE_ROUNDS = 30
SHARE_WEIGHT = 10.0
#: When the descent ends, its most rounds, and rounds between two stagings of the cells' rates.
TOLERANCE = 1e-3
ROUNDS = 200
STAGED = 8


def _words(rows: DataFrame) -> DataFrame:
    """(…, tokens, words): the number of words and runs of marks, and the distinct ones in lower case.

    A run of marks is told apart from the word before it, as a text's thousand marked words would be no thousandfold
    evidence. A text in which words follow themselves has one word more, by the order of magnitude of how often.
    """
    split = F.split(F.translate(F.regexp_replace(F.lower("text"), MARKS, " $1 "), "\t\n\x0b\x0c\r", " " * 5), " ")
    rows = rows.withColumn("every", F.filter(split, lambda w: w != ""))
    same = F.zip_with("every", F.slice("every", 2, F.greatest(F.size("every") - 1, F.lit(0))), lambda a, b: a == b)
    rows = rows.withColumn("again", F.size(F.filter(same, lambda x: x)))
    more = F.when(F.col("again") > 0, F.array(F.concat(F.lit(" again "), F.floor(F.log2("again")).cast("string")))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("tokens", F.size("every").cast("long")).withColumn("words", F.concat(F.array_distinct("every"), more)).drop("every", "text", "again")


def _told(n: list[Column], sizes: list[float], total: float) -> tuple[Column, Column]:
    """Arrays over the domains: what a word and what its lack tells, in nats, from its rows `n` in each domain.

    That is the logarithm of how much likelier it is in the domain than in all labelled rows. The lack of a word that
    few rows have counts; the lack of a frequent one does not, as it may only tell that a text is short.
    """
    overall = sum(n) / F.lit(max(total, 1.0))
    known = (overall > 0) & (overall < 1)
    chance = [(x + SMOOTHING * overall) / (size + SMOOTHING) for x, size in zip(n, sizes, strict=True)]
    word = F.array(*(F.when(known, F.ln(c / overall)).otherwise(0.0) for c in chance))
    lack = F.array(*(F.when(known & (overall <= RARE), F.ln((1 - c) / (1 - overall))).otherwise(0.0) for c in chance))
    return word, lack


class Evidence:
    """What the labelled rows tell: (word, weights) of the most telling words, and for each domain what a text without
    them has, the temperature by which a text's sum is divided, and the labelled rows."""

    def __init__(self, weights: DataFrame, without: list[float], temperatures: list[float], sizes: list[float]):
        self.weights, self.without, self.temperatures, self.sizes = weights, without, temperatures, sizes


def learn(docs: DataFrame, labels: DataFrame, domains: dict[str, str] = DOMAINS, rows: int = TRAIN_ROWS, size: int = VOCABULARY) -> Evidence:
    """Counts the words of at most `rows` labelled documents; of those that tell enough, the `size` that tell most are kept."""
    spark = docs.sparkSession
    some = range(len(domains))
    domain = F.expr("CASE " + " ".join(f"WHEN {condition} THEN {i}" for i, condition in enumerate(domains.values())) + " END")
    sample = (
        labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain")).where("domain IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(rows)
    )
    # The sample is bounded by `rows`, so it may be broadcast.
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    held = common.stage(_words(docs.join(F.broadcast(sample), "doc_id")).withColumn("fold", fold))
    found = {(r.domain, r.fold): float(r["count"]) for r in held.groupBy("domain", "fold").count().collect()}
    by_fold = [[found.get((i, f), 0.0) for i in some] for f in range(FOLDS)]
    sizes = [sum(s[i] for s in by_fold) for i in some]
    if not sum(sizes):
        return Evidence(spark.createDataFrame([], "word string, weights array<double>"), [0.0 for _ in some], [1.0 for _ in some], sizes)
    each = [F.count(F.when((F.col("domain") == i) & (F.col("fold") == f), 1)).cast("double").alias(f"n{i}_{f}") for f in range(FOLDS) for i in some]
    counts = held.select("domain", "fold", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), *each).where(F.col("n") >= LEAST_ROWS)
    whole = [sum(F.col(f"n{i}_{f}") for f in range(FOLDS)) for i in some]
    word, lack = _told(whole, sizes, sum(sizes))
    telling = sum(n * word[i] for i, n in enumerate(whole))
    telling = F.round(telling, 9)
    chosen = counts.where(telling >= LEAST_TOLD).orderBy(telling.desc(), "word").limit(size)
    names = ["word", "lack"]
    columns = [word.alias("word_0"), lack.alias("lack_0")]
    for f in range(FOLDS):  # without the fold's own rows
        rest = [s - t for s, t in zip(sizes, by_fold[f], strict=True)]
        told = _told([n - F.col(f"n{i}_{f}") for i, n in enumerate(whole)], rest, sum(rest))
        columns += [c.alias(f"{name}_{f + 1}") for name, c in zip(names, told, strict=True)]
    chosen = common.stage(chosen.select(F.col("word").alias("word"), *columns))
    sums = chosen.agg(*(F.coalesce(F.sum(F.col(f"lack_{f}")[i]), F.lit(0.0)) for f in range(FOLDS + 1) for i in some)).first()
    without = [[float(sums[f * len(domains) + i]) for i in some] for f in range(FOLDS + 1)]
    more = [F.zip_with(f"word_{f}", f"lack_{f}", lambda a, b: a - b).alias(f"more_{f}") for f in range(FOLDS + 1)]
    chosen = chosen.select("word", *more)
    return Evidence(chosen.select("word", F.col("more_0").alias("weights")), without[0], _temperatures(held, chosen, without, sizes), sizes)


def _temperatures(held: DataFrame, chosen: DataFrame, without: list[list[float]], sizes: list[float]) -> list[float]:
    """The temperatures under which the labelled rows' own domains are likeliest, each row judged without its fold."""
    some = range(len(sizes))
    # The vocabulary is bounded by its size.
    met = held.select("doc_id", "domain", "fold", F.explode_outer("words").alias("word")).join(F.broadcast(chosen), "word", "left")
    own = F.element_at(F.array(*(F.col(f"more_{f + 1}") for f in range(FOLDS))), F.col("fold") + 1)
    scored = met.groupBy("doc_id", "domain", "fold").agg(*(F.coalesce(F.sum(own[i]), F.lit(0.0)).alias(f"s{i}") for i in some))
    rest = F.array(*(F.array(*(F.lit(x) for x in without[f + 1])) for f in range(FOLDS)))
    summed = common.stage(scored.select("domain", *((F.col(f"s{i}") + F.element_at(rest, F.col("fold") + 1)[i]).alias(f"s{i}") for i in some)))
    logs = [float(np.log(max(s, 1e-9) / sum(sizes))) for s in sizes]

    def loss(temperatures: list[float]) -> Column:
        values = [F.col(f"s{i}") / temperatures[i] + logs[i] for i in some]
        top = F.greatest(*values) if len(values) > 1 else values[0]
        return F.avg(top + F.ln(sum(F.exp(v - top) for v in values)) - F.element_at(F.array(*values), F.col("domain") + 1))

    same = [float(x or 0.0) for x in summed.agg(*(loss([t for _ in some]) for t in TEMPERATURES)).first()]
    best = [TEMPERATURES[int(np.argmin(np.round(same, 9)))] for _ in some]
    for _ in range(TURNS):
        for i in some:
            found = [float(x or 0.0) for x in summed.agg(*(loss([*best[:i], t, *best[i + 1 :]]) for t in TEMPERATURES)).first()]
            best[i] = TEMPERATURES[int(np.argmin(np.round(found, 9)))]
    return best


def _shares(cells: DataFrame, sizes: list[float]) -> list[float]:
    """The domains' shares of the documents, from the cells' evidence."""
    some, total = range(len(sizes)), sum(sizes)
    labelled = np.array([(s + 0.5) / (total + 0.5 * len(sizes)) for s in sizes])
    share = labelled
    for _ in range(SHARE_ROUNDS):
        sums = np.array([float(x or 0.0) for x in cells.agg(*(F.sum(F.col("documents") * p) for p in _posteriors(share))).first()])
        before, share = share, sums + SHARE_WEIGHT * labelled
        share = share / share.sum()
        if np.abs(share - before).max() < 1e-4:
            break
    return [float(share[i]) for i in some]


def _posteriors(shares: np.ndarray | list[float]) -> list[Column]:
    logs = [F.col(f"e{i}") * UNIT + float(np.log(max(s, 1e-12))) for i, s in enumerate(shares)]
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    powers = [F.exp(x - top) for x in logs]
    return [p / sum(powers) for p in powers]


def posteriors(docs: DataFrame, labels: DataFrame, domains: dict[str, str] = DOMAINS, train: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Staged (doc_id, tokens, e0...) of every document, one row for each doc_id, and the cells of equal evidence
    (e0..., documents, tokens, p_<domain>...).

    `train` holds the texts of the labelled rows, where docs lacks some of them; by default it is docs.
    """
    rows = common.one_row_each(docs)
    told = learn(rows if train is None else common.one_row_each(train), labels, domains)
    some = range(len(domains))
    spread = _words(rows).select("doc_id", "tokens", F.explode_outer("words").alias("word"))
    # The vocabulary is bounded by its size.
    met = spread.join(F.broadcast(told.weights), "word", "left")
    scored = met.groupBy("doc_id").agg(F.max("tokens").alias("tokens"), *(F.coalesce(F.sum(F.col("weights")[i]), F.lit(0.0)).alias(f"s{i}") for i in some))
    # Words that come in any order may add up differently in the last digits.
    values = [F.round(F.col(f"s{i}") + x, 6) / told.temperatures[i] for i, x in enumerate(told.without)]
    top = F.greatest(*values) if len(values) > 1 else values[0]
    evidence = [F.greatest(F.round((v - top) / UNIT), F.lit(-MOST / UNIT)).cast("int").alias(f"e{i}") for i, v in enumerate(values)]
    found = common.stage(scored.select("doc_id", "tokens", *evidence))
    cells = common.stage(found.groupBy(*(f"e{i}" for i in some)).agg(F.count("*").alias("documents"), F.sum("tokens").cast("double").alias("tokens")))
    p = _posteriors(_shares(cells, told.sizes))
    return found, common.stage(cells.select("*", *(x.alias(f"p_{n}") for x, n in zip(p, domains, strict=True))))


def descend(cells: DataFrame, names: list[str], targets: dict[str, float], total: float | None = None) -> tuple[DataFrame, float]:
    """The cells with their rates, and how far the farthest domain is from its target, as a share of the mixture."""
    p = [F.col(f"p_{n}") for n in names]
    some, tokens = range(len(p)), F.col("tokens")
    cells = cells.withColumn("rate", F.lit(1.0))
    weight = np.array([max(targets.get(n, 0.0), 0.0) for n in names])
    scale, best, worse, damping = 0.0, np.inf, 0, 1.0
    kept = cells
    for turn in range(ROUNDS):
        moving = F.when(F.col("rate") > 0, tokens).otherwise(0.0)
        sums = cells.agg(*(F.sum(tokens * x * F.col("rate")) for x in p), *(F.sum(moving * x * y) for x in p for y in p)).first()
        now, moments = np.array([float(x or 0.0) for x in sums[: len(p)]]), np.array([float(x or 0.0) for x in sums[len(p) :]]).reshape(len(p), len(p))
        if not turn:
            if not now.sum():
                return cells, 0.0
            weight = weight / weight.sum() if weight.sum() else now / now.sum()
            lead = int(weight.argmax())
            scale = float(total if total else now[lead] / weight[lead])
        distance = float(np.abs(now - scale * weight).max() / scale) if scale else 0.0
        if distance < best * 0.999:
            best, kept, worse = distance, cells, 0
        else:
            worse, damping = worse + 1, damping / 2
        if best < TOLERANCE or worse > 8:
            break
        step = damping * np.linalg.lstsq(moments + 1e-9 * max(moments.trace(), 1e-300) * np.eye(len(p)), now - scale * weight, rcond=None)[0]
        cells = cells.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - sum(p[i] * float(step[i]) for i in some)))
        if turn % STAGED == STAGED - 1:
            cells = common.stage(cells)
    return kept, best


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, domains: dict[str, str] = DOMAINS, total: float | None = None, train: DataFrame | None = None) -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate, missed) of every document.

    `total` is the tokens that the mixture shall have; by default as many as give the domain with the largest target
    the tokens that it has.
    """
    names = list(domains)
    rows, cells = posteriors(docs, labels, domains, train)
    fitted, missed = descend(cells, names, targets, total)
    if missed >= TOLERANCE:
        warnings.warn(f"mixing: a domain's share is {missed:.4f} away from its target", stacklevel=2)
    fitted = common.stage(fitted.withColumn("rate", F.round("rate", 9)))
    keys = [f"e{i}" for i in range(len(names))]
    joined = rows.join(fitted.drop("tokens", "documents"), keys)
    return joined.select("doc_id", "tokens", *(f"p_{n}" for n in names), "rate", F.lit(missed).alias("missed"))


def mixed(docs: DataFrame, fitted: DataFrame) -> DataFrame:
    """The rows of docs as often as their rate says: its whole part, and once more with the chance of the rest.

    The chance is drawn from a hash of doc_id, so a repeated run gives the same rows.
    """
    chance = F.pmod(F.xxhash64("__id", F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    times = fitted.select(F.col("doc_id").alias("__id"), F.col("rate")).select("__id", F.floor(F.col("rate") + chance).cast("int").alias("__times"))
    joined = docs.join(times, docs["doc_id"].cast("long") == times["__id"], "left")
    copies = joined.withColumn("__copies", F.array_repeat(F.lit(0), F.coalesce("__times", F.lit(1))))
    return copies.withColumn("__copy", F.explode("__copies")).select(*docs.columns)
