"""Toxicity scores by a weighted finite-state grammar of clauses.

A lexicon reads words as symbols: insult, threat, target, negation, reported speech, or none of these. Transducers then
rewrite a clause's symbols: negation turns the insults and threats in its reach into denied ones, a verb of saying
turns those behind it into reported ones, and the last one reads a clause to its end and names it by its gravest event
and by whether it is aimed at somebody. They are composed into one machine; its paths add up the arcs' weights. A
document's score is a logistic function of what its matched clauses weigh, so a word counts as its clause uses it.

What is learnt comes from labelled rows: the insults that the fixed lists lack, as word beginnings that stand in toxic
documents far more often than chance allows (a document's copies count once, or their words would pass for insults),
and how much each kind of clause weighs, held near the machine's own weights. The sample is bounded by `TRAIN_ROWS`; at most `CANDIDATES` beginnings of it are counted. All
else is one pass of tasks over whole texts, without a shuffle.

Defined results: a null or empty text, or one without a matched clause, scores by the shares of the labels alone;
without labelled rows the fixed lists and weights decide; labels without a doc_id or a value are left out, and of
several for a doc_id the highest counts; repeated rows are scored each; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common

#: Labelled rows that are learnt from, word beginnings counted in them, and their lengths in bytes.
TRAIN_ROWS = 12_000
CANDIDATES = 50_000
LENGTHS = range(3, 13)
#: Toxic rows that an insult must stand in, how unlikely chance must make this (in nats), and how sure it must be.
LEAST_ROWS = 3
LEAST_EVIDENCE = 18.0
LEAST_SURE = 0.9
#: Bands of two coordinates of a sketch of a toxic row's word shingles, by which copies are recognised.
BANDS = 8
SHINGLE = 5
PENALTY = 0.5
#: Words that a negation reaches.
REACH = 3
# Words of each class in the four languages.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "idiota", "imbécil", "estúpido", "dummkopf", "trottel", "abschaum", "imbécile", "crétin")
THREATS = ("kill", "hurt", "destroy", "beat", "burn", "murder", "matar", "matarte", "destruir", "töten", "umbringen", "schlagen", "tuer", "frapper", "détruire")
TARGETS = ("you", "your", "he", "she", "they", "him", "her", "them", "tú", "usted", "ellos", "ella", "du", "dich", "ihr", "sie", "tu", "toi", "vous", "ils", "elle")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "nunca", "jamás", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais")
REPORTS = ("said", "says", "wrote", "claimed", "called", "quoted", "dijo", "escribió", "sagte", "schrieb", "behauptete", "dit", "écrit", "affirmait")
ENDS = b".!?;\n"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, DENIED_INSULT, DENIED_THREAT, SAID_INSULT, SAID_THREAT = SYMBOLS = range(11)
#: Events from the least to the gravest; a clause's name is its gravest event, and whether it is aimed.
EVENTS = (DENIED_THREAT, DENIED_INSULT, SAID_THREAT, SAID_INSULT, INSULT, THREAT)
NAMES = 2 * len(EVENTS)

_SOLID = np.zeros(256, bool)  # letters and digits, and every byte of a character beyond ASCII
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _SOLID[_low:_high] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(ENDS)] = True


@dataclass(frozen=True)
class Transducer:
    """For each state and symbol: the next state, the symbol that is written, and the arc's weight."""

    arcs: tuple[tuple[tuple[int, int, float], ...], ...]

    def compose(self, other: Transducer) -> Transducer:
        """What reads as this one and writes as the other one makes of it; weights add up."""
        numbers, rows, waiting = {(0, 0): 0}, [], [(0, 0)]
        for one, two in waiting:
            row = []
            for to, out, weight in self.arcs[one]:
                onward, written, more = other.arcs[two][out]
                if (to, onward) not in numbers:
                    numbers[to, onward] = len(numbers)
                    waiting.append((to, onward))
                row.append((numbers[to, onward], written, weight + more))
            rows.append(tuple(row))
        return Transducer(tuple(rows))


def negation() -> Transducer:
    """States count the words that a negation still reaches."""
    denied = {INSULT: (DENIED_INSULT, -2.0), THREAT: (DENIED_THREAT, -2.0)}
    rows = []
    for left in range(REACH + 1):
        arc = lambda s, left=left: (REACH, s, 0.0) if s == NEGATION else (0, s, 0.0) if s == END else (max(left - 1, 0), *(denied.get(s, (s, 0.0)) if left else (s, 0.0)))
        rows.append(tuple(arc(s) for s in SYMBOLS))
    return Transducer(tuple(rows))


def reported_speech() -> Transducer:
    """The second state lasts from a verb of saying to the clause's end."""
    said = {INSULT: (SAID_INSULT, -1.5), THREAT: (SAID_THREAT, -2.0)}
    before = tuple((int(s == REPORT), s, 0.0) for s in SYMBOLS)
    behind = tuple((int(s != END), *said.get(s, (s, 0.0))) for s in SYMBOLS)
    return Transducer((before, behind))


def clauses() -> Transducer:
    """States are the gravest event so far and whether a target was met; the end writes the clause's name, from 1 on."""
    weights = {INSULT: 4.0, DENIED_INSULT: 4.0, SAID_INSULT: 4.0, THREAT: 1.0, DENIED_THREAT: 1.0, SAID_THREAT: 1.0}
    rows = []
    for event in range(len(EVENTS) + 1):
        for aimed in (0, 1):
            row = []
            for s in SYMBOLS:
                if s == END:
                    row.append((0, event and 2 * event - 1 + aimed, (1.0 if event and aimed else 0.0)))
                else:
                    grave = EVENTS.index(s) + 1 if s in EVENTS else 0
                    # A clause weighs what its gravest event does.
                    more = weights[s] - (weights[EVENTS[event - 1]] if event else 0.0) if grave > event else 0.0
                    row.append((2 * max(event, grave) + (aimed or s == TARGET), 0, more))
            rows.append(tuple(row))
    return Transducer(tuple(rows))


def grammar() -> Transducer:
    return negation().compose(reported_speech()).compose(clauses())


def own_weights(machine: Transducer) -> np.ndarray:
    """The weight that the machine itself gives to each kind of clause: that of the shortest clause of its name."""
    found = np.zeros(NAMES)
    seen, waiting = {0}, [(0, 0.0)]
    named: set[int] = set()
    for state, weight in waiting:
        for to, out, more in machine.arcs[state][: END + 1]:  # the symbols that the lexicon reads
            if out and out not in named:
                named.add(out)
                found[out - 1] = weight + more
            if to not in seen:
                seen.add(to)
                waiting.append((to, weight + more))
    return found


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; where each word's letters start and end; its text's number; whether a clause ends behind it."""
    data, offsets = common.buffer(column)
    data = common.lowered(data)
    if len(data):
        accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        data[accented] += 0x20  # U+00C0 to U+00DE
    starts, ends, rows = common.word_spans(data, offsets)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    if not len(starts):
        return data, starts, ends, row, np.zeros(0, bool)
    place = np.arange(len(data))
    following = np.minimum.accumulate(np.where(_SOLID[data], place, len(data))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(_SOLID[data], place + 1, 0))
    first = np.minimum(following[starts], ends)
    last = np.maximum(before[ends - 1], first)
    marks = np.concatenate([[0], np.cumsum(_ENDS[data])])
    onward = np.append(starts[1:], len(data))
    over = (marks[onward] > marks[last]) | np.append(row[1:] != row[:-1], True)
    return data, first, last, row, over


def _first_three(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    return ((padded[first] << 16 | padded[first + 1] << 8 | padded[first + 2]) * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _hashes(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    return common.span_hashes(data, ends[:-1], ends[1:]) if len(data) else np.zeros(len(texts), np.uint64)


def _prefixes(data: np.ndarray, first: np.ndarray, last: np.ndarray, spans: common.Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word, length and hash of every beginning of a word, whole words of any length included."""
    words, lengths = [np.flatnonzero(last - first >= LENGTHS[0])], [(last - first)[last - first >= LENGTHS[0]]]
    continues = np.append(data, 0) & 0xC0 == 0x80
    for n in LENGTHS:
        some = np.flatnonzero((last - first > n) & ~continues[np.minimum(first + n, len(data))])
        words.append(some)
        lengths.append(np.full(len(some), n))
    word, length = np.concatenate(words), np.concatenate(lengths)
    return word, length, spans(first[word], first[word] + length)


class Lexicon:
    """Reads words as symbols. `insults` are beginnings of words and how sure each is; the fixed words are whole."""

    def __init__(self, insults: dict[bytes, float]):
        self.insults = insults
        whole = {w: s for s, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
        self._whole = dict(zip(_hashes([w.encode() for w in whole]).tolist(), whole.values(), strict=True))
        fixed = [w.encode() for w in INSULTS]
        self._fixed = set(_hashes(fixed).tolist())
        begins = list(insults)
        self._sure = dict(zip(_hashes(begins).tolist(), insults.values(), strict=True))
        self._lengths = sorted({len(b) for b in begins})
        eventful = [*begins, *fixed, *(w.encode() for w in THREATS)]
        self._may = np.zeros(1 << 16, bool)
        joined = np.frombuffer(b"".join(eventful), np.uint8)
        self._may[_first_three(joined, np.cumsum([0, *map(len, eventful)])[:-1])] = True

    def read(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, over: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of clauses with an insult or threat, their symbols, and how sure the insults are."""
        maybe = np.flatnonzero(self._may[_first_three(data, first)] & (last > first)) if len(first) else np.zeros(0, np.int64)
        spans = common.Spans(data)
        symbol, sure = np.zeros(len(first), np.int8), np.zeros(len(first))
        for n in self._lengths:
            some = maybe[(last - first)[maybe] >= n]
            found = np.array([self._sure.get(h, 0.0) for h in spans(first[some], first[some] + n).tolist()])
            sure[some] = np.maximum(sure[some], found) if len(some) else 0.0
        whole = spans(first[maybe], last[maybe]).tolist()
        sure[maybe] = np.maximum(sure[maybe], [0.9 * (h in self._fixed) for h in whole]) if len(maybe) else 0.0
        threats = maybe[np.array([self._whole.get(h) == THREAT for h in whole], bool)]
        symbol[threats], sure[threats] = THREAT, np.maximum(sure[threats], 0.9)
        symbol[(sure > 0) & (symbol == OTHER)] = INSULT
        clause = np.cumsum(over) - over
        eventful = np.flatnonzero(np.isin(clause, clause[symbol > 0]))
        plain = eventful[symbol[eventful] == OTHER]
        symbol[plain] = [self._whole.get(h, OTHER) for h in spans(first[plain], last[plain]).tolist()]
        return eventful, symbol, sure


def features(column: pa.Array, lexicon: Lexicon, machine: Transducer) -> np.ndarray:
    """For each text and kind of clause how much of it there is: the root of what its clauses add up to, at most 4."""
    data, first, last, row, over = _words(column)
    eventful, symbol, sure = lexicon.read(data, first, last, over)
    out = np.zeros((len(column), NAMES))
    state, most, arcs = 0, 0.0, machine.arcs
    for s, p, text, ends in zip(symbol[eventful].tolist(), sure[eventful].tolist(), row[eventful].tolist(), over[eventful].tolist(), strict=True):
        state = arcs[state][s][0]
        most = max(most, p)
        if ends:
            state, name, _ = arcs[state][END]
            if name:
                out[text, name - 1] += most
            most = 0.0
    return np.sqrt(np.minimum(out, 4.0))


@dataclass(frozen=True)
class Model:
    insults: dict[bytes, float]
    bias: float
    weights: np.ndarray

    def scores(self, counted: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + counted @ self.weights, -500, 500)))


def fit(counted: np.ndarray, toxic: np.ndarray, prior: np.ndarray) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression by Newton's method; the weights are held near `prior`."""
    share = (toxic.sum() + 1.0) / (len(toxic) + 10.0)  # ten rows more, one of them toxic
    rows = np.column_stack([np.ones(len(toxic)), counted])
    start = np.concatenate([[np.log(share / (1 - share))], prior])
    hold = np.concatenate([[PENALTY / 4], np.full(len(prior), PENALTY)])
    params = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ params, -500, 500)))
        gradient = rows.T @ (p - toxic) + hold * (params - start)
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(hold)
        step = np.linalg.solve(curve, gradient)
        params = params - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(params[0]), params[1:]


def families(bands: np.ndarray) -> np.ndarray:
    """A number for each row; rows that share a value in a column, directly or through others, have the same one."""
    parent = list(range(len(bands)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for column in bands.T:
        holder: dict[int, int] = {}
        for i, value in enumerate(column.tolist()):
            parent[root(i)] = root(holder.setdefault(value, i))
    return np.array([root(i) for i in range(len(bands))], np.int64)


def choose_insults(held: list[np.ndarray], family: np.ndarray, clean: np.ndarray, n_clean: int, names: list[bytes]) -> dict[bytes, float]:
    """The beginnings that tell toxic documents, and how sure each does.

    `held` has the candidates of each toxic document, and documents of one family (copies) count once; `clean` has the
    clean documents of each candidate. Of beginnings that contain one another the one with the most evidence is taken.
    """
    _, family = np.unique(family, return_inverse=True)
    n_toxic = int(family.max(initial=-1)) + 1
    doc = np.repeat(family, [len(h) for h in held])
    candidate = np.concatenate([np.zeros(0, np.int64), *held]).astype(np.int64)
    found = np.bincount(np.unique(doc * max(len(names), 1) + candidate) % max(len(names), 1), minlength=len(names))
    expected = n_toxic * (clean + 1.0) / (n_clean + 1.0)
    evidence = np.where(found >= LEAST_ROWS, found * np.log(np.maximum(found, 1) / expected), 0.0)
    # How many toxic documents there would be for a clean one if both kinds were equally frequent, the clean ones one more.
    sure = found / (found + expected)
    length = np.array([len(n) for n in names], np.int64)
    chosen: dict[bytes, float] = {}
    # Of equals the longer beginning is taken: it lets more words alone that are yet unseen.
    for i in np.lexsort((np.arange(len(names)), -length, -np.round(evidence, 6))).tolist():
        if evidence[i] < LEAST_EVIDENCE:
            break
        if sure[i] >= LEAST_SURE and not any(names[i].startswith(c) or c.startswith(names[i]) for c in chosen):
            chosen[names[i]] = float(sure[i])
    return chosen


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learns from at most `rows` labelled documents (doc_id, toxic)."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # The sample is bounded by `rows`, so it may be broadcast. Of equal texts one is learnt from.
    found = common.one_row_each(docs).join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    held = common.stage(found)
    machine = grammar()
    candidates = _candidates(held)
    insults = _insults(held, candidates) if candidates else {}
    lexicon = Lexicon(insults)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            lists = pa.FixedSizeListArray.from_arrays(pa.array(features(part.column(0), lexicon, machine).ravel()), NAMES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([lists, part.column(1)], ["counted", "toxic"])

    table = held.mapInArrow(kernel, "counted array<double>, toxic boolean").toArrow()  # `rows` rows of NAMES numbers
    counted = np.array(table.column("counted").to_pylist(), float).reshape(-1, NAMES)
    return Model(insults, *fit(counted, np.array(table.column("toxic").to_pylist(), float), own_weights(machine)))


def _candidates(held: DataFrame) -> list[bytes]:
    """The beginnings that several toxic documents of the sample hold."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            data, first, last, row, _ = _words(part.column(0))
            word, length, hashes = _prefixes(data, first, last, common.Spans(data))
            _, one = np.unique(hashes, return_index=True)
            number = np.searchsorted(np.unique(hashes), hashes)
            counts = np.bincount(np.unique(row[word] * max(len(one), 1) + number) % max(len(one), 1), minlength=len(one))
            raw = data.tobytes()
            names = [raw[a : a + n] for a, n in zip(first[word[one]].tolist(), length[one].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(counts.astype(np.int64))], ["begin", "n"])

    counted = held.where("toxic").select("text").mapInArrow(kernel, "begin binary, n long").groupBy("begin").agg(F.sum("n").alias("n"))
    return [bytes(r.begin) for r in counted.where(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "begin").limit(CANDIDATES).select("begin").collect()]


def _bands(data: np.ndarray, first: np.ndarray, last: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """BANDS values for each text, which near copies share; a short text is one shingle."""
    words = common.Spans(data)(first, last)
    counts = np.bincount(row, minlength=rows)
    starts = np.flatnonzero(np.arange(len(words)) + SHINGLE <= np.cumsum(counts)[row])
    grams, owner = common.gram_hashes(words, SHINGLE)[starts] if len(starts) else np.zeros(0, np.uint64), row[starts]
    sums = np.zeros(rows, np.uint64)
    np.add.at(sums, row, words)
    short = np.flatnonzero(counts < SHINGLE)
    grams, owner = np.concatenate([grams, common.mix(sums[short])]), np.concatenate([owner, short])
    out = np.full((rows, 2 * BANDS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(2 * BANDS):
        np.minimum.at(out[:, i], owner, common.mix(grams ^ common.mix(np.array([i + 1], np.uint64))))
    return common.mix(out[:, 0::2] ^ common.mix(out[:, 1::2])).view(np.int64)


def _insults(held: DataFrame, candidates: list[bytes]) -> dict[bytes, float]:
    """The chosen candidates; the driver receives the toxic rows' candidates and the clean rows' counts, both bounded."""
    hashes = _hashes(candidates)
    order = np.argsort(hashes)
    known = hashes[order]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            data, first, last, row, _ = _words(part.column(0))
            word, _, own = _prefixes(data, first, last, common.Spans(data))
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            some = known[at] == own
            pair = np.unique(row[word[some]] * len(known) + order[at[some]])
            doc, number = pair // len(known), pair % len(known)
            toxic = np.array(part.column(1).to_pylist(), bool)
            bands = _bands(data, first, last, row, len(toxic))
            for i in np.flatnonzero(toxic).tolist():
                yield pa.RecordBatch.from_pydict({"bands": pa.array([bands[i]], pa.list_(pa.int64())), "held": pa.array([number[doc == i].astype(np.int32)], pa.list_(pa.int32())), "counts": pa.array([None], pa.list_(pa.int32())), "n": pa.array([0], pa.int64())})
            clean = np.bincount(number[~toxic[doc]], minlength=len(known))
            kept = np.flatnonzero(clean)
            yield pa.RecordBatch.from_pydict({"bands": pa.array([None], pa.list_(pa.int64())), "held": pa.array([kept.astype(np.int32)], pa.list_(pa.int32())), "counts": pa.array([clean[kept].astype(np.int32)], pa.list_(pa.int32())), "n": pa.array([int((~toxic).sum())])})

    lists, bands, clean, n_clean = [], [], np.zeros(len(candidates), np.int64), 0
    for r in held.mapInArrow(kernel, "bands array<long>, held array<int>, counts array<int>, n long").toLocalIterator():
        if r.counts is None:
            lists.append(np.array(r.held, np.int64))
            bands.append(r.bands)
        else:
            np.add.at(clean, np.array(r.held, np.int64), np.array(r.counts, np.int64))
            n_clean += r.n
    return choose_insults(lists, families(np.array(bands, np.int64).reshape(-1, BANDS)), clean, n_clean, candidates)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row: the probability that the text is toxic."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, machine = Lexicon(model.insults), grammar()
        for part in common.slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(features(part.column(1), lexicon, machine)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(kernel, "doc_id long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns; a fifth of the labels, named by a hash of doc_id, is held out."""
    held_out = F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0
    model = train(docs, labels.where(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
