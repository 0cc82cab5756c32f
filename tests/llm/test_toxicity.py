"""The clause grammar, what is learnt, and held-out rows."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chronoreg.llm import common, toxicity
from corpus import corpus, frame

NAMES = {"idiot": toxicity.INSULT, "kill": toxicity.THREAT, "you": toxicity.TARGET, "not": toxicity.NEGATION, "said": toxicity.REPORT, "table": toxicity.OTHER}


def named(clause):
    """A clause's kind by plain rules: its gravest event, and whether a target is in it."""
    events, reach, said, aimed = [], 0, False, False
    for word in clause:
        symbol = NAMES[word]
        if symbol == toxicity.NEGATION:
            reach = toxicity.REACH + 1
        if symbol in (toxicity.INSULT, toxicity.THREAT):
            insult = symbol == toxicity.INSULT
            if reach:
                symbol = toxicity.DENIED_INSULT if insult else toxicity.DENIED_THREAT
            elif said:
                symbol = toxicity.SAID_INSULT if insult else toxicity.SAID_THREAT
            events.append(toxicity.EVENTS.index(symbol) + 1)
        reach = max(reach - 1, 0)
        said |= symbol == toxicity.REPORT
        aimed |= symbol == toxicity.TARGET
    return 2 * max(events) - 1 + aimed if events else 0


def test_composed_machine_reads_as_its_parts():
    """Every clause of up to five words, through the machine and by plain rules."""
    machine = toxicity.grammar()
    for n in range(6):
        for clause in itertools.product(NAMES, repeat=n):
            state = 0
            for word in clause:
                state = machine.arcs[state][NAMES[word]][0]
            after, name, _ = machine.arcs[state][toxicity.END]
            assert (after, name) == (0, named(clause)), clause


def test_weights_of_paths():
    """The composed machine's weights are the sums of its parts' weights."""
    parts = [toxicity.negation(), toxicity.reported_speech(), toxicity.clauses()]
    machine, rng = toxicity.grammar(), random.Random(4)
    for _ in range(200):
        states, state, total, one = [0, 0, 0], 0, 0.0, 0.0
        for symbol in [rng.choice(list(NAMES.values())) for _ in range(12)] + [toxicity.END]:
            state, _, more = machine.arcs[state][symbol]
            one += more
            for i, part in enumerate(parts):
                states[i], symbol, more = part.arcs[states[i]][symbol]
                total += more
        assert abs(one - total) < 1e-9


def test_counted_clauses():
    lexicon, machine = toxicity.Lexicon({b"gru": 1.0}), toxicity.grammar()
    rng = random.Random(8)
    texts, want = [], []
    for _ in range(300):
        words = [rng.choice([*NAMES, "grumpf", "Table,", "KILL", "\"You\"", "idiots", "é", "idiot.", "table!", "not;", "x\n", "(kill)"]) for _ in range(rng.randint(0, 25))]
        texts.append(" ".join(words))
        found = np.zeros(toxicity.NAMES)
        for clause in re.split(r"[.!?;\n]", texts[-1]):
            plain = [re.sub(r"[^a-zé]", "", w.lower()) for w in clause.split()]
            plain = ["idiot" if w.startswith("gru") else w if w in NAMES else "table" for w in plain if w]
            if name := named(plain):
                sure = 1.0 if "gru" in clause else 0.9
                found[name - 1] += sure
        want.append(found)
    got = toxicity.features(pa.array(texts), lexicon, machine)
    same = [np.allclose(np.sqrt(np.minimum(w, 4)), g) for w, g in zip(want, got)]
    assert all(same), [(t, w, g) for t, w, g, ok in zip(texts, want, got, same) if not ok][:1]


def test_context_counts():
    model = toxicity.Model({}, -3.0, toxicity.own_weights(toxicity.grammar()))
    score = lambda text: float(model.scores(toxicity.features(pa.array([text]), toxicity.Lexicon({}), toxicity.grammar()))[0])
    assert score("you are an idiot") > score("an idiot") > score("they said idiot in court") > score("a table") == score("")
    assert score("you are an idiot") > score("you are not an idiot") and score("a table. idiot") == score("idiot")
    assert score("kill you") > score("kill time") and score("words " * 100_000 + "you idiot") == score("you idiot")
    assert score("she is not here, and you are an idiot") == score("you are an idiot")


def test_learnt_insults():
    """A stem with many endings is found; a word that the copies of one document share is not."""
    names = [b"gru", b"grumpf", b"copied", b"the"]
    held = [np.array([0, 1, 3]) if i < 12 else np.array([0, 3]) if i < 30 else np.array([2, 3]) for i in range(60)]
    family = np.array([*range(30), *[30] * 30])
    chosen = toxicity.choose_insults(held, family, np.array([1, 0, 0, 400]), 500, names)
    assert list(chosen) == [b"gru"] and 0.9 < chosen[b"gru"] < 1
    assert toxicity.families(np.array([[1, 5], [2, 5], [3, 6], [2, 7], [4, 8]])).tolist().count(toxicity.families(np.array([[1, 5], [2, 5], [3, 6], [2, 7], [4, 8]]))[0]) == 3


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = common.table(spark, sf, "labels", "doc_id", "toxic")
    docs = common.table(spark, sf, "documents", "doc_id", "text")
    rows = toxicity.digest(docs, labels).join(labels, "doc_id").collect()
    toxic, clean = ([r.score for r in rows if r.held_out and (r.toxic > 0) == x] for x in (True, False))
    assert len(toxic) > 80 and len(clean) > 600
    assert np.mean(np.array(toxic) >= 0.5) > 0.8 and np.mean(np.array(clean) >= 0.5) < 0.01
    auc = np.mean([np.mean(t > np.array(clean)) + 0.5 * np.mean(t == np.array(clean)) for t in toxic])
    assert auc > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, sf, "documents", "doc_id", "text"), common.table(spark, sf, "labels", "doc_id", "toxic")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity.digest(docs, x).collect())) for x in (labels, other))
    assert one == two and len(one) == docs.count()


def test_awkward_rows(spark):
    rows = corpus(5)
    some = spark.createDataFrame([(3, None), (None, 1), (1003, 1), (1003, 0), (6, 0), (1000, 1)], "doc_id long, toxic int")
    got = toxicity.digest(frame(spark, rows), some).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id in (1000, 1001, 1002)}) == 1
    none = toxicity.digest(frame(spark, rows), some.where("false")).collect()
    assert len(none) == len(rows) and all(0 < r.score < 0.5 for r in none)
    assert toxicity.digest(frame(spark, []), some).collect() == []
