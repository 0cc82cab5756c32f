"""A small corpus with copies, near copies, shared passages and awkward rows."""

import random

SCHEMA = "doc_id long, text string, keys int, note string"  # extra columns with names that operators use themselves


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda k: [rng.choice(words) for _ in range(k)]
    passage = prose(60)
    docs = []
    for i in range(n):
        body = prose(rng.randint(0, 120))
        if i % 5 == 1:
            at = rng.randint(0, len(body))
            body = body[:at] + passage + body[at:]
        if i % 7 == 3 and docs:
            body = rng.choice(docs)[1].split(" ")
            if len(body) > 30 and i % 2:
                body[rng.randrange(len(body))] = "edited"
        docs.append((i * 3, rng.choice([" ", "  ", "\n"]).join(body) if i % 11 == 2 else " ".join(body)))
    docs += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "one two three"), (1004, "x" * 5000), (1005, " ".join(passage) * 3)]
    docs += [docs[1], (None, " ".join(passage))]  # a repeated row, and a row without an id
    rng.shuffle(docs)
    return [(d, t, i % 3, "doc_id") for i, (d, t) in enumerate(docs)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_id(rows):
    """The texts by id, as every operator sees them: null as empty, rows without an id left out."""
    return {d: t or "" for d, t, *_ in rows if d is not None}
