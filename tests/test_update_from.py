"""``update_from`` against a plain-Python model of UPDATE ... FROM ... JOIN on random rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronoreg.operators.apply import BY, TOUCHED, update_from

T0 = datetime(2024, 1, 1)
SCHEMA_T = "k long, s timestamp_ntz, link long, effective_end_date timestamp_ntz, " \
           "sys_end_date timestamp_ntz, sys_deleted_ind string"
SCHEMA_R = "k long, s timestamp_ntz, req_link long, new_sys_end_date timestamp_ntz, " \
           "new_effective_end_date timestamp_ntz, new_sys_deleted_ind string, _by string"


def _maybe(rng, value, p=0.2):
    return None if rng.random() < p else value


def _data(seed):
    rng = random.Random(seed)
    day = lambda: T0 + timedelta(days=rng.randint(0, 3))
    targets = []
    for _ in range(40):
        row = (rng.randint(0, 5), _maybe(rng, day(), 0.1), _maybe(rng, rng.randint(0, 3)),
               _maybe(rng, day()), _maybe(rng, day()), rng.choice(["N", "Y"]))
        targets.append(row)
        if rng.random() < 0.2:
            targets.append(row)  # exact duplicate target rows
    requests = [(rng.randint(0, 5), _maybe(rng, day(), 0.1), _maybe(rng, rng.randint(0, 3)),
                 _maybe(rng, day()), _maybe(rng, day()), _maybe(rng, rng.choice(["N", "Y"])), "x")
                for _ in range(30)]
    return targets, requests


def _key(v):
    return (v is not None, v)


def _model(targets, requests, with_pred):
    out = []
    for t in targets:
        hits = [r for r in requests
                if t[0] is not None and r[0] is not None and t[0] == r[0]
                and t[1] is not None and r[1] is not None and t[1] == r[1]
                and (not with_pred or (t[2] is not None and r[2] is not None and t[2] != r[2]))]
        if hits:
            best = max(hits, key=lambda r: (_key(r[3]), _key(r[4]), _key(r[5])))
            out.append((t[0], t[1], t[2], best[4], best[3], best[5], True))
        else:
            out.append((*t, False))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_update_from_matches_model(spark, seed):
    targets, requests = _data(seed)
    t = spark.createDataFrame(targets, SCHEMA_T)
    r = spark.createDataFrame(requests, SCHEMA_R).drop("req_link")
    named, others = update_from(t, r, ["k", "s"])
    columns = ["k", "s", "link", "effective_end_date", "sys_end_date", "sys_deleted_ind"]
    rows = [tuple(x) for x in named.select(*columns, TOUCHED).collect()]
    assert all(x[-1] for x in rows)
    rows += [(*x, False) for x in others.select(*columns).collect()]
    assert sorted(rows, key=str) == _model(targets, requests, False)
    assert named.filter(F.col(BY).isNull()).count() == 0
