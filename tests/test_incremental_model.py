"""Incremental operators against a plain Python model on random change logs."""

import random

from souk.operators import incremental as I


def model_merge(base, changes):
    state = dict(base)
    latest = {}
    for k, v, ver, op in changes:
        if k not in latest or ver > latest[k][1]:
            latest[k] = (v, ver, op)
    for k, (v, _, op) in latest.items():
        if op == "D":
            state.pop(k, None)
        else:
            state[k] = v
    return state


def test_merge_upsert_snapshot_cdc_model(spark):
    rnd = random.Random(3)
    base = {k: float(k) for k in range(60)}
    changes, used = [], set()
    for _ in range(150):
        k = rnd.randrange(0, 80)                       # keys >= 60 are inserts
        ver = rnd.randrange(1, 1000)
        while (k, ver) in used:                        # versions unique per key
            ver = rnd.randrange(1, 1000)
        used.add((k, ver))
        op = rnd.choice(["U", "U", "D", "I"])
        v = None if rnd.random() < 0.15 else float(rnd.randrange(1000))
        changes.append((k, v, ver, op))
    bdf = spark.createDataFrame(list(base.items()), "k int, v double")
    cdf = spark.createDataFrame(changes, "k int, v double, version int, op string")

    got = {r.k: r.v for r in I.merge_on_read(bdf, cdf, ["k"], ["v"]).collect()}
    assert got == model_merge(base.items(), changes)

    # snapshot as of version 500 over the change log alone
    upto = [c for c in changes if c[2] <= 500]
    snap = {r.k: r.v for r in I.snapshot_as_of(cdf, ["k"], "version", 500, op="op").collect()}
    assert snap == model_merge({}, upto)

    # CDC apply: last by lsn wins, deletes drop the key
    cdc = {r.k: r.v for r in I.cdc_apply(cdf.withColumnRenamed("version", "lsn"), ["k"], "lsn", "op").collect()}
    assert cdc == model_merge({}, changes)

    # changes between base and merged state
    merged = model_merge(base.items(), changes)
    ch = {r.k: r.change for r in I.changes_between(bdf, I.merge_on_read(bdf, cdf, ["k"], ["v"]), ["k"], ["v"]).collect()}
    want = {}
    for k in set(base) | set(merged):
        if k not in base:
            want[k] = "I"
        elif k not in merged:
            want[k] = "D"
        elif base[k] != merged[k]:
            want[k] = "U"
    assert ch == want

    # upsert: greatest version per key over base (version 0) and changes, inserts included
    up = I.upsert_latest(bdf.selectExpr("k", "v", "0 AS version"), cdf.drop("op"), ["k"], "version")
    want_up = {k: (v, 0) for k, v in base.items()}
    for k, v, ver, _ in changes:
        if ver > want_up.get(k, (None, -1))[1]:
            want_up[k] = (v, ver)
    assert {r.k: (r.v, r.version) for r in up.collect()} == want_up
