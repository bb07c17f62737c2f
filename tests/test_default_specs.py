"""The default specs of the blocks, value by value, against plain Python over the groups."""

import math
import random
import statistics

from cohortforge.plans import blocks as B
from cohortforge.sources import schemas


def _rows(schema, n, seed, fixed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        row = {}
        for f in schema.fields:
            kind = f.dataType.typeName()
            row[f.name] = (rnd.choice(["A", "B", "c", None]) if kind == "string" else rnd.choice([round(rnd.uniform(-9, 9), 3), 0.0, None])
                           if kind == "double" else rnd.randint(-20, -1))
        out.append(row | fixed(i))
    return out


def _reduce(values, agg):
    have = [v for v in values if v is not None]
    if agg == "size":
        return len(values)
    if agg == "nunique":
        return len(set(have))
    if agg == "sum":
        return sum(have)
    if not have:
        return None
    if agg in ("var", "std"):
        if len(have) < 2:
            return None
        return statistics.variance(have) if agg == "var" else statistics.stdev(have)
    return {"min": min, "max": max, "mean": statistics.fmean}[agg](have)


def _codes(rows, cols):
    for c in cols:
        order = {v: i for i, v in enumerate(sorted({r[c] or "NULL" for r in rows}))}
        for r in rows:
            r[c] = order[r[c] or "NULL"]


def _check(got, rows, key, spec, prefix):
    groups = {}
    for r in rows:
        if r[key] is not None:
            groups.setdefault(r[key], []).append(r)
    found = {r[key]: r for r in got.collect()}
    assert set(found) == set(groups)
    for k, members in groups.items():
        for c, aggs in spec.items():
            for a in aggs:
                want, have = _reduce([m[c] for m in members], a), found[k][f"{prefix}{c}_{a.upper()}"]
                assert (want is None) == (have is None), (k, c, a, want, have)
                assert want is None or math.isclose(want, have, rel_tol=1e-9, abs_tol=1e-9), (k, c, a, want, have)


def _text(schema, *without):
    return [f.name for f in schema.fields if f.dataType.typeName() == "string" and f.name not in without]


def _spec(spec, cats):
    return {**{c: list(a) for c, a in spec.items()}, **{c: [*spec.get(c, []), "mean"] for c in cats}}


def test_previous_applications(spark):
    schema = schemas.PREVIOUS_APPLICATION
    rows = _rows(schema, 60, 1, lambda i: {"SK_ID_CURR": i % 7 if i else None, "SK_ID_PREV": i})
    got, cats = B.previous_applications(spark.createDataFrame(rows, schema))
    assert cats == _text(schema)
    _codes(rows, cats)
    for r in rows:
        a, c = r["AMT_APPLICATION"], r["AMT_CREDIT"]
        r["APP_CREDIT_PERC"] = None if a is None or c is None else a / c if c else math.copysign(math.inf, a) if a else None
    spec = {c: a for c, a in B.PREV_NUM_SPEC.items() if c != "APP_CREDIT_PERC"}
    _check(got, rows, "SK_ID_CURR", _spec(spec, cats), "PREV_")
    finite = [r for r in rows if r["SK_ID_CURR"] is not None]
    clean = {k for k in {r["SK_ID_CURR"] for r in finite} if not any(r["SK_ID_CURR"] == k and r["APP_CREDIT_PERC"] in (math.inf, -math.inf) for r in finite)}
    found = {r.SK_ID_CURR: r for r in got.collect()}
    for k in {r["SK_ID_CURR"] for r in finite}:
        values = [r["APP_CREDIT_PERC"] for r in finite if r["SK_ID_CURR"] == k]
        have = [v for v in values if v is not None]
        assert found[k]["PREV_APP_CREDIT_PERC_MIN"] == (min(have) if have else None) and found[k]["PREV_APP_CREDIT_PERC_MAX"] == (max(have) if have else None)
        if k in clean and len(have) > 1:
            assert math.isclose(found[k]["PREV_APP_CREDIT_PERC_VAR"], statistics.variance(have), rel_tol=1e-9)


def test_bureau_and_balance(spark):
    balance = _rows(schemas.BUREAU_BALANCE, 80, 2, lambda i: {"SK_ID_BUREAU": i % 25})
    bureau = _rows(schemas.BUREAU, 30, 3, lambda i: {"SK_ID_CURR": i % 6 if i else None, "SK_ID_BUREAU": i})
    got, bb_cats = B.bureau_and_balance(spark.createDataFrame(bureau, schemas.BUREAU), spark.createDataFrame(balance, schemas.BUREAU_BALANCE))
    assert bb_cats == _text(schemas.BUREAU_BALANCE)
    cats = _text(schemas.BUREAU)
    _codes(balance, bb_cats)
    _codes(bureau, cats)
    for r in bureau:
        own = [b for b in balance if b["SK_ID_BUREAU"] == r["SK_ID_BUREAU"]]
        months = [b["MONTHS_BALANCE"] for b in own]
        r["MONTHS_BALANCE_MIN"], r["MONTHS_BALANCE_MAX"], r["MONTHS_BALANCE_SIZE"] = (min(months), max(months), len(own)) if own else (None,) * 3
        for c in bb_cats:
            r[f"{c}_MEAN"] = statistics.fmean(b[c] for b in own) if own else None
    _check(got, bureau, "SK_ID_CURR", _spec(B.BUREAU_NUM_SPEC, [*cats, *[f"{c}_MEAN" for c in bb_cats]]), "BURO_")


def test_instalments(spark):
    schema = schemas.INSTALLMENTS_PAYMENTS
    rows = _rows(schema, 70, 4, lambda i: {"SK_ID_CURR": i % 5 if i else None, "AMT_INSTALMENT": 1.0 + i % 4 if i % 9 else None})
    got, _ = B.installments_payments(spark.createDataFrame(rows, schema))
    for r in rows:
        paid, due, day, due_day = r["AMT_PAYMENT"], r["AMT_INSTALMENT"], r["DAYS_ENTRY_PAYMENT"], r["DAYS_INSTALMENT"]
        both = paid is not None and due is not None
        r["PAYMENT_PERC"], r["PAYMENT_DIFF"] = (paid / due, due - paid) if both else (None, None)
        late = 0 if day is None or due_day is None else day - due_day
        r["DPD"], r["DBD"] = max(late, 0), max(-late, 0)
    _check(got, rows, "SK_ID_CURR", B.INS_SPEC, "INSTAL_")
    assert sum(r.INSTAL_COUNT for r in got.collect()) == sum(r["SK_ID_CURR"] is not None for r in rows)
