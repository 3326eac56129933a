"""The pair-free best-address choice against brute force over all pairs,
on random dates that hit the edge cases (ties on one date, undated
addresses, no address at all, dates before the rank anchor, addresses more
than 9999 days after treatment)."""

import datetime as dt
import random

from episcope.operators import address as AD

ANCHOR = dt.date(1800, 1, 1)


def _brute(days, addrs):
    out = {}
    for p, t in days:
        cands = []
        for a in [a for a in addrs if a[1] == p]:
            aid, _, d, icb, imd = a
            if d is None:
                r = AD.NO_DATE_RANK
            elif d <= t:
                r = (ANCHOR - d).days
            else:
                r = (d - t).days
            cands.append(((r, aid is None, aid if aid is not None else 0, icb is None, icb or "",
                           imd is None, imd or ""), (icb, imd, aid)))
        out[(p, t)] = min(cands)[1] if cands else (None, None, None)
    return out


def test_best_address_per_day_matches_brute_force(spark):
    rng = random.Random(7)
    base = dt.date(2020, 1, 1)
    addrs, aid = [], 0
    for p in range(1, 40):
        for _ in range(rng.randint(0, 6)):
            aid += 1
            kind = rng.random()
            if kind < 0.15:
                d = None
            elif kind < 0.2:
                d = dt.date(1790, 1, 1) + dt.timedelta(days=rng.randint(0, 5000))
            elif kind < 0.3:
                d = base + dt.timedelta(days=rng.randint(9990, 10010))
            else:
                d = base + dt.timedelta(days=rng.randint(-900, 900))
            same = addrs and rng.random() < 0.15 and addrs[-1][1] == p
            if same:
                d = addrs[-1][2]
            addrs.append((aid if rng.random() > 0.05 else None, p, d,
                          rng.choice(["North", "South", None]), rng.choice(["1", "2", None])))
    days = sorted({(p, base + dt.timedelta(days=rng.randint(-800, 800))) for p in range(1, 45) for _ in range(3)})
    geo = spark.createDataFrame(addrs, "addressid long, patientid long, dateofaddress date, "
                                       "icb_hb string, imd19_quintile_lsoas string")
    d = spark.createDataFrame(days, "patientid long, treatmentstartdate date")
    got = {(r.patientid, r.treatmentstartdate): ((r.best.icb, r.best.imd, r.best.id) if r.best else (None, None, None))
           for r in AD.best_address_per_day(d, geo, '2017-10-01', '2022-04-01').collect()}
    assert got == _brute(days, addrs)
