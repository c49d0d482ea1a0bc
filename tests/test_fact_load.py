"""The incremental fact equals a full build after late, corrected and withdrawn rows, and touches only their months."""

import datetime as dt
import os
import random

import pytest

from vigil.plans.fact import FactParams, build_fact
from vigil.plans.fact_load import FactLoad

D = dt.date
PARAMS = dict(long_indicators={"tt_cases": "c", "tt_deaths": "d"}, long_renames={"Guinea 2": "Guinea"}, wide_a_renames={}, wide_b_renames={}, cases_order=("date",),
              wide_a_order=None, wide_b_order=None)


def sources():
    rng = random.Random(4)
    days = [D(2021, 1, 1) + dt.timedelta(days=i) for i in range(150)]
    cases = {(k, d): (k, d, name, cont, rng.choice([5.0, 7.0, -3.0, None]), float(rng.randrange(9))) for k, name, cont in
             (("PER", "Peru", "South America"), ("GIN", "Guinea", "Africa"), ("XXX", "Guinea Bissau", "Africa")) for d in days}
    vacc = {(k, d): (k, d, float(i)) for i, d in enumerate(days) for k in ("PER", "GIN") if i % 3}
    long = {(i, c, d): (i, c, d, float(rng.randrange(50))) for i in "cd" for c in ("Guinea 2", "Peru") for d in days[:60:4]}
    a = {(c, d): (c, 1.0, 2.0, d) for c in ("Peru", "Grand Total") for d in days[20:80:5]}
    b = {(c, d): (d, c, 3.0, 4.0, 5.0) for c in ("Guinea", "Peru") for d in days[::7]}
    return [cases, vacc, long, a, b]


def frames(spark, s):
    kinds = ["id string, date date, location string, continent string, new_cases double, new_deaths double", "iso_code string, date date, people_fully_vaccinated double",
             "indicator string, country string, date date, value double", "country string, tt_cases double, tt_deaths double, date date",
             "date date, country string, tt_cases double, tt_deaths double, tt_recovery double"]
    return [spark.createDataFrame(list(rows.values()), kind) for rows, kind in zip(s, kinds)]


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(f"{path}/fact") for f in fs if f.startswith("part-")}


@pytest.fixture()
def load(spark, tmp_dir):
    s, store = sources(), FactLoad(spark, tmp_dir, FactParams(**PARAMS))

    def run(change=None):
        if change:
            change(*s)
        before = files(tmp_dir)
        touched = store.load(*frames(spark, s))
        want = build_fact(*frames(spark, s), FactParams(**PARAMS))
        assert sorted(map(str, store.fact().collect())) == sorted(map(str, want.select(store.fact().columns).collect()))
        gone = {tuple(f.split("/")[1:3]) for f in before - files(tmp_dir)}
        assert gone <= {(f"category={c}", f"month={m}") for c, m in touched}
        return touched
    return run


def test_loads_equal_full_builds(load):
    assert len(load()) == 6 + 2 + 3 + 5  # the first load makes all months, and looks at the one that the last days reach into
    assert load() == []

    def corrected(cases, *_):  # the day a week later lies in the next month
        cases["PER", D(2021, 2, 26)] = ("PER", D(2021, 2, 26), "Peru", "South America", 11.0, 0.0)
        cases["PER", D(2021, 3, 5)] = ("PER", D(2021, 3, 5), "Peru", "South America", -1.0, 0.0)

    assert load(corrected) == [("covid", "2021-02"), ("covid", "2021-03")]

    def earlier_value(cases, vacc, *_):  # only the day looked back to changes: the month after is touched as well
        cases["PER", D(2021, 2, 26)] = ("PER", D(2021, 2, 26), "Peru", "South America", 13.0, 0.0)
        vacc["GIN", D(2021, 4, 2)] = ("GIN", D(2021, 4, 2), 999.0)

    assert load(earlier_value) == [("covid", "2021-02"), ("covid", "2021-03"), ("covid", "2021-04")]

    def new_day(cases, vacc, long, a, b):  # a new last day adds a number, the others keep theirs
        for d in (D(2021, 5, 31), D(2021, 6, 1)):
            cases["GIN", d] = ("GIN", d, "Guinea", "Africa", 1.0, 1.0)
        long["c", "Peru", D(2021, 3, 20)] = ("c", "Peru", D(2021, 3, 20), 8.0)

    assert load(new_day) == [("covid", "2021-05"), ("covid", "2021-06"), ("ebola", "2021-03")]


def test_late_days_renumber_and_keys_turn_bad(load):
    load()

    def late(_, __, long, a, b):  # a day before all others of the source
        b["Peru", D(2020, 12, 30)] = (D(2020, 12, 30), "Peru", 1.0, 1.0, 1.0)
        long["c", "Peru", D(2021, 1, 2)] = ("c", "Peru", D(2021, 1, 2), 1.0)

    assert load(late) == [("ebola", "2021-01"), ("ebola", "2021-02"), *(("sars", m) for m in ("2020-12", "2021-01", "2021-02", "2021-03", "2021-04", "2021-05"))]

    def bad(cases, *_):  # one null continent: the key's rows go, and with it the prefix of its name has one row less
        cases["XXX", D(2021, 1, 9)] = ("XXX", D(2021, 1, 9), "Guinea Bissau", None, 1.0, 1.0)

    touched = load(bad)
    assert {c for c, _ in touched} == {"covid"} and len(touched) >= 5

    def moved(cases, *_):  # Peru's continent changes: the other sources' rows of that prefix do as well
        for k, r in list(cases.items()):
            if r[0] == "PER":
                cases[k] = (*r[:3], "Oceania", *r[4:])

    assert {c for c, _ in load(moved)} == {"covid", "ebola", "h1n1", "sars"}


def test_withdrawn_rows_null_dates_and_empty_sources(load):
    load()

    def withdrawn(cases, vacc, long, a, b):
        for k in [k for k in a if k[1].month == 3]:
            del a[k]
        cases["PER", None] = ("PER", None, "Peru", "South America", -2.0, None)
        vacc["PER", None] = ("PER", None, 5.0)

    touched = load(withdrawn)
    assert ("h1n1", "2021-03") in touched and ("covid", "none") in touched

    def nothing(cases, vacc, long, a, b):
        for s in (cases, vacc, long, a, b):
            s.clear()

    load(nothing)


def test_a_failed_load_is_repeated(spark, tmp_dir, monkeypatch):
    s, store = sources(), FactLoad(spark, tmp_dir, FactParams(**PARAMS))
    store.load(*frames(spark, s))
    s[0]["PER", D(2021, 2, 3)] = ("PER", D(2021, 2, 3), "Peru", "South America", 77.0, 0.0)
    with monkeypatch.context() as m:
        m.setattr(FactLoad, "_keep", lambda self, new: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.load(*frames(spark, s))
    assert store.load(*frames(spark, s)) == [("covid", "2021-02")]
    want = build_fact(*frames(spark, s), FactParams(**PARAMS))
    assert sorted(map(str, store.fact().collect())) == sorted(map(str, want.collect()))
