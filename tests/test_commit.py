"""A commit that is cut off: each day is old or new, and the next run finishes it."""

from __future__ import annotations

import datetime as dt

import pytest

from eodlake.operators import commit
from eodlake.operators.store import Store

DAYS = [dt.date(2024, 3, d) for d in (4, 5, 6)]
SCHEMA = "index_name string, date date, close double, volume long, turnover double"


def index_rows(spark, close, days=DAYS):
    return spark.createDataFrame([(n, d, close, 1, 2.0) for d in days for n in ("TEN", "FIFTY")], SCHEMA)


def closes(store):
    """The closes of each day, which has two rows or none."""
    out = {}
    for r in store["index_daily"].collect():
        out.setdefault(r.date, []).append(r.close)
    assert all(len(v) == 2 and len(set(v)) == 1 for v in out.values()), out
    return {d: v[0] for d, v in out.items()}


class Lost(Exception):
    pass


@pytest.fixture
def dying(monkeypatch):
    """Lets the driver die before its n-th move of a folder."""

    def after(n):
        moves, move = iter(range(n)), commit._move

        def last(*args):
            if next(moves, None) is None:
                raise Lost
            move(*args)

        monkeypatch.setattr(commit, "_move", last)

    yield after
    monkeypatch.undo()


@pytest.mark.parametrize("moves", range(8))
def test_each_day_is_old_or_new_and_the_next_run_finishes(spark, store, dying, monkeypatch, moves):
    store.upsert_index(index_rows(spark, 1.0))
    # three days merged into the stage (a move each), then two moves a day
    dying(3 + moves)
    if moves < 6:
        with pytest.raises(Lost):
            store.upsert_index(index_rows(spark, 2.0))
    else:
        store.upsert_index(index_rows(spark, 2.0))
    monkeypatch.undo()
    found = closes(store)
    done = moves // 2
    assert found == {d: 2.0 if i < done else 1.0 for i, d in enumerate(DAYS) if i != done or moves % 2 == 0 or moves > 6}
    again = Store(spark, store.root).create_tables()
    assert closes(again) == dict.fromkeys(DAYS, 2.0)
    assert commit.folders(spark, f"{store.root}/_staged/index_daily") == []


def test_a_run_that_dies_before_its_commit_leaves_nothing(spark, store, dying, monkeypatch):
    store.upsert_index(index_rows(spark, 1.0))
    dying(1)
    with pytest.raises(Lost):
        store.upsert_index(index_rows(spark, 2.0))
    monkeypatch.undo()
    assert closes(store) == dict.fromkeys(DAYS, 1.0)
    assert store.upsert_index(index_rows(spark, 3.0, DAYS[:1])) == 2
    assert closes(store) == {DAYS[0]: 3.0, DAYS[1]: 1.0, DAYS[2]: 1.0}


def jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_an_upsert_counts_while_it_writes(spark, store):
    """One write for new days, one more for stored ones; no scan, count or emptiness check of its own."""
    rows = index_rows(spark, 1.0).repartition(4)
    first = jobs(spark, "first load", lambda: store.upsert_index(rows))
    again = jobs(spark, "second load", lambda: store.upsert_index(rows))
    # a job for each exchange that adaptive execution runs first, and the write
    assert first <= 3, first
    assert again <= first + 6, again
    assert store.upsert_index(index_rows(spark, 4.0, [])) == 0
