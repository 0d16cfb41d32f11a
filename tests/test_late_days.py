"""The trailing mean kept up to date: equal to the batch window after days come late, change or go."""

import datetime as dt
import random

import pytest

from adfuse.operators import refresh_rolling_mean, rolling_mean

KINDS = "platform string, date date, spend double"
DAY = dt.date(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.select("platform", "date", "spend", "avg").collect())


def frame(spark, state):
    return spark.createDataFrame([(p, d, v) for (p, d), v in state.items()], KINDS)


@pytest.mark.parametrize("kind", ["rows", "days"])
@pytest.mark.parametrize("n", [1, 3, 7])
def test_out_of_order_batches_equal_the_batch_window(spark, kind, n):
    r = random.Random(n)
    state = {(p, DAY + dt.timedelta(days=k)): r.choice([None, r.random()]) for p in "ab" for k in range(60) if r.random() < 0.7}
    held = rolling_mean(frame(spark, state), "spend", n, kind, out="avg")
    for step in range(3):
        changed = set()
        for _ in range(r.randint(1, 5)):
            key = (r.choice("abc"), DAY + dt.timedelta(days=r.randint(-5, 70)))
            changed.add(key)
            if r.random() < 0.3:
                state.pop(key, None)  # gone, or was never there
            else:
                state[key] = r.random()
        keys = spark.createDataFrame([*changed, *list(changed)[:1]], "platform string, date date")
        held = refresh_rolling_mean(held, frame(spark, state), keys, "spend", n, kind, out="avg")
        assert rows(held) == rows(rolling_mean(frame(spark, state), "spend", n, kind, out="avg")), step
        held = spark.createDataFrame(held.collect(), held.schema)


def test_only_the_touched_rows_are_new(spark):
    state = {("a", DAY + dt.timedelta(days=k)): float(k) for k in range(300)}
    held = rolling_mean(frame(spark, state), "spend", 7, "rows", out="avg")
    marked = held.selectExpr("platform", "date", "spend", "-1D AS avg")  # as if the earlier result were this
    late = DAY + dt.timedelta(days=100)
    got = refresh_rolling_mean(
        marked, frame(spark, state), spark.createDataFrame([("a", late)], "platform string, date date"), "spend", 7, "rows", out="avg"
    )
    new = sorted(x.date for x in got.where("avg >= 0").collect())
    assert new == [late + dt.timedelta(days=k) for k in range(7)] and got.count() == 300


def test_nothing_changed(spark):
    state = {("a", DAY): 1.0}
    held = rolling_mean(frame(spark, state), "spend", 7, "rows", out="avg")
    none = spark.createDataFrame([], "platform string, date date")
    assert rows(refresh_rolling_mean(held, frame(spark, state), none, "spend", 7, "rows", out="avg")) == rows(held)
