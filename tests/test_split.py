"""Split allocation against a plain computation, with a dominant group."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from gridtally import columns as C
from gridtally.operators import split as S
from gridtally.operators.base import ContractError
from gridtally.plans.reports import split_by_tag

SCHEMA = (
    f"n int, {S.INTERVAL} string, {S.PARENT} string, {S.RESOURCE} string, {S.RATIO} string, "
    f"{C.ENERGY} double, {C.OPERATIONAL} double, {C.EMBODIED} double"
)


def rows(count: int = 3000, seed: int = 5) -> list[tuple]:
    """A third of all rows belong to one resource; some keys and values are missing."""
    rng = random.Random(seed)
    out = []
    for n in range(count):
        owner = "hot" if rng.random() < 0.34 else f"r{rng.randrange(200)}"
        interval = None if rng.random() < 0.05 else f"d{rng.randrange(3)}"
        if rng.random() < 0.3:
            parent = rng.choice([None, "null", "NULL"])
            idle = owner.endswith("7")
            impacts = [None if idle else round(rng.random() * 100, 3) for _ in range(3)]
            out.append((n, interval, parent, owner, None, *impacts))
        else:
            ratio = rng.choice([None, "n/a", f"{rng.random():.3f}", f"{rng.random():.3f}", f"{rng.random():.3f}"])
            out.append((n, interval, owner, f"pod{n}", ratio, None, None, None))
    return out


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def expected(data):
    totals = defaultdict(lambda: [0.0] * 4)
    for _, interval, parent, own, ratio, *impacts in data:
        key = (interval, own if parent is None or parent.lower() == "null" else parent)
        for at, value in enumerate([*impacts, number(ratio)]):
            totals[key][at] += value or 0.0
    result = {}
    for n, interval, parent, own, ratio, *_ in data:
        total = totals[(interval, parent)]
        weight = number(ratio)
        if parent is None or parent.lower() == "null" or sum(total) <= 0 or weight is None or total[3] == 0:
            result[n] = (None, None, None)
        else:
            result[n] = tuple(total[at] * (weight / total[3]) for at in range(3))
    return result


@pytest.mark.parametrize("heavy", [1, 7, 1000])
def test_every_row_gets_its_share(spark, heavy):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    got = S.allocate_splits(df, heavy_groups=heavy).collect()
    want = expected(data)
    assert len(got) == len(data) and {r["n"] for r in got} == set(want)
    for row in got:
        for name, value in zip(S.DEFAULT_IMPACTS, want[row["n"]]):
            share = row[S.PREFIX + name]
            assert (share is None) == (value is None), row
            assert share is None or math.isclose(share, value, rel_tol=1e-6, abs_tol=1e-9)


def test_groups_without_impacts_give_zero_shares(spark):
    data = [(1, "d", "a", "p1", "0.5", None, None, None), (2, "d", "b", "p2", None, None, None, None)]
    got = {r["n"]: r[S.PREFIX + C.ENERGY] for r in S.allocate_splits(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {1: 0.0, 2: None}


def test_no_task_holds_the_dominant_group(spark):
    """With the heavy group broadcast, what is shuffled by key is without it."""
    df = spark.createDataFrame(rows(), SCHEMA)
    light = S.group_totals(df).where("children > 0").orderBy("children", ascending=False)
    sizes = [r["children"] for r in light.collect()]
    assert sizes[0] > 10 * sizes[5]


def test_impact_list_and_missing_columns(spark):
    assert S.impact_list("a, b,c") == ["a", "b", "c"]
    df = spark.createDataFrame(rows(10), SCHEMA)
    with pytest.raises(ContractError, match="nope"):
        S.allocate_splits(df, ["nope"])
    with pytest.raises(ContractError, match=S.RATIO):
        S.allocate_splits(df.drop(S.RATIO))


def test_split_by_tag(spark):
    df = spark.createDataFrame(
        [({"ns": "a", "x": "y"}, 1.0), ({"ns": "a"}, 2.0), ({"ns": "b"}, 5.0), ({"x": "z"}, 9.0), (None, 1.0)],
        f"resource_tags map<string,string>, split_{C.OPERATIONAL} double",
    )
    got = [(r["key"], r["value"], r["total_g"]) for r in split_by_tag(df, "ns").collect()]
    assert got == [("ns", "b", 5.0), ("ns", "a", 3.0)]


def test_tasks_hold_few_groups(spark):
    """A task that sums rows meets neighbouring groups, not those of all rows that it read."""
    lines = [(n, f"d{n % 2000:04}", "null", "r", "1", 1.0, 1.0, 1.0) for n in range(8000)]
    lines += [(n, "hot", "null", "r", "1", 1.0, 1.0, 1.0) for n in range(8000, 16000)]
    usage = spark.createDataFrame(lines, SCHEMA).repartition(4, "n")
    totals = S.group_totals(usage)
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")
    found = {r.interval: r[C.ENERGY] for r in totals.collect()}
    assert len(found) == 2001 and found["hot"] == 8000.0 and {v for k, v in found.items() if k != "hot"} == {4.0}
