"""Mergeable states: sums equal, sketches within their errors, feeds replaced and added."""

import random

import pytest
from pyspark.sql import functions as F

from tenderloom.operators.states import States

C = F.col
SCHEMA = "month string, kind string, amount double, buyer string"


def rows(rng, months, n):
    return [(rng.choice(months), rng.choice(["a", "b", None]), rng.choice([None, round(rng.uniform(0, 1e6), 2)]), f"b{rng.randrange(4000)}") for _ in range(n)]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    rng = random.Random(7)
    states = States(spark, str(tmp_path_factory.mktemp("states") / "s"), ["kind"], ["amount"], ["buyer"], ["amount"])
    feeds = {"one": rows(rng, ["2024-01", "2024-02"], 6000), "two": rows(rng, ["2024-02", "2024-03"], 6000)}
    for feed, own in feeds.items():
        states.add(spark.createDataFrame(own, SCHEMA).repartition(3), "month", feed)
    states.add(spark.createDataFrame(feeds["two"], SCHEMA), "month", "two")  # once more: replaced, not doubled
    return states, feeds["one"] + feeds["two"]


@pytest.mark.parametrize("by,first,last", [(["kind"], None, None), ([], "2024-02", None), (["month"], "2024-01", "2024-02")])
def test_reports_equal_a_full_pass(kept, by, first, last):
    states, all_ = kept
    own = [r for r in all_ if (first or "") <= r[0] <= (last or "9")]
    groups = {}
    for r in own:
        groups.setdefault(tuple({"kind": r[1], "month": r[0]}[b] for b in by), []).append(r)
    got = states.report(by, first, last, (0.1, 0.5, 0.9)).collect()
    assert len(got) == len(groups)
    for g in got:
        mine = groups[tuple(g[b] for b in by)]
        amounts = sorted(r[2] for r in mine if r[2] is not None)
        assert g.n == len(mine) and g.sum_amount == pytest.approx(sum(amounts), abs=1e-3) and g.mean_amount == pytest.approx(sum(amounts) / len(amounts))
        assert (g.min_amount, g.max_amount) == (amounts[0], amounts[-1])
        kinds = len({r[3] for r in mine})
        assert abs(g.distinct_buyer - kinds) <= 0.02 * kinds + 1
        for q, v in zip((0.1, 0.5, 0.9), g.quantiles_amount):
            assert abs(sum(x <= v for x in amounts) / len(amounts) - q) < 0.006


def test_a_report_reads_states_alone_and_an_addition_one_feed(kept, spark):
    states, _ = kept
    files = {f.split("feed=")[1].split("/")[0] for f in states.report(["kind"]).inputFiles()}
    assert files == {"one", "two"}
    before = {f for f in states.rows().inputFiles()}
    states.add(spark.createDataFrame([("2024-04", "a", 1.0, "x")], SCHEMA), "month", "three")
    assert before < set(states.rows().inputFiles()) and states.report(["month"], "2024-04").first().n == 1
    with pytest.raises(ValueError):
        states.add(spark.createDataFrame([], SCHEMA), "month", "a/b")


def test_no_values(spark, tmp_path):
    states = States(spark, str(tmp_path / "s"), [], ["amount"], ["buyer"], ["amount"])
    states.add(spark.createDataFrame([("2024-01", "a", None, None)], SCHEMA), "month", "f")
    r = states.report().first()
    assert (r.n, r.sum_amount, r.mean_amount, r.distinct_buyer, r.quantiles_amount) == (1, 0.0, None, 0, [None])
