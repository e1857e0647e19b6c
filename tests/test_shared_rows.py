"""Trees that share their rows while they are cut alike, and tables that go whole to tasks."""

import numpy as np
import pytest

from firmlens.operators import growing
from firmlens.operators.growing import Binned, Block, Pairs, Rules, Work

ARRAYS = ("feature", "cut", "left", "gap_left", "value", "size", "gain", "owner", "depth")
LIMITS = [(1, 2), (5, 60), (40, 2), (60, 200), (20, 300), (150, 2), (2, 20)]


def grown(kind: str, rules: list[Rules], source=None) -> growing.Trees:
    rng = np.random.default_rng(4)
    n = 900
    bins = rng.integers(0, 40, (n, 4)).astype(np.uint8)
    bins[rng.random((n, 4)) < 0.1] = growing.GAP
    x = np.where(bins == growing.GAP, np.nan, bins.astype(float))
    y = rng.integers(0, 3, n).astype(float) if kind == "class" else rng.normal(size=n) + bins[:, 0]
    table = Binned(None, [np.arange(40.0)] * 4, n, classes=[0.0, 1.0, 2.0] if kind == "class" else [], unit=2.0**-30)
    work = Work.of(table, rules, None, 1.0)
    block = Block(rng.integers(0, 1 << 62, n).astype(np.uint64), x, bins, y, np.zeros(n, int), None)
    lead = np.arange(len(rules)) if source is None else np.unique(source, return_index=True)[1]
    w = growing._weights(block, work, lead)
    row, slot = np.nonzero(w > 0)
    stats = growing._statistics(block, work, row, lead[slot], w[row, slot], None)
    pairs = Pairs(slot, stats, (x if work.random_cuts else bins)[row], None)
    return growing.grow_here(work, np.arange(len(rules)), np.ones(len(rules), np.uint64), np.zeros(len(rules), int), pairs, source)


def rules(kind: str, random_cuts: bool) -> list[Rules]:
    names = ("gini", "entropy") if kind == "class" else ("squared", "poisson")
    return [
        Rules(names[i % 2], min_leaf=a, min_split=b, columns=2, draw="bootstrap", random_cuts=random_cuts, seed=s)
        for s in range(3) for i, (a, b) in enumerate(LIMITS)
    ]


@pytest.mark.parametrize("kind", ["class", "value"])
@pytest.mark.parametrize("random_cuts", [False, True])
def test_trees_that_share_rows_are_those_of_their_own(kind, random_cuts):
    some = rules(kind, random_cuts)
    alone, shared = grown(kind, some), grown(kind, some, np.array([r.seed for r in some]))
    assert all(np.array_equal(getattr(alone, n), getattr(shared, n)) for n in ARRAYS)
    assert len(alone.feature) > 500


@pytest.mark.parametrize("kind", ["class", "value"])
@pytest.mark.parametrize("random_cuts", [False, True])
def test_cuts_a_column_at_a_time_are_those_of_all_cells(kind, random_cuts, monkeypatch):
    some = rules(kind, random_cuts)
    fast = grown(kind, some)

    class Slow:
        def __init__(self, pairs, stats, exact, work, of_nodes, drawn, random, source):
            kept = Pairs(pairs.slot, np.stack([v.astype(np.int64) for v in stats], axis=1), pairs.x, None)
            self.__dict__ = growing._sorted_cuts(kept, work, of_nodes, drawn, random).__dict__

    monkeypatch.setattr(growing, "NearCuts", Slow)
    slow = grown(kind, some)
    assert all(np.array_equal(getattr(fast, n), getattr(slow, n)) for n in ARRAYS)


def test_whole_tables_give_the_trees_of_levels(spark, monkeypatch):
    """A table beyond ``LOCAL_ROWS`` goes whole to tasks where many small trees are asked for."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    rows = [(i, v.tolist(), float(v[0] > 0) + float(v[1] > 0.5)) for i, v in enumerate(x)]
    table = growing.binned(spark.createDataFrame(rows, "k long, x array<double>, y double"), "k", "class", F_x(), "y")
    some = [Rules("gini", min_leaf=60, columns=2, draw="bootstrap", seed=s // 2, min_split=2 + 300 * (s % 2)) for s in range(40)]
    monkeypatch.setattr(growing, "LOCAL_ROWS", 100)
    sent = []
    whole_trees = growing._whole_trees
    monkeypatch.setattr(growing, "_whole_trees", lambda *a: sent.append(a[2]) or whole_trees(*a))
    whole = growing.grow(table, some)
    monkeypatch.setattr(growing, "WHOLE_TIMES", 1)
    levels = growing.grow(table, some)
    assert sent == [40]
    for t in range(40):
        at = [g.walk(x)[:, t] for g in (whole, levels)]
        assert np.array_equal(whole.value[at[0]], levels.value[at[1]])


def F_x():
    from pyspark.sql import functions as F

    return F.col("x")


def test_whole_tables_give_the_random_cuts_of_levels(spark, monkeypatch):
    """Extremely randomised trees of small and of unlimited depth, which need the values of all rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    x[rng.random((400, 3)) < 0.1] = np.nan
    rows = [(i, v.tolist(), float(np.nan_to_num(v[0]) > 0) + float(np.nan_to_num(v[1]) > 0.5)) for i, v in enumerate(x)]
    table = growing.binned(spark.createDataFrame(rows, "k long, x array<double>, y double"), "k", "class", F_x(), "y")
    some = [Rules("entropy", min_leaf=30, columns=2, random_cuts=True, seed=s // 2, min_split=2 + 200 * (s % 2)) for s in range(40)]
    monkeypatch.setattr(growing, "LOCAL_ROWS", 100)
    sent = []
    whole_trees = growing._whole_trees
    monkeypatch.setattr(growing, "_whole_trees", lambda *a: sent.append(a[2]) or whole_trees(*a))
    whole = growing.grow(table, some)
    monkeypatch.setattr(growing, "WHOLE_TIMES", 1)
    levels = growing.grow(table, some)
    assert sent == [40]
    for t in range(40):
        at = [g.walk(x)[:, t] for g in (whole, levels)]
        assert np.array_equal(whole.value[at[0]], levels.value[at[1]])
