"""Hard negatives beside a plain version, and the Four Russians' scores beside numpy's products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import four_russians as fr
from shelfwise.llm import queries

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, q int, shard int, rank string"


def plain(rows, every=100):
    """Sorted (anchor, positive, rank, negative, positive score, negative score)."""
    whole = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        whole[i] = min(whole.get(i, r), r)
    out = []
    for a, (label, q) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, other) for i, (other, p) in whole.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


def run(monkeypatch, spark, rows, shard):
    table = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *a: table)
    monkeypatch.setattr(fr.hard_negatives, "__defaults__", (*fr.hard_negatives.__defaults__[:-1], shard))
    return got(queries.op13_four_russians(spark, ""))


@pytest.mark.parametrize("shard", [40, 10_000])
def test_awkward_rows(monkeypatch, spark, shard):
    rng = random.Random(4)
    draw = lambda: [round(rng.gauss(0.1, 0.3), 1) for _ in range(5)]  # noqa: E731  coarse, so scores tie
    rows = [(i, draw(), i % 3) for i in range(500)]
    rows += [(700 + i, [0.1] * 5, i % 10) for i in range(60)]  # one very common vector
    rows += [(1, rows[1][1], 1), (900, None, 1), (901, [None] * 5, 1), (902, [0.1, 0.2, None, 0.1, 0.0], 1),
             (903, [math.nan] + [0.0] * 4, 1), (904, [math.inf] + [0.0] * 4, 1), (1000, draw(), None), (None, draw(), 1),
             (1100, [0.0] * 5, 2), (1200, draw(), 9)]
    want = plain(rows)
    assert want and run(monkeypatch, spark, rows, shard) == want


def test_few_rows(monkeypatch, spark):
    assert run(monkeypatch, spark, [], 10) == []
    assert run(monkeypatch, spark, [(100, [1.0], 1)], 10) == []
    rows = [(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2), (4, [0.5], 2), (200, [0.5], 3)]
    assert run(monkeypatch, spark, rows, 10) == plain(rows) != []


def test_rows_without_a_score(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.5], 2), (4, [1e300, 0.0], 2), (5, [], 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert got(fr.hard_negatives(table, F.col("id") == 0)) == [(0, 1, 1, 2, 65536, 32768)]


@pytest.mark.parametrize("most", [0, 1, 127, 128, 255, 70_000, 1 << 24])
def test_scores_are_products(most):
    rng = np.random.default_rng(most)
    q = rng.integers(-most, most + 1, size=(500, 19))
    q[:2] = [[most], [-most]]
    a = rng.integers(-most, most + 1, size=(7, 19))
    planes = fr.Planes(np.arange(500)[::-1].copy(), np.zeros(500, np.int64), q)
    assert (planes.scores(a) == a @ q[::-1].T).all()


def test_first_keeps_ties_in_order():
    s = np.array([3, 5, 5, 1, 5, 4])
    assert fr.first(s, np.array([0, 1, 2, 3, 4, 5]), 2).tolist() == [1, 2]
    assert fr.first(s, np.array([4, 5]), 5).tolist() == [4, 5]
