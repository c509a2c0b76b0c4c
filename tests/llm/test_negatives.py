"""Hard negatives against brute force, with ties, repeated rows, odd vectors and small blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score long, part int, id string, slot int"


def _rows(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).repartition(parts)


def _brute(rows, anchor, positives=5, k=5, low=80, high=100):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = (label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        own[i] = min(own.get(i, one), one)
    score = lambda a, b: sum(x * y for x, y in zip(own[a][1], own[b][1], strict=False))
    out = []
    for a in filter(anchor, own):
        first = lambda ids: sorted(ids, key=lambda i: (-score(a, i), i))
        for p in first(i for i in own if i != a and own[i][0] == own[a][0])[:positives]:
            fit = first(i for i in own if own[i][0] != own[a][0] and low * score(a, p) <= high * score(a, i) <= high * score(a, p))
            out += [(a, p, n + 1, i, score(a, p), score(a, i)) for n, i in enumerate(fit[:k])]
    return sorted(out)


def _mined(rows, modulus):
    found = negatives.hard_negatives(rows, F.col("vec_id") % modulus == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("blocks", [None, (16, 8, 4, 64)], ids=["one block", "small blocks"])
def test_equals_brute_force(spark, monkeypatch, blocks):
    if blocks:
        for name, value in zip(("BLOCK_ROWS", "LEAST_ROWS", "BLOCK_ANCHORS", "ENTRIES"), blocks, strict=True):
            monkeypatch.setattr(negatives, name, value)
    rng = random.Random(5)
    # Few distinct values, so that scores tie; a third of the rows have one label and one vector.
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, 0.6]) for _ in range(4)], rng.randrange(4)) for i in range(120)]
    rows += [(i, [0.3, 0.3, 0.25, 0.6], 2) for i in range(120, 180)]
    rows += [(7, [0.6, 0.6, 0.6, 0.6], 0), (7, [0.6, 0.6, 0.6, 0.6], 0), (10, [0.3], 1), (200, [0.6, 0.25], 3), (210, [], 1), (220, [0.6] * 9, 1)]
    rows += [(None, [1.0] * 4, 1), (230, None, 1), (240, [1.0, None, 1.0, 1.0], 1), (250, [float("nan")] * 4, 1), (260, [float("inf")] * 4, 2), (270, [1.0] * 4, None)]
    want = _brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 100 and _mined(_rows(spark, rows), 10) == want


def test_scores_beyond_doubles_and_below_zero(spark):
    big = 2.0**20
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big, 0.99609375], 2), (3, [big, 1.00390625], 2), (10, [-1.0, 0.0], 5), (11, [1.0, 0.0], 5), (12, [1.0, 0.0], 6)]
    got = _mined(_rows(spark, rows), 10)
    assert got == _brute(rows, lambda i: i % 10 == 0) and [g[3] for g in got if g[0] == 0] == [2]
    assert not [g for g in got if g[0] == 10]  # its only positive has a score below zero


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, None, 1)], [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_small_tables(spark, rows):
    assert _mined(_rows(spark, rows), 10) == _brute(rows, lambda i: i % 10 == 0)


def test_first_of_rows_takes_ties_in_order():
    scores = np.array([[3, 5, 5, 5, 1], [2, 2, 2, 2, 2]])
    r, c = negatives.first_of_rows(scores, np.array([[1, 1, 0, 1, 1], [0, 1, 1, 1, 1]], bool), 3)
    assert list(zip(r.tolist(), c.tolist(), strict=True)) == [(0, 0), (0, 1), (0, 3), (1, 1), (1, 2), (1, 3)]
