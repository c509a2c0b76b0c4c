"""The quadratic discriminant against plain code, on held-out rows, and on odd tables."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import quality, tokens

SCHEMA = "doc_id long, text string, lang string, features string, label string, marked long, score string"
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "É ñ 漢字"), (6, "word " * 60_000), (6, "word " * 60_000), (None, "a null id"), (7, "same id"), (7, "other")]


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "en", "f", "l", 1, "s") for r in rows], SCHEMA).repartition(3)


def _plain(text):
    """The statistics of one text, from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x]
    n, chars, letters = len(words), len(text), len(re.findall(r"[A-Za-z\u0080-\U0010FFFF]", text))
    share = lambda k, of: math.asin(math.sqrt(min(1, k / max(1, of))))
    count = lambda signs: sum(text.count(c) for c in signs)
    signs = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in ".,;:!?\"'()-"]
    runs = [tuple(words[i : i + 3]) for i in range(n - 2)]
    return [
        math.log1p(n), math.log1p(sum(len(w.encode()) for w in words) / max(1, n)), math.log1p(chars / max(1, len(lines))),
        share(len(re.findall("[A-Z]", text)), letters), share(len(re.findall("[0-9]", text)), chars), share(count(".,;:"), n),
        share(count("!?"), n), share(count(signs), n), share(count("\"'()-"), n), share(sum(w[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for w in words), n),
        share(sum(w[-1] in [*signs, "!", "?"] for w in words), n), share(sum(len(w.encode()) <= 2 for w in words), n),
        share(n - len(set(words)), n), share(len(lines) - len(set(lines)), len(lines)), share(len(runs) - len(set(runs)), n),
    ]


def test_statistics_equal_plain_code():
    rng = random.Random(1)
    marks = [*"abcABC", "é", "Ñ", "漢", " ", " ", "\n", "\t", ".", ",", "!", "?", "#", "|", "-", "7", "the ", "the "]
    texts = [None, "", " ", "\n\n", "a", "a b c a b c", *("".join(rng.choices(marks, k=rng.randrange(300))) for _ in range(60)), "word and " * 40_000]
    got = np.concatenate([quality.statistics(part) for part in tokens.slices(pa.array(texts), lower=False, size=500)])
    assert np.allclose(got, [_plain(t) for t in texts], atol=1e-12) and got.shape[1] == quality.FEATURES


def _labelled(n, seed=2):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 200))]
        kind = rng.choice(["good", "good", "good", "signs", "loud"])
        if kind == "signs":
            words = [w + rng.choice(["***", "$$$", ""]) for w in words]
        if kind == "loud":
            words = [w.upper() + rng.choice(["!!", ""]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind == "good")))
    return rows, labels


def test_scores_equal_plain_code_and_hold_out(spark):
    rows, labels = _labelled(900)
    marks = spark.createDataFrame([x for x in labels if x[0] % 3] + [(2, 1), (None, 1), (4, None), (5, 7)], "doc_id long, quality int")
    found = quality.classify(_docs(spark, rows), marks, F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    assert found.columns == ["doc_id", "held_out", "score"]
    got = {r.doc_id: r for r in found.collect()}
    x, y = np.array([_plain(t) for _, t in rows]), np.array([v for _, v in labels])
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in rows])
    used = np.array([i % 3 > 0 for i, _ in rows]) & ~held
    parts = [x[used & (y == k)] for k in (0, 1)]
    pooled = sum(len(p) * np.cov(p.T, bias=True) for p in parts) / used.sum() + 1e-4 * np.eye(x.shape[1])
    density = []
    for p in parts:
        w = quality.TO_POOLED + (1 - quality.TO_POOLED) * x.shape[1] / (x.shape[1] + len(p))
        s = (1 - w) * np.cov(p.T, bias=True) + w * pooled
        s = (1 - quality.TO_DIAGONAL) * s + quality.TO_DIAGONAL * np.diag(np.diag(s))
        gap = x - p.mean(axis=0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(s), gap) - 0.5 * np.linalg.slogdet(s)[1])
    rank = np.argsort(density[1] - density[0])
    score = np.array([got[i].score for i, _ in rows])
    assert (np.diff(score[rank]) >= -1e-9).all() and all(got[i].held_out == held[i] for i, _ in rows)
    assert ((score >= 0.7) == (y == 1))[held].mean() > 0.97
    # The curve is calibrated: scores of the rows it was fitted on average to the share of ones.
    assert score[used].mean() == pytest.approx(y[used].mean(), abs=0.01)


def test_curve_recovers_a_logistic():
    middle = np.linspace(-5, 5, 200)
    p = 1 / (1 + np.exp(-(1.5 * middle - 0.7)))
    assert quality.fit_curve(middle, 1e4 * (1 - p), 1e4 * p) == pytest.approx((1.5, -0.7), abs=1e-3)


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(4, 1)], 2 / 3), ([(4, 0), (7, 0)], 1 / 5), ([(4, 0), (7, 1)], None)])
def test_edges_give_a_row_each(spark, labels, score):
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.classify(_docs(spark, EDGES), marks, F.lit(None).cast("boolean")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in EDGES)
    assert all(0 <= r.score <= 1 and r.held_out is False for r in got)
    assert score is None or all(r.score == pytest.approx(score) for r in got)
    same = [r.score for r in got if r.doc_id == 6]
    assert same[0] == same[1]


def test_no_documents(spark):
    marks = spark.createDataFrame([(4, 1)], "doc_id long, quality int")
    assert quality.classify(_docs(spark, []), marks, F.lit(False)).collect() == []
