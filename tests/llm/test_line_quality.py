import itertools
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from farebox.llm import line_quality as lq


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    counts = np.array([1, 4, 3, 5])
    scores, pairs = rng.normal(size=counts.sum()) * 2, rng.normal(size=(2, 2))
    good, expected = lq.marginals(scores, counts, pairs)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        s = scores[at : at + n]
        at += n
        total, hits, both = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(s[i] * x for i, x in enumerate(labels)) + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
            total += w
            hits += w * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                both[a, b] += w
        want += (hits / total).tolist()
        want_pairs += both / total
    assert np.allclose(good, want) and np.allclose(expected, want_pairs)


def test_batches_and_neighbours():
    texts = ["a b\n\nC d!\nC d!", None, "", "x #", "one.\n" * 30 + "two"]
    x, weight, counts = lq.line_features(texts)
    assert counts.tolist() == [4, 1, 1, 1, 31] and weight.tolist()[:7] == [3, 0, 4, 4, 0, 0, 3]
    d = len(lq.NAMES)
    assert (x[1:4, d : 2 * d] == x[0:3, :d]).all() and not x[0, d : 2 * d].any() and not x[3, 2 * d :].any()
    assert x[2, 3 + len(lq.CLASSES) + 1] > 0 == x[0, 3 + len(lq.CLASSES) + 1]
    field = lq.Field(np.random.default_rng(2).normal(size=3 * d), np.array([[1.0, -1.0], [-0.5, 2.0]]))
    whole, _ = lq.line_marginals(x, counts, field)
    alone = np.concatenate([lq.marginals(x[a - n : a] @ field.weights, np.array([n]), field.pairs)[0] for a, n in zip(np.cumsum(counts), counts)])
    assert np.allclose(whole, alone)
    assert np.allclose(lq.score(texts, field)[0], (alone[:4] * weight[:4]).sum() / 11)


def test_held_out_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in lq.line_quality(docs, labels).collect()}
    truth = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pandas()
    n = Counter((q, out[i].predicted) for i, q in zip(truth.doc_id, truth.quality) if out[i].held_out)
    assert n[0, 0] >= 0.95 * (n[0, 0] + n[0, 1]) and n[1, 1] >= 0.98 * (n[1, 0] + n[1, 1])
    assert len(out) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out.values())


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, f"good words here {i}.\nand a second line.", 1) for i in range(30)] + [(100 + i, "BAD!! " * (i + 3), 0) for i in range(30)]
    rows += [(200, None, 1), (201, "", 0), (None, "good words here.", 1), (3, rows[3][1], 1)]
    docs = spark.createDataFrame([(a, b, 5, 6) for a, b, _ in rows], "doc_id long, text string, quality int, score int")
    labels = spark.createDataFrame([(a, c, None) for a, _, c in rows] + [(1, None, 1)], "doc_id long, quality int, toxic int")
    out = lq.line_quality(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == (r.doc_id is None or r.doc_id < 100) for r in out if r.doc_id not in (200, 201))
    assert {r.score for r in lq.line_quality(docs, labels.where("quality = 1")).collect()} == {0.5}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lq.line_quality(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_odds_equal_marginals():
    rng = np.random.default_rng(4)
    counts = np.array([1, 7, 300, 1, 2, 40, 7, 1000])
    scores = rng.normal(0, 3, counts.sum())
    for pairs in (rng.normal(0, 2, (2, 2)), np.zeros((2, 2)), np.array([[5.0, -40.0], [-40.0, 5.0]])):
        good, _ = lq.marginals(scores, counts, pairs)
        assert np.abs(lq._odds(scores, counts, pairs) - good).max() < 1e-9
        for a, n in zip(np.cumsum(counts) - counts, counts):
            assert np.abs(lq._odds(scores[a : a + n], np.array([n]), pairs) - good[a : a + n]).max() < 1e-9
