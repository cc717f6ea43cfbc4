"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, log1p
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from farebox.llm.shared import fold_of, table

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Labelled texts, by hash of their id, that the field is fitted on. Only their lines' features reach the driver.
FITTED = 4_000
#: Strength of the pull of all weights to zero, and steps of the fit.
RIDGE, STEPS = 1.0, 25
#: Lines that one forward-backward pass takes, about.
BATCH_LINES = 20_000

#: Classes of bytes that are counted in a line.
CLASSES = {"symbol": b"#*$%&|<>", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "point": b".,;:!?\"'()-", "mark": b"!?"}
NAMES = ("one", "words", "word_length", *CLASSES, "same_words", "repeats", "ends", "blank")


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, lines per text) of all lines; a null text is one empty line.

    A line's own features describe its words and bytes and how often the text holds it.
    Its neighbours' own features follow, zero at the ends of the text.
    """
    datas = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    split = [d.split(b"\n") for d in datas]
    counts = np.array([len(x) for x in split], dtype=np.int64)
    lines = [x for part in split for x in part]
    size = np.array([len(x) for x in lines], dtype=np.float64)
    own = np.zeros((len(lines), len(NAMES)))
    own[:, 0] = 1
    joined = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    starts = (np.cumsum(size + 1) - size - 1).astype(np.int64)
    for k, chars in enumerate(CLASSES.values()):
        of = np.zeros(256, dtype=np.int64)
        of[list(chars)] = 1
        own[:, 3 + k] = np.add.reduceat(of[joined], starts) / np.maximum(size, 1) if len(lines) else 0
    at = 3 + len(CLASSES)
    i = 0
    for part in split:
        held = Counter(part) if len(part) > 1 else {}
        for line in part:
            words = line.split()
            if words:
                n = len(words)
                own[i, 1] = np.log1p(n) / 5
                own[i, 2] = min(sum(map(len, words)) / n, 20) / 10
                own[i, at] = 1 - len(set(words)) / n
                own[i, at + 1] = np.log1p(held.get(line, 1) - 1)
                own[i, at + 2] = words[-1][-1:] in b".!?"
            else:
                own[i, at + 3] = 1
            i += 1
    first = np.zeros(len(lines), dtype=bool)
    first[np.cumsum(counts) - counts] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[first] = 0
    after[:-1] = own[1:]
    after[:-1][first[1:]] = 0
    return np.hstack([own, before, after]), size, counts


class Field(NamedTuple):
    """Weights of a line's features for the label good (bad has 0), and of pairs of labels in turn."""

    weights: np.ndarray
    pairs: np.ndarray


def _padded(scores: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, longest, 2) label scores and which places hold a line."""
    live = np.arange(counts.max()) < counts[:, None]
    out = np.zeros((*live.shape, 2))
    out[..., 1][live] = scores
    return out, live


def _log_add(x: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over the last axis but one, for two labels."""
    a, b = x[..., 0, :], x[..., 1, :]
    high = np.maximum(a, b)
    return high + np.log1p(np.exp(-np.abs(a - b)))


def marginals(scores: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once: P(good) of each line, and expected counts of label pairs."""
    node, live = _padded(scores, counts)
    steps = node.shape[1]
    ahead, back = np.zeros_like(node), np.zeros_like(node)
    ahead[:, 0] = node[:, 0]
    for t in range(1, steps):
        ahead[:, t] = node[:, t] + _log_add(ahead[:, t - 1, :, None] + pairs)
    for t in range(steps - 2, -1, -1):
        come = node[:, t + 1] + back[:, t + 1]
        back[:, t] = np.where(live[:, t + 1, None], _log_add((come[:, None, :] + pairs).swapaxes(1, 2)), 0)
    both = ahead + back
    good = 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500)))
    expected = np.zeros((2, 2))
    for t in range(steps - 1):
        k = live[:, t + 1]
        if k.any():
            joint = ahead[k, t, :, None] + pairs + (node[k, t + 1] + back[k, t + 1])[:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return good[live], expected


def _alone(odds: float, scores: np.ndarray, table: np.ndarray) -> list[float]:
    """Log odds of one text's messages after each of ``scores``, own score included."""
    (p00, p01), (p10, p11) = table.tolist()
    out = []
    for own in scores.tolist():
        a, b, c, d = p01, odds + p11, p00, odds + p10
        good = max(a, b) + log1p(exp(-abs(a - b)))
        bad = max(c, d) + log1p(exp(-abs(c - d)))
        odds = own + good - bad
        out.append(odds)
    return out


def _odds(scores: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """P(good) of each line, as ``marginals`` gives it, from the log odds of the messages alone.

    With two labels a message is known by its odds, so a step is a few operations on
    one number per text. Texts are ordered by length, and each step takes those that go on.
    """
    order = np.argsort(-counts, kind="stable")
    many = np.searchsorted(-counts[order], -np.arange(counts.max()), "left")
    first = (np.cumsum(counts) - counts)[order]
    last = first + counts[order] - 1

    def through(odds: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.logaddexp(table[0, 1], odds + table[1, 1]) - np.logaddexp(table[0, 0], odds + table[1, 0])

    ahead, back = scores.copy(), np.zeros(len(scores))
    # where one text goes on alone, single numbers are quicker than arrays of one
    alone = max(1, int(np.searchsorted(-many, -1, "left")))
    for t in range(1, alone):
        at = first[: many[t]] + t
        ahead[at] += through(ahead[at - 1], pairs)
    for t in range(1, alone):
        at = last[: many[t]] - t
        back[at] = through(back[at + 1] + scores[at + 1], pairs.T)
    if alone < len(many):
        a, z = int(first[0]), int(last[0]) + 1
        ahead[a + alone : z] = _alone(ahead[a + alone - 1], scores[a + alone : z], pairs)
        back[a : z - alone] = _alone(back[z - alone] + scores[z - alone], scores[a : z - alone][::-1], pairs.T)[::-1] - scores[a : z - alone]
    return 1 / (1 + np.exp(np.clip(-(ahead + back), -500, 500)))


def _batches(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Texts of like numbers of lines, so that little is padded."""
    order = np.argsort(counts, kind="stable")
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop - at + 1) * counts[order[stop]] <= BATCH_LINES and counts[order[stop]] <= 2 * counts[order[at]]:
            stop += 1
        yield order[at:stop]
        at = stop


def _rows(of: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Line numbers of some texts, in their order."""
    first = (np.cumsum(counts) - counts)[of]
    n = counts[of]
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def line_marginals(x: np.ndarray, counts: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    out, expected = np.zeros(len(x)), np.zeros((2, 2))
    scores = x @ field.weights
    for of in _batches(counts):
        rows = _rows(of, counts)
        out[rows], pairs = marginals(scores[rows], counts[of], field.pairs)
        expected += pairs
    return out, expected


def line_odds(x: np.ndarray, counts: np.ndarray, field: Field) -> np.ndarray:
    """P(good) of each line, without the pairs that only a fit needs."""
    return _odds(x @ field.weights, counts, field.pairs)


def fit_field(x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Field:
    """Largest conditional likelihood of the label sequences; each line carries its text's label.

    Steps go along the gradient of the field's likelihood, scaled by the curvature
    that the lines would have without their neighbours.
    """
    y = np.repeat(labels, counts).astype(float)
    same = np.maximum(counts - 1, 0)
    seen = np.diag([same[labels == 0].sum(), same[labels == 1].sum()]).astype(float)
    weights, pairs = np.zeros(x.shape[1]), np.zeros((2, 2))
    for _ in range(STEPS):
        p, expected = line_marginals(x, counts, Field(weights, pairs))
        curve = np.maximum(p * (1 - p), 0.02)
        hessian = (x * curve[:, None]).T @ x + RIDGE * np.eye(len(weights))
        weights = weights + np.linalg.solve(hessian, x.T @ (y - p) - RIDGE * weights)
        pairs = pairs + np.clip((seen - expected - RIDGE * pairs) / (0.25 * same.sum() + RIDGE), -1, 1)
    return Field(weights, pairs)


def score(texts: list[str | None], field: Field) -> np.ndarray:
    """Mean P(good) of each text's lines, weighted by their bytes (equally if all are empty)."""
    out, at = np.zeros(len(texts)), 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at] or "")
        while stop < len(texts) and size + len(texts[stop] or "") < 1 << 20:
            size += len(texts[stop] or "")
            stop += 1
        x, weight, counts = line_features(texts[at:stop])
        good = line_odds(x, counts, field)
        first = np.cumsum(counts) - counts
        total = np.add.reduceat(weight, first)
        weight = np.where(np.repeat(total, counts) > 0, weight, 1)
        out[at:stop] = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
        at = stop
    return np.clip(out, 0, 1)


def learn_field(docs: DataFrame, labels: DataFrame, fitted: int = FITTED) -> Field | None:
    """Field fitted on at most ``fitted`` labelled texts; None without both labels.

    Of labels, and of texts that repeat an id, the first ``fitted`` in a fixed order are taken.
    Their features are taken where the texts are; the sample's ids are few enough to
    be sent there.
    """
    some = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fitted)
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text, quality in batch[["doc_id", "text", "quality"]].itertuples(index=False):
                x, _, counts = line_features([text])
                yield pd.DataFrame({"doc_id": [doc_id], "quality": [quality], "lines": [int(counts[0])], "x": [x.astype("<f4").tobytes()]})

    rows = found.mapInPandas(run, "doc_id long, quality int, lines int, x binary").orderBy("doc_id", "quality", "lines", "x").limit(fitted).collect()
    if len({r.quality for r in rows}) < 2:
        return None
    counts = np.array([r.lines for r in rows])
    x = np.frombuffer(b"".join(r.x for r in rows), dtype="<f4").reshape(counts.sum(), -1).astype(np.float64)
    return fit_field(x, counts, np.array([r.quality for r in rows]))


def score_texts(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, with a field from ``learn_field``.

    Defined cases: a null or empty text is one empty line and has a score; without a
    field all scores are 0.5; repeated rows each get the same; a null doc_id is held
    out as the empty text's checksum says; a score is a number of its own, so ties need no order;
    all lines of a text of any length count; extra columns are not read; no rows give no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            known = shipped.value
            yield pd.Series(score(list(batch), known) if known else np.full(len(batch), 0.5), dtype="float64")

    out = docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), of("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def line_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_texts`` with a field fitted on labelled rows that are not held out."""
    known = labels.where(fold_of("doc_id", FOLDS) != HELD_OUT)
    return score_texts(docs, learn_field(docs, known))


def op4_line_quality(spark, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
