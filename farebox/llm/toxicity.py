"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from farebox.llm.shared import Scratch, fold_of, table

FOLDS, HELD_OUT = 4, 2
#: Lengths of word beginnings that may be entries beside whole words.
STEMS = (4, 5, 6, 7, 8)
#: An entry is in at least this share of the toxic texts, and at least this share of the texts
#: with it are toxic. The first bounds the lexicon.
SUPPORT, PRECISION = 0.001, 0.6
#: Least log likelihood ratio against chance: very many strings are tried.
EVIDENCE = 25.0
#: A phrase with an entry is an exception if at least so many clean texts hold it, and so many times the toxic ones.
EXCEPTION_TEXTS = 5
THRESHOLD = 0.3
#: Labelled rows, by hash of their id, that the lexicon is learned from.
LABELLED = 100_000
#: Labelled texts, by hash, whose sums of weights and lengths fit the score.
FITTED = 20_000
#: Counted words that a task holds before it passes them on.
HELD = 100_000

#: Code points that look like these letters.
LOOKALIKES = {
    "a": "аαɑ@4", "b": "Ьβвƅ8", "c": "сϲ", "d": "ԁɗ", "e": "еεҽ3", "g": "ɡց9", "h": "һհ", "i": "іιı1|", "j": "јϳ", "k": "кκ", "l": "ӏ",
    "m": "мϻ", "n": "пո", "o": "оοօσ0", "p": "рρ", "q": "ԛգ", "r": "гꭇ", "s": "ѕꜱ$5", "t": "тτ7", "u": "υսц", "v": "ѵν", "w": "ԝωա",
    "x": "хχ", "y": "уγү", "z": "ᴢʐ2",
}
LETTERS = {c: letter for letter, chars in LOOKALIKES.items() for c in chars}


class _Folding(dict):
    """Translation table that works out each code point when it first occurs."""

    def __missing__(self, point: int) -> str:
        out = ""
        whole = chr(point) if chr(point) in LETTERS else unicodedata.normalize("NFKC", chr(point)).lower()
        for c in whole:
            if c in LETTERS:
                out += LETTERS[c]
            elif c.isalnum():
                out += c
            elif unicodedata.category(c) not in ("Mn", "Cf"):
                out += " "
        self[point] = out
        return out


@cache
def _folding() -> _Folding:
    return _Folding()


def fold(text: str | None) -> str:
    """Lower-case letters with lookalikes and digit substitutes folded, one space between words and at both ends.

    Invisible code points and loose accents go; an exclamation mark before a letter or digit is an i.
    A 1 folds to i; as it may also stand for l, the lexicon holds entries with l in both forms.
    """
    text = text or ""
    if "!" in text:
        text = re.sub(r"!(?=\w)", "i", text)
    return f" {' '.join(text.translate(_folding()).split())} "


class Lexicon(NamedTuple):
    """Weights by entry: " word " for whole words, " stem" for beginnings; phrases that
    don't count; and what turns a text's weight and length into its score."""

    weights: dict[str, float]
    exceptions: frozenset[str]
    fit: tuple[float, ...] = (-4.0, 1.0, 1.0)


def automaton(lexicon: Lexicon):
    found = ahocorasick.Automaton()
    for entry, weight in lexicon.weights.items():
        found.add_word(entry, (len(entry), weight))
    found.make_automaton()
    return found


def matches(folded: str, found) -> dict[int, tuple[float, str]]:
    """By where a word begins: the weight of the longest entry that matches it, and the word."""
    longest: dict[int, tuple[int, float]] = {}
    if len(found):
        for end, entry in found.iter(folded):
            at = end - entry[0] + 2
            longest[at] = max(longest.get(at, entry), entry)
    return {at: (weight, folded[at : folded.index(" ", at)]) for at, (_, weight) in longest.items()}


def phrases(folded: str, at: int, word: str) -> list[str]:
    """The word with the one before and with the one after."""
    before = folded.rfind(" ", 0, at - 1) + 1 if at > 1 else at
    stop = at + len(word)
    after = folded.find(" ", stop + 1)
    out = []
    if before < at - 1:
        out.append(folded[before:stop])
    if after > 0:
        out.append(folded[at:after])
    return out


def weight_of(text: str | None, lexicon: Lexicon, found) -> tuple[float, int]:
    """(sum of weights, words) of a text."""
    folded = fold(text)
    total = 0.0
    for at, (weight, word) in matches(folded, found).items():
        if not lexicon.exceptions or not any(p in lexicon.exceptions for p in phrases(folded, at, word)):
            total += weight
    return total, folded.count(" ") - 1 if len(folded) > 2 else 0


def features(total: float, words: int) -> tuple[float, float, float]:
    """Weight in all and for its length: one match says less about a long text."""
    return 1.0, math.log1p(total), math.log1p(100 * total / (words + 50))


def score_of(total: float, words: int, fit: tuple[float, ...]) -> float:
    """0 without a match."""
    z = sum(a * b for a, b in zip(features(total, words), fit, strict=True))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) if total > 0 else 0.0


def fit_scores(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a light ridge (separable classes stay finite)."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
    return tuple(w.tolist())


def _counted(key):
    """Texts per counted string and label, from a function that names the strings of a folded text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out():
            return pd.DataFrame([(s, t, n) for (s, t), n in held.items()], columns=["entry", "toxic", "n"])

        for batch in batches:
            for text, toxic in batch[["text", "toxic"]].itertuples(index=False):
                held.update((s, toxic) for s in key(fold(text)))
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def _entries(folded: str) -> set[str]:
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in STEMS if len(w) > n}


def learn_lexicon(labelled: DataFrame, scratch: Scratch) -> Lexicon:
    """Lexicon from rows of text and toxic (0 or 1).

    Each text counts once for every word and word beginning in it. Entries are
    those that prevail in toxic texts; they are in a thousandth of the toxic texts
    at least, so a text of n words bounds them by 1000 * 6 n. In a second pass, the
    neighbours of matched words in other texts give the exceptions. At most
    ``FITTED`` texts, chosen by hash, give their weight and length to the driver to
    fit the score.
    """
    rows = labelled.where("toxic is not null and text is not null").select("text", F.col("toxic").cast("int").alias("toxic"))
    rows = scratch.write(rows, "rows")
    texts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = texts.get(1, 0), texts.get(0, 0)
    if not bad or not good:
        return Lexicon({}, frozenset())
    spread = lambda c: c.groupBy("entry").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("bad"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("good")
    )
    sums = spread(rows.mapInPandas(_counted(_entries), "entry string, toxic int, n long"))
    sums = scratch.write(sums, "entries")
    held, base = F.col("bad") + F.col("good"), bad / (bad + good)
    part = lambda c, rate: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (held * rate))).otherwise(0.0)
    strong = 2 * (part("bad", base) + part("good", 1 - base)) >= EVIDENCE
    kept = sums.where((F.col("bad") >= SUPPORT * bad) & (F.col("bad") >= PRECISION * held) & strong)
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    weights = {r.entry: r.weight for r in kept.select("entry", weight.alias("weight")).collect()}
    other = {e.replace("l", "i"): w for e, w in weights.items() if "l" in e}
    seen = {r.entry for r in sums.where(F.col("entry").isin(list(other)) & (F.col("good") > 0)).collect()} if other else set()
    weights = {e: w for e, w in other.items() if e not in seen} | weights
    lexicon = Lexicon(weights, frozenset())
    shipped = scratch.spark.sparkContext.broadcast(lexicon)

    def near(folded: str) -> set[str]:
        found = _automaton(shipped)
        return {p for at, (_, word) in matches(folded, found).items() for p in phrases(folded, at, word)}

    around = spread(rows.mapInPandas(_counted(near), "entry string, toxic int, n long"))
    clean = around.where((F.col("good") >= EXCEPTION_TEXTS) & (F.col("bad") * EXCEPTION_TEXTS < F.col("good")))
    lexicon = Lexicon(weights, frozenset(r.entry for r in clean.select("entry").collect()))
    final = scratch.spark.sparkContext.broadcast(lexicon)

    @F.pandas_udf("struct<total:double,words:long>")
    def weighed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _automaton(final)
            yield pd.DataFrame([weight_of(t, final.value, found) for t in batch], columns=["total", "words"])

    # weighed before they are sorted, so that texts don't move
    narrow = rows.select("toxic", F.xxhash64("text").alias("place"), weighed("text").alias("of")).select("toxic", "place", "of.*")
    some = narrow.orderBy("place", "toxic").limit(FITTED).collect()
    x = np.array([features(r.total, r.words) for r in some])
    return lexicon._replace(fit=fit_scores(x, np.array([r.toxic for r in some])))


_BUILT: dict[str, object] = {}


def _automaton(shipped):
    """The automaton of a broadcast lexicon, built once in each worker."""
    if shipped.value is not _BUILT.get("of"):
        _BUILT.update({"of": shipped.value, "automaton": automaton(shipped.value)})
    return _BUILT["automaton"]


def score_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, with a lexicon from ``learn_lexicon``.

    Defined cases: null and empty texts, and all if the lexicon is empty, score 0;
    repeated rows each get the same; a null doc_id is held out as the empty text's
    checksum says; a score is a number of its own, so ties need no order; texts of any length
    are read whole; extra columns are not read; no rows give no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = _automaton(shipped)
            yield pd.Series([score_of(*weight_of(t, shipped.value, found), shipped.value.fit) for t in batch], dtype="float64")

    out = docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), of("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """``score_texts`` with the lexicon of at most ``labelled`` labelled rows that are not held out.

    Their ids are chosen by hash and sent to the texts, which so stay where they are.
    """
    known = labels.where((fold_of("doc_id", FOLDS) != HELD_OUT) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(labelled)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return score_texts(docs, learn_lexicon(found, Scratch(docs.sparkSession, "toxicity")))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
