import math
import random
from collections import Counter

import pyarrow.parquet as pq

from farebox.llm import toxicity as tox
from farebox.llm.shared import Scratch


def test_folding():
    assert tox.fold("L0ser, lоsеr (Cyrillic) LOSER l​oser ｌｏｓｅｒ") == " loser loser cyrillic loser loser loser "
    assert tox.fold("1d!0t stup1d! $cum tr@5h") == " idiot stupid scum trash "
    assert tox.fold(None) == "  " and tox.fold(" \n") == "  "


def brute_force(text, lexicon):
    """All words one by one, without an automaton."""
    words, total = tox.fold(text).split(), 0.0
    for i, w in enumerate(words):
        fits = [x for e, x in sorted(lexicon.weights.items(), key=lambda x: len(x[0])) if (e.endswith(" ") and e.strip() == w) or (not e.endswith(" ") and w.startswith(e[1:]))]
        near = ([f"{words[i - 1]} {w}"] if i else []) + ([f"{w} {words[i + 1]}"] if i + 1 < len(words) else [])
        if fits and not any(p in lexicon.exceptions for p in near):
            total += fits[-1]
    return total, len(words)


def test_matching_equals_brute_force():
    rng = random.Random(4)
    vocabulary = ["trash", "trashy", "clown", "vequm", "vequla", "veq", "the", "can", "not", "of"]
    lexicon = tox.Lexicon({" trash ": 5.0, " vequ": 4.0, " clown ": 6.0, " trashy": 2.0}, frozenset({"trash can", "not clown"}))
    found = tox.automaton(lexicon)
    for _ in range(300):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) + rng.choice(["", ".", " "])
        got, words = tox.weight_of(text, lexicon, found)
        want, n = brute_force(text, lexicon)
        assert words == n and math.isclose(got, want)


def test_held_out_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in tox.toxicity(docs, labels).collect()}
    truth = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pandas()
    n = Counter((t, out[i].predicted) for i, t in zip(truth.doc_id, truth.toxic) if out[i].held_out)
    assert n[1, 1] >= 0.88 * (n[1, 0] + n[1, 1]) and n[0, 1] <= 0.01 * (n[0, 0] + n[0, 1])
    assert len(out) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out.values())


def test_learning_and_scores_equal_brute_force(spark):
    """Every entry of every text counted one by one, and the measures of evidence taken from their definition."""
    rng = random.Random(6)
    clean, bad = [f"word{i}" for i in range(60)], ["vermin", "verminous", "slime", "slimy"]
    rows = [(" ".join(rng.choices(clean, k=20)), 0) for _ in range(400)]
    rows += [(" ".join(rng.choices(clean, k=10) + [rng.choice(bad)] + rng.choices(clean, k=9)), 1) for _ in range(60)]
    lexicon = tox.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"), Scratch(spark, "test"))
    texts, held = Counter(t for _, t in rows), Counter()
    for text, t in rows:
        words = set(tox.fold(text).split())
        held.update((e, t) for e in {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in tox.STEMS if len(w) > n})
    want, base = {}, texts[1] / len(rows)
    for e in {e for e, _ in held}:
        b, g = held[e, 1], held[e, 0]
        evidence = 2 * sum(x * math.log(x / ((b + g) * rate)) for x, rate in ((b, base), (g, 1 - base)) if x)
        if b >= tox.SUPPORT * texts[1] and b >= tox.PRECISION * (b + g) and evidence >= tox.EVIDENCE:
            want[e] = math.log((b + 0.5) / (texts[1] + 1)) - math.log((g + 0.5) / (texts[0] + 1))
    assert " vermin" in want or " vermin " in want
    folded = {e.replace("l", "i"): w for e, w in want.items() if "l" in e and not held[e.replace("l", "i"), 0]}
    assert lexicon.weights.keys() == (folded | want).keys()
    assert all(math.isclose(lexicon.weights[e], w) for e, w in (folded | want).items())
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    for r in tox.score_texts(docs, lexicon).collect():
        total, n = brute_force(rows[r.doc_id][0], lexicon)
        z = lexicon.fit[0] + lexicon.fit[1] * math.log1p(total) + lexicon.fit[2] * math.log1p(100 * total / (n + 50))
        assert math.isclose(r.score, 1 / (1 + math.exp(-max(-50, min(50, z)))) if total > 0 else 0, abs_tol=1e-9)
        assert r.predicted == rows[r.doc_id][1]


def test_learned_exceptions(spark):
    rows = [(f"a b{i} trash c", 1) for i in range(20)] + [(f"d{i} trash can e", 0) for i in range(1)] + [(f"x y{i} z", 0) for i in range(300)]
    rows += [(f"the trash can {i}", 0) for i in range(5)] + [(None, 1), ("q", None)]
    lexicon = tox.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"), Scratch(spark, "test"))
    assert " trash " in lexicon.weights and "trash can" in lexicon.exceptions
    found = tox.automaton(lexicon)
    assert tox.weight_of("the trash can", lexicon, found)[0] == 0 < tox.weight_of("tr4sh talk", lexicon, found)[0]


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 1), (None, "you idiot", 1), (4, "you idiot", 1), (4, "you idiot", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")
    assert [r.score for r in tox.toxicity(docs, labels).collect()] == [0.0] * 5
    out = tox.score_texts(docs, tox.Lexicon({" idiot ": 9.0}, frozenset())).collect()
    assert [r.predicted for r in out] == [0, 0, 1, 1, 1]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tox.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
