"""Every operator on a very long text beside short ones: whole texts count, not prefixes."""

import random

import public_tokenizers
import pytest

from farebox.llm import language_id, line_quality, mixing, packing, quality_rules, simhash, suffix_dedup, token_counts, toxicity
from farebox.llm.shared import Scratch
from tests.llm.test_quality_rules import plain_stats
from tests.llm.test_simhash import plain_fingerprint
from tests.llm.test_suffix_dedup import brute_force


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]
    return " ".join(rng.choice(words) + (".\n" if i % 40 == 39 else "") for i in range(60_000))


@pytest.fixture(scope="module")
def docs(spark, long_text):
    rows = [(1, long_text, "en", "a"), (2, "start " + long_text[-1000:], "en", "a"), (3, "short text", "en", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_suffix_dedup(docs):
    out = sorted((tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()), key=str)
    assert out == brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in out) >= 2000


def test_quality_rules(docs, long_text):
    r = quality_rules.quality_rules(docs).where("doc_id = 1").first()
    assert tuple(r[c] for c in (*quality_rules.STATS, "base_failed")) == plain_stats(long_text)


def test_simhash(docs, long_text):
    part = long_text[:100_000]
    assert simhash.fingerprint(part) == plain_fingerprint(part)
    assert simhash.simhash_groups(docs).where("doc_id = 1").first().fingerprint == f"{simhash.fingerprint(long_text):016x}"


def test_counts_and_packing(docs, long_text):
    counted = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()}
    halves = long_text.split(" ", 1)[1]
    assert counted[1] > token_counts.text_counter(public_tokenizers.path(token_counts.MODEL))(halves)[0] > 60_000
    pieces = packing.pack(docs).where("doc_id = 1").orderBy("start").collect()
    at = 0
    for p in pieces:
        assert p.start == at and p.offset + p.length <= packing.CAPACITY
        at += p.length
    assert at == pieces[0].doc_tokens == len(packing.token_ids(long_text, public_tokenizers.path(packing.RANKS)))


def test_mixing(docs):
    r = mixing.mix(docs).where("doc_id = 1").first()
    assert r.size == 60_000 and 0 <= r.taken <= 120_000


def test_scores_read_the_end_of_a_text(docs, spark):
    filters = language_id.build_filters({"aa": language_id.grams(["abcd"])[1], "bb": language_id.grams(["wxyz"])[1]})
    assert language_id.predict(["1 " * 600_000 + "wxyz"], filters)[0] == ["bb"]
    lexicon = toxicity.Lexicon({" zzz ": 9.0}, frozenset())
    assert toxicity.weight_of("a " * 300_000 + "zzz", lexicon, toxicity.automaton(lexicon)) == (9.0, 300_001)
    x, weight, counts = line_quality.line_features(["a\n" * 50_000 + "###"])
    assert counts[0] == 50_001 and x[-1, 3] == 1 and x[-2, -len(line_quality.NAMES) + 3] == 1
    found = language_id.learn_filters(docs, Scratch(spark, "test"))
    assert [r.lang_pred for r in language_id.identify(docs, found).collect()] == ["en"] * 3
