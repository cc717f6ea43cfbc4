"""Token counts of a unigram tokenizer, without the tokens."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import ahocorasick
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from farebox.llm.shared import table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Fixed value: an unknown character scores so much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Distinct words whose counts a worker remembers.
REMEMBERED = 500_000


def vocabulary(path: str) -> tuple[dict[str, float], float]:
    """Scores of the pieces that text can match, and the smallest score of all pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {i: model.get_score(i) for i in range(model.get_piece_size())}
    normal = {model.id_to_piece(i): s for i, s in scores.items() if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    return normal, min(scores.values())


def counter(pieces: dict[str, float], least: float) -> Callable[[str], tuple[int, float]]:
    """Function from a string to the piece count and score of its best segmentation.

    Aho-Corasick names the pieces that end at each place, longest first. The best
    score up to a place and the number of its pieces are all that is kept. Of equal
    scores the piece that starts first wins, as in tokenizers that extend from the
    left and replace only by more. Only places within the longest piece are remembered,
    so a text of any length takes the memory of that window. A character that is no piece itself may be
    unknown: it then counts as its UTF-8 bytes, and scores ``UNKNOWN_PENALTY`` below
    the worst piece.
    """
    found = ahocorasick.Automaton()
    for piece, score in pieces.items():
        found.add_word(piece, (len(piece), score))
    if pieces:
        found.make_automaton()
    unknown = least - UNKNOWN_PENALTY
    window = max(map(len, pieces), default=1) + 1

    def count(text: str) -> tuple[int, float]:
        n = len(text)
        # the places that a piece can still reach back to, as a ring
        best, number = [0.0] * window, [0] * window
        matches = found.iter(text) if pieces else iter(())
        end, match = next(matches, (n, None))
        for at in range(n):
            top, many, single = float("-inf"), 0, False
            while end == at:
                size, score = match
                single = single or size == 1
                start = (at + 1 - size) % window
                total = best[start] + score
                if total > top:
                    top, many = total, number[start] + 1
                end, match = next(matches, (n, None))
            if not single:
                start = at % window
                total = best[start] + unknown
                if total > top:
                    top, many = total, number[start] + len(text[at].encode("utf-8", "surrogatepass"))
            best[(at + 1) % window], number[(at + 1) % window] = top, many
        return number[n % window], best[n % window]

    return count


class TextCounter:
    """Counts whole texts word by word, remembering words.

    A text is normalised as the model does: a space in front, spaces as U+2581. If no piece
    has this mark behind another character, no piece crosses the start of a word,
    and the best segmentation is that of the words one by one. Otherwise the text
    is one word.
    """

    def __init__(self, pieces: dict[str, float], least: float):
        self.count = counter(pieces, least)
        crossing = any(b == SPACE != a for p in pieces for a, b in pairwise(p))
        self.words = re.compile(".+" if crossing else f"{SPACE}+[^{SPACE}]*", re.DOTALL)
        self.known: dict[str, tuple[int, float]] = {}

    def __call__(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        tokens, score, known = 0, 0.0, self.known
        for word in self.words.findall(SPACE + text.replace(" ", SPACE)):
            found = known.get(word)
            if found is None:
                found = self.count(word)
                if len(word) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = found
            tokens += found[0]
            score += found[1]
        return tokens, score


@cache
def text_counter(path: str) -> TextCounter:
    return TextCounter(*vocabulary(path))


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens and score of the best segmentation of its text.

    ``path`` names a sentencepiece model whose pieces and scores are taken as a
    unigram vocabulary with byte fallback. Sums are of 64-bit floats; the scores of
    ``MODEL`` are whole numbers, so its sums are exact and independent of how a text is cut.

    Defined cases: a null or empty text has 0 tokens; repeated rows each get the
    same; texts and words of any length are counted whole; a null doc_id is kept; extra columns are not read; no rows give no rows.
    """
    path = path or public_tokenizers.path(MODEL)

    @F.pandas_udf("struct<n_tokens:long,score:double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = text_counter(path)
        for batch in batches:
            yield pd.DataFrame([count(t) for t in batch], columns=["n_tokens", "score"])

    found = docs.select("doc_id", of("text").alias("found"))
    return found.select("doc_id", "found.n_tokens", "found.score")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
