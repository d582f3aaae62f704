"""Token counts under a unigram vocabulary, without the tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
CACHE = 600_000
UNKNOWN_PENALTY = 10.0


def read_pieces(path: str) -> tuple[list[tuple[str, float]], bool]:
    """The pieces that match text, with their scores, of a SentencePiece model file, and whether it
    has byte pieces. Unknown, control and byte pieces match no text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [
        (model.id_to_piece(i), model.get_score(i)) for i in ids
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    ]
    return pieces, any(model.is_byte(i) for i in ids)


class Counter:
    """Counts pieces of the best segmentation.

    The automaton gives, for every end in the text, the pieces that end there, longest first. Per
    end the best score and the number of pieces that reach it are kept, and nothing else. As in the
    tokenizer, a candidate replaces another only if it scores higher, so among equals the longest
    last piece wins; a character that is no piece of its own may be the unknown piece, at the least
    score of the vocabulary less a penalty; neighbouring unknown pieces are one, or, if the
    vocabulary has byte pieces, one for each byte.
    """

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score, False))
        self.automaton.make_automaton()
        self.singles = {p for p, _ in pieces if len(p) == 1}
        self.unknown_score = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        # Where no piece holds a space mark after another character, the best path through a text
        # is made of those through its words. Sums of whole numbers don't depend on where they
        # begin; others could be rounded differently, so they are added from the text's start.
        self.by_word = not any(SPACE in p.lstrip(SPACE) or s != int(s) for p, s in pieces)
        self.cache: dict[str, tuple[float, int, bool, bool]] = {}
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def best(self, text: str) -> tuple[float, int, bool, bool]:
        """Score and number of pieces of the best path, and whether its first and its last piece
        are unknown (to join them across words)."""
        if self.singles.issuperset(text):
            return self.known(text)
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        last = [False] * (n + 1)  # the path's last piece is unknown
        first = [False] * (n + 1)
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in range(n + 1)]
        for end, found in self.automaton.iter(text):
            ends[end + 1].append(found)
        for end in range(1, n + 1):
            top, pieces, unk, head = None, 0, False, False
            options = sorted(ends[end], reverse=True)
            single = text[end - 1]
            if single not in self.singles:
                options.append((1, self.unknown_score, True))
            for size, gain, unknown in options:
                begin = end - size
                total = score[begin] + gain
                if top is None or total > top:
                    top, unk = total, unknown
                    pieces, head = count[begin], first[begin] if begin else unknown
                    if not unknown:
                        pieces += 1
                    elif self.byte_fallback:
                        pieces += len(text[begin:end].encode())
                    else:
                        pieces += not last[begin]
            score[end], count[end], last[end], first[end] = top, pieces, unk, head
        return score[n], count[n], first[n], last[n]

    def known(self, text: str) -> tuple[float, int, bool, bool]:
        """The same where every character is a piece, so none is unknown. The automaton gives the
        matches by their end, longest first."""
        score, count = [0.0] * (len(text) + 1), [0] * (len(text) + 1)
        before = -1
        for end, (size, gain, _) in self.automaton.iter(text):
            begin = end + 1 - size
            total = score[begin] + gain
            if end != before or total > score[end + 1]:
                score[end + 1], count[end + 1] = total, count[begin] + 1
                before = end
        return score[-1], count[-1], False, False

    def __call__(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of a text: a space mark for every space, and one in front
        unless there is one."""
        if not text:
            return 0, 0.0
        if self.by_word and "  " not in text and SPACE not in text:
            # Every space begins a word, and the first word has its mark in any case.
            words = text.split(" ") if text[0] != " " else text[1:].split(" ")
            found = [*map(self.cache.get, words)]
            if None in found:
                found = [f or self.remember(w) for w, f in zip(words, found, strict=True)]
            return self.joined(found)
        marked = text.replace(" ", SPACE)
        if marked[0] != SPACE:
            marked = SPACE + marked
        if not self.by_word:
            total, n, _, _ = self.best(marked)
            return n, total
        return self.joined([self.best(word) for word in self.words.findall(marked)])

    def remember(self, word: str) -> tuple[float, int, bool, bool]:
        found = self.best(SPACE + word)
        if len(word) <= 64:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def joined(self, found: list[tuple[float, int, bool, bool]]) -> tuple[int, float]:
        """Pieces and score of words in a row; unknown pieces that touch are one without byte pieces."""
        n, total = sum([f[1] for f in found]), sum([f[0] for f in found])
        if not self.byte_fallback:
            n -= sum(a[3] and b[2] for a, b in zip(found, found[1:], strict=False))
        return n, total


_last: tuple | None = None


def _counter(vocabulary: tuple) -> Counter:
    """The worker's counter for a vocabulary, kept with its words from one task to the next."""
    global _last
    if _last is None or _last[0] is not vocabulary:
        _last = (vocabulary, Counter(*vocabulary))
    return _last[1]


def token_counts(
    spark: SparkSession, text: Column, pieces: list[tuple[str, float]], byte_fallback: bool
) -> Column:
    """Column: struct of ``n_tokens`` and ``score`` of the best segmentation of whole texts under a
    unigram vocabulary, which is broadcast (its size is the tokenizer's, not the data's).

    Null and empty texts have no tokens. Repeated rows get equal results; other columns are not
    looked at. Words that were seen are remembered, up to a fixed number per worker.
    """
    shared = spark.sparkContext.broadcast((pieces, byte_fallback))

    @F.arrow_udf("struct<n_tokens:long,score:double>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(shared.value)
        for texts in batches:
            found = [counter(t) if t else (0, 0.0) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())],
                ["n_tokens", "score"],
            )

    return count(text)
