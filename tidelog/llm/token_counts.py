"""Token counts under a unigram vocabulary, by a Viterbi pass that keeps only the best score and its piece count.

An Aho-Corasick automaton lists the vocabulary's pieces by the place where they end, the longest first. Dynamic
programming over places keeps the best score and how many pieces it took; no pieces are written down. Tie rules are the
tokenizer's: at equal scores the piece that begins first wins; a character without a piece of its own may be unknown, at
the lowest score of the vocabulary less ``UNKNOWN_PENALTY``, and counts as its UTF-8 bytes if the vocabulary has bytes,
else a run of unknown characters counts as one piece.

Texts are read as the tokenizer reads them: a space is written as ``MARK``, and one stands before a text that is not
empty. If no piece has ``MARK`` after another character (checked), every best path meets the place before a run of
marks. Texts then fall apart into words there without changing a count, and each word's result is remembered for a
while. Otherwise whole texts are scored; either way the work is linear in the text.

Nulls and repeats: null and empty texts have no tokens; each row gives one row, also where ids are null or repeat. Empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import MEMO_WORDS, small_batches

#: The box has no unigram model; the pieces and scores of this one (merge ranks) are read as a unigram vocabulary.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Longer words are scored each time and not remembered.
LONG_WORD = 100


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``floor`` is the lowest score of the whole vocabulary."""

    scores: dict[str, float]
    floor: float
    has_bytes: bool

    @property
    def words_stand_alone(self) -> bool:
        return not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.scores)


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; its size is that of a vocabulary, so tasks get it with their code."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
    return Vocabulary(scores, min(map(model.get_score, ids)), any(model.is_byte(i) for i in ids))


class Counter:
    """Best score and piece count of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.unknown = vocabulary.floor - UNKNOWN_PENALTY
        self.has_bytes = vocabulary.has_bytes
        self.split = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall if vocabulary.words_stand_alone else None
        self.memo: dict[str, tuple[float, int]] = {}

    def best(self, text: str) -> tuple[float, int]:
        """The Viterbi pass over one word or text."""
        size = len(text)
        scores, counts, unknown_last = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        found = self.automaton.iter(text) if len(self.automaton) else iter(())
        ahead = next(found, None)
        for end in range(size):
            best, single = None, False
            while ahead is not None and ahead[0] == end:
                length, score = ahead[1]
                begin = end + 1 - length
                single = single or length == 1
                score += scores[begin]
                if best is None or score > best:
                    best, count = score, counts[begin] + 1
                ahead = next(found, None)
            unknown = False
            if not single:
                score = scores[end] + self.unknown
                if best is None or score > best:
                    best, unknown = score, True
                    if self.has_bytes:
                        count = counts[end] + len(text[end].encode("utf-8", "surrogatepass"))
                    else:
                        count = counts[end] + (not unknown_last[end])
            scores[end + 1], counts[end + 1], unknown_last[end + 1] = best, count, unknown
        return scores[size], counts[size]

    def word(self, word: str) -> tuple[float, int]:
        if len(word) > LONG_WORD:
            return self.best(word)
        known = self.memo.get(word)
        if known is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            known = self.memo[word] = self.best(word)
        return known

    def count(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if self.split is None:
            return self.best(marked)
        score, pieces = 0.0, 0
        for more, count in map(self.word, self.split(marked)):
            score += more
            pieces += count
        return score, pieces


def count_tokens(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, score`` of every row of ``docs`` under the vocabulary of a model file."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(model))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary.value)
        for batch in small_batches(batches, "text"):
            found = [counter.count(text or "") for text in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([c for _, c in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "score"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(counted, "doc_id bigint, n_tokens bigint, score double")
