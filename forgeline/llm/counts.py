"""Token counts under a unigram model, by dynamic programming over a trie of words.

The words of a batch of documents that no earlier batch had are sorted, which lays out their trie:
a word shares with the one before it the nodes of their common prefix. The best score of reaching a node
is computed once for all words below it, level by level over arrays of nodes; the number of
tokens at a word's last node is remembered for the word, and documents add up the numbers of
their words.

The vocabulary is a sentencepiece file's, its pieces in order of rank; a piece's log-probability is
that of its rank under Zipf's law. A character that no piece covers costs as many tokens as its
UTF-8 has bytes. Ties go to fewer tokens.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_slices, packed

#: Put before each word, as the vocabulary marks the start of one.
START = "▁"
#: Longer words are worked on one at a time.
WIDTH = 32
#: Words remembered per process, about 150 bytes each; a full memory starts again.
REMEMBERED = 500_000
#: What a byte of an uncovered character scores, below any piece.
BYTE = -20.0


class Unigram:
    """Pieces with scores as a trie, in arrays: the step from a state by a character is found in
    a sorted list of (state, character) keys."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        prefixes = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})
        state = {"": 0} | {p: i for i, p in enumerate(prefixes, 1)}
        steps = sorted((state[p[:-1]] << 21 | ord(p[-1]), i) for i, p in enumerate(prefixes, 1))
        self.keys = np.array([k for k, _ in steps] + [1 << 62], np.int64)
        self.to = np.array([i for _, i in steps] + [-1], np.int32)
        self.score = np.array([-np.inf] + [pieces.get(p, -np.inf) for p in prefixes])
        self.known: dict[str, int] = {}

    def _step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        key = states.astype(np.int64) << 21 | letters
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def count_one(self, word: str) -> int:
        """Tokens of one word, by the plain recurrence."""
        score, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            score[end], count[end] = score[end - 1] + BYTE * size, count[end - 1] + size
            for start in range(max(0, end - self.longest), end):
                value = self.pieces.get(word[start:end])
                if value is not None:
                    new = score[start] + value, -count[start] - 1
                    if new > (score[end], -count[end]):
                        score[end], count[end] = new[0], -new[1]
        return count[-1]

    def count_sorted(self, words: list[str]) -> np.ndarray:
        """Tokens of distinct sorted words of at most WIDTH characters."""
        n = len(words)
        chars = np.array(words, f"<U{WIDTH}").view("<u4").reshape(n, WIDTH).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, n)
        shared = np.zeros(n, np.int64)  # length of the prefix that the word before has, too
        if n > 1:
            same = np.cumprod(chars[1:] == chars[:-1], axis=1).sum(1)
            shared[1:] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
        result = np.zeros(n, np.int64)
        # Per level: the node of each word, and each node's score, tokens and states by piece length so far.
        of_word, scores, counts = [np.zeros(n, np.int64)], [np.zeros(1)], [np.zeros(1, np.int64)]
        states: list[np.ndarray] = []
        for depth in range(1, int(lengths.max(initial=0)) + 1):
            new = (lengths >= depth) & (shared < depth)
            firsts = np.flatnonzero(new)
            letter = chars[firsts, depth - 1]
            parent = of_word[-1][firsts]
            size = 1 + (letter > 0x7F) + (letter > 0x7FF) + (letter > 0xFFFF)
            best, tokens = scores[-1][parent] + BYTE * size, counts[-1][parent] + size
            now = []
            for length in range(1, min(len(states) + 1, self.longest) + 1):
                state = np.full(len(firsts), -1, np.int32)
                before = np.zeros(len(firsts), np.int32) if length == 1 else states[length - 2][parent]
                alive = np.flatnonzero(before >= 0)
                if length > 1 and not len(alive):
                    break
                state[alive] = self._step(before[alive], letter[alive])
                now.append(state)
                ends = alive[state[alive] >= 0]
                from_node = of_word[depth - length][firsts[ends]]
                value = scores[depth - length][from_node] + self.score[state[ends]]
                many = counts[depth - length][from_node] + 1
                better = (value > best[ends]) | ((value == best[ends]) & (many < tokens[ends]))
                best[ends[better]], tokens[ends[better]] = value[better], many[better]
            states = now
            of_word.append(np.cumsum(new) - 1)
            scores.append(best)
            counts.append(tokens)
            done = np.flatnonzero(lengths == depth)
            result[done] = tokens[of_word[-1][done]]
        return result

    def counts(self, texts: list[str]) -> list[int]:
        split = [t.split() for t in texts]
        known = self.known
        new = set().union(*split).difference(known)
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set().union(*split)
        short = sorted(w for w in new if len(w) < WIDTH and "\0" not in w)
        if short:
            known.update(zip(short, self.count_sorted([START + w for w in short]).tolist()))
        known.update((w, self.count_one(START + w)) for w in new if w not in known)
        return [sum(map(known.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    """The model of a vocabulary file, one per process and kept between tasks."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    norm = math.log(sum(1 / (r + 2.7) for r in range(len(usual))))
    return Unigram({model.id_to_piece(i): -math.log(r + 2.7) - norm for r, i in enumerate(usual)})


def token_count(text: Column, vocabulary: str) -> Column:
    """Tokens of a whole text, word by word (words are split at any white space); null and blank
    texts have none."""

    def count(texts: list[str]) -> pa.Array:
        return pa.array(unigram(vocabulary).counts(texts), pa.int64())

    return F.arrow_udf(by_slices(count, pa.int64()), "bigint")(text)


def counted(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as ``row`` with id and n_tokens. Repeated rows count alike, rows
    without an id like others; an empty table gives no rows."""
    base = packed(docs, id=f"{doc_id}:bigint", text=text)
    return base.withColumn("n_tokens", token_count(F.col("text"), vocabulary)).drop("text")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4(docs: DataFrame) -> DataFrame:
    rows = counted(docs.select("doc_id", "text"), vocabulary_path())
    return rows.select(F.col("id").alias("doc_id"), "n_tokens")
