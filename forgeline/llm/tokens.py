"""Token ids of whole texts with a given tokenizer file, sharing work between equal words.

Words not met before go to the tokenizer together, those of many texts as one text: a call per word, or per
text, costs more than the words. The ids are dealt back to the words by the lengths of their tokens' bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .common import slices

#: White space other than ASCII's, which a tokenizer and Python may see differently.
ODD = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \t\n\r\x0b\x0c"]
ODD_ASCII = [c for c in ODD if c.isascii()]
#: Bytes that are white space.
WHITE = np.zeros(256, bool)
WHITE[list(b" \t\n\r\x0b\x0c")] = True
#: New words per call, and how few of them are taken one by one if they can't be told apart together.
TOGETHER = 10_000
FEW = 32
#: Characters of the texts whose chunks are looked up together.
TEXTS_CHARS = 1_000_000
#: Chunks remembered per process, about 170 bytes each, in two halves of which the older one is dropped.
REMEMBERED = 1_000_000


class Encoder:
    """Encodes texts chunk by chunk and remembers the ids of each chunk as bytes. A piece never crosses a border
    between two chunks."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # A tokenizer that drops white space can take words without the space before them.
        self.spaced = bool(self.tokenizer.encode("a b", add_special_tokens=False).ids != self._ids("a") + self._ids("b"))
        #: Tokens that stand for a string as it is, wherever it stands: texts that hold one are encoded whole.
        self.added = sorted(str(token) for token in self.tokenizer.get_added_tokens_decoder().values())
        #: Bytes of a text that each token stands for: a byte-level token has a character per byte.
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(token.removesuffix("</w>"))
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _alone(self, chunks: list[str]) -> None:
        for chunk, found in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)):
            self.known[chunk] = self._bytes(found.ids)

    def _together(self, chunks: list[str]) -> bool:
        """Encode chunks as one text, each with a space before it; false if the ids do not part where the chunks do,
        as when a tokenizer changes letters to others of more bytes."""
        text = "".join(chunks) if self.spaced else " ".join(chunks)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum(self.lengths[ids])
        sizes = map(len, chunks) if text.isascii() else (len(c.encode()) for c in chunks)
        border = np.cumsum(np.fromiter(sizes, np.int64, len(chunks)))
        if not len(ends) or ends[-1] != border[-1]:
            return False
        at = np.searchsorted(ends, border)
        if (ends[at] != border).any():
            return False
        stored, step = ids.astype(self.kind).tobytes(), self.kind.itemsize
        start = 0
        for chunk, end in zip(chunks, ((at + 1) * step).tolist()):
            self.known[chunk] = stored[start:end]
            start = end
        return True

    def _learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks not met before."""
        first = " " if self.spaced else ""
        plain, other, alone = [], [], []
        for c in chunks:
            (alone if c.isspace() or not c.startswith(first) else plain if c.isascii() else other).append(c)
        for joined in (plain, other):
            parts = [joined[k : k + TOGETHER] for k in range(0, len(joined), TOGETHER)]
            while parts:
                part = parts.pop()
                if self._together(part):
                    continue
                if len(part) <= FEW:
                    alone += part
                else:  # a word that does not part from its neighbours is among a few in the end
                    parts += [part[: len(part) // 2], part[len(part) // 2 :]]
        if alone:
            self._alone(alone)

    def _whole(self, text: str) -> bool:
        """Whether a text has to be encoded as it is, not chunk by chunk."""
        return any(c in text for c in (ODD_ASCII if text.isascii() else ODD)) or any(t in text for t in self.added)

    def _chunks(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where chunks start in the bytes of texts that start at ``starts``: a word with the space before it, or what
        else there is between words, whose last character stands alone. A run of spaces gives its last one to the word
        behind it. Without ``spaced``, words and what is between them."""
        gap, first = WHITE[data], np.zeros(len(data), bool)
        first[starts] = True
        before = np.zeros(len(data), bool)  # the character before is white, in the same text
        before[1:] = gap[:-1]
        before[first] = False
        if not self.spaced:
            return np.flatnonzero(first | (gap != before))
        space, last = np.zeros(len(data), bool), np.zeros(len(data), bool)
        space[1:] = data[:-1] == ord(" ")
        last[:-1] = ~gap[1:] & ~first[1:]
        return np.flatnonzero(first | (gap & (~before | last)) | (~gap & before & ~space))

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        known, old, new = self.known, self.old, []
        for chunk in set(chunks).difference(known):
            if chunk in old:
                known[chunk] = old[chunk]
            elif not self.spaced and chunk.isspace():
                known[chunk] = b""
            else:
                new.append(chunk)
        if new:
            self._learn(new)
        found = list(map(known.__getitem__, chunks))
        if len(known) > self.remembered // 2:  # what is not asked for again in the next half goes
            self.old, self.known = known, {}
        return found

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Each chunk is looked up once for all the texts, and those not met before are
        encoded together."""
        bodies = [b"" if self._whole(text) else text.encode() for text in texts]
        lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        at = self._chunks(data, (ends - lengths)[lengths > 0])
        offsets = np.append(at, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        found = self._ids_of(chunks.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(found), self.kind)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        which = chunks.indices.to_numpy()
        counts = sizes[which]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - upto[:-1], counts) + np.arange(upto[-1])]
        start, end = (upto[np.searchsorted(at, x)].tolist() for x in (ends - lengths, ends))
        return [
            ids[a:b] if body or not text else np.array(self._ids(text), self.kind)
            for text, body, a, b in zip(texts, bodies, start, end)
        ]

    def __call__(self, text: str) -> np.ndarray:
        return self.many([text])[0]

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow array, null as empty, for a slice of it at a time."""
        for part in slices(texts, TEXTS_CHARS):
            yield from self.many(part)


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder per process and file, kept between tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a process per core
    return Encoder(path, remembered)
