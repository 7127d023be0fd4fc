"""Token ids of whole texts by the ``tokenizers`` library, each distinct chunk of text encoded once."""

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from storelake.llm.text import words_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side already

# Unicode white space, as the tokenizers' patterns understand it.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_LETTERS = "A-Za-zß-öø-ÿ"  # Latin letters that no normalisation but that of A-Z changes

# Where a text can be cut without changing its ids. With a word vocabulary white space is dropped and always ends a word.
# With a byte vocabulary a word takes one space before it along; of a longer run of white space the last one stays with
# the word. A run of letters ends before a comma or full stop, so such a run is cut off, which leaves fewer distinct chunks.
_BYTE_CHUNKS = re.compile(
    rf" ?[{_LETTERS}]+(?=[.,](?:[\t-\r ]|\Z))| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_PLAIN = re.compile(rf" ?[{_LETTERS}]+")

# Byte-level vocabularies write a byte as a printable character: itself, or else the next one from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE_LETTER = chr(_AS_LETTERS[ord(" ")])

MAX_CHUNKS = 1_000_000  # distinct chunks remembered by a worker before it starts anew


class _Known(dict):
    """Chunks by number; a new one is listed when it is first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


class Encoder:
    """Ids of texts, the same as those of the tokenizer itself, which encodes each distinct chunk once.

    A chunk of plain letters is one word to every pre-tokenizer, and goes to the tokenizer's model straight away. Texts
    that may hold a special token are encoded whole, since such a token also cuts white space.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = kind
        self.marks = {mark: self.tokenizer.encode(mark, add_special_tokens=False).ids for mark in ",."}
        tokens = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = sorted({token[:2] for token in tokens})
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.flat, self.ends = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self) -> None:
        """Encode the chunks listed as new, and add their ids to the table."""
        new, flat, rest = self.known.new, [], []
        marks = self.marks if self.kind == "word" else {}
        for at, chunk in enumerate(new):
            after = marks.get(chunk[-1])
            stem = chunk if after is None else chunk[:-1]
            if (stem.isascii() and stem.isalpha()) or _PLAIN.fullmatch(stem):
                own = self._ids_of(stem, after is not None)
                flat.append(own if after is None else own + after)
            else:
                flat.append(None)
                rest.append(at)
        others = self.tokenizer.encode_batch_fast([new[at] for at in rest], add_special_tokens=False)
        for at, other in zip(rest, others):
            flat[at] = other.ids
        sizes = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(flat), dtype=np.int32, count=int(sizes.sum()))])
        self.known.new = []

    def _ids_of(self, stem: str, look: bool) -> list[int]:
        """Ids of a run of letters, taken from the table if it may be there."""
        number = self.known.get(stem, len(self.ends)) if look else len(self.ends)
        if number < len(self.ends) - 1:
            return self.flat[self.ends[number] : self.ends[number + 1]].tolist()
        if stem.isascii():
            word = stem.replace(" ", _SPACE_LETTER)
        else:
            word = stem.encode().decode("latin-1").translate(_AS_LETTERS)
        return [token.id for token in self.model.tokenize(word)]

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the chunks of all texts, and where each text begins."""
        if self.kind == "word":  # only A-Z: what else the tokenizer lower-cases it does itself
            index, distinct, starts = words_of(texts)
            chunks = pc.ascii_lower(distinct).to_pylist()
            return np.fromiter(map(self.known.__getitem__, chunks), dtype=np.int64, count=len(chunks))[index], starts
        split = [_BYTE_CHUNKS.findall(text) for text in texts.to_pylist()]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in split], dtype=np.int64)])
        chunks = map(self.known.__getitem__, chain.from_iterable(split))
        return np.fromiter(chunks, dtype=np.int64, count=int(starts[-1])), starts

    def encode(self, texts: pa.Array | list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids (int32) of the texts in order, each text closed by ``end_id``, and where each text begins."""
        texts = pa.array(texts, type=pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts, whole = pc.fill_null(texts, ""), np.zeros(len(texts), dtype=bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if len(self.known) > MAX_CHUNKS:
            self._forget()
        index, starts = self._split(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts)
        self._learn()
        sizes = self.ends[index + 1] - self.ends[index]
        after = np.concatenate([[0], np.cumsum(sizes)])
        lengths = np.diff(after[starts])
        # Ids of a chunk lie side by side in the table, and each end id moves those behind it on by one.
        places = np.repeat(self.ends[index] - after[:-1], sizes) + np.arange(after[-1])
        own = {row: self.tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids for row in np.flatnonzero(whole).tolist()}
        for row, ids in own.items():
            lengths[row] = len(ids)
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        out, last = np.empty(begins[-1], dtype=np.int32), begins[1:] - 1
        free = np.ones(len(out), dtype=bool)
        free[last] = False
        out[last] = end_id
        for row, ids in own.items():
            out[begins[row] : last[row]], free[begins[row] : last[row]] = ids, False
        out[free] = self.flat[places]
        return out, begins


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it outlives the task."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary, looked up on the machine that reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)
