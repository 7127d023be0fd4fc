"""Words of whole texts as 64-bit hashes, taken from the bytes of an Arrow column without a Python string for each."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text handled at a time; a longer text is handled alone

# What a byte counts as: 0 ends a word. Bytes from 128 on belong to characters beyond ASCII.
_ALL = np.arange(256, dtype=np.uint8)
_LOWERED = np.where((_ALL >= ord("A")) & (_ALL <= ord("Z")), _ALL + 32, _ALL).astype(np.uint8)
_WHITE = (_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13))
SPACED = np.where(_WHITE, 0, 1).astype(bool), _ALL  # runs of anything but ASCII white space
_ALNUM = (_ALL >= 128) | ((_LOWERED >= 97) & (_LOWERED <= 122)) | ((_ALL >= 48) & (_ALL <= 57))
PLAIN = _ALNUM, _LOWERED  # runs of digits, letters and all beyond ASCII, A-Z as a-z

_LETTERS = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: it has an inverse among the 64-bit numbers
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {True: np.ones(1, dtype=np.uint64), False: np.ones(1, dtype=np.uint64)}


def _power(size: int, inverse: bool) -> np.ndarray:
    if len(_powers[inverse]) < size:
        steps = np.full(size, _INVERSE if inverse else _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers[inverse] = np.multiply.accumulate(steps)
    return _powers[inverse][:size]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with no more than ``most`` bytes of text, or with one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, end
        at = end


def hashed_words(texts: pa.Array, kind: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts (null: none), and where the words of each text begin (one more entry than texts).

    A hash is the sum of the word's letters, each a fixed 64-bit number, times powers of an odd base. All sums come from one
    running total over the bytes. Words are taken for equal where their hashes are.
    """
    whole = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = whole.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if len(whole) == 0 or edges[-1] == edges[0]:
        return np.empty(0, dtype=np.uint64), np.zeros(len(whole) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    inside, folded = kind
    word = inside[raw]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    cut = edges[:-1][edges[:-1] < len(raw)]
    starts[cut] = word[cut]  # a text begins a word whatever ended the one before
    first = np.flatnonzero(starts)
    stops = np.append(word, False)
    stops[:-1] = ~word
    stops[-1] = True
    stops[cut] = True
    last = np.flatnonzero(stops)
    ends = last[np.searchsorted(last, first, side="right")]
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(np.where(word, _LETTERS[folded[raw]], np.uint64(0)) * _power(len(raw), False), out=total[1:])
    hashes = (total[ends] - total[first]) * _power(len(raw), True)[first]
    return hashes, np.searchsorted(first, edges)
