"""Words and lines of whole texts, taken a batch at a time."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The six ASCII white-space characters: a word is a run of anything else.
WHITE = " \t\n\x0b\f\r"


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """All words of a batch of texts (null: none), each distinct word stated once.

    Returns the words as indices into the distinct words, the distinct words, and where the words of
    each text begin (one more entry than there are texts).
    """
    trimmed = pc.utf8_trim(pc.fill_null(texts.cast(pa.large_string()), ""), characters=WHITE)
    split = pc.ascii_split_whitespace(trimmed)
    empty = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)
    sizes = np.where(empty, 0, pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = split.flatten()
    if empty.any():  # an empty text splits into one empty word
        flat = flat.filter(pc.not_equal(flat, ""))
    coded = flat.dictionary_encode()
    starts = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    return coded.indices.to_numpy(), coded.dictionary, starts


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments along the first axis; empty segments sum to zero."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]), dtype=values.dtype)
    full = starts[1:] > starts[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full], axis=0)
    return out


_LANES = np.uint64(0x0101010101010101)
_SPAN = 255  # what a lane of eight bits can count


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes of each segment have each bit: 64 columns, bit 0 first.

    Bit k of all eight bytes is added up in one pass, a byte to a lane, in runs too short to overflow.
    """
    sizes = np.diff(starts)
    runs = -(-sizes // _SPAN)
    first = np.concatenate([[0], np.cumsum(runs)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], runs)
    edges = np.append(np.repeat(starts[:-1], runs) + within * _SPAN, starts[-1]).astype(np.int64)
    counts = np.empty((len(sizes), 64), dtype=np.int64)
    for bit in range(8):
        lanes = segment_sums((hashes >> np.uint64(bit)) & _LANES, edges)
        per_byte = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts[:, bit::8] = segment_sums(per_byte, first)
    return counts


def majority_bits(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints whose bits are set in over half of each segment's hashes."""
    bits = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)
