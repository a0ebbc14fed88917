"""Words, shingles and their 64-bit hashes, for whole Arrow columns of text at a time.

Text stays UTF-8 bytes. A span's hash is a polynomial over random 64-bit values of its bytes;
all spans of a window come out of one running sum, so no Python runs per word. Two different
spans share a hash with a probability of about 2**-64.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WINDOW = 1 << 18
SLICE_BYTES = 4 << 20
#: For steps that hold many arrays as long as the text.
PART_BYTES = 1 << 20
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, 5 modulo 8
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
CASELESS = BYTES.copy()
CASELESS[65:91] = BYTES[97:123]
_POWERS = np.full(WINDOW + 1, _BASE, dtype=np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS, dtype=np.uint64)
_INVERSES = np.full(WINDOW + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
_INVERSES[0] = 1
_INVERSES = np.cumprod(_INVERSES, dtype=np.uint64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
#: Bytes of words that end at white space only.
NOT_SPACE = ~SPACE
#: Bytes of words that end at ASCII punctuation, too.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other, and where each text starts; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or starts[0] == starts[-1]:
        return np.zeros(0, dtype=np.uint8), starts - starts[0]
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def words(
    data: np.ndarray, offsets: np.ndarray, of: np.ndarray = NOT_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text."""
    inside = of[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTES
) -> np.ndarray:
    """A 64-bit hash of the bytes in each span; spans are in order and do not overlap.

    ``values`` gives each byte's value; :data:`CASELESS` ignores ASCII case.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + WINDOW, side="right"))
        if j <= i:  # a span longer than the window
            out[i] = xxhash.xxh64_intdigest(values[data[base : ends[i]]].tobytes())
            i += 1
            continue
        part = values[data[base : ends[j - 1]]]
        part *= _POWERS[: len(part)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part, out=sums[1:])
        first = starts[i:j] - base
        out[i:j] = (sums[ends[i:j] - base] - sums[first]) * _INVERSES[first]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def joined_hashes(hashes: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """Hash of a sequence of hashes, given as one array per place."""
    out = np.full(len(hashes[0]), seed, dtype=np.uint64)
    for h in hashes:
        out = mix(out * np.uint64(_BASE) + h)
    return out


def shingle_sets(hashes: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of each text, ascending.

    A text of fewer than k words has its whole sequence as one shingle; without words it has
    none.
    """
    n = np.diff(first)
    if len(hashes) >= k:
        grams = joined_hashes([hashes[j : len(hashes) - k + 1 + j] for j in range(k)], k)
    else:
        grams = np.zeros(0, dtype=np.uint64)
    out = []
    for start, count in zip(first[:-1].tolist(), n.tolist()):
        if count >= k:
            out.append(np.unique(grams[start : start + count - k + 1]))
        elif count:
            out.append(joined_hashes([hashes[start + j : start + j + 1] for j in range(count)], count))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def text_shingles(column: pa.Array, k: int) -> list[np.ndarray]:
    """Shingle sets of a column; words end at ASCII white space, A-Z count as a-z."""
    data, offsets = text_bytes(column)
    starts, ends, first = words(data, offsets)
    return shingle_sets(span_hashes(data, starts, ends, CASELESS), first, k)
