"""Words and shingles of many texts at once, as arrays of 64-bit hashes.

Words are the runs of bytes other than space and \\t to \\r, so a text is never decoded.
Arrow batches are cut into pieces of about `PIECE` bytes; a longer text is a piece of its
own. Memory is some sixty bytes for each byte of a piece.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_SEED = np.random.default_rng(20)
_BYTES = _SEED.integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x):
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n):
    global _powers, _inverses
    if len(_powers) < n:
        inverse = _U(pow(int(_STEP), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[_U(1), np.full(n, _STEP)])
            _inverses = np.cumprod(np.r_[_U(1), np.full(n, inverse)])
    return _powers, _inverses


def pieces(column):
    """Cut a string column: (first row, bytes, offsets of its rows in them). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


#: What parts words of letters and digits; all bytes from 128 on count as letters.
NOT_LETTERS = ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


def word_bounds(data, offsets, gaps=_SPACE):
    """Starts and ends of the words, and where the words of each text begin."""
    gap = gaps[data]
    word = ~gap
    first = np.empty(len(data), bool)
    last = np.empty(len(data), bool)
    if len(data):
        first[0] = True
        first[1:] = gap[:-1]
        last[-1] = True
        last[:-1] = gap[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges] = True
        last[edges - 1] = True
    starts = np.flatnonzero(word & first)
    ends = np.flatnonzero(word & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def running_hash(data, lower=True):
    """What `span_hashes` needs to know of a piece."""
    with np.errstate(over="ignore"):
        powers, _ = _power_tables(len(data) + 1)
        codes = _BYTES[_LOWER[data]] if lower else _BYTES[data]
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes * powers[: len(data)], out=running[1:])
        return running


def span_hashes(running, starts, ends):
    """A 64-bit hash of each span of bytes, wherever it stands."""
    with np.errstate(over="ignore"):
        _, inverses = _power_tables(len(running))
        spans = (running[ends] - running[starts]) * inverses[starts]
        return mix(spans + (ends - starts).astype(np.uint64) * _STEP)


def word_hashes(data, offsets, lower=True):
    """Hash of each word and where the words of each text begin."""
    starts, ends, firsts = word_bounds(data, offsets)
    return span_hashes(running_hash(data, lower), starts, ends), firsts


def shingles(hashes, firsts, size):
    """Hashes of the runs of `size` words, and where those of each text begin.

    A text with fewer words has its whole sequence as one run, one without words has none.
    """
    counts = np.diff(firsts)
    with np.errstate(over="ignore"):
        n = len(hashes)
        runs = np.zeros(n, np.uint64)
        for k in range(size):
            runs[: n - k] = runs[: n - k] * _STEP + hashes[k:] if n > k else runs[: n - k]
        # in the last size - 1 words of a text the run above is that of other texts
        of_word = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(n) - firsts[:-1][of_word]
        whole = place + size <= counts[of_word]
        for row in np.flatnonzero((counts > 0) & (counts < size)):
            total = _U(counts[row])
            for x in hashes[firsts[row] : firsts[row + 1]]:
                total = total * _STEP + x
            runs[firsts[row]] = mix(total)
            whole[firsts[row]] = True
    kept = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix(runs[whole]), np.concatenate([[0], np.cumsum(kept)])


def distinct(values, firsts):
    """Sorted distinct values of each text, and where those of each text begin."""
    values = values.copy()
    for a, b in zip(firsts[:-1], firsts[1:]):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[firsts[:-1][firsts[:-1] < len(values)]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[firsts]


def sums(values, firsts):
    """Sum of each text's values, 0 for none."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[firsts[1:]] - total[firsts[:-1]]
