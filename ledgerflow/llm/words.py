"""Words of Arrow text columns as numpy arrays, without a Python loop over words.

A word is a run of bytes outside of 0x20 and 0x09 to 0x0D of the UTF-8 text, with
A to Z in lower case. It is represented by a 64-bit hash: a polynomial over its
bytes, read off running sums, then mixed. Null texts count as empty.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 19  # bytes hashed at a time; bounds memory for long texts
CHUNK = 1 << 19  # bytes of text in one slice of a batch, single documents aside

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# Everything of ASCII but letters and digits, for words without punctuation.
IS_MARK = np.arange(256) < 0x80
IS_MARK[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False

_powers = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    size = max(WINDOW, 1 << (n - 1).bit_length())
    if _powers.get("size", 0) < size:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _powers[name] = np.cumprod(row, dtype=np.uint64)
        _powers["size"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 places where its rows start."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    starts = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[starts[0]:starts[-1]], starts - starts[0]


def slices(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK):
    """The batch in runs of rows with about ``most`` bytes of text; a longer text is alone."""
    _, starts = flat(batch.column(text))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + most, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def word_bounds(data: np.ndarray, starts: np.ndarray, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; no word reaches over a row's end."""
    space = separators[data]
    edges = starts[(starts > 0) & (starts < len(data))]
    before = np.empty_like(space)
    before[:1] = True
    before[1:] = space[:-1]
    before[edges] = True
    after = np.empty_like(space)
    after[-1:] = True
    after[:-1] = space[1:]
    after[edges - 1] = True
    return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1


def _hash(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64, out=sums[1:])
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool = True, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word, and the n + 1 places where the rows' words start.

    ``separators`` says which bytes are in no word: white space, if nothing else.
    """
    out, first, _ = located_words(data, starts, lower, separators)
    return out, np.searchsorted(first, starts).astype(np.int64)


def located_words(data: np.ndarray, starts: np.ndarray, lower: bool = True, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash for every word, its first byte and its end."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    if lower:
        data = LOWER[data]
    first, end = word_bounds(data, starts, separators)
    return run_hashes(data, first, end), first, end


def run_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for every run of bytes, given in ascending order."""
    out = np.empty(len(first), dtype=np.uint64)
    at = 0
    while at < len(first):
        low = first[at]
        upto = max(at + 1, int(np.searchsorted(end, low + WINDOW, side="right")))
        out[at:upto] = _hash(data[low:end[upto - 1]], first[at:upto] - low, end[at:upto] - low)
        at = upto
    return out


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; of the whole text where it has fewer; none without words."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + words[k:len(words) - n + 1 + k])
    return out


def binary(rows) -> pa.Array:
    return pa.array(rows, type=pa.binary())
