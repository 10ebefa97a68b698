"""Words of many texts at once: places and 64-bit hashes, by numpy over the bytes of Arrow columns.

A word's hash is a sum of table values for its bytes, each times an odd factor for its place in the
word, finished by a mixer; tables come from a fixed seed. Words are never decoded."""

from __future__ import annotations

import numpy as np

U = np.uint64
_M1, _M2, _G = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads all bits."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def _stream(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + U(seed)) * _G)


_LETTER = _stream(256, 1 << 20)
_LETTER[65:91] = _LETTER[97:123]
_CASED = _stream(256, 1 << 20)
_PLACE = {"table": _stream(1 << 10, 1 << 40) | U(1)}

#: Bytes of text whose words are hashed at once.
PIECE = 1 << 18
#: Bytes of words: letters and digits and all beyond ASCII; or all but white space.
LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
DARK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its values and the end."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the hash of each word in order, and the number of words of each text.
    inside: which bytes words have; fold: A-Z as a-z."""
    n = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    is_in = inside[raw]
    begins = is_in.copy()
    begins[1:] &= ~is_in[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(raw)]
    begins[edges] = is_in[edges]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    hashes = np.empty(len(starts), np.uint64)
    # Arrays of eight bytes for each byte of text are made for a piece at a time; pieces begin with a word.
    marks = np.unique(np.concatenate([[0], np.searchsorted(starts, np.arange(PIECE, len(raw), PIECE)), [len(starts)]]))
    for i, j in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
        at, end = int(starts[i]), int(starts[j]) if j < len(starts) else len(raw)
        places = np.flatnonzero(is_in[at:end])
        firsts = np.flatnonzero(begins[at:end][places])
        sizes = np.diff(np.append(firsts, len(places)))
        within = np.arange(len(places)) - np.repeat(firsts, sizes)
        if (longest := int(sizes.max())) > len(_PLACE["table"]):
            _PLACE["table"] = _stream(2 * longest, 1 << 40) | U(1)
        value = (_LETTER if fold else _CASED)[raw[at:end][places]] * _PLACE["table"][within]
        hashes[i:j] = mix(np.add.reduceat(value, firsts) + sizes.astype(np.uint64) * _G)
    return hashes, counts


def slices(column, size: int = 4 << 20):
    """Runs of rows (start, length) of about so many bytes of text."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, to - at
        at = to


#: Each byte, A-Z as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, size: int = 1 << 20):
    """(starts, ends, texts) of the words, in runs of about so many bytes that end where a word does, so
    that arrays of one text of any length stay small. A word ends with its text."""
    at, edges = 0, offsets[1:-1]
    while at < len(raw):
        to = min(at + size, len(raw))
        while to < len(raw) and inside[raw[to]]:
            out = np.flatnonzero(~inside[raw[to : to + size]])
            to = min(to + (int(out[0]) if len(out) else size), len(raw))
        is_in = np.zeros(to - at + 2, bool)
        is_in[1:-1] = inside[raw[at:to]]
        starts, ends = is_in[1:-1] & ~is_in[:-2], is_in[1:-1] & ~is_in[2:]
        cuts = edges[np.searchsorted(edges, at, "right") : np.searchsorted(edges, to)] - at
        starts[cuts] = is_in[1:-1][cuts]
        ends[cuts - 1] = is_in[1:-1][cuts - 1]
        starts, ends = np.flatnonzero(starts) + at, np.flatnonzero(ends) + at + 1
        yield starts, ends, np.searchsorted(offsets, starts, "right") - 1
        at = to


def flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of slices, one slice after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
