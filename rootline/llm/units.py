"""Vectorised text units for Arrow batches: words, rolling hashes and window minima.

A batch's texts lie one after the other in one byte array; every function here works on that array at once, and no
unit, gram or window ever spans two texts.
"""

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ODD = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
SALT = np.uint64(0xD6E8FEB86659FD93)
PIECE = 1 << 18
LONG_WORD = 1 << 12

# The separators of the two word rules, as byte values.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_ALNUM = tuple(b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))


def word_mask(separators) -> np.ndarray:
    """256 flags, True where a byte belongs to a word."""
    mask = np.ones(256, bool)
    mask[list(separators)] = False
    return mask


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and leaves all other bytes alone."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def text_chunks(batch: pa.RecordBatch, column: str, limit: int):
    """Yield (lo, hi, data, offsets) for runs of rows of about ``limit`` bytes (one row at least); null is empty."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()), b"")
    n = len(col)
    if not n:
        return
    _, offs, values = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray):
    """Start and end byte of every word, and the index of each text's first word (one more entry than texts)."""
    inside = mask[data]
    start, end = inside.copy(), inside.copy()
    if len(data):
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        first = offsets[:-1][offsets[:-1] < len(data)]
        start[first] = inside[first]
        last = offsets[1:][offsets[1:] > 0] - 1
        end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def pieces(starts: np.ndarray, ends: np.ndarray):
    """Yield (lo, hi) for runs of words, in order, of about PIECE bytes (one word at least)."""
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE, "right")))
        yield lo, hi
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the result; works in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Polynomial hashes modulo 2**64 of any span of a unit sequence, from prefix sums."""

    def __init__(self, base: int = BASE, seed: int = 7):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.bytes = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.key = (self.base ^ seed).to_bytes(8, "little")
        self.up = self.down = np.ones(1, np.uint64)

    def room(self, n: int) -> None:
        if len(self.up) < n + 1:
            n = max(n + 1, 1 << 16)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (self.base, self.inverse))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self.room(len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the spans [a, b)."""
        h = (prefix[b] - prefix[a]) * self.down[a]
        h += (b - a).astype(np.uint64) * SALT
        return mix(h)

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all k-grams, also of those that cross two texts."""
        n = len(prefix) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        h = prefix[k:] - prefix[:-k]
        h *= self.down[: n - k + 1]
        h += np.uint64(k * int(SALT) & ODD)
        return mix(h)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """One hash a word; ``table`` maps bytes first.  Sums of 8 bytes a byte stand in memory for one piece, not for all of ``data``."""
        values, out = self.bytes if table is None else self.bytes[table], np.empty(len(starts), np.uint64)
        for lo, hi in pieces(starts, ends):
            first = starts[lo]
            out[lo:hi] = self.span(self.prefix(values[data[first : ends[hi - 1]]]), starts[lo:hi] - first, ends[lo:hi] - first)
        return out

    def sound_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """One hash a word, for users that compare no bytes behind it: sums modulo 2**64 collide for words that anybody can
        write.  Words of up to 7 bytes keep bytes and length in their 64 bits, so these never collide among themselves;
        longer ones take a keyed BLAKE2b hash, computed once for each distinct word of a piece."""
        out, key = np.empty(len(starts), np.uint64), np.uint64(int.from_bytes(self.key, "little"))
        for lo, hi in pieces(starts, ends):
            first = starts[lo]
            piece = data[first : ends[hi - 1]] if table is None else table[data[first : ends[hi - 1]]]
            at, size = starts[lo:hi] - first, ends[lo:hi] - starts[lo:hi]
            lanes = np.ndarray(len(piece), np.dtype("<u8"), buffer=np.concatenate([piece, np.zeros(8, np.uint8)]), strides=(1,))
            held = np.minimum(size, 7).astype(np.uint64)
            h = lanes[at] & ((np.uint64(1) << (held * np.uint64(8))) - np.uint64(1))
            h |= held << np.uint64(56)
            h ^= key
            out[lo:hi] = mix(h)
            for i in np.flatnonzero(size > LONG_WORD):
                out[lo + i] = self._digest(piece[at[i] : at[i] + size[i]].data)
            long = np.flatnonzero((size > 7) & (size <= LONG_WORD))
            if len(long):
                edge = np.concatenate([[0], np.cumsum(size[long])]).astype(np.int32)
                held = piece[np.repeat(at[long], size[long]) + ragged(size[long])]
                coded = pa.Array.from_buffers(pa.binary(), len(long), [None, pa.py_buffer(edge), pa.py_buffer(held)]).dictionary_encode()
                each = np.array([self._digest(x) for x in coded.dictionary.to_pylist()], np.uint64)
                out[lo + long] = each[coded.indices.to_numpy()]
        return out

    def _digest(self, word) -> int:
        return int.from_bytes(blake2b(word, digest_size=8, key=self.key).digest(), "little")


def sliding(fn, a: np.ndarray, width: int) -> np.ndarray:
    """fn (minimum or maximum) over every window of ``width`` items, by doubling."""
    if len(a) < width:
        return a[:0]
    out, span = a, 1
    while span * 2 <= width:
        out = fn(out[:-span], out[span:])
        span *= 2
    return fn(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def window_minima(grams: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of grams that are the least of a window of ``width`` grams (all of equal ones), and each window's least.

    valid: for each window start, whether the window lies in one text; the least of others is 0.  Every valid window
    holds a position, and equal windows hold positions at equal offsets.
    """
    least = sliding(np.minimum, grams, width)
    if not len(least):
        return np.zeros(0, np.int64), least
    least = np.where(valid, least, np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    most = sliding(np.maximum, np.concatenate([edge, least, edge]), width)
    return np.flatnonzero((most == grams) & (most > 0)), least


def own_minimum(grams: np.ndarray, least: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each window start, the index in ``at`` of the window's leftmost least gram."""
    own = np.searchsorted(at, starts)
    left = np.arange(len(starts))
    while len(left):
        left = left[grams[at[own[left]]] != least[starts[left]]]
        own[left] += 1
    return own


def ends_of(bounds: np.ndarray) -> np.ndarray:
    """For each unit, the index after its text's last unit."""
    return np.repeat(bounds[1:], np.diff(bounds))


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """n flags: inside any of the spans [lo, hi)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:-1]) > 0


def cut(data, table: bytes):
    """Yield ``data`` mapped by ``table``, in pieces of about PIECE bytes that end at white space, so no word is split."""
    lo = 0
    while lo < len(data):
        piece, hi = bytes(data[lo : lo + PIECE]).translate(table), lo + PIECE
        if hi < len(data) and not piece[-1:].isspace():
            rest = bytearray()
            while hi < len(data) and not rest[-1:].isspace():
                more = bytes(data[hi : hi + 64]).translate(table)
                end = next((i + 1 for i, b in enumerate(more) if b in SPACES), len(more))
                rest += more[:end]
                hi += end
            piece += rest
        yield piece
        lo = hi
