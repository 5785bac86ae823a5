"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z:
digits, a-z and every code point from U+0080 on.  In UTF-8 that is a property
of single bytes, so the split needs no decoding: all bytes >= 0x80 belong to
words.  Null texts have no words.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = True
_IS_WORD[0x41:0x5B] = True
_IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: masks of the low 0..8 bytes of a lane
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: words of more bytes (there are few) are hashed one by one
_LONG = 256


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def utf8_column(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20):
    """Row ranges of a batch holding about ``max_bytes`` of text each (one row
    at least, so a very long text is a slice of its own)."""
    lengths = batch.column(column).cast(pa.large_string())
    _, offsets = utf8_column(lengths)
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte range: eight bytes at a time are mixed into a
    state that starts from the length."""
    size = end - start
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    out = mix((lanes[start] & _LOW[np.minimum(size, 8)]) ^ (size.astype(U64) * U64(0x9E3779B97F4A7C15)))
    more = np.flatnonzero((size > 8) & (size <= _LONG))
    done = 8
    while len(more):
        lane = lanes[start[more] + done] & _LOW[np.minimum(size[more] - done, 8)]
        out[more] = mix((out[more] ^ lane) * U64(0xD6E8FEB86659FD93))
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > _LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words:
    """Word boundaries and 64-bit word hashes of a column of texts.  A text is
    never cut; the arrays take about ten bytes per byte of text.

    ``start``/``end`` are byte offsets into ``data`` (lower-cased bytes);
    ``lo[d]:hi[d]`` are the words of document ``d``.
    """

    def __init__(self, column):
        raw, self.offsets = utf8_column(column)
        self.data = _LOWER[raw]
        self.n_docs = len(self.offsets) - 1
        inside = _IS_WORD[raw]
        n = len(raw)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        begins = self.offsets[:-1][np.diff(self.offsets) > 0]
        first[begins] = inside[begins]
        ends = begins[begins > 0] - 1
        last[ends] = inside[ends]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.lo = np.searchsorted(self.start, self.offsets[:-1], side="left")
        self.hi = np.searchsorted(self.start, self.offsets[1:], side="left")
        self.n_words = self.hi - self.lo
        self.inside = inside

    @functools.cached_property
    def hash(self) -> np.ndarray:
        return byte_hashes(self.data, self.start, self.end)

    def text_keys(self) -> list[bytes | None]:
        """128-bit BLAKE2 of every text's words with one space between them;
        None for texts without words."""
        later = np.ones(len(self.start), dtype=bool)
        later[self.lo[self.n_words > 0]] = False
        before = self.start[later] - 1  # in the same text: words are maximal
        keep = self.inside.copy()
        keep[before] = True
        data = self.data.copy()
        data[before] = 0x20
        joined = memoryview(np.ascontiguousarray(data[keep]))
        ends = np.cumsum(segment_sum(self.end - self.start, self.n_words) + np.maximum(self.n_words - 1, 0)).tolist()
        return [hashlib.blake2b(joined[a:b], digest_size=16).digest() if b > a else None
                for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.n_words)

    def phrase(self, first: int, n: int) -> bytes:
        """The words ``first .. first + n - 1`` joined by one space."""
        data, s, e = self.data, self.start, self.end
        return b" ".join(data[s[i]:e[i]].tobytes() for i in range(first, first + n))


#: bytes of words that are cut into n-grams at a time
PORTION_BYTES = 1 << 20


def word_portions(words: Words, which: np.ndarray):
    """(slice, word numbers) of ``which`` in runs of about ``PORTION_BYTES``."""
    if not len(which):
        return
    ends = np.cumsum(words.end[which] - words.start[which])
    cuts = np.searchsorted(ends, np.arange(1, int(ends[-1]) // PORTION_BYTES + 1) * PORTION_BYTES) + 1
    edges = np.unique(np.concatenate([[0], np.minimum(cuts, len(which)), [len(which)]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield slice(a, b), which[a:b]


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words (across documents; mask the ends)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= U64(0x9E3779B97F4A7C15)
        out += hashes[j:j + n]
    return mix(out)


def doc_shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, document of each, number per document) of the ``k``-word
    shingles, repeats included; a document of 1 to k-1 words is one shingle,
    one without words has none."""
    n = words.n_words
    grams = gram_hashes(words.hash, k)
    counts = np.where(n >= k, n - k + 1, 0)
    total = int(counts.sum())
    begin = np.cumsum(counts) - counts
    index = np.arange(total) - np.repeat(begin, counts) + np.repeat(words.lo, counts)
    hashes, docs = grams[index], np.repeat(np.arange(words.n_docs), counts)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        own = np.array([gram_hashes(words.hash[words.lo[d]:words.hi[d]], int(n[d]))[0] for d in short],
                       dtype=U64)
        hashes, docs = np.concatenate([hashes, own]), np.concatenate([docs, short])
        order = np.argsort(docs, kind="stable")
        hashes, docs = hashes[order], docs[order]
        counts = counts.copy()
        counts[short] = 1
    return hashes, docs, counts


def segment_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive segments of the given lengths (0 for empty ones)."""
    out = np.zeros((len(counts),) + values.shape[1:], dtype=values.dtype)
    full = np.flatnonzero(counts)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, begin, axis=0)
    return out
