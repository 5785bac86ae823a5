"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the model's pieces reads a text once.  At each
position the pieces ending there are its state's output and those along the
output links; each relaxes the best score of a segmentation up to that
position (Viterbi).  The segmentation of greatest total piece score wins; of
equal ones, that whose last piece starts first.

That is a unigram model's encoding.  In a model of BPE type a piece may
follow another only if merging the two pieces' characters in score order
gives back just these two; all other steps score minus infinity.  Each prefix
then has one segmentation with a finite score, the one that merging gives, so
the same pass yields the ids of such models.  (Pieces that merging never
makes are left out.  Stretches with neighbouring word marks are merged
outright, since the pieces of several marks share one score.)

A character that no piece covers costs ten below the least piece score and is
written as its bytes' pieces (or the unknown id, without byte pieces).  Where
two neighbouring characters stand in no piece together, no piece and no merge
can span them, so the best segmentation of a text is that of the stretches
between such places in turn.  Columns of texts are cut into stretches by a
table of the pairs that occur in pieces; each distinct stretch is segmented
once per task and kept (at most ``CACHED`` stretches of at most
``CACHED_CHARS`` characters, as 64-bit hashes).

Model files are read as published: pieces with scores and types, the model
type and the normaliser's flags.  Only identity normalisation is accepted.

Decoding joins the pieces, turns marks into spaces, joins byte pieces into
characters (invalid sequences become U+FFFD each byte) and drops the space
that encoding put in front.

Defined cases: null is the empty text, which has no ids.  Word marks (U+2581)
in a text come back as spaces.  Extra columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import zlib
from array import array
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.common import map_batches
from lodestar.llm.words import U64, byte_hashes, segment_sum, slices

MARK = "▁"
CACHED = 800_000
CACHED_CHARS = 64
UNKNOWN_PENALTY = 10.0

# fixed values of the published model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def default_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message's fields."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    dummy_prefix: bool = True
    extra_spaces: bool = False  # runs of spaces are one, ends are trimmed
    merges: bool = False  # BPE

    @classmethod
    def read(cls, path: str) -> PieceModel:
        model = cls(extra_spaces=True)
        with open(path, "rb") as file:
            data = file.read()
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = float(np.frombuffer(v, "<f4")[0])
                    elif n == 3:
                        kind = v
                model.pieces.append(piece)
                model.scores.append(score)
                model.types.append(kind)
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
                if kind not in (UNIGRAM, BPE):
                    raise ValueError("only unigram and BPE models are supported")
                model.merges = kind == BPE
            elif number == 3:
                for n, v in _fields(value):
                    if n == 2 and v:
                        raise ValueError("only identity normalisation is supported")
                    if n == 3:
                        model.dummy_prefix = bool(v)
                    if n == 4:
                        model.extra_spaces = bool(v)
        return model


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.unknown = model.types.index(UNKNOWN)
        self.byte_id = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True))
                        if t == BYTE}
        usable = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True))
                  if t in (NORMAL, USER_DEFINED) and p}
        if any(model.types[i] == USER_DEFINED for i in usable.values()):
            raise ValueError("user-defined pieces are not supported")
        self.scores = model.scores
        self.unknown_score = min((model.scores[i] for i in usable.values()), default=0.0) - UNKNOWN_PENALTY
        self.usable = usable
        self.pairs: dict[int, bool] = {}  # left << 20 | right
        self._build({p: i for p, i in usable.items() if not model.merges or len(self.merge(p)) == 1})
        # which characters may stand side by side in a piece, as bits
        self.character = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        for i, c in enumerate(sorted({c for p in usable for c in p}), 1):
            self.character[ord(c)] = i
        n = int(self.character.max()) + 1
        self.together = np.zeros((n, -(-n // 8)), dtype=np.uint8)
        for p in usable:
            for a, b in itertools.pairwise(p):
                i, j = self.character[ord(a)], self.character[ord(b)]
                self.together[i, j >> 3] |= 1 << (j & 7)
        self._forget()
        spelled = []
        for p, t in zip(model.pieces, model.types, strict=True):
            spelled.append(b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE
                           else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode())
        self.spelled = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.spelled_size = np.array([len(x) for x in spelled], dtype=np.int64)
        self.spelled_first = np.cumsum(self.spelled_size) - self.spelled_size

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=U64)
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _build(self, usable: dict[str, int]) -> None:
        """Goto, failure, output and output links of the automaton."""
        goto: list[dict[str, int]] = [{}]
        output = [-1]
        for piece, i in usable.items():
            state = 0
            for c in piece:
                nxt = goto[state].get(c)
                if nxt is None:
                    nxt = goto[state][c] = len(goto)
                    goto.append({})
                    output.append(-1)
                state = nxt
            output[state] = i
        fail = array("i", [0] * len(goto))
        link = array("i", [0] * len(goto))  # nearest suffix state with an output
        todo = deque(goto[0].values())
        while todo:
            state = todo.popleft()
            for c, child in goto[state].items():
                f = fail[state]
                while f and c not in goto[f]:
                    f = fail[f]
                f = goto[f].get(c, 0)
                fail[child] = f
                link[child] = f if output[f] >= 0 else link[f]
                todo.append(child)
        # the output links of every state followed to their end, longest first
        ending: list[tuple[tuple[int, int], ...]] = [()] * len(goto)
        todo = deque(goto[0].values())
        while todo:
            state = todo.popleft()
            own = ((output[state], len(self.model.pieces[output[state]])),) if output[state] >= 0 else ()
            ending[state] = own + ending[link[state]]
            todo.extend(goto[state].values())
        self.goto, self.fail, self.ending = goto, fail, ending

    def merge(self, text: str) -> list[str]:
        """Pieces of ``text`` after merging its characters: always the pair
        whose union scores most, the first of equal ones.  Pairs wait in a
        heap, so n characters take n log n steps."""
        n = len(text)
        usable, scores = self.usable, self.scores
        parts: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n:
                i = usable.get(parts[left] + parts[right])
                if i is not None:
                    heapq.heappush(heap, (-scores[i], left, right, len(parts[left]) + len(parts[right])))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            # either side may have grown or gone since the pair was offered
            if parts[left] is None or after[left] != right or len(parts[left]) + len(parts[right]) != size:
                continue
            parts[left] += parts[right]
            parts[right] = None
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [p for p in parts if p is not None]

    def follows(self, left: int, right: int) -> bool:
        """Whether merging leaves these two pieces side by side."""
        if len(self.pairs) >= CACHED // 4:
            self.pairs.clear()
        a, b = self.model.pieces[left], self.model.pieces[right]
        known = self.pairs[left << 20 | right] = self.merge(a + b) == [a, b]
        return known

    def spell(self, part: str) -> list[int]:
        """Ids of a piece or, unless it is one, of a character's bytes."""
        i = self.usable.get(part)
        if i is not None:
            return [i]
        if not self.byte_id:
            return [self.unknown]
        return [self.byte_id[b] for b in part.encode("utf-8", "surrogatepass")]

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation of a stretch, in one pass."""
        merges = self.model.merges
        if merges and MARK + MARK in text:
            return tuple(i for part in self.merge(text) for i in self.spell(part))
        goto, fail, ending, scores, pairs = self.goto, self.fail, self.ending, self.scores, self.pairs
        n = len(text)
        best = [0.0] * (n + 1)
        back = [0] * (n + 1)
        piece = [-1] * (n + 1)
        state = 0
        for end, c in enumerate(text, 1):
            after = goto[state].get(c)
            while after is None and state:
                state = fail[state]
                after = goto[state].get(c)
            state = after or 0
            top = None
            one = False
            for i, size in ending[state]:  # longest first
                begin = end - size
                one = size == 1
                if merges:
                    left = piece[begin]
                    if left >= 0:
                        fits = pairs.get(left << 20 | i)
                        if not (self.follows(left, i) if fits is None else fits):
                            continue  # minus infinity
                    top, back[end], piece[end] = best[begin] + scores[i], begin, i
                    one = True
                    break  # the only finite one
                value = best[begin] + scores[i]
                if top is None or value > top:
                    top, back[end], piece[end] = value, begin, i
            if not one:
                value = best[end - 1] + self.unknown_score
                if top is None or value > top:
                    top, back[end], piece[end] = value, end - 1, -1
            best[end] = top
        ids: list[int] = []
        end = n
        while end:
            if piece[end] >= 0:
                ids.append(piece[end])
            else:
                ids.extend(reversed(self.spell(text[end - 1])))
            end = back[end]
        ids.reverse()
        return tuple(ids)

    def normalise(self, text: str) -> str:
        if self.model.extra_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if self.model.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", MARK)

    def _segmented(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, ...]]:
        return [self.segment(points[a:b].tobytes().decode("utf-32-le")) for a, b in zip(start, end, strict=True)]

    def encode_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids back to back, number per text)."""
        texts = [self.normalise(t or "") for t in texts]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        if not len(points):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        kind = self.character[points]
        cut = np.ones(len(points), dtype=bool)
        cut[1:] = (self.together[kind[:-1], kind[1:] >> 3] >> (kind[1:] & 7).astype(np.uint8)) & 1 == 0
        cut[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(points))
        hashes = byte_hashes(points.view(np.uint8), 4 * start, 4 * end)
        first, count = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        short = np.flatnonzero(end - start <= CACHED_CHARS)
        distinct, where, inverse = np.unique(hashes[short], return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
        if len(self.known) + len(new) > CACHED:
            self._forget()
            new = np.arange(len(distinct))
        if len(new):
            own = self._segmented(points, start[short[where[new]]], end[short[where[new]]])
            n = np.array([len(i) for i in own], dtype=np.int64)
            known = np.concatenate([self.known, distinct[new]])
            by = np.argsort(known, kind="stable")
            self.known = known[by]
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(n) - n])[by]
            self.count = np.concatenate([self.count, n])[by]
            self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(own), np.int32)])
        at = np.searchsorted(self.known, distinct)[inverse]
        first[short], count[short] = self.first[at], self.count[at]
        ids = self.ids
        long = np.flatnonzero(end - start > CACHED_CHARS)
        if len(long):
            own = self._segmented(points, start[long], end[long])
            count[long] = [len(i) for i in own]
            first[long] = len(ids) + np.cumsum(count[long]) - count[long]
            ids = np.concatenate([ids, np.fromiter(itertools.chain.from_iterable(own), np.int32)])
        flat = ids[np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return flat, segment_sum(count, np.diff(np.searchsorted(start, edges)))

    def decode_texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids back to back."""
        size = self.spelled_size[ids]
        place = np.arange(int(size.sum())) + np.repeat(self.spelled_first[ids] - (np.cumsum(size) - size), size)
        data = self.spelled[place].tobytes()
        edges = np.concatenate([[0], np.cumsum(segment_sum(size, counts))])
        texts = [data[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(edges.tolist())]
        if self.model.dummy_prefix:
            texts = [t[1:] if t[:1] == " " else t for t in texts]
        return texts

    def encode(self, text: str | None) -> list[int]:
        return self.encode_texts([text])[0].tolist()

    def decode(self, ids) -> str:
        ids = np.asarray(ids, dtype=np.int64)
        return self.decode_texts(ids, np.array([len(ids)]))[0]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(PieceModel.read(path))


def encode(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and ids of every text."""
    path = model_path or default_model_path()

    def run(batches):
        own = codec(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids, n = own.encode_texts(part.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids array<int>")


def encode_checked(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_ids and ids of every text, and whether the ids decode to it
    (a null text to the empty one)."""
    path = model_path or default_model_path()

    def run(batches):
        own = codec(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                ids, n = own.encode_texts(texts)
                back = own.decode_texts(ids, n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), lists,
                     pa.array([b == (t or "") for b, t in zip(back, texts, strict=True)], pa.bool_())],
                    names=["doc_id", "n_ids", "ids", "lossless"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, n_ids long, ids array<int>, lossless boolean")


def decode(coded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and text of every row of ids; null ids are none."""
    path = model_path or default_model_path()

    def run(batches):
        own = codec(path)
        for batch in batches:
            lists = [i or [] for i in batch.column("ids").to_pylist()]
            texts = own.decode_texts(np.array([i for ids in lists for i in ids], dtype=np.int64),
                                     np.array([len(ids) for ids in lists], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    kind = coded.schema["doc_id"].dataType.simpleString()
    return map_batches(coded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def round_trips(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), the decoded text, and whether it equals the text."""
    path = model_path or default_model_path()

    def run(batches):
        own = codec(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                ids, n = own.encode_texts(texts)
                back = own.decode_texts(ids, n)
                raw, edges = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(4 * n)]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n),
                     pa.array([zlib.crc32(raw[a:b]) for a, b in itertools.pairwise(edges)], pa.int64()),
                     pa.array(back, pa.string()),
                     pa.array([b == (t or "") for b, t in zip(back, texts, strict=True)])],
                    names=["doc_id", "n_ids", "ids_crc32", "decoded", "lossless"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, n_ids long, ids_crc32 long, decoded string, lossless boolean")
