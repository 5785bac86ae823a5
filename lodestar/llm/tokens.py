"""Token ids in files of frequency-ranked, byte-aligned variable-length codes.

Ids are replaced by their rank in descending corpus frequency (ties: lower id
first), so frequent ids need one byte.  A rank takes 1 to 4 bytes,
little-endian; its length - 1 is two bits in a separate stream of control
bytes, four ranks a byte, the first in the low bits.  A file is Parquet with a
row per document and the columns ``control`` and ``data`` beside ``doc_id``
and ``n_tokens``; ``ranks.parquet`` beside the files holds the table from rank
to id.  Decoding looks lengths up in a 256-row table and gathers whole blocks
of documents at once.

Documents are dealt into ranges of ascending doc_id, one file each, sorted;
the first shuffle (whole texts) is the only one.  Token counts come from all
documents, from the tasks that encode them; the rank table has a row per vocabulary entry.  Offsets of files
are running sums over one row per file.

Defined cases: null is the empty text, i.e. the end id alone.  Null doc_ids
come first, equal ones in the order of their texts' hash.  Extra columns are
ignored.  Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches
from lodestar.llm.words import U64, byte_hashes, segment_sum, slices, utf8_column
from lodestar.session import remove_folder, scratch_path

END_ID = 2
BLOCK_TOKENS = 1 << 20
_FOUR = np.arange(4)
#: control byte -> lengths of its four values
LENGTHS = ((np.arange(256)[:, None] >> (2 * _FOUR)) & 3) + 1
#: kinds of bytes of UTF-8: space and line feed, ASCII letters, other visible
#: ASCII, and the first of two bytes (no such character is white space but
#: U+0085 and U+00A0, which start with C2)
WHITE, LETTER, MARK, TWO = 1, 2, 4, 8
VISIBLE, SHOWN = LETTER | MARK, LETTER | MARK | TWO
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[0x20, 0x0A]] = WHITE
KINDS[0x21:0x7F] = MARK
KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = LETTER
KINDS[0xC3:0xE0] = TWO


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def encode_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths - 1, data bytes) of unsigned 32-bit values."""
    values = values.astype("<u4")
    extra = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    present = _FOUR[None, :] <= extra[:, None]
    return extra, values.view(np.uint8).reshape(-1, 4)[present]


def control_bytes(extra: np.ndarray) -> np.ndarray:
    """Two bits a value, four values a byte; the last byte is padded with 0."""
    padded = np.zeros(-(-len(extra) // 4) * 4, dtype=np.uint8)
    padded[:len(extra)] = extra
    four = padded.reshape(-1, 4)
    return four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6


def decode_values(control: np.ndarray, n: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The values of documents of ``n`` values each, whose control bytes and
    data stand back to back."""
    total = int(n.sum())
    n_control = -(-n // 4)
    lengths = LENGTHS[control].reshape(-1)
    # drop the padding after each document
    start = 4 * (np.cumsum(n_control) - n_control)
    lengths = lengths[np.repeat(start, n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)]
    at = np.cumsum(lengths) - lengths
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    values = padded[at].astype(np.uint32)
    for j in range(1, 4):
        longer = np.flatnonzero(lengths > j)
        if not len(longer):
            break
        values[longer] |= padded[at[longer] + j].astype(np.uint32) << np.uint32(8 * j)
    return values


class ChunkEncoder:
    """Encodes columns of texts with the tokenizers library, each distinct
    chunk of text once.

    A chunk starts at a single space between two visible characters.  A
    byte-level pre-tokenizer always cuts there and no merge crosses its cuts,
    so a text's ids are its chunks' ids in turn.  With the library's own
    pattern (``ByteLevel``), chunks also start at a single line feed between
    two visible characters and at an ASCII digit or mark after an ASCII letter:
    no match of the pattern goes on there, and none looks back.  A column's new
    chunks go to the library joined into one text; the ids' byte lengths tell
    which chunk each belongs to.  Known chunks (up to ``CACHED_CHUNKS`` of at
    most ``CACHED_BYTES`` bytes, by their 64-bit hashes) stay for later columns
    until there are too many of them or of their ids (``CACHED_IDS``).
    """

    CACHED_BYTES = 64
    CACHED_CHUNKS = 1 << 21
    CACHED_IDS = 1 << 24

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = _tokenizer(path)
        cutter = self.tokenizer.pre_tokenizer
        self.own_pattern = isinstance(cutter, ByteLevel) and cutter.use_regex and self.tokenizer.normalizer is None
        vocab = self.tokenizer.get_vocab()
        self.id_type = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        self.id_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token)  # one character a byte
        self.forget()

    def forget(self) -> None:
        self.n_known = 0
        self.ids = np.zeros(0, dtype=self.id_type)
        self._slots_for(1 << 15)

    def _slots_for(self, n: int) -> None:
        """An empty hash table of at least ``2 * n`` slots; hash 0 is a free one."""
        slots = 2 << max(n - 1, 1).bit_length()
        self.known = np.zeros(slots, dtype=U64)
        self.first = np.zeros(slots, dtype=np.int32)
        self.count = np.zeros(slots, dtype=np.uint8)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        """Of every hash its slot, or the free one where its search ends."""
        last = len(self.known) - 1
        slot = (hashes & U64(last)).astype(np.int64)
        there = self.known[slot]
        todo = np.flatnonzero((there != hashes) & (there != 0))
        while len(todo):
            at = (slot[todo] + 1) & last
            slot[todo] = at
            there = self.known[at]
            todo = todo[(there != hashes[todo]) & (there != 0)]
        return slot

    def _put(self, hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        """Enters distinct hashes that are not in the table."""
        while len(hashes):
            slot = self._slot(hashes)
            self.known[slot] = hashes  # of several for one slot, one stays
            stays = self.known[slot] == hashes
            self.first[slot[stays]] = first[stays]
            self.count[slot[stays]] = count[stays]
            hashes, first, count = hashes[~stays], first[~stays], count[~stays]

    def _each(self, chunks: list[bytes]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.id_type) for e in coded]

    def _joined(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number per chunk) of chunks that start with their white space."""
        ids = self._each([raw])[0]
        at = np.cumsum(self.id_bytes[ids])
        last = np.searchsorted(at, ends)
        if len(ids) and (at[np.minimum(last, len(at) - 1)] != ends).any():
            raise ValueError("this tokenizer does not cut at single spaces")
        return ids, np.diff(np.concatenate([[-1], last]))

    def learn(self, hashes: np.ndarray, raw: np.ndarray, start: np.ndarray, size: np.ndarray,
              spaced: np.ndarray) -> None:
        """Encodes new chunks of distinct hashes; those ``spaced`` start with
        one white space and a visible character."""
        parts, counts = [], np.zeros(len(start), dtype=np.int64)
        if spaced.any():
            ends = np.cumsum(size[spaced])
            own = np.arange(ends[-1]) + np.repeat(start[spaced] - (ends - size[spaced]), size[spaced])
            ids, counts[spaced] = self._joined(raw[own].tobytes(), ends)
            parts.append(ids)
        other = np.flatnonzero(~spaced)
        rest = self._each([raw[start[i]:start[i] + size[i]].tobytes() for i in other])
        counts[other] = [len(i) for i in rest]
        order = np.concatenate([np.flatnonzero(spaced), other])
        first = np.zeros(len(start), dtype=np.int64)
        first[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.ids = np.concatenate([self.ids, *parts, *rest])
        self.n_known += len(hashes)
        if 2 * self.n_known > len(self.known):
            full = self.known != 0
            old = self.known[full], self.first[full], self.count[full]
            self._slots_for(self.n_known)
            self._put(*old)
        self._put(hashes, first, counts)

    def _cuts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first bytes of all chunks, whether each starts with one white space
        and a visible character)."""
        kind = KINDS[raw]
        white = kind == WHITE if self.own_pattern else raw == 0x20
        after = (kind & SHOWN) > 0
        before = (kind & VISIBLE) > 0
        before[1:] |= kind[:-1] == TWO
        cut = np.zeros(len(raw), dtype=bool)
        cut[1:-1] = white[1:-1] & before[:-2] & after[2:]
        if self.own_pattern:
            cut[1:] |= (kind[1:] == MARK) & (kind[:-1] == LETTER)
        full = np.diff(offsets) > 0
        begins, ends = offsets[:-1][full], offsets[1:][full]
        # white space must have both neighbours in its own text
        lone = ends - 1
        cut[lone[white[lone]]] = False
        cut[begins] = True
        start = np.flatnonzero(cut)
        spaced = white[start] & after[np.minimum(start + 1, len(raw) - 1)]
        spaced[np.searchsorted(start, begins[ends - begins == 1])] = False
        return start, spaced

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids back to back, number per text); null is the empty text."""
        raw, offsets = utf8_column(column)
        n_docs = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, dtype=self.id_type), np.zeros(n_docs, dtype=np.int64)
        start, spaced = self._cuts(raw, offsets)
        end = np.append(start[1:], len(raw))
        size = end - start
        hashes = byte_hashes(raw, start, end)
        hashes[hashes == 0] = 1
        long = np.flatnonzero(size > self.CACHED_BYTES)
        short = np.flatnonzero(size <= self.CACHED_BYTES) if len(long) else slice(None)
        of_short = hashes[short]
        slot = self._slot(of_short)
        new = np.flatnonzero(self.known[slot] == 0)
        if len(new):
            distinct, where = np.unique(of_short[new], return_index=True)
            if self.n_known + len(distinct) > self.CACHED_CHUNKS or len(self.ids) > self.CACHED_IDS:
                self.forget()
                distinct, where = np.unique(of_short, return_index=True)
                new = np.arange(len(of_short))
            at = np.arange(len(start))[short][new[where]]
            slots = len(self.known)
            self.learn(distinct, raw, start[at], size[at], spaced[at])
            if len(self.known) == slots:
                slot[new] = self._slot(of_short[new])
            else:
                slot = self._slot(of_short)
        first, count = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        first[short], count[short] = self.first[slot], self.count[slot]
        ids = self.ids
        if len(long):
            own = self._each([raw[start[i]:end[i]].tobytes() for i in long])
            count[long] = [len(i) for i in own]
            first[long] = len(ids) + np.cumsum(count[long]) - count[long]
            ids = np.concatenate([ids, *own])
        ends = np.cumsum(count)
        flat = ids[np.arange(ends[-1]) + np.repeat(first - (ends - count), count)]
        per_doc = segment_sum(count, np.diff(np.searchsorted(start, offsets)))
        return flat, per_doc


@functools.lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def binary_column(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` (bytes) as an Arrow column."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


#: the file number of a task's id counts among its documents' rows
COUNTS = -1


def _tokenize(path: str, end_id: int):
    """Rows of the documents' ids, then one row (file ``COUNTS``) of the task's
    ids and how often each occurs."""
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = chunk_encoder(path)
        total = np.zeros(max(len(encoder.id_bytes), end_id + 1), dtype=np.int64)
        like = None
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                like = part.schema
                ids, n = encoder.encode(part.column("text"))
                total += np.bincount(ids, minlength=len(total))
                total[end_id] += len(n)
                with_end = np.full(len(ids) + len(n), end_id, dtype=encoder.id_type)
                with_end[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                yield pa.RecordBatch.from_arrays(
                    [part.column("file"), part.column("doc_id"), part.column("tie"), pa.array(n + 1),
                     binary_column(with_end.view(np.uint8), (n + 1) * with_end.itemsize)],
                    names=["file", "doc_id", "tie", "n_tokens", "ids"])
        if like is not None:
            at = np.flatnonzero(total)
            counts = np.concatenate([at, total[at]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([COUNTS], pa.int32()), pa.nulls(1, like.field("doc_id").type), pa.nulls(1, pa.int64()),
                 pa.array([len(at)], pa.int64()), pa.array([counts.tobytes()], pa.binary())],
                names=["file", "doc_id", "tie", "n_tokens", "ids"])
    return run


def _counts(batches):
    """(id, n) of the tasks' counts rows."""
    for batch in batches:
        for raw in batch.column("ids").to_pylist():
            at, n = np.frombuffer(raw, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["id", "n"])


def binary_bytes(column: pa.Array) -> np.ndarray:
    """The bytes of a binary column without nulls, back to back."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]


def pack_values(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control bytes, their number per document, data bytes, their number) of
    documents of ``n`` values each; every document starts a control byte."""
    extra, data = encode_values(values)
    n_control = -(-n // 4)
    padded = np.zeros(4 * int(n_control.sum()), dtype=np.uint8)
    padded[np.arange(len(extra)) + np.repeat(4 * (np.cumsum(n_control) - n_control) - (np.cumsum(n) - n), n)] = extra
    return control_bytes(padded), n_control, data, segment_sum(extra.astype(np.int64) + 1, n)


def _pack(rank_of):
    def run(batches):
        ranks = rank_of.value
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n_tokens").to_numpy()
            raw = binary_bytes(batch.column("ids"))
            ids = raw.view("<u2" if len(raw) == 2 * n.sum() else "<u4")
            control, n_control, data, n_data = pack_values(ranks[ids], n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("doc_id"), batch.column("tie"), batch.column("n_tokens"),
                 binary_column(control, n_control), binary_column(data, n_data)],
                names=["file", "doc_id", "tie", "n_tokens", "control", "data"])
    return run


def write_files(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                ranges: int | None = None) -> None:
    """Encodes ``docs`` (doc_id, text) into files under ``path``."""
    spark = docs.sparkSession
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
            .repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
            .withColumn("file", F.spark_partition_id()))
    raw_path = f"{path}/raw"
    map_batches(rows, _tokenize(tokenizer_path or default_tokenizer_path(), end_id),
                f"file int, doc_id {kind}, tie long, n_tokens long, ids binary").write.option(
        "compression", "zstd").parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    ranks = (map_batches(raw.where(F.col("file") == COUNTS).select("ids"), _counts, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n"))
             .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1))  # vocabulary rows
    ranks.select("rank", "id", "n").write.parquet(f"{path}/ranks")
    table = spark.read.parquet(f"{path}/ranks").collect()
    rank_of = np.zeros(max((r["id"] for r in table), default=0) + 1, dtype=np.uint32)
    for r in table:
        rank_of[r["id"]] = r["rank"]
    map_batches(raw.where(F.col("file") != COUNTS), _pack(spark.sparkContext.broadcast(rank_of)),
                f"file int, doc_id {kind}, tie long, n_tokens long, control binary, data binary").write.option(
        "compression", "zstd").parquet(f"{path}/coded")
    remove_folder(spark, raw_path)


def _decoded(id_of, column: str, made):
    """Documents' rows with ``made(ids of each as bytes)`` as the last column."""
    def run(batches):
        ids = id_of.value
        for batch in batches:
            n_all = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(np.cumsum(n_all[first:]), BLOCK_TOKENS)) + first)
                part = batch.slice(first, last - first)
                n = n_all[first:last]
                first = last
                control, data = (binary_bytes(part.column(c)) for c in ("control", "data"))
                raw = memoryview(ids[decode_values(control, n, data)].astype("<u4").view(np.uint8))
                edge = np.concatenate([[0], np.cumsum(4 * n)]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("file"), part.column("doc_id"), part.column("tie"), part.column("n_tokens"),
                     made([raw[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)])],
                    names=["file", "doc_id", "tie", "n_tokens", column])
    return run


def _read(spark, path: str, column: str, made, kind: str) -> DataFrame:
    coded = spark.read.parquet(f"{path}/coded")
    ranks = spark.read.parquet(f"{path}/ranks").select("rank", "id").collect()
    id_of = np.zeros(max(len(ranks), 1), dtype=np.uint32)
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    own = coded.schema["doc_id"].dataType.simpleString()
    return map_batches(coded, _decoded(spark.sparkContext.broadcast(id_of), column, made),
                       f"file int, doc_id {own}, tie long, n_tokens long, {column} {kind}")


def read_files(spark, path: str) -> DataFrame:
    """file, doc_id, tie, n_tokens and ids (little-endian unsigned 32-bit) of
    every document in the files."""
    return _read(spark, path, "ids", lambda texts: pa.array([bytes(t) for t in texts], pa.binary()), "binary")


def positions(spark, path: str) -> DataFrame:
    """doc_id, start (ids before it in all files), n_tokens and ids_crc32 of
    every document, from the files; the decoded ids stay in their tasks."""
    read = _read(spark, path, "ids_crc32", lambda texts: pa.array([zlib.crc32(t) for t in texts], pa.int64()), "long")
    in_file = (Window.partitionBy("file").orderBy(F.asc_nulls_first("doc_id"), "tie")
               .rowsBetween(Window.unboundedPreceding, -1))
    # one row per file: the running sum over files is small
    files = (spark.read.parquet(f"{path}/coded").groupBy("file").agg(F.sum("n_tokens").alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(
                 Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return read.join(files.select("file", "before"), "file").select(
        "doc_id", (F.col("before") + F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0))).alias("start"),
        "n_tokens", "ids_crc32")


def encoded_positions(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes ``docs`` to files in the shared scratch folder and reads their
    positions back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_files(docs, path, tokenizer_path)
    return positions(docs.sparkSession, path)
