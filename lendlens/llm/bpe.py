"""Byte-level BPE encoding and decoding over a global vocabulary of distinct words.

Texts are cut into pre-tokens. A chunk of texts lists its distinct words once and keeps, per text,
the word numbers by position, both in packed rows. The distinct words of all chunks meet in one
shuffle by word hash, each is encoded once, its ids go back to the chunks that have it, and the ids
are put in order by position. Decoding
gathers rows of the token-byte table, which has one row per rank of the vocabulary file.
"""

from __future__ import annotations

import base64
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, giving_back, id_and_text, pack, rows_of, slices, stored, unpack

CHUNK_WORDS = 300_000
CHUNK_TOKENS = 8_000_000
SLICE_BYTES = 2_000_000
WORD, TEXT = 0, 1
NULL_ID = -(2**63)
_PACKED = pa.schema(
    [("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())]
)
_PACKED_DDL = "chunk long, kind int, bucket int, body binary"
_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64 and rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _cut(pattern: str, buckets: int):
    """Packed rows of a chunk: its distinct words by bucket, and its texts as word numbers."""

    def run(batches):
        find = regex.compile(pattern).findall
        partition = TaskContext.get().partitionId() << 33
        chunk, numbers, waiting, tokens = partition, _Numbers(), [], 0

        def rows():
            """Words are numbered anew by frequency, so that most numbers are small."""
            n = len(numbers)
            counts = sum((np.bincount(part[2], minlength=n) for part in waiting), np.zeros(n, int))
            rank = np.empty(n, np.uint32)
            rank[np.argsort(-counts, kind="stable")] = np.arange(n, dtype=np.uint32)
            for ids, lengths, found in waiting:
                body = pack(ids, lengths, rank[found])
                yield batch_of(_PACKED, [[chunk], [TEXT], [zlib.crc32(body) % buckets], [body]])
            words = [word.encode() for word in numbers]
            bucket = np.fromiter((zlib.crc32(word) % buckets for word in words), np.int32, n)
            order = np.lexsort((rank, bucket))
            for members in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                own = [words[i] for i in members]
                joined = np.frombuffer(b"".join(own), np.uint8)
                lengths = np.fromiter(map(len, own), np.uint32, len(own))
                body = pack(rank[members], lengths, joined)
                yield batch_of(_PACKED, [[chunk], [WORD], [int(bucket[members[0]])], [body]])

        for batch in slices(batches, most=SLICE_BYTES):
            ids, texts = (column.to_pylist() for column in batch.columns)
            cut = []
            for text in texts:  # so that the words of one text only are held as strings
                words = find(text)
                cut.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            found = np.concatenate(cut)
            ids = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            waiting.append((ids, lengths, found))
            tokens += len(found)
            if len(numbers) > CHUNK_WORDS or tokens > CHUNK_TOKENS:
                yield from rows() if tokens else _empty_rows(chunk, waiting)
                chunk, numbers, waiting, tokens = chunk + 1, _Numbers(), [], 0
        if waiting:
            yield from rows() if tokens else _empty_rows(chunk, waiting)

    return giving_back(run)


def _empty_rows(chunk: int, waiting: list):
    for part in waiting:
        yield batch_of(_PACKED, [[chunk], [TEXT], [0], [pack(*part)]])


def _split(joined: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    data, ends = joined.tobytes(), np.cumsum(lengths, dtype=np.int64).tolist()
    return [data[start:end] for start, end in zip([0, *ends], ends)]


def _encode_words(ranks: dict[bytes, int], pattern: str):
    """All chunks' words of a bucket are in one task, which encodes a distinct word once.

    Rows of texts pass.
    """

    def run(batches):
        encoding = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        known: dict[bytes, list[int]] = {}
        current = None
        for batch in batches:
            for chunk, kind, bucket, body in rows_of(batch):
                if kind == TEXT:
                    yield batch_of(_PACKED, [[chunk], [TEXT], [bucket], [body]])
                    continue
                if bucket != current:
                    current, known = bucket, {}
                numbers, lengths, joined = unpack(body)
                words = _split(joined, lengths)
                for word in words:
                    if word not in known:
                        known[word] = encoding.encode_ordinary(word.decode())
                ids = [known[word] for word in words]
                counts = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum()))
                yield batch_of(
                    _PACKED, [[chunk], [WORD], [bucket], [pack(numbers, counts, flat)]]
                )

    return giving_back(run)


class Pieces:
    """Pieces of a flat array, which can be laid one after the other in any order."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat = flat
        self.lengths = lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def gather(self, rows: np.ndarray) -> np.ndarray:
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        shift = self.starts[rows] - (ends - lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(shift, lengths) + np.arange(total)]


def _assemble(batches):
    """The encoded words of a chunk come first, then its texts."""
    chunk, parts, pieces = None, [], None
    for batch in batches:
        for at, kind, _, body in rows_of(batch):
            if at != chunk:
                chunk, parts, pieces = at, [], None
            if kind == WORD:
                parts.append(unpack(body))
                continue
            if pieces is None:
                none = [np.zeros(0, np.uint32)]
                numbers, counts, flat = (np.concatenate([p[i] for p in parts] or none) for i in range(3))
                by_number = np.argsort(numbers, kind="stable")
                pieces = Pieces(Pieces(flat, counts).gather(by_number).astype("<u4"), counts[by_number])
                parts = []
            ids, lengths, found = unpack(body)
            tokens = pieces.gather(found).tobytes()
            sizes = np.concatenate([[0], np.cumsum(pieces.lengths[found])])
            ends = sizes[np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])].tolist()
            doc_ids = [None if i == NULL_ID else i for i in ids.view(np.int64).tolist()]
            bodies = [tokens[4 * start : 4 * end] for start, end in zip(ends, ends[1:])]
            yield batch_of(_ENCODED, [doc_ids, [len(ids) // 4 for ids in bodies], bodies])


def _ordered_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Packed rows by chunk: its encoded words, then its texts as word numbers."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = id_and_text(docs).mapInArrow(_cut(pattern, buckets), _PACKED_DDL)
    by_word = cut.repartition("bucket").sortWithinPartitions("bucket", "kind")
    encoded = stored(by_word.mapInArrow(_encode_words(ranks, pattern), _PACKED_DDL), "word-ids")
    return encoded.repartition("chunk").sortWithinPartitions("chunk", "kind")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row; ids are little-endian unsigned 32-bit integers.

    NULL and empty texts have no tokens. Repeated rows and NULL ids each give a row. A text is
    encoded whole, however long; chunks end at text ends, after ``CHUNK_WORDS`` distinct words or
    ``CHUNK_TOKENS`` positions. There are as many word buckets as shuffle partitions, so both grow
    with the input; a bucket is read row by row, and holds its distinct words only.
    """
    ordered = _ordered_words(docs, ranks, pattern)
    return ordered.mapInArrow(giving_back(_assemble), "doc_id long, n_tokens long, ids binary")


def _decode(ranks: dict[bytes, int]):
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    pieces = Pieces(np.frombuffer(b"".join(table), np.uint8), np.array([len(token) for token in table]))
    schema = pa.schema([*_ENCODED, ("bytes", pa.binary())])

    def run(batches):
        for batch in slices(batches, "ids"):
            ids, counts, bodies = (column.to_pylist() for column in batch.columns)
            texts = [pieces.gather(np.frombuffer(body, "<u4")).tobytes() for body in bodies]
            yield batch_of(schema, [ids, counts, bodies, texts])

    return giving_back(run)


_DECODED_DDL = "doc_id long, n_tokens long, ids binary, bytes binary"


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The rows of ``encode`` with the decoded ``bytes``."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(_decode(ranks), _DECODED_DDL)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``decode`` of ``encode``; one Python worker of a task does both, a batch at a time."""
    decoded = _decode(ranks)
    ordered = _ordered_words(docs, ranks, pattern)
    return ordered.mapInArrow(lambda batches: decoded(_assemble(batches)), _DECODED_DDL)


def token_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes, per document."""
    return round_trip(docs, ranks, pattern).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
