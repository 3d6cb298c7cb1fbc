"""Substring dedup by longest-previous-factor arrays.

A byte goes if a 50-byte string covers it that also starts in a document with a smaller id.

1. Every 50-byte window has a minimiser, the leftmost least-hashed 20-byte string in it. Equal
   windows have equal minimisers at equal places, so only windows with one minimiser need to be
   compared. Consecutive windows with the same minimiser form a run.
2. Runs meet by minimiser hash, packed, and combined within each batch first. Of equal runs, all but
   those of the smallest document go as a whole.
3. What is left under a minimiser that has several runs (about one run in twenty) is fetched from
   the texts. Its windows are put in suffix order; previous and next smaller documents give the
   longest previous factor of each, and windows with one of 50 bytes go too.
4. Ranges meet their documents once more, which returns the bytes that stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, id_and_text, pack, slices, stored, unpack
from lendlens.llm.seeds import BYTE_VALUES, Rolling, merged, mixed, sliding_least

SPAN = 50
SEED = 20
PIECE = 1 << 21
CONTEXTS = 1 << 13
NULL_RANK = 2**63 - 1  # a NULL id comes after all others
RANGE, REQUEST = 0, 1
TEXT_FIRST, TEXT_LAST = -1, 2
_SEEDS = pa.schema(
    [("bucket", pa.int32()), ("body", pa.binary()), ("rank", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
)
_SEEDS_DDL = "bucket int, body binary, rank long, start long, end long"
_FOUND = pa.schema(
    [("kind", pa.int32()), ("rank", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.int64())]
)
_FOUND_DDL = "kind int, rank long, start long, end long, seed long"
_CONTEXT = pa.schema([("seed", pa.int64()), ("rank", pa.int64()), ("start", pa.int64()), ("body", pa.binary())])
_CONTEXT_DDL = "seed long, rank long, start long, body binary"
_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("kept", pa.binary()),
    ]
)
_KEPT_DDL = (
    "doc_id long, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept binary"
)


def window_runs(data: np.ndarray, lengths: np.ndarray, span: int = SPAN, seed: int = SEED):
    """Runs of consecutive windows with one minimiser, in concatenated pieces.

    Returns arrays: start (in ``data``), number of windows, hash of the minimiser, and a hash of the
    run's whole text and its minimiser's place.
    """
    n = len(data)
    if n < span:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    rolling = Rolling(BYTE_VALUES[data])
    values = rolling.all_of(seed)
    place = sliding_least(values, span - seed + 1)
    piece = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    valid = piece[: n - span + 1] == piece[span - 1 :]
    same = np.zeros(len(place), bool)
    same[1:] = (place[1:] == place[:-1]) & valid[1:] & valid[:-1]
    start = np.flatnonzero(valid & ~same)
    last = np.flatnonzero(valid & ~np.append(same[1:], False))
    count, offset = last - start + 1, place[start] - start
    shape = (count * 64 + offset).astype(np.uint64)
    whole = rolling.of(start, last + span)
    return start, count, values[place[start]], mixed(whole ^ (shape << np.uint64(20)))


def fold(data: bytes) -> int:
    """Upper half of a place: tells texts apart that share one ``doc_id``."""
    return (xxhash.xxh32_intdigest(data) >> 1) << 32


def _resolve(seed, whole, rank):
    """Order by seed, run and document; True where a smaller document has the same run."""
    order = np.lexsort((rank, whole, seed))
    seed, whole, rank = seed[order], whole[order], rank[order]
    head = np.ones(len(seed), bool)
    head[1:] = (seed[1:] != seed[:-1]) | (whole[1:] != whole[:-1])
    least = rank[head][np.cumsum(head) - 1] if len(rank) else rank
    return order, rank > least


def _ranges(kind: int, rows: np.ndarray) -> pa.RecordBatch:
    n = len(rows)
    return batch_of(_FOUND, [np.full(n, kind, np.int32), rows[:, 0], rows[:, 1], rows[:, 2], np.zeros(n, np.int64)])


def _seed_rows(buckets: int):
    def of_pieces(pieces):
        lengths = np.array([len(data) for _, _, data in pieces], np.int64)
        data = np.frombuffer(b"".join(data for _, _, data in pieces), np.uint8)
        start, count, seed, whole = window_runs(data, lengths)
        piece = np.repeat(np.arange(len(pieces)), lengths)[start]
        shift = np.array([base for _, base, _ in pieces], np.int64) - (np.cumsum(lengths) - lengths)
        start = start + shift[piece]
        rank = np.array([r for r, _, _ in pieces], np.int64)[piece]
        order, gone = _resolve(seed, whole, rank)
        seed, whole, rank, start, count = (x[order] for x in (seed, whole, rank, start, count))
        done = merged(rank[gone], start[gone], start[gone] + count[gone] - 1 + SPAN)
        n = len(done)
        if n:
            yield batch_of(
                _SEEDS, [(done[:, 0] % buckets).astype(np.int32), [None] * n, done[:, 0], done[:, 1], done[:, 2]]
            )
        seed, whole, rank, start, count = (x[~gone] for x in (seed, whole, rank, start, count))
        bucket = ((seed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((start, rank, bucket))
        for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(own):
                body = pack(seed[own], whole[own], rank[own], start[own], count[own].astype(np.uint8))
                yield batch_of(_SEEDS, [[int(bucket[own[0]])], [body], [None], [None], [None]])

    def run(batches):
        for batch in slices(batches, most=PIECE):
            pieces, size = [], 0
            for rank, text in zip(*(column.to_pylist() for column in batch.columns)):
                data = text.encode()
                base = fold(data)
                for at in range(0, len(data) - SPAN + 1, PIECE):
                    part = data[at : at + PIECE + SPAN - 1]
                    if size and size + len(part) > PIECE:
                        yield from of_pieces(pieces)
                        pieces, size = [], 0
                    pieces.append((rank, base + at, part))
                    size += len(part)
            if pieces:
                yield from of_pieces(pieces)

    return run


def _match_runs(batches):
    """Ranges that go, and runs whose text must be compared; rows come bucket by bucket, and only one is held."""
    parts, current = [], None
    for batch in batches:
        plain = batch.filter(batch.column(1).is_null())
        if plain.num_rows:
            rows = np.stack([plain.column(i).to_numpy() for i in (2, 3, 4)], axis=1)
            yield _ranges(RANGE, rows)
        for bucket, body in zip(batch.column(0), batch.column(1)):  # one value at a time, as bodies are large
            if not body.is_valid:
                continue
            if parts and bucket != current:
                yield from _matched(parts)
            parts.append(unpack(body.as_buffer()))
            current = bucket
    if parts:
        yield from _matched(parts)


def _matched(parts: list[list[np.ndarray]]):
    """The runs of one bucket, which are taken out of ``parts``."""
    seed, whole, rank, start, count = (np.concatenate([p[i] for p in parts]) for i in range(5))
    parts.clear()
    rank, start = rank.view(np.int64), start.view(np.int64)
    order, gone = _resolve(seed, whole, rank)
    seed, rank, start, count = (x[order] for x in (seed, rank, start, count))
    end = start + count - 1 + SPAN
    rows = np.stack([rank[gone], start[gone], end[gone]], axis=1)
    for at in range(0, len(rows), 100_000):
        yield _ranges(RANGE, rows[at : at + 100_000])
    seed, rank, start, end = (x[~gone] for x in (seed, rank, start, end))
    if not len(seed):
        return
    head = np.ones(len(seed), bool)
    head[1:] = seed[1:] != seed[:-1]
    group, heads = np.cumsum(head) - 1, np.flatnonzero(head)
    open_groups = np.minimum.reduceat(rank, heads) < np.maximum.reduceat(rank, heads)
    wanted = open_groups[group]
    seed, rank, start, end = (x[wanted] for x in (seed.view(np.int64), rank, start, end))
    for at in range(0, len(seed), 100_000):
        part = slice(at, at + 100_000)
        n = len(seed[part])
        yield batch_of(_FOUND, [np.full(n, REQUEST, np.int32), rank[part], start[part], end[part], seed[part]])


def _fetch(batches):
    """The texts of a document come before its requests; returns the requested bytes."""
    current, texts = None, {}
    for batch in batches:
        out = [[] for _ in _CONTEXT]
        for kind, rank, start, end, seed, text in zip(*(column.to_pylist() for column in batch.columns)):
            if rank != current:
                current, texts = rank, {}
            if kind == TEXT_FIRST:
                data = text.encode()
                texts[fold(data) >> 32] = data
                continue
            at = start & 0xFFFFFFFF
            body = texts[start >> 32][at : at + end - start]
            for values, value in zip(out, (seed, rank, start, body)):
                values.append(value)
        if out[0]:
            yield batch_of(_CONTEXT, out)


def previous_factors(ranks: list[int], common: list[int]) -> np.ndarray:
    """For each suffix, in suffix order, the longest prefix that a smaller document's suffix has.

    ``common[i]`` is the length that suffixes i - 1 and i share. The nearest suffix of a smaller
    document before it (previous smaller value) and after it (next smaller value) share the most.
    """

    def one_way(ranks, common):
        found, stack = [], []
        for rank, shared in zip(ranks, common):
            while stack and stack[-1][0] >= rank:
                shared = min(shared, stack.pop()[1])
            found.append(shared if stack else 0)
            stack.append((rank, shared))
        return found

    before = one_way(ranks, common)
    after = one_way(ranks[::-1], [0, *common[:0:-1]])[::-1]
    return np.maximum(before, after)


def repeated_windows(data: np.ndarray, places: np.ndarray, ranks: np.ndarray, span: int = SPAN) -> np.ndarray:
    """True for windows of ``data`` at ``places`` whose previous factor has ``span`` bytes."""
    windows = np.lib.stride_tricks.sliding_window_view(data, span)[places]
    order = np.argsort((windows + 1).view(f"S{span}").ravel(), kind="stable")  # UTF-8 has no 0xFF
    windows = windows[order]
    differ = windows[1:] != windows[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), span)
    common = np.concatenate([[0], shared])
    near = common >= span
    near[:-1] |= shared >= span
    kept = np.flatnonzero(near)  # others share less than a span with every suffix
    factors = previous_factors(ranks[order][kept].tolist(), common[kept].tolist())
    found = np.zeros(len(places), bool)
    found[order[kept]] = factors >= span
    return found


def _compare(batches):
    """Contexts sorted by seed; whole seeds are compared together, many small ones at a time."""
    waiting, count, last = [], 0, None

    def compare():
        bodies = [body for _, _, _, body in waiting]
        lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
        data = np.frombuffer(b"".join(bodies), np.uint8)
        windows = lengths - SPAN + 1
        member = np.repeat(np.arange(len(bodies)), windows)
        within = np.arange(len(member)) - np.repeat(np.cumsum(windows) - windows, windows)
        ranks = np.array([rank for _, rank, _, _ in waiting], np.int64)[member]
        found = repeated_windows(data, (np.cumsum(lengths) - lengths)[member] + within, ranks)
        start = (np.array([start for _, _, start, _ in waiting], np.int64)[member] + within)[found]
        rows = merged(ranks[found], start, start + SPAN)
        if len(rows):
            yield _ranges(RANGE, rows)

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if count >= CONTEXTS and row[0] != last:
                yield from compare()
                waiting, count = [], 0
            waiting.append(row)
            count, last = count + 1, row[0]
    if waiting:
        yield from compare()


def _cut(batches):
    """The ranges of a document come before its texts; returns what stays of each text."""
    current, ranges = None, []
    for batch in batches:
        out = [[] for _ in _KEPT]
        for kind, rank, start, end, doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
            if rank != current:
                current, ranges = rank, []
            if kind == RANGE:
                ranges.append((start, end))
                continue
            data = text.encode()
            base = fold(data)
            own = np.array([(s - base, e - base) for s, e in ranges if s >> 32 == base >> 32], np.int64)
            spans = merged(np.zeros(len(own), np.int64), *own.T)[:, 1:] if len(own) else own.reshape(0, 2)
            edges = [0, *spans.ravel().tolist(), len(data)]
            kept = b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2]))
            row = (doc_id, len(data), len(data) - len(kept), *spans.T.tolist(), kept)
            for values, value in zip(out, row if len(spans) else (*row[:3], [], [], kept)):
                values.append(value)
        if out[0]:
            yield batch_of(_KEPT, out)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, starts, ends, kept`` for every row; ``kept`` is binary.

    ``starts`` and ``ends`` are the maximal removed runs. Texts are UTF-8 bytes; strings are judged
    on the input. A NULL text is empty, and texts under 50 bytes stay. Rows that share a ``doc_id``
    do not remove from each other, as neither id is smaller; NULL ids come last. Texts longer than
    ``PIECE`` bytes are hashed in overlapping pieces, so every window is in one piece.
    """
    docs = id_and_text(docs).withColumn("rank", F.coalesce("doc_id", F.lit(NULL_RANK)))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seeds = docs.select("rank", "text").mapInArrow(_seed_rows(buckets), _SEEDS_DDL)
    by_bucket = seeds.repartition("bucket").sortWithinPartitions("bucket")
    found = stored(by_bucket.mapInArrow(_match_runs, _FOUND_DDL), "runs")
    none = F.lit(None)
    requests = found.filter(F.col("kind") == REQUEST).withColumn("text", none.cast("string"))
    texts = docs.select(
        F.lit(TEXT_FIRST).alias("kind"),
        "rank",
        *[none.cast("long").alias(name) for name in ("start", "end", "seed")],
        "text",
    )
    by_document = requests.unionByName(texts).repartition("rank").sortWithinPartitions("rank", "kind")
    contexts = by_document.mapInArrow(_fetch, _CONTEXT_DDL)
    compared = contexts.repartition("seed").sortWithinPartitions("seed").mapInArrow(_compare, _FOUND_DDL)
    more = stored(compared, "factors")
    ranges = found.filter(F.col("kind") == RANGE).unionByName(more)
    ranges = ranges.select(
        "kind", "rank", "start", "end", none.cast("long").alias("doc_id"), none.cast("string").alias("text")
    )
    last = docs.select(
        F.lit(TEXT_LAST).alias("kind"),
        "rank",
        none.cast("long").alias("start"),
        none.cast("long").alias("end"),
        "doc_id",
        "text",
    )
    ordered = ranges.unionByName(last).repartition("rank").sortWithinPartitions("rank", "kind")
    return ordered.mapInArrow(_cut, _KEPT_DDL)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Counts of removed bytes and spans, and the digest of the rest, per document."""
    return remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
