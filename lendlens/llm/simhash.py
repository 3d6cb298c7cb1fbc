"""SimHash near-dedup by tiled exact comparison.

Fingerprints of whole texts are reduced to distinct values and packed, in order of their population
counts, into tiles. Two fingerprints within the radius have population counts within the radius, in
total and summed over the four 16-bit quarters, so tile pairs further apart are skipped, and inside
a tile pair so are blocks. The rest is compared exactly with exclusive-or and bit counts. A tile
pair returns a spanning forest of its links, not all links, so a large group of near copies stays
linear; the forests are joined by connected components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, giving_back, keep_one_row, row_key, slices, stored
from lendlens.llm.graph import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
TILE = 1 << 14
BLOCK = 256
QUARTERS = [0xFFFF << shift for shift in (0, 16, 32, 48)]
_PRINTS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("print", pa.int64())])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_TILES = pa.schema([("low", pa.int32()), ("high", pa.int32()), ("prints", pa.binary())])


def shingle_hashes(text: str, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Bytes split at ASCII white space and lower-cased in A-Z only, as the shingles need it."""
    words = text.encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: 1 - shingle_words or None].tolist(), ends[shingle_words - 1 :].tolist())
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """A signed 64-bit integer; bit i is 1 where over half the shingle hashes have it."""
    hashes = shingle_hashes(text, shingle_words)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        octets = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, digest, print`` for every row; a NULL or empty text has print 0."""

    def run(batches):
        for batch in slices(batches):
            ids, digests, texts = (column.to_pylist() for column in batch.columns)
            prints = [fingerprint(text, shingle_words) for text in texts]
            yield batch_of(_PRINTS, [ids, digests, prints])

    rows = docs.select(row_key(docs).alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("key.*", "text").mapInArrow(giving_back(run), "doc_id long, digest binary, print long")


def _tiles(distinct: DataFrame, tile: int) -> DataFrame:
    """Packed sorted runs of fingerprints with their least and largest population count."""

    def pack(batches):
        waiting = np.zeros(0, np.int64)

        def row(prints):
            counts = np.bitwise_count(prints.view(np.uint64))
            return batch_of(_TILES, [[int(counts.min())], [int(counts.max())], [prints.tobytes()]])

        for batch in batches:
            waiting = np.concatenate([waiting, batch.column(0).to_numpy(zero_copy_only=False)])
            while len(waiting) >= tile:
                yield row(waiting[:tile])
                waiting = waiting[tile:]
        if len(waiting):
            yield row(waiting)

    counts = [F.bit_count(F.col("print").bitwiseAND(F.lit(_signed(mask)))) for mask in QUARTERS]
    total = F.bit_count("print")
    keys = [total, counts[0] + counts[1], counts[0], counts[2], F.col("print")]
    ordered = distinct.select("print", *[key.alias(f"k{i}") for i, key in enumerate(keys)])
    ordered = ordered.repartitionByRange(*[f"k{i}" for i in range(len(keys))])
    ordered = ordered.sortWithinPartitions(*[f"k{i}" for i in range(len(keys))])
    packed = ordered.select("print").mapInArrow(giving_back(pack), "low int, high int, prints binary")
    return stored(packed.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Tile pairs whose population counts come within the radius; over tile numbers only."""
    one = tiles.select(
        F.col("tile").alias("a"), F.explode(F.sequence("low", F.col("high"))).alias("count")
    )
    other = tiles.select(
        F.col("tile").alias("b"),
        F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius)).alias("count"),
    )
    near = one.join(other, "count").filter(F.col("a") <= F.col("b")).select("a", "b").distinct()
    left = tiles.select(F.col("tile").alias("a"), F.col("prints").alias("left"))
    right = tiles.select(F.col("tile").alias("b"), F.col("prints").alias("right"))
    pairs = near.join(left, "a").join(right, "b")
    return pairs.repartition("a", "b").select("left", "right", (F.col("a") == F.col("b")).alias("own"))


class _Forest:
    """Roots of the nodes 0..n-1, and the links that joined them."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, one: np.ndarray, other: np.ndarray) -> None:
        differ = self.root[one] != self.root[other]
        one, other = one[differ], other[differ]
        if not len(one):
            return
        n = len(self.root)
        _, first = np.unique(self.root[one] * n + self.root[other], return_index=True)
        above = {}

        def top(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        for i, j in zip(one[first].tolist(), other[first].tolist()):
            r, s = sorted((top(int(self.root[i])), top(int(self.root[j]))))
            if r != s:
                above[s] = r
                self.links.append((i, j))
        target = np.arange(n)
        for s in above:
            target[s] = top(s)
        self.root = target[self.root]


def _boxes(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest quarter counts of each block."""
    counts = np.stack([np.bitwise_count(prints & np.uint64(mask)) for mask in QUARTERS], axis=1)
    cuts = np.arange(0, len(prints), BLOCK)
    counts = counts.astype(np.int16)
    return np.minimum.reduceat(counts, cuts), np.maximum.reduceat(counts, cuts)


def tile_links(left: np.ndarray, right: np.ndarray, own: bool, radius: int) -> list[tuple[int, int]]:
    """A spanning forest (as values) of the links between two tiles, or within one."""
    (low, high), (low2, high2) = _boxes(left), _boxes(right)
    gap = np.maximum(low[:, None] - high2[None], low2[None] - high[:, None])
    near = np.maximum(gap, 0).sum(axis=2) <= radius
    both = left if own else np.concatenate([left, right])
    shift = 0 if own else len(left)
    forest = _Forest(len(both))
    for i, j in np.argwhere(near):
        if own and j < i:
            continue
        one, other = left[i * BLOCK : (i + 1) * BLOCK], right[j * BLOCK : (j + 1) * BLOCK]
        x, y = np.nonzero(np.bitwise_count(one[:, None] ^ other[None]) <= radius)
        forest.add(x + i * BLOCK, y + j * BLOCK + shift)
    values = both.view(np.int64)
    return [(int(values[i]), int(values[j])) for i, j in forest.links]


def _links(pairs: DataFrame, radius: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                left, right, own = (batch.column(i)[row].as_py() for i in range(3))
                found = tile_links(
                    np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), own, radius
                )
                yield batch_of(_EDGES, list(zip(*found)) or [[], []])

    return pairs.mapInArrow(giving_back(run), "a long, b long")


def near_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """``doc_id, fingerprint, component_id``, and ``digest`` of the text and ``component``, for every row.

    The component is named by the smallest ``doc_id`` that can be reached over fingerprints
    differing in at most ``radius`` bits (NULL ids do not name one); ``component`` is its least
    fingerprint, which tells components apart where ids repeat. NULL and empty texts have
    fingerprint zero and are linked like any other; repeated rows share fingerprint and component.
    """
    prints = stored(fingerprints(docs, shingle_words), "prints")
    groups = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first_id")), "print-groups")
    rows = groups.count()
    pairs = _tile_pairs(_tiles(groups.select("print"), tile), radius)
    roots = components(stored(_links(pairs, radius), "forests"))
    rooted = groups.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    rooted = stored(rooted, "rooted", rows)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    least = stored(least, "least-ids", rows)
    named = rooted.join(least, "root").select("print", F.col("root").alias("component"), "component_id")
    return prints.join(stored(named, "named", rows), "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        "digest",
        "component",
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest id (NULL last, equal ids by digest); columns unchanged.

    Rows are told apart by id and text, so texts that share an id, or have none, are each judged by themselves.
    """
    key = F.struct("doc_id", "digest").alias("key")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    groups = near_groups(docs).groupBy("component", "doc_id", "digest").agg(F.count("*").alias("copies"))
    groups = stored(groups, "near-groups")
    first = groups.groupBy("component").agg(F.min(order).alias("first"))
    chosen = groups.join(stored(first, "near-firsts"), "component").filter(
        (F.col("digest") == F.col("first.digest")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    )
    return keep_one_row(docs, stored(chosen.select(key, "copies"), "near-kept"))
