"""Ranked lexical search, term at a time with a limited number of accumulators.

Queries are searched in blocks of bounded size against all documents. A shard of documents holds
the postings of the block's terms. Within a shard the terms of a query are taken rarest first. While a
document that has none of the terms so far could still reach the k-th best score, a posting may open
an accumulator; from then on only the open ones are updated, so their scores are exact. The k-th best
score is the better of the shard's partial one and the final one of the task's earlier shards.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.llm.common import batch_of, pack, slices, stored, unpack

SHARD_BYTES = 16_000_000
SLICE_BYTES = 2_000_000
BLOCK_BYTES = 2_000_000
BEST = 10
NULL_ID = -(2**63)
# Terms are runs of ASCII digits, ASCII letters in lower case and all that is not ASCII.
_TO_TERMS = bytes(
    byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in bytes(range(256)).lower()
)
_SHARDS = pa.schema(
    [
        ("n_docs", pa.int64()),
        ("n_terms", pa.int64()),
        ("terms", pa.list_(pa.int32())),
        ("docs", pa.list_(pa.int64())),
        ("body", pa.binary()),
    ]
)
_SHARDS_DDL = "n_docs long, n_terms long, terms array<int>, docs array<long>, body binary"
_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item int, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TO_TERMS).split()


def _index(numbers: dict[bytes, int]):
    """Shards: ids and lengths of documents, and postings of the numbered terms by term."""

    def run(batches):
        waiting, size = [], 0

        def shard():
            ids, lengths, found, owner = (np.concatenate(part) for part in zip(*_placed(waiting)))
            n_docs = len(ids)
            keys, tf = np.unique(found * n_docs + owner, return_counts=True)
            term, counts = np.unique(keys // n_docs, return_counts=True)
            body = pack(ids, lengths, term, counts, keys % n_docs, tf)
            full = int(np.count_nonzero(lengths))
            return batch_of(_SHARDS, [[full], [int(lengths.sum())], [term.tolist()], [counts.tolist()], [body]])

        for batch in slices(batches, most=SLICE_BYTES):
            ids, texts = (column.to_pylist() for column in batch.columns)
            cut = [terms(text) for text in texts]
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            get = numbers.get
            found = np.array([get(word, -1) for words in cut for word in words], np.int64)
            owner = np.repeat(np.arange(len(cut)), lengths)[found >= 0]
            ids = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            waiting.append((ids, lengths, found[found >= 0], owner))
            size += sum(map(len, texts))
            if size > SHARD_BYTES:
                yield shard()
                waiting, size = [], 0
        if waiting:
            yield shard()

    return run


def _placed(waiting: list):
    start = 0
    for ids, lengths, found, owner in waiting:
        yield ids, lengths, found, owner + start
        start += len(ids)


class Shard:
    def __init__(self, body: bytes, n_docs: int, n_terms: int):
        ids, lengths, term, counts, owner, tf = (part.astype(np.int64) for part in unpack(body))
        self.ids = ids
        if n_terms and 90 * int(lengths.max(initial=0)) * n_docs >= 2**63:
            share = np.array([90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        else:
            share = 90 * lengths * n_docs // max(n_terms, 1)
        m = 100 - 90 + share
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[owner])
        ends = np.cumsum(counts)
        self.postings = {
            number: (owner[end - n : end], impact[end - n : end], int(impact[end - n : end].max()))
            for number, n, end in zip(term.tolist(), counts.tolist(), ends.tolist())
        }

    def accumulate(
        self, query: list[tuple[int, int]], best: int, least: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the documents for (term, weight) pairs, the rarest first, and who has an accumulator.

        Scores of the ``best`` documents are exact, but for documents under ``least``.
        """
        lists = [(weight, *self.postings[term]) for term, weight in query if term in self.postings]
        remaining = sum(weight * most for weight, _, _, most in lists)
        score, opened = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        opens = True
        for weight, owner, impact, most in lists:
            if opens:
                partial = score[opened]
                kth = int(np.partition(partial, -best)[-best]) if len(partial) >= best else 0
                opens = remaining >= max(kth, least)
            if opens:
                opened[owner] = True
            else:
                survives = opened[owner]
                owner, impact = owner[survives], impact[survives]
            score[owner] += weight * impact
            remaining -= weight * most
        return score, opened

    def search(self, query: list[tuple[int, int]], best: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``best`` documents; those that score under ``least`` may be left out."""
        score, _ = self.accumulate(query, best, least)
        found = np.flatnonzero(score > 0)
        if len(found) > best:
            kth = np.partition(score[found], -best)[-best]
            found = found[score[found] >= kth]
        return _first(self.ids[found], score[found], best)


def _first(ids: np.ndarray, scores: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:best]
    return ids[order], scores[order]


def _search(queries: list[list[tuple[int, int]]], n_docs: int, n_terms: int, best: int):
    """The best documents of a task's shards for each query."""

    def run(batches):
        none = np.zeros(0, np.int64)
        tops = [(none, none)] * len(queries)
        for batch in batches:
            for (body,) in zip(batch.column(0).to_pylist()):
                shard = Shard(body, n_docs, n_terms)
                for number, query in enumerate(queries):
                    ids, scores = tops[number]
                    least = int(scores[-1]) if len(scores) == best else 0
                    more, their = shard.search(query, best, least)
                    tops[number] = _first(np.concatenate([ids, more]), np.concatenate([scores, their]), best)
        for number, (ids, scores) in enumerate(tops):
            doc_ids = [None if i == NULL_ID else i for i in ids.tolist()]
            yield batch_of(_FOUND, [[number] * len(ids), doc_ids, scores.tolist()])

    return run


def weight(n_docs: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * docs + 1)))


def _search_block(docs: DataFrame, items: list, best: int) -> DataFrame:
    spark = docs.sparkSession
    cut = [sorted(set(terms(row.text.encode()))) for row in items]
    numbers = {term: number for number, term in enumerate(sorted(set().union(*cut)))}
    shards = stored(docs.mapInArrow(_index(numbers), _SHARDS_DDL), "search-shards")
    total = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    with_term = (
        shards.select(F.explode(F.arrays_zip("terms", "docs")).alias("t"))
        .groupBy("t.terms")
        .agg(F.sum("t.docs").alias("docs"))
    )
    df = {row.terms: row.docs for row in with_term.collect()}  # terms of this block only
    queries = []
    for words in cut:
        known = sorted((df[numbers[word]], numbers[word]) for word in words if numbers[word] in df)
        queries.append([(number, weight(n_docs, n)) for n, number in known])
    found = shards.select("body").mapInArrow(_search(queries, n_docs, n_terms, best), _FOUND_DDL)
    ids = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(items)], "item int, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    # The broadcast side has a row per query of the block, which BLOCK_BYTES bounds.
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item with a score above 0.

    Every row of ``docs`` is a document, also where an id repeats or is NULL; NULL ids come first among
    equal scores. NULL and empty texts have no term: such documents are not found, such items have no
    row. Rows of ``benchmark`` with equal id and text are one item, with equal id and other texts
    several items, each ranked by itself. Empty tables give no row. Texts are read whole; other
    columns are not read. A block holds ``BLOCK_BYTES`` of item texts on average, so what the driver
    and a task hold of the items does not grow; documents are read once per block.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = [
        _search_block(rows, items.filter(block == number).orderBy("item_id", "text").collect(), best)
        for number in range(blocks)
    ]
    return reduce(DataFrame.unionByName, found)
