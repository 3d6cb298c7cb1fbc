"""LM scoring with Brown classes: exchange clustering, class transitions, word emissions.

Texts become packed chunks of word numbers; a chunk lists its distinct words once, by word bucket.
A bucket keeps, for each of its words, the training count and the class. In each round the classes go
to the chunks, which count every word's neighbouring classes and the class bigrams; the counts go back
to the word's bucket, where the word moves to the class with the highest gain in likelihood. A
round moves one slice of the words, as moves of one round do not see each other; gains leave out the
few cells that a word and its own class share. A round after which the corpus likelihood fell is undone.
Words seen fewer than ``LEAST_COUNT`` times in training are one class that no word joins or leaves, as
so few neighbours say nothing about a word. Unseen words are one more word of that class.

The model is P(w | v) = P(class of w | class of v) * P(w | class of w). Transitions are smoothed
towards the share of the class, emissions by adding one, so that both together fall back to the
add-one unigram.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, pack, slices, stored, unpack

CLASSES = 64
ROUNDS = 6
SLICES = 2
NO_PART = SLICES  # the slice of words that never move
LEAST_COUNT = 3
RARE = 0
ALL_STAY = SLICES + 1
SMOOTHING = float(CLASSES)
CHUNK_TOKENS = 2_500_000
SLICE_BYTES = 2_000_000
GAIN_ROWS = 50_000
COUNTED_WORDS = 1 << 15
# The fold that is held out of training.
FOLDS, HELD_OUT = 7, 2
END = b""
NULL_ID = -(2**63)
VOCAB, LINK, CLASS, TEXT, CONTEXT, CELLS, WORDS = range(7)
_ROWS = pa.schema(
    [("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())]
)
_ROWS_DDL = "chunk long, kind int, bucket int, body binary"
_COUNTED = pa.schema([*_ROWS, ("cells", pa.list_(pa.int64()))])
_COUNTED_DDL = f"{_ROWS_DDL}, cells array<long>"
_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
_SCORES_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text leaves the held-out remainder; a NULL id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def _row(chunk: int, kind: int, bucket: int, body: bytes) -> pa.RecordBatch:
    return batch_of(_ROWS, [[chunk], [kind], [bucket], [body]])


def _rows(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns[:4]))


def _cut(buckets: int):
    """A chunk's text row (ids, held out, lengths, word numbers) and one row of words per bucket."""

    def run(batches):
        chunk = TaskContext.get().partitionId() << 33
        numbers, waiting, tokens = _Numbers(), [], 0

        def rows():
            """Words are numbered anew by frequency, so that most numbers are small."""
            ids, held, lengths, found = (np.concatenate(part) for part in zip(*waiting))
            n = len(numbers)
            rank = np.empty(n, np.uint32)
            rank[np.argsort(-np.bincount(found, minlength=n), kind="stable")] = np.arange(n, dtype=np.uint32)
            yield _row(chunk, TEXT, 0, pack(ids, held, lengths, rank[found]))
            training = np.bincount(found[np.repeat(held == 0, lengths)], minlength=n).astype(np.uint64)
            words = list(numbers)
            bucket = np.fromiter((zlib.crc32(word) % buckets for word in words), np.int32, n)
            order = np.lexsort((rank, bucket))
            for members in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                own = [words[i] for i in members]
                sizes = np.fromiter(map(len, own), np.uint32, len(own))
                joined = np.frombuffer(b"".join(own), np.uint8)
                body = pack(rank[members], training[members], sizes, joined)
                yield _row(chunk, LINK, int(bucket[members[0]]), body)

        for batch in slices(batches, most=SLICE_BYTES):
            ids, held, texts = (column.to_pylist() for column in batch.columns)
            found, lengths = [], []
            for text in texts:
                words = text.lower().split()  # bytes: A-Z and ASCII space only
                lengths.append(len(words) + 1)
                found.extend([numbers[word] for word in words])
                found.append(numbers[END])
            ids = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            waiting.append((ids, np.array(held, np.uint8), np.array(lengths), np.array(found, np.uint32)))
            tokens += len(found)
            if tokens > CHUNK_TOKENS:
                yield from rows()
                chunk, numbers, waiting, tokens = chunk + 1, _Numbers(), [], 0
        if waiting:
            yield from rows()

    return run


def _split(sizes: np.ndarray, joined: np.ndarray) -> list[bytes]:
    data, ends = joined.tobytes(), np.cumsum(sizes, dtype=np.int64).tolist()
    return [data[start:end] for start, end in zip([0, *ends], ends)]


def _number(batches):
    """Per bucket: its words' numbers for every chunk, then counts, first classes and slices, and the words."""
    for bucket, rows in groupby(_rows(batches), key=lambda row: row[2]):
        numbers, counts = _Numbers(), np.zeros(1024, np.uint64)
        for chunk, _, _, body in rows:
            codes, training, sizes, joined = unpack(body)
            words = _split(sizes, joined)
            own = np.fromiter((numbers[word] for word in words), np.uint32, len(words))
            if len(numbers) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(numbers) + len(counts), np.uint64)])
            counts[own] += training
            yield _row(chunk, LINK, bucket, pack(codes, own))
        counts = counts[: len(numbers)]
        mixed = np.fromiter((zlib.crc32(word, 1) for word in numbers), np.uint32, len(numbers))
        rare = counts < LEAST_COUNT
        classes = np.where(rare, RARE, RARE + 1 + mixed % (CLASSES - 1))
        part = np.where(rare, NO_PART, mixed // CLASSES % SLICES)
        yield _row(-1, VOCAB, bucket, pack(counts, classes.astype(np.uint8), part.astype(np.uint8)))
        sizes = np.fromiter(map(len, numbers), np.uint32, len(numbers))
        yield _row(-1, WORDS, bucket, pack(sizes, np.frombuffer(b"".join(numbers), np.uint8)))


def _spread(moving: int | None):
    """To each chunk: numbers and classes of its words, with their training counts.

    With a slice in ``moving`` there are numbers in the bucket in place of counts, and the class of a
    word of that slice is marked by an added ``CLASSES``.
    """

    def run(batches):
        counts = marked = None
        for chunk, kind, bucket, body in _rows(batches):
            if kind == VOCAB:
                counts, classes, part = unpack(body)
                marked = classes if moving is None else classes + np.uint8(CLASSES) * (part == moving)
                continue
            codes, own = unpack(body)
            yield _row(chunk, CLASS, bucket, pack(codes, marked[own], counts[own] if moving is None else own))

    return run


def _chunks(batches):
    """Per chunk the columns of its word rows, side by side in the order of word numbers, and its text."""
    for chunk, rows in groupby(_rows(batches), key=lambda row: row[0]):
        parts, buckets = [], []
        for _, kind, bucket, body in rows:
            if kind == CLASS:
                parts.append(unpack(body))
                buckets.append(np.full(len(parts[-1][0]), bucket, np.int32))
                continue
            codes, *columns = (np.concatenate(part) for part in zip(*parts))
            order = np.argsort(codes)
            columns = [column[order] for column in (*columns, np.concatenate(buckets))]
            yield chunk, columns, unpack(body)
            parts = buckets = None


def _pairs(text: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Held-out mark, word and word before it of each place; a text's first word follows an end."""
    _, held, lengths, found = text
    return np.repeat(held, lengths.astype(np.int64)), found, np.concatenate([found[-1:], found[:-1]])


def counted(centre: np.ndarray, classes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells (word times ``CLASSES`` plus its neighbour's class) that occur, sorted, and how often.

    ``COUNTED_WORDS`` words are counted at a time, as a counter for each cell of a chunk's words would be too large.
    """
    keys, counts = [], []
    for start in range(0, words, COUNTED_WORDS):
        own = (centre >= start) & (centre < start + COUNTED_WORDS)
        cells = np.bincount((centre[own] - np.uint32(start)) * np.uint32(CLASSES) + classes[own])
        keys.append(np.flatnonzero(cells))
        counts.append(cells[keys[-1]].astype(np.uint32))
        keys[-1] += start * CLASSES
    return np.concatenate(keys), np.concatenate(counts)


def _count(batches):
    """Class bigrams of a chunk, and for words that may move their neighbours' classes, by bucket."""
    for chunk, (marked, own, buckets), text in _chunks(batches):
        held, word, before = _pairs(text)
        word, before = word[held == 0], before[held == 0]
        classes, moves = marked % np.uint8(CLASSES), marked >= CLASSES
        pairs = classes[before].astype(np.uint16) * np.uint16(CLASSES) + classes[word]
        cells = np.bincount(pairs, minlength=CLASSES * CLASSES)
        del held, pairs, text
        yield batch_of(_COUNTED, [[chunk], [CELLS], [0], [None], [cells.tolist()]])
        sides = []
        for side, (centre, neighbour) in enumerate(((word, before), (before, word))):
            kept = moves[centre]
            keys, counts = counted(centre[kept], classes[neighbour[kept]], len(moves))
            code = keys // CLASSES
            place = (side * CLASSES + keys % CLASSES).astype(np.uint8)
            sides.append((buckets[code], own[code], place, counts))
        bucket, *columns = (np.concatenate(part) for part in zip(*sides))
        order = np.argsort(bucket, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(members):
                body = pack(*(column[members] for column in columns))
                part = [[chunk], [CONTEXT], [int(bucket[members[0]])], [body], [None]]
                yield batch_of(_COUNTED, part)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(cells: np.ndarray) -> float:
    """The part of the corpus log-likelihood that depends on classes."""
    return float(_h(cells).sum() - _h(cells.sum(0)).sum() - _h(cells.sum(1)).sum())


def best_classes(
    contexts: np.ndarray, counts: np.ndarray, classes: np.ndarray, cells: np.ndarray
) -> np.ndarray:
    """The best class of each word; ``contexts`` has its left, then its right classes' counts.

    A word that leaves its class loses what it has there; the gain is the change of the likelihood.
    On equal gains it stays.
    """
    n = counts.astype(np.float64)
    into = cells.sum(0)[None, :] + 0.0
    out_of = cells.sum(1)[None, :] + 0.0
    gain = -(_h(into + n[:, None]) - _h(into)) - (_h(out_of + n[:, None]) - _h(out_of))
    rows = np.arange(len(n))
    stay = -(_h(into[0, classes]) - _h(np.maximum(into[0, classes] - n, 0)))
    stay -= _h(out_of[0, classes]) - _h(np.maximum(out_of[0, classes] - n, 0))
    table = np.concatenate([cells, cells.T])  # a row per left class, then per right class
    word, place = np.nonzero(contexts)
    count = contexts[word, place].astype(np.float64)
    most = int(contexts.max(initial=0)) + 1
    kinds, kind = np.unique(place * most + contexts[word, place], return_inverse=True)
    more = (kinds % most)[:, None].astype(np.float64)
    found = table[kinds // most]
    change = _h(found + more) - _h(found)
    for start in range(0, len(word), GAIN_ROWS):
        part = slice(start, start + GAIN_ROWS)
        own = word[part]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        gain[own[first]] += np.add.reduceat(change[kind[part]], first, axis=0)
    now = table[place, classes[word]]
    stay += np.bincount(word, _h(now) - _h(np.maximum(now - count, 0)), len(n))
    gain[:, RARE] = -np.inf
    gain[rows, classes] = stay
    best = gain.argmax(axis=1)
    better = gain[rows, best] > stay + 1e-9 * np.abs(stay)
    return np.where(better, best, classes).astype(np.uint8)


def _exchange(cells: np.ndarray, moving: int):
    """Per bucket: neighbours of a slice's words over all chunks, then these words' new classes."""

    def run(batches):
        for bucket, rows in groupby(_rows(batches), key=lambda row: row[2]):
            counts, classes, part = map(np.array, unpack(next(rows)[3]))
            at = np.flatnonzero(part == moving)
            row_of = np.zeros(len(counts), np.int64)
            row_of[at] = np.arange(len(at))
            contexts = np.zeros((len(at), 2 * CLASSES), np.int64)
            for _, _, _, body in rows:
                own, place, n = unpack(body)
                contexts[row_of[own], place] += n  # a chunk has each (word, place) once
            classes[at] = best_classes(contexts, counts[at], classes[at], cells)
            yield _row(-1, VOCAB, bucket, pack(counts, classes, part))

    return run


def _totals(batches):
    """Training tokens and words seen in training, by class, of a bucket."""
    for _, _, _, body in _rows(batches):
        counts, classes, _ = unpack(body)
        n = np.bincount(classes, counts.astype(np.float64), CLASSES).astype(np.int64)
        kinds = np.bincount(classes[counts > 0], minlength=CLASSES)
        yield batch_of(pa.schema([("cells", pa.list_(pa.int64()))]), [[[*n.tolist(), *kinds.tolist()]]])


def _sums(rows: DataFrame, size: int) -> np.ndarray:
    """Sums of an array column by position, of fixed length ``size``: all that the driver gets."""
    summed = rows.select(F.posexplode("cells")).groupBy("pos").agg(F.sum("col").alias("n"))
    sums = np.zeros(size)
    for row in summed.collect():
        sums[row.pos] = row.n
    return sums


def _score(cells: np.ndarray, totals: np.ndarray):
    members = totals[:CLASSES] + totals[CLASSES:]
    members[RARE] += 1  # the unseen word
    share = members / members.sum()
    with np.errstate(divide="ignore"):  # a class without a word is never used
        moves = np.log10((cells + SMOOTHING * share) / (cells.sum(1, keepdims=True) + SMOOTHING))
        in_class = np.log10(members)
    size = members.sum()

    def run(batches):
        for _, (classes, counts, _), text in _chunks(batches):
            held, word, before = _pairs(text)
            count = np.log10(counts.astype(np.float64) + 1)
            base = count - np.log10(size)
            emitted = count - in_class[classes]
            ids, out, lengths, _ = text
            starts = np.cumsum(lengths, dtype=np.int64) - lengths.astype(np.int64)
            score = moves[classes[before], classes[word]] + emitted[word]
            known = np.add.reduceat((counts > 0)[word].astype(np.int64), starts)
            doc_ids = [None if i == NULL_ID else i for i in ids.view(np.int64).tolist()]
            columns = [lengths.astype(np.int64), known, np.add.reduceat(base[word], starts), np.add.reduceat(score, starts)]
            yield batch_of(_SCORES, [doc_ids, out.astype(bool), *columns])

    return run


def _by(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key, "kind", "chunk")


@dataclass(frozen=True)
class ClassModel:
    """What was learned, beside the texts that it was learned from and that it scores."""

    texts: DataFrame
    links: DataFrame
    words: DataFrame
    vocab: DataFrame
    cells: np.ndarray  # training bigrams of classes
    totals: np.ndarray  # training tokens, then words seen in training, of each class

    def at_chunks(self, part: int | None) -> DataFrame:
        """Chunks with the classes of their words, and words of slice ``part`` marked, or counts."""
        spread = _by(self.links.unionByName(self.vocab), "bucket").mapInArrow(_spread(part), _ROWS_DDL)
        return _by(spread.unionByName(self.texts), "chunk")

    def word_classes(self) -> DataFrame:
        """``word`` (its bytes; the end is empty), ``n`` in training and ``class``; unseen words left out."""
        rows = _by(self.vocab.unionByName(self.words), "bucket")
        return rows.mapInArrow(_word_classes, "word binary, n long, class int")

    def scores(self) -> DataFrame:
        """A row per text, as ``score_texts`` has it."""
        scored = self.at_chunks(None).mapInArrow(_score(self.cells, self.totals), _SCORES_DDL)
        mean = F.col("score") / F.col("n_tokens")
        return scored.select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(int(self.totals[:CLASSES].sum())).cast("long").alias("train_tokens"),
            "base_score",
            "score",
            F.pow(F.lit(10.0), -mean).alias("perplexity"),
        )


def _word_classes(batches):
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("class", pa.int32())])
    counts = classes = None
    for _, kind, _, body in _rows(batches):
        if kind == VOCAB:
            counts, classes, _ = unpack(body)
            continue
        words, seen = _split(*unpack(body)), np.flatnonzero(counts)
        yield batch_of(schema, [[words[i] for i in seen], counts[seen], classes[seen]])


def learn(docs: DataFrame, rounds: int = ROUNDS) -> ClassModel:
    """Counts of all training texts, and word classes after ``rounds`` rounds of exchange."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held"), text.alias("text"))
    cut = stored(rows.mapInArrow(_cut(buckets), _ROWS_DDL), "lm-chunks")
    words = _by(cut.filter(F.col("kind") == LINK), "bucket")
    numbered = stored(words.mapInArrow(_number, _ROWS_DDL), "lm-words")
    model = ClassModel(
        cut.filter(F.col("kind") == TEXT),
        *[numbered.filter(F.col("kind") == kind) for kind in (LINK, WORDS, VOCAB)],
        np.zeros(0),
        np.zeros(0),
    )
    best = None

    def bigrams(rows: DataFrame) -> np.ndarray:
        cells = _sums(rows.filter(F.col("kind") == CELLS), CLASSES * CLASSES)
        return cells.reshape(CLASSES, CLASSES)

    for turn in range(rounds):
        part = turn % SLICES
        found = stored(model.at_chunks(part).mapInArrow(_count, _COUNTED_DDL), "lm-counts")
        cells = bigrams(found)
        if best and likelihood(cells) < likelihood(best.cells):
            model = best
            continue
        best = replace(model, cells=cells)
        contexts = found.filter(F.col("kind") == CONTEXT).drop("cells")
        moved = _by(model.vocab.unionByName(contexts), "bucket").mapInArrow(_exchange(cells, part), _ROWS_DDL)
        model = replace(model, vocab=stored(moved, "lm-classes"))
    cells = bigrams(model.at_chunks(ALL_STAY).mapInArrow(_count, _COUNTED_DDL))
    model = best if best and likelihood(cells) < likelihood(best.cells) else replace(model, cells=cells)
    totals = _sums(model.vocab.mapInArrow(_totals, "cells array<long>"), 2 * CLASSES)
    return replace(model, totals=totals)


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` per row.

    A NULL text is empty; an empty text has one token, its end. A NULL id is in training. Repeated
    rows each count and each give a row; other columns are not read. An empty table gives no row,
    and with nothing to learn from every score is 0 and every perplexity 1. A chunk ends at a text's end
    after ``CHUNK_TOKENS`` tokens, so a longer text is a chunk of its own. There are as many
    buckets as shuffle partitions; a bucket holds the counts of its distinct words.
    """
    return learn(docs, rounds).scores()
