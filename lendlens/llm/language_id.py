"""Language ID by interpolated Kneser-Ney character models, one per language.

Character 4-grams of a sample of labelled training rows, bounded for each language, are counted in
Spark. All counts make the models: highest-order counts, and below them counts of distinct left contexts. Each order is one sorted array of n-gram
hashes with a column per language. A text goes to the language with the lowest cross-entropy per
character. It is rejected if that exceeds the language's training level by more than its length
explains; the level and spread come from the calibration fold, pooled where a language has few rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, counted_small, giving_back, row_key, slices, stored

ORDER = 4
DISCOUNT = 0.75
REJECT_SPREADS = 16.0
CALIBRATION_CHARS = 400
LEAST_CALIBRATION = 30
UNKNOWN = "und"
FLUSH_GRAMS = 500_000
FIT_CHARS = 10_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NOT_LETTERS = re.compile(r"[\W\d_]+")
# What the pattern above leaves beside letters: numbers such as one half or a circled two.
_OTHER_NUMBERS = "".join(c for c in map(chr, range(0x80, 0x110000)) if c.isalnum() and not c.isalpha())
_OTHER_NUMBERS = re.compile(f"[ {_OTHER_NUMBERS}]+")
_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])
_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("fold", pa.int64()),
        ("lang", pa.string()),
        ("n_chars", pa.int64()),
        ("lang_pred", pa.string()),
        ("entropy", pa.float64()),
        ("score", pa.float64()),
    ]
)
_SCORES_DDL = (
    "doc_id long, digest binary, fold long, lang string, n_chars long, lang_pred string, "
    "entropy double, score double"
)


def letters(text: str | None) -> str:
    """Lower-case letters with one space around each word; empty if there is no letter."""
    kept = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not kept.replace(" ", "").isalpha():  # in few texts
        kept = _OTHER_NUMBERS.sub(" ", kept).strip()
    return f"{kept} " if kept else ""


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after ORDER - 1 spaces, and the places that are predicted."""
    pad = " " * (ORDER - 1)
    joined = "".join(pad + text for text in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + len(pad)
    places = np.ones(len(codes), bool)
    starts = np.cumsum(lengths) - lengths
    for i in range(len(pad)):
        places[starts + i] = False
    return codes.astype(np.uint64), np.flatnonzero(places)


def _hashes(codes: np.ndarray, ends: np.ndarray, order: int, skip: int = 0) -> np.ndarray:
    """Hashes of the ``order`` characters that end ``skip`` before ``ends``."""
    value = np.zeros(len(ends), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(order - 1 + skip, skip - 1, -1):
            value = (value + codes[ends - back] + np.uint64(1)) * _MIX
            value ^= value >> np.uint64(29)
    return value


def _count(batches):
    counts: dict[str, Counter] = {}

    def rows():
        for lang, grams in counts.items():
            yield batch_of(_COUNTS, [[lang] * len(grams), list(grams), list(grams.values())])

    for batch in slices(batches):
        langs, texts = (column.to_pylist() for column in batch.columns)
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts):
            if kept := letters(text):
                by_lang.setdefault(lang, []).append(kept)
        for lang, kept in by_lang.items():
            codes, ends = _codes(kept)
            number, unique = pd.factorize(_hashes(codes, ends, ORDER))
            last = np.zeros(len(unique), np.int64)
            last[number] = ends
            n = np.bincount(number)
            grams = np.stack([codes[last - back] for back in range(ORDER - 1, -1, -1)], axis=1)
            named = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            into = counts.setdefault(lang, Counter())
            into.update({named[i * ORDER : (i + 1) * ORDER]: int(k) for i, k in enumerate(n)})
        if sum(map(len, counts.values())) > FLUSH_GRAMS:
            yield from rows()
            counts.clear()
    yield from rows()


class Models:
    """Kneser-Ney tables of all languages; n-gram hashes of each order in one sorted array."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        self.prob: list[tuple[np.ndarray, np.ndarray]] = []
        self.rest: list[tuple[np.ndarray, np.ndarray]] = []
        counts = Counter({(lang, gram): n for lang, gram, n in rows})
        alphabet = {gram[-1] for _, gram, _ in rows}
        self.floor = 1.0 / (len(alphabet) + 1)
        for order in range(ORDER, 0, -1):
            self._add(counts, order)
            shorter = Counter((lang, gram[1:]) for lang, gram in counts)
            counts = shorter

    def _add(self, counts: Counter, order: int) -> None:
        total, kinds = Counter(), Counter()
        for (lang, gram), n in counts.items():
            total[lang, gram[:-1]] += n
            kinds[lang, gram[:-1]] += 1
        self.prob.append(
            self._table({k: (n - DISCOUNT) / total[k[0], k[1][:-1]] for k, n in counts.items()}, order, 0.0)
        )
        self.rest.append(
            self._table({k: DISCOUNT * kinds[k] / n for k, n in total.items()}, order - 1, 1.0)
        )

    def _table(self, values: dict, order: int, default: float) -> tuple[np.ndarray, np.ndarray]:
        grams = sorted({gram for _, gram in values})
        text = "".join(grams).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(text, np.uint32).astype(np.uint64)
        ends = np.arange(1, len(grams) + 1) * order - 1
        keys = _hashes(codes, ends, order)
        columns = np.full((len(grams) + 1, len(self.langs)), default)
        row, column = {g: i for i, g in enumerate(grams)}, {x: i for i, x in enumerate(self.langs)}
        for (lang, gram), value in values.items():
            columns[row[gram], column[lang]] = value
        order_of = np.argsort(keys)
        return keys[order_of], np.concatenate([columns[order_of], columns[-1:]])

    @staticmethod
    def _look_up(found: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
        sorted_keys, columns = found
        at = np.searchsorted(sorted_keys, keys)
        at[at == len(sorted_keys)] = 0
        return columns[np.where(sorted_keys[at] == keys, at, len(sorted_keys))]

    def log_probs(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Natural logarithms, a row per place and a column per language."""
        p = self.floor
        for order, prob, rest in zip(range(1, ORDER + 1), self.prob[::-1], self.rest[::-1]):
            seen = self._look_up(prob, _hashes(codes, ends, order))
            p = seen + self._look_up(rest, _hashes(codes, ends, order - 1, skip=1)) * p
        return np.log(p)

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Nats per character of non-empty prepared texts, for each language."""
        codes, ends = _codes(texts)
        number, unique = pd.factorize(_hashes(codes, ends, ORDER))
        last = np.zeros(len(unique), np.int64)
        last[number] = ends
        logs = self.log_probs(codes, last).astype(np.float32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(lengths) - lengths
        sums = [np.add.reduceat(logs[:, i][number], starts, dtype=np.float64) for i in range(logs.shape[1])]
        return -np.stack(sums, axis=1) / lengths[:, None]


# Remainders of a fold. Fit and calibration share the labelled rows.
HELD_OUT, CALIBRATION = 2, 3


def fold(docs: DataFrame) -> Column:
    """crc32 of the id's text, modulo 4; a NULL id counts as an empty text."""
    text = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4


def train(docs: DataFrame) -> Models:
    """Fit on a sample of the labelled rows of the two fitting folds, about ``FIT_CHARS`` characters a language.

    A language with less is used whole; of others, rows are drawn by a hash of id and text. So the
    number of n-grams that the driver and each task hold has a bound for each language, whatever the input. All n-grams
    of the sample are kept.
    """
    fitting = ~fold(docs).isin(HELD_OUT, CALIBRATION)
    labelled = docs.filter(fitting & F.col("lang").isNotNull()).select(
        "doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")
    )
    sizes = labelled.groupBy("lang").agg((FIT_CHARS / F.sum(F.length("text"))).alias("share"))
    sizes = stored(sizes, "language-shares")  # a row per language
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) < F.col("share") * (1 << 32)
    sample = labelled.join(sizes, "lang").filter(drawn)
    counts = (
        sample.select("lang", "text")
        .mapInArrow(giving_back(_count), "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    return Models([tuple(row) for row in counts.collect()])


def _score(models: Models):
    def run(batches):
        for batch in slices(batches):
            ids, digests, folds, langs, texts = (column.to_pylist() for column in batch.columns)
            kept = [letters(text) for text in texts]
            full = [i for i, text in enumerate(kept) if text and models.langs]
            best = [(UNKNOWN, None, 0.0)] * len(ids)
            if full:
                entropy = models.entropies([kept[i] for i in full])
                lengths = np.array([len(kept[i]) for i in full])
                least = entropy.min(axis=1)
                away = (entropy - least[:, None]) * np.minimum(lengths, 100)[:, None]
                share = 1 / np.exp(-away).sum(axis=1)
                for i, k, e, s in zip(full, entropy.argmin(axis=1), least, share):
                    best[i] = (models.langs[k], float(e), float(s))
            lengths = [len(text) for text in kept]
            yield batch_of(_SCORES, [ids, digests, folds, langs, lengths, *map(list, zip(*best))])

    return giving_back(run)


def _levels(scored: DataFrame, langs: list[str]) -> DataFrame:
    """``lang_pred, level, spread`` of every language, from the rows that the calibration fold has right.

    With under ``LEAST_CALIBRATION`` of them a language's spread is the pooled one at least; with
    none its level is the highest of all. With so few over all languages, the level of such a
    language is NULL and rejects nothing.
    """
    learned = scored.filter((F.col("fold") == CALIBRATION) & (F.col("lang") == F.col("lang_pred")))
    weight = F.least("n_chars", F.lit(CALIBRATION_CHARS))
    entropy = F.col("entropy")
    level = F.avg(entropy)
    square = F.avg(entropy * entropy * weight) - 2 * level * F.avg(entropy * weight) + level * level * F.avg(weight)
    own = learned.groupBy("lang_pred").agg(
        F.count("*").alias("n"), level.alias("level"), F.greatest(square, F.lit(0.0)).alias("square")
    )
    own = stored(own, "language-own-levels")
    pooled = own.agg(
        F.sum("n").alias("all_n"),
        F.max("level").alias("top"),
        (F.sum(F.col("n") * F.col("square")) / F.sum("n")).alias("pooled"),
    )
    names = own.sparkSession.createDataFrame([(lang,) for lang in langs], "lang_pred string")
    few = F.coalesce(F.col("n"), F.lit(0)) < LEAST_CALIBRATION
    known = ~few | (F.col("all_n") >= LEAST_CALIBRATION)
    return names.join(own, "lang_pred", "left").crossJoin(pooled).select(
        "lang_pred",
        F.when(known, F.coalesce("level", "top")).alias("level"),
        F.sqrt(F.when(few, F.greatest("square", "pooled")).otherwise(F.col("square"))).alias("spread"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, entropy, rejected`` and the text's ``digest`` for every row.

    ``lang_pred`` is a learned language, or ``und`` (score 0, rejected) where the text is NULL or
    has no letter, or nothing could be learned. Ties go to the first language by name. Whole texts
    are scored. Repeated rows get equal answers. ``lang`` is used to train and calibrate only. A NULL id
    counts as an empty one in its fold. An empty table gives no row; other columns are not read.
    """
    key = row_key(docs)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        key["digest"].alias("digest"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    models = train(docs)
    rows = docs.select("doc_id", "digest", fold(docs).alias("fold"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    scored = stored(rows.mapInArrow(_score(models), _SCORES_DDL), "language-scores")
    spread = _levels(scored, models.langs)
    limit = F.col("level") + REJECT_SPREADS * F.col("spread") / F.sqrt(F.least("n_chars", F.lit(CALIBRATION_CHARS)))
    spread = stored(spread, "language-levels")  # a row per language; small ones are broadcast
    return scored.join(spread, "lang_pred", "left").select(
        "doc_id",
        (F.col("fold") == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
        "entropy",
        ((F.col("lang_pred") == UNKNOWN) | F.coalesce(F.col("entropy") > limit, F.lit(False))).alias("rejected"),
        "digest",
    )


def drop_unknown(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`identify` rejects; columns unchanged.

    A row goes by its own text: another row of its id, or of a NULL id, does not take it along.
    """
    rejected = identify(docs).filter("rejected").select(F.struct("doc_id", "digest").alias("_rejected_key"))
    rejected = counted_small(stored(rejected.distinct(), "rejected-rows"))
    return docs.join(rejected, row_key(docs) == F.col("_rejected_key"), "left_anti")
