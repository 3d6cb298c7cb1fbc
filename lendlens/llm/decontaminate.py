"""Benchmark decontamination by template canonicalisation; DataFrame operations only.

Numbers, names and units become typed placeholders, so a question with other values has the same
template. A document's capitalised word is a name in its template, and each window of five template
words has one hash. An item's window has a hash for each choice of its words that a document may have
in capitals, so the few items carry all forms and the many documents one. A window of
placeholders alone would match anything; it keeps its own words.

A document that has most windows of an item is a candidate. For candidates, windows are aligned by
position, and a window counts only if its words and the values in its slots agree: along one
alignment, equal values of the item stand for equal values in the document. A shorter item is one
window. What is left must still cover the item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import counted_small, row_key, stored

WINDOW = 5
LEAST_COVER = 0.8
LEAST_WORDS = 3
LITERAL_WORDS = 2
BROADCAST_HASHES = 2_000_000
# Placeholder marks (private-use characters) and unit words.
NUMBER, UNIT, NAME, MAYBE, AFTER_MARKS = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"
UNITS = (
    "km|kilometers?|kilometres?|cm|mm|m|meters?|metres?|miles?|feet|foot|ft|inch(?:es)?|yards?|kg|"
    "kilograms?|mg|g|grams?|lbs?|pounds?|oz|ounces?|tons?|ml|l|liters?|litres?|gallons?|seconds?|"
    "minutes?|hours?|days?|weeks?|months?|years?|percent|dollars?|cents?|euros?|mph|degrees?"
)
_NAME = r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{M}])"
_CAPITAL = rf"(?<![{NUMBER}-{MAYBE}\p{{L}}\p{{M}}])(\p{{Lu}}[\p{{L}}\p{{M}}]*)"
_NUMBER = r"(\p{N}+(?:[.,]\p{N}+)*)"
_UNIT = rf"(?i)(?<=\p{{N}} )\s*({UNITS})(?![\p{{L}}\p{{M}}])"
_VALUE = rf"{NUMBER}\p{{N}}+(?:[.,]\p{{N}}+)*|[{UNIT}-{MAYBE}][\p{{L}}\p{{M}}]+|[\p{{L}}\p{{M}}]+"


def _values(text: Column, names: str | None, capitals: str) -> Column:
    """Words in lower case, with a mark before those that are values."""
    text = F.translate(text, f"{NUMBER}{UNIT}{NAME}{MAYBE}", "    ")
    if names:
        text = F.regexp_replace(text, _NAME, f"{names}$1")
    text = F.regexp_replace(text, _NUMBER, f" {NUMBER}$1 ")
    text = F.regexp_replace(text, _UNIT, f"{UNIT}$1")
    text = F.regexp_replace(text, _CAPITAL, f"{capitals}$1")
    return F.regexp_extract_all(F.lower(text), F.lit(_VALUE), F.lit(0))


def _mark(word: Column) -> Column:
    return F.substring(word, 1, 1)


def _is_marked(word: Column) -> Column:
    return (word >= NUMBER) & (word < AFTER_MARKS)


def _is_fixed(word: Column) -> Column:
    """A number or unit: never another form."""
    return _mark(word).isin(NUMBER, UNIT)


def _bare(word: Column) -> Column:
    """A word without its mark; the mark of a number or unit."""
    word_only = F.when(_is_marked(word), word.substr(F.lit(2), F.length(word))).otherwise(word)
    return F.when(_is_fixed(word), _mark(word)).otherwise(word_only)


def _key(word: Column) -> Column:
    """A value that compares: names and other words alike, whatever their case was."""
    return F.when(_is_fixed(word), word).otherwise(F.concat(F.lit(NAME), _bare(word)))


def _own_words(words: list[Column]) -> Column:
    """The hash of a window by its words, where it has placeholders only."""
    return F.xxhash64(F.lit("words"), *map(_bare, words))


def _document_words(text: Column) -> Column:
    """``values`` and ``template``: the latter has a mark alone for a value."""
    return _values(text, None, NAME)


def _template(values: Column) -> Column:
    return F.transform(values, lambda w: F.when(_is_marked(w), _mark(w)).otherwise(w))


def _document_windows(values: Column, template: Column, width: int) -> Column:
    """One hash per window; empty where there are too few words."""

    def at(i: Column) -> Column:
        own = [F.get(template, i + k) for k in range(width)]
        only_marks = reduce(lambda a, b: a & b, map(_is_marked, own))
        words = _own_words([F.get(values, i + k) for k in range(width)])
        return F.when(only_marks, words).otherwise(F.xxhash64(*own))

    places = F.sequence(F.lit(0), F.size(template) - width)
    return F.when(F.size(template) >= width, F.transform(places, at)).otherwise(
        F.array().cast("array<bigint>")
    )


def _item_forms(values: Column, width: int) -> Column:
    """For each window of an item the hashes of all documents' windows that may mean the same."""

    def at(i: Column) -> Column:
        own = [F.get(values, i + k) for k in range(width)]
        fixed = reduce(lambda a, b: a + b, [_is_fixed(w).cast("int") * (1 << k) for k, w in enumerate(own)])

        def form(chosen: Column) -> Column:
            return F.xxhash64(
                *[F.when(chosen.bitwiseAND(1 << k) != 0, NAME).otherwise(_bare(w)) for k, w in enumerate(own)]
            )

        every = (1 << width) - 1
        choices = F.filter(
            F.sequence(F.lit(0), F.lit(every)),
            lambda chosen: (chosen.bitwiseAND(fixed) == 0) & (chosen.bitwiseOR(fixed) != every),
        )
        return F.concat(F.transform(choices, form), F.array(_own_words(own)))

    places = F.sequence(F.lit(0), F.size(values) - width)
    return F.when(F.size(values) >= width, F.transform(places, at)).otherwise(
        F.array().cast("array<array<bigint>>")
    )


def _item_windows(benchmark: DataFrame, least_words: int) -> DataFrame:
    """``item, n_windows, width, at, hash, values, strict, semi``; strict items have too few literal
    words, semi-strict ones without those that may be names.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    items = items.withColumn("item", F.struct("item_id", F.sha2("text", 256).alias("digest")))
    items = items.select("item", _values(F.col("text"), NAME, MAYBE).alias("values")).distinct()
    items = items.filter(F.size("values") >= least_words)
    literal = F.size(F.filter("values", lambda w: ~_is_marked(w)))
    maybe = F.size(F.filter("values", lambda w: _mark(w) == MAYBE))
    items = items.withColumn("width", F.least(F.size("values"), F.lit(WINDOW)))
    forms = F.array().cast("array<array<bigint>>")
    for width in range(max(least_words, 1), WINDOW + 1):
        forms = F.when(F.col("width") == width, _item_forms(F.col("values"), width)).otherwise(forms)
    windows = items.select(
        "item",
        (F.size("values") - F.col("width") + 1).alias("n_windows"),
        (literal + maybe < LITERAL_WORDS).alias("strict"),
        (literal < LITERAL_WORDS).alias("semi"),
        "values",
        "width",
        F.posexplode_outer(forms).alias("at", "forms"),
    )
    windows = windows.withColumn("hash", F.explode_outer(F.array_distinct("forms"))).drop("forms")
    return stored(
        windows.withColumn("values", F.slice("values", F.col("at") + 1, F.col("width"))), "item-windows"
    )


def _candidates(docs: DataFrame, items: DataFrame, widths: list[int], least_cover: float) -> DataFrame:
    """Documents with at least the share ``least_cover`` of an item's windows, at any place.

    A window that has several forms in a document may count for each here. The few document windows
    that an item has are found first, by the hashes alone: up to ``BROADCAST_HASHES`` of them, counted here,
    are broadcast (8 bytes each); with more, the join shuffles.
    """
    words = docs.select("key", _document_words(F.col("text")).alias("values"))
    words = words.select("key", "values", _template(F.col("values")).alias("template"))
    hashes = F.flatten(
        F.array(*[_document_windows(F.col("values"), F.col("template"), width) for width in widths])
    )
    # Not explode(): Spark would filter on the array's size first, and for that compute it anew from the
    # text, with the words once per window. The join leaves out the NULL of a text without windows.
    hashes = words.select("key", F.explode_outer(hashes).alias("hash"))
    wanted = items.groupBy("hash", "item", "n_windows").agg(F.count("*").alias("places"))
    known = stored(items.select("hash").distinct(), "item-hashes")
    found = hashes.join(counted_small(known, BROADCAST_HASHES), "hash", "left_semi").join(stored(wanted, "wanted-windows"), "hash")
    # The join keeps little; a window that a document repeats is combined in the map task.
    distinct = found.groupBy("key", "item", "n_windows", "hash").agg(F.first("places").alias("places"))
    covered = distinct.groupBy("key", "item", "n_windows").agg(F.sum("places").alias("covered"))
    return covered.filter(F.col("covered") >= least_cover * F.col("n_windows")).select("key", "item")


def _aligned(words: DataFrame, items: DataFrame, pairs: DataFrame, widths: list[int]) -> DataFrame:
    """Equal windows of candidate pairs with the slots that must agree along an alignment."""
    places = None
    for width in widths:
        hashes = _document_windows(F.col("doc_values"), F.col("template"), width)
        one = words.select("key", "doc_values", F.posexplode_outer(hashes).alias("place", "hash"))
        one = one.select("key", F.slice("doc_values", F.col("place") + 1, width).alias("doc_values"), "place", "hash")
        places = one if places is None else places.unionByName(one)
    rows = places.join(pairs, "key").join(items, ["item", "hash"]).select(
        "key",
        "item",
        "n_windows",
        "strict",
        "semi",
        "at",
        (F.col("place") - F.col("at")).alias("line"),
        F.arrays_zip(F.col("values").alias("item_values"), "doc_values").alias("both"),
    )
    # An item's own word has to be the document's, whatever its case there.
    rows = rows.filter(
        F.forall("both", lambda s: _is_marked(s["item_values"]) | (_bare(s["item_values"]) == _bare(s["doc_values"])))
    )

    def slot(s: Column) -> Column:
        other = _key(s["item_values"]) != _key(s["doc_values"])
        maybe = _mark(s["item_values"]) == MAYBE
        return F.struct(
            _key(s["item_values"]).alias("value"),
            _key(s["doc_values"]).alias("doc_value"),
            (other & (F.col("strict") | (F.col("semi") & maybe))).alias("other"),
        )

    def bound(s: Column) -> Column:
        """A word that may be a name is a slot where the document has another word."""
        other = _key(s["item_values"]) != _key(s["doc_values"])
        return _mark(s["item_values"]).between(NUMBER, NAME) | ((_mark(s["item_values"]) == MAYBE) & other)

    slots = F.transform(F.filter("both", bound), slot)
    return stored(rows.withColumn("slots", slots).drop("strict", "semi", "both").distinct(), "alignments")


def findings(
    docs: DataFrame,
    benchmark: DataFrame,
    least_cover: float = LEAST_COVER,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``key, item, n_windows, n_covered``: a row per contaminated text under an id, and item."""
    docs = docs.select(row_key(docs).alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = _item_windows(benchmark, least_words)
    widths = sorted(row.width for row in items.select("width").distinct().collect()) or [WINDOW]
    pairs = stored(_candidates(docs, items, widths, least_cover), "leak-candidates")
    wanted = counted_small(stored(pairs.select("key").distinct(), "candidate-rows"))
    texts = docs.join(wanted, "key", "left_semi").dropDuplicates(["key"])
    words = texts.select("key", _document_words(F.col("text")).alias("doc_values"))
    words = words.select("key", "doc_values", _template(F.col("doc_values")).alias("template"))
    aligned = _aligned(words, items, pairs, widths)
    line = ["key", "item", "line"]
    slots = aligned.select(*line, F.explode_outer("slots").alias("slot")).select(*line, "slot.*")
    bad = (
        slots.groupBy(*line, "value")
        .agg(
            F.min("doc_value").alias("least"),
            F.max("doc_value").alias("most"),
            F.max("other").alias("other"),
        )
        .filter((F.col("least") != F.col("most")) | F.col("other"))
        .groupBy(*line)
        .agg(F.collect_set("value").alias("bad"))
    )
    consistent = aligned.join(bad, line, "left").filter(
        F.col("bad").isNull() | ~F.arrays_overlap("slots.value", "bad")
    )
    return (
        consistent.groupBy("key", "item", "n_windows")
        .agg(F.count_distinct("at").alias("n_covered"))
        .filter(F.col("n_covered") >= least_cover * F.col("n_windows"))
    )


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least_cover: float = LEAST_COVER,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id, item_id, n_windows, n_covered, cover``: a row per contaminated document and item.

    Documents without a finding have no row. NULL and empty texts have no window and are never
    found. Items of fewer than ``least_words`` words are not searched, as they would be found everywhere;
    other items of under five words are one window. An item with under two literal words is found
    only with its own values. Repeated rows give one finding, and so do several texts under one id;
    a NULL ``doc_id`` is an id like others. Texts are searched whole. Empty tables give no row; other columns
    are not read.
    """
    return (
        findings(docs, benchmark, least_cover, least_words)
        .groupBy(F.col("key.doc_id").alias("doc_id"), F.col("item.item_id").alias("item_id"))
        .agg(F.max("n_windows").cast("long").alias("n_windows"), F.max("n_covered").alias("n_covered"))
        .withColumn("cover", F.round(F.col("n_covered") / F.col("n_windows"), 6))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns unchanged.

    A row goes by its own text: another row of its id, or of a NULL id, does not take it along.
    """
    found = findings(docs, benchmark).select(F.col("key").alias("_found_key")).distinct()
    found = counted_small(stored(found, "leaking-rows"))
    return docs.join(found, row_key(docs) == F.col("_found_key"), "left_anti")
