"""Exact dedup by deterministic block naming; DataFrame operations only.

A text is cut into blocks of ``block_chars`` code points. Equal blocks get one integer name, then
adjacent names are paired and equal pairs get one name, until each document has a single name. Two
documents have the same (level, name) exactly if their texts are equal.

Block contents are shuffled once: distinct blocks gather under their 64-bit hash, are sorted there,
and are numbered. Occurrences then look up names by hash. Where one hash has several contents, the
occurrences of that hash are told apart by content, so a hash collision cannot merge texts.

Names are numbers within sorted partitions of a stored table, so a repeated task gives the same
ones. Hot blocks collapse in the map-side aggregation; the name look-ups are joins of stored
tables, which AQE can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import id_and_text, stored

BLOCK_CHARS = 1024
NO_PARTNER = -1
KEY = ["doc_id", "fold"]


def _blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """A row per block: ``doc_id, fold, n_blocks, pos, block``; an empty text is one empty block."""
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("fold"),
        F.sha2("text", 256).alias("text_sha256"),
        F.when(F.length("text") > 0, cut).otherwise(F.array(F.lit(""))).alias("blocks"),
    )
    return rows.select(
        *KEY,
        "text_sha256",
        F.size("blocks").alias("n_blocks"),
        F.posexplode("blocks").alias("pos", "block"),
    )


def _numbered(distinct: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows in sorted order within hash partitions; stored, so that numbers are final."""
    ranked = distinct.sortWithinPartitions(*order)
    return stored(ranked.withColumn("name", F.monotonically_increasing_id()), name)


def _block_names(blocks: DataFrame, block_hash: Callable[[str], Column]) -> DataFrame:
    """``hash, block, name``; ``block`` is NULL where its hash has one content only."""
    contents = blocks.groupBy(block_hash("block").alias("hash")).agg(
        F.array_sort(F.collect_set("block")).alias("contents")
    )
    distinct = contents.select(
        "hash", F.size("contents").alias("n"), F.posexplode("contents").alias("rank", "block")
    )
    distinct = distinct.select(
        "hash", "rank", F.when(F.col("n") > 1, F.col("block")).alias("block")
    )
    return _numbered(distinct, ["hash", "rank"], "block-names")


def _first_names(docs: DataFrame, block_chars: int, block_hash) -> tuple[DataFrame, DataFrame]:
    """Names of all blocks, and a row per input row with its digest."""
    blocks = _blocks(docs, block_chars)
    places = stored(
        blocks.select(
            *KEY,
            F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256"),
            "n_blocks",
            "pos",
            block_hash("block").alias("hash"),
        ),
        "block-places",
    )
    names = _block_names(blocks, block_hash)
    columns = [*KEY, "n_blocks", "pos", "name"]
    plain = names.filter(F.col("block").isNull()).drop("block")
    found = places.join(plain, "hash").select(*columns)
    ambiguous = names.filter(F.col("block").isNotNull())
    if not ambiguous.isEmpty():
        contents = blocks.withColumn("hash", block_hash("block"))
        found = found.unionByName(contents.join(ambiguous, ["hash", "block"]).select(*columns))
    rows = places.filter(F.col("pos") == 0).select(*KEY, "text_sha256")
    return found, rows


def _next_names(names: DataFrame, level: int) -> DataFrame:
    """Pair neighbours and name the pairs; a last odd name is paired with ``NO_PARTNER``."""
    side = F.col("pos") % 2
    pairs = names.groupBy(
        *KEY,
        F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks"),
        F.floor(F.col("pos") / 2).cast("int").alias("pos"),
    ).agg(
        F.max(F.when(side == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("right"),
    )
    pairs = stored(pairs, f"pairs-{level}")
    distinct = pairs.select("left", "right").distinct()
    dictionary = _numbered(distinct, ["left", "right"], f"pair-names-{level}")
    return pairs.join(dictionary, ["left", "right"]).select(*KEY, "n_blocks", "pos", "name")


def identities(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, block_hash: Callable[[str], Column] = F.xxhash64
) -> DataFrame:
    """``doc_id, text_sha256, level, name`` for every row; (level, name) identifies the text."""
    docs = id_and_text(docs)
    names, rows = _first_names(docs, block_chars, block_hash)
    level, done = 0, None
    while True:
        names = stored(names, f"names-{level}")
        ended = (
            names.filter(F.col("n_blocks") == 1)
            .groupBy(*KEY)
            .agg(F.min("name").alias("name"))
            .select(*KEY, F.lit(level).alias("level"), "name")
        )
        done = ended if done is None else done.unionByName(ended)
        names = names.filter(F.col("n_blocks") > 1)
        if names.isEmpty():
            break
        level += 1
        names = _next_names(names, level)
    named = done.select(F.col("doc_id").alias("_id"), F.col("fold").alias("_fold"), "level", "name")
    same = rows["doc_id"].eqNullSafe(named["_id"]) & (rows["fold"] == named["_fold"])
    return rows.join(named, same).select("doc_id", "text_sha256", "level", "name")


def exact_groups(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, block_hash: Callable[[str], Column] = F.xxhash64
) -> DataFrame:
    """A row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts, the row with the largest ``doc_id`` is kept. A NULL text counts as empty. Rows
    are counted with repetition; where a ``doc_id`` repeats with one text, one of its rows is kept.
    A NULL ``doc_id`` is an id like others, below all numbers. ``doc_id`` repeating with different
    texts gives separate documents. No rows in, no rows out.
    """
    copies = Window.partitionBy("doc_id", "level", "name").orderBy("text_sha256")
    rows = stored(
        identities(docs, block_chars, block_hash).withColumn("copy", F.row_number().over(copies)),
        "identities",
    )
    groups = stored(
        rows.groupBy("level", "name").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "text-groups",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep; columns unchanged."""
    kept = (
        exact_groups(docs)
        .filter("kept")
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    )
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    named = docs.withColumn("_row_sha", sha)
    same = named["doc_id"].cast("long").eqNullSafe(kept["_id"]) & (named["_row_sha"] == kept["_sha"])
    rows = named.join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "_row_sha"]).drop("_row_sha")
