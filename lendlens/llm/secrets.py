"""Secret scans over an incremental blob ledger.

Every text ever seen is addressed by its SHA-256 (a blob). The ledger is an append-only table of
scanned blobs with the rule versions applied and the spans found. A scan reads each distinct blob
once, applies only rule versions that the ledger lacks for it, appends, and joins findings back to
all paths that hold the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, few_files, id_and_text, shuffles_removed, slices, stored
from lendlens.session import scratch_dir


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; shorter ones than ``least`` (of ``group``) are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules. A run of hex digits is maximal, so {32,} finds the same runs.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", 1, r"[0-9a-f]{32,}", least=32),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    # The second alternative passes over a run that is no token, so that it is not tried from every place.
    Rule(
        "web_token",
        2,
        r"(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)|eyJ[A-Za-z0-9_-]*+",
        group=1,
    ),
    Rule("url_password", 1, r"://[^\s/:@]{1,256}:[^\s/@]{1,256}@"),
)
RULES = BASE_RULES + MORE_RULES
LEDGER = "blob binary, scanned array<string>, spans array<struct<rule:string,start:long,end:long>>"
_SPAN = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_ROWS = pa.schema(
    [("blob", pa.binary()), ("scanned", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))]
)


def find_spans(text: str, rule: Rule, compiled: re.Pattern) -> Iterator[tuple[int, int]]:
    for match in compiled.finditer(text):
        found = match.group(rule.group)
        if found is not None and len(found) >= rule.least:
            yield match.span()


def _scanner(rules: Sequence[Rule]):
    def scan(batches):
        compiled = {rule.key: (rule, re.compile(rule.pattern, re.ASCII)) for rule in rules}
        for batch in slices(batches):
            blobs, texts, pending = (column.to_pylist() for column in batch.columns)
            found = [
                [
                    {"rule": key, "start": start, "end": end}
                    for key in keys
                    for start, end in find_spans(text, *compiled[key])
                ]
                for text, keys in zip(texts, pending)
            ]
            yield batch_of(_ROWS, [blobs, pending, found])

    return scan


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def create_ledger(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)


def update_ledger(versions: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger at ``path`` lacks of ``versions`` (a ``text`` per row) and append it.

    A repeated run finds nothing left to scan. A failed run appends nothing, as its files are not
    committed. All tasks scan; what they found is short and goes to few files, as each costs a local file system
    two processes that set its mode.
    """
    spark = versions.sparkSession
    create_ledger(spark, path)
    blobs = (
        versions.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .select(F.unhex(F.sha2("text", 256)).alias("blob"), "text")
        .dropDuplicates(["blob"])
    )
    done = (
        read_ledger(spark, path)
        .select("blob", F.explode("scanned").alias("rule"))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("done"))
    )
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    pending = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    unseen = (
        blobs.join(done, "blob", "left")
        .select("blob", "text", pending.alias("pending"))
        .filter(F.size("pending") > 0)
    )
    scanned = unseen.mapInArrow(_scanner(rules), LEDGER).repartition(few_files(versions.count()))
    with shuffles_removed(spark):
        scanned.write.mode("append").parquet(path)


def scan(docs: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id`` and ``spans`` (rule kind, start, end in code points) for every row.

    A NULL text is empty; an empty text has no spans. Repeated rows are each answered. Spans are
    sorted by start, then by the order of ``rules``, and may overlap between rules.
    """
    docs = id_and_text(docs)
    update_ledger(docs, ledger, rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    current = [rule.key for rule in rules]
    seen = read_ledger(docs.sparkSession, ledger)
    of_blob = seen.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = F.transform(
        F.array_sort(
            F.transform(
                F.filter("spans", lambda s: s["rule"].isin(current)),
                lambda s: F.struct(
                    s["start"].alias("start"),
                    order[s["rule"]].alias("place"),
                    s["end"].alias("end"),
                    s["rule"].alias("rule"),
                ),
            )
        ),
        lambda s: F.struct(kinds[s["rule"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    findings = stored(of_blob.select("blob", spans.alias("spans")), "findings", seen.count())
    paths = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("blob"))
    return paths.join(findings, "blob").select("doc_id", "spans")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts, digest and span list per document, scanned with a new ledger.

    NULL and empty texts have counts of 0 and the digest of an empty text. Repeated rows and NULL ids each
    give a row; an empty table gives none. The rows are short and dealt to few partitions.
    """
    found = scan(docs, scratch_dir(docs.sparkSession, "blob-ledger"))
    base = [rule.kind for rule in BASE_RULES]

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    ).repartition(few_files(docs.count()))
