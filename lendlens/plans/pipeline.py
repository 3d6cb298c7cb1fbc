"""The batch flow: raw loans -> scored -> RAW -> CLEAN -> ANALYTICS."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lendlens.operators.clean_layer import clean_layer
from lendlens.operators.cleaning import clean
from lendlens.operators.features import add_features
from lendlens.operators.scoring import add_risk_score
from lendlens.plans.marts import MARTS, row_counts
from lendlens.schema import DEFAULT_MODEL, ScoreModel
from lendlens.sources.layers import LOANS, LayerStore

SCORED_VIEW = "loans_scored"
REJECTS = "loan_rejects"


def score_loans(raw: DataFrame, model: ScoreModel = DEFAULT_MODEL) -> DataFrame:
    """Clean, add features, score: one lazy plan with a single shuffle (the dedup)."""
    return raw.transform(clean).transform(add_features).transform(add_risk_score, model)


def build_clean(raw: DataFrame, model: ScoreModel = DEFAULT_MODEL) -> DataFrame:
    return raw.transform(score_loans, model).transform(clean_layer)


def register_scored(scored: DataFrame, name: str = SCORED_VIEW) -> None:
    scored.createOrReplaceTempView(name)


def run_pipeline(raw: DataFrame, store: LayerStore, model: ScoreModel = DEFAULT_MODEL) -> None:
    """Write every layer. The dedup runs once; later layers read the written one before them.

    RAW has a folder per status and CLEAN one per risk tier, so queries of one of them read it alone.
    Rows are counted while they are written, in total and per tier, and again in the stored table.
    A difference, or a stored mart whose groups do not add up to CLEAN, raises ``RuntimeError``.
    """
    sent = Observation()
    scored = score_loans(raw, model).observe(sent, *_tier_counts(model))
    loaded = store.load_raw(scored)
    check_equal("RAW", sent.get, loaded.agg(*_tier_counts(model)).first().asDict())
    clean_loans = store.replace("clean", LOANS, clean_layer(loaded), ["risk_tier"])
    for name, mart in MARTS.items():
        store.replace("analytics", name, mart(clean_loans))
    check_marts(store)


def quarantine(rejects: DataFrame, store: LayerStore) -> DataFrame:
    """Store the records that a CSV load could not parse beside RAW, for inspection."""
    return store.replace("raw", REJECTS, rejects)


def _tier_counts(model: ScoreModel) -> list[Column]:
    tier = F.col("risk_tier")
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(tier == label).alias(label) for label in model.tiers.labels],
    ]


def check_equal(table: str, expected: dict[str, int], found: dict[str, int]) -> None:
    if expected != found:
        raise RuntimeError(f"{table} holds {found}, written were {expected}")


def check_marts(store: LayerStore) -> None:
    """Every loan of stored CLEAN is in one group of each stored mart; one job for all marts."""
    counts = store.read("clean").agg(F.lit("CLEAN").alias("name"), F.count("*").alias("rows"))
    for name in MARTS:
        mart = store.read("analytics", name)
        loans = "total_borrowers" if "total_borrowers" in mart.columns else "total_loans"
        total = F.coalesce(F.sum(loans), F.lit(0)).alias("rows")
        counts = counts.unionByName(mart.agg(F.lit(name).alias("name"), total))
    found = {row["name"]: row["rows"] for row in counts.toLocalIterator()}
    for name in MARTS:
        check_equal(f"mart {name}", {"rows": found["CLEAN"]}, {"rows": found[name]})


def stored_mart_counts(store: LayerStore) -> DataFrame:
    """One (table_name, row_count) row per stored mart."""
    return row_counts({name: store.read("analytics", name) for name in MARTS})
