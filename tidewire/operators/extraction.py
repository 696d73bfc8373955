"""Typed extraction records and tiered attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewire import fixed_values as fixed

_PAYLOAD = (
    "schemaVersion string, recordType string, source_name string, source_url string, entityName string, "
    "employeeCount int, collectedAt string, _corrupt string"
)
REQUIRED = ["source_name", "source_url", "entityName", "collectedAt"]


def validate_payloads(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """rows + record (struct, NULL when rejected), reason (NULL when valid)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = rows.withColumn("_p", F.from_json(F.col(payload), _PAYLOAD, options))
    missing = F.array_compact(F.array(*[F.when(F.col(f"_p.{f}").isNull(), F.lit(f)) for f in REQUIRED]))
    reason = (
        F.when(F.col("_p").isNull() | F.col("_p._corrupt").isNotNull(), F.lit("corrupt"))
        .when(F.size("_missing") > 0, F.concat(F.lit("missing "), F.array_join("_missing", ",")))
    )
    record = F.struct(
        F.coalesce("_p.schemaVersion", F.lit(fixed.SCHEMA_VERSION)).alias("schemaVersion"),
        F.coalesce("_p.recordType", F.lit("STARTUP")).alias("recordType"),
        *[F.col(f"_p.{f}").alias(f) for f in ["source_name", "source_url", "entityName", "employeeCount", "collectedAt"]],
    )
    judged = parsed.withColumn("_missing", missing).withColumn("reason", reason)
    return judged.withColumn("record", F.when(F.col("reason").isNull(), record)).drop("_p", "_missing")


def select_first_success(
    attempts: DataFrame,
    tier_attempts: int = fixed.TIER_ATTEMPTS,
    retry_statuses: Sequence[int] = tuple(fixed.RETRY_STATUSES),
) -> DataFrame:
    """Outcome per doc of attempts(doc_id, tier, attempt, status, payload).

    Tiers run in order with at most tier_attempts attempts each; a status that is neither success nor retryable
    ends its tier. (doc_id, tier, attempt, payload) of the first success; all NULL but doc_id when every tier fails.
    """
    place = F.row_number().over(Window.partitionBy("doc_id", "tier").orderBy("attempt"))
    tried = attempts.withColumn("_place", place).where(F.col("_place") <= tier_attempts)
    # at most tier_attempts rows are left per doc and tier
    first_ok = F.min(F.when(F.col("status") == 200, F.struct("attempt", "payload")))
    first_fatal = F.min(F.when(~F.col("status").isin(200, *retry_statuses), F.col("attempt")))
    tiers = tried.groupBy("doc_id", "tier").agg(first_ok.alias("_ok"), first_fatal.alias("_fatal"))
    reached = F.col("_ok").isNotNull() & (F.col("_fatal").isNull() | (F.col("_ok.attempt") < F.col("_fatal")))
    best = F.min(F.when(reached, F.struct("tier", "_ok.attempt", "_ok.payload")))
    return tiers.groupBy("doc_id").agg(best.alias("_best")).select("doc_id", "_best.tier", "_best.attempt", "_best.payload")


def failover_chain(
    attempts: DataFrame,
    tier_attempts: int = fixed.TIER_ATTEMPTS,
    retry_statuses: Sequence[int] = tuple(fixed.RETRY_STATUSES),
) -> DataFrame:
    """(doc_id, tier, attempt, payload, shrinks): the first success as in select_first_success, and how often the text was
    halved before, that is the 413s that were tried in its tier and in earlier ones; all NULL but doc_id without success."""
    place = F.row_number().over(Window.partitionBy("doc_id", "tier").orderBy("attempt"))
    tried = attempts.withColumn("_place", place).where(F.col("_place") <= tier_attempts)
    # At most tier_attempts tries of a tier, and one row for each of a document's tiers.
    tries = F.sort_array(F.collect_list(F.struct("attempt", "status", "payload")))
    tiers = tried.groupBy("doc_id", "tier").agg(tries.alias("_tries"))
    last = F.try_element_at(F.filter("_tries", lambda t: ~t["status"].isin(*retry_statuses)), F.lit(1))
    stopped = tiers.withColumn("_last", last)
    too_large = F.filter("_tries", lambda t: (t["status"] == 413) & (F.col("_last").isNull() | (t["attempt"] < F.col("_last.attempt"))))
    won = F.coalesce(F.col("_last.status") == 200, F.lit(False))
    steps = stopped.select("doc_id", F.struct(
        "tier", won.alias("won"), F.size(too_large).alias("shrunk"), F.col("_last.attempt").alias("attempt"), F.col("_last.payload").alias("payload")).alias("_step"))
    chains = steps.groupBy("doc_id").agg(F.sort_array(F.collect_list("_step")).alias("_chain"))
    best = chains.withColumn("_best", F.try_element_at(F.filter("_chain", lambda s: s["won"]), F.lit(1)))
    shrinks = F.aggregate(F.filter("_chain", lambda s: s["tier"] <= F.col("_best.tier")), F.lit(0), lambda a, s: a + s["shrunk"])
    return best.select("doc_id", "_best.tier", "_best.attempt", "_best.payload", F.when(F.col("_best").isNotNull(), shrinks).alias("shrinks"))


def split_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(extracted, exhausted)."""
    extracted = outcomes.where(F.col("tier").isNotNull())
    return extracted, outcomes.where(F.col("tier").isNull()).select("doc_id")
