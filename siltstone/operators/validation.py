"""Validation evidence: row rules, currency, maturity, report and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.skew import lookup_join

# Gates, statuses, reason codes, id pattern and the maturity ladder.
GATES = (
    "unit", "contract", "lint", "dagbag", "local_integration", "external_smoke", "recovery", "alert", "runbook",
)
STATUSES = ("PASS", "FAIL", "SKIP_WITH_REASON")
REASON_CODES = (
    "MISSING_CREDENTIAL", "EXTERNAL_DISABLED", "UNSUPPORTED_REPOSITORY_CAPABILITY", "PRECONDITION_FAILED",
    "ASSERTION_FAILED", "INFRASTRUCTURE_ERROR", "TIMEOUT", "RATE_LIMITED", "EXPIRED_EVIDENCE", "WRONG_COMMIT",
    "STALE_PRECONDITION", "E2E_PREREQUISITE_MISSING",
)
CAPABILITY_ID = r"^CAP-(0[1-9]|10)$"
LADDER = (
    ("Implemented", ("unit", "contract", "lint")),
    ("Locally Validated", ("local_integration",)),
    ("Infrastructure Validated", ("external_smoke",)),
    ("Operationally Complete", ("recovery", "alert", "runbook")),
)
UNVALIDATED = "Not Validated"


def _unless(rule: Column) -> Column:
    """Broken when the rule is false or, for a NULL field, unknown."""
    return ~F.coalesce(rule, F.lit(False))


def evidence_violations(reason_codes: Sequence[str] = REASON_CODES) -> Column:
    """All broken row rules of an evidence record, in a fixed order; an empty array means valid."""
    passed = F.col("status") == "PASS"
    reason = F.col("reason_code")
    rules = {
        "invalid_capability_id": _unless(F.col("capability_id").rlike(CAPABILITY_ID)),
        "unknown_gate": _unless(F.col("gate").isin(*GATES)),
        "unknown_status": _unless(F.col("status").isin(*STATUSES)),
        "pass_with_reason": passed & reason.isNotNull(),
        "reason_required": ~passed & (F.coalesce(reason, F.lit("")) == ""),
        "unknown_reason_code": reason.isNotNull() & ~reason.isin(*reason_codes),
        "external_pass_without_expiry": (F.col("gate") == "external_smoke") & passed & F.col("expires_at").isNull(),
        "finished_before_started": F.col("finished_at") < F.col("started_at"),
    }
    return F.filter(F.array(*[F.when(broken, name) for name, broken in rules.items()]), lambda v: v.isNotNull())


def is_current(now: Column, commit: str, code_independent: Column | None = None) -> Column:
    """Not expired at ``now`` and made at the given commit, unless the evidence does not depend on code."""
    expired = F.coalesce(F.col("expires_at") < now, F.lit(False))
    same = F.col("commit_sha") == commit
    return ~expired & (same if code_independent is None else code_independent | same)


def maturity_level(required: Column, passed: Column) -> Column:
    """Highest ladder step reached from the required and the passed gates.

    A step without required gates is passed, except the first one, which must ask for something.
    """
    def names(gates: Sequence[str]) -> Column:
        return F.array(*[F.lit(g) for g in gates])

    steps = [F.array_intersect(required, names(gates)) for _, gates in LADDER]
    open_gates = [F.size(F.array_except(step, passed)) for step in steps]
    level = F.when((F.size(steps[0]) == 0) | (open_gates[0] > 0), UNVALIDATED)
    for (reached, _), missing in zip(LADDER, open_gates[1:]):
        level = level.when(missing > 0, reached)
    return level.otherwise(LADDER[-1][0])


def maturity(capabilities: DataFrame, evidence: DataFrame, now: Column, commit: str) -> DataFrame:
    """Maturity per capability (capability_id, required_gates, ...), kept when it has no evidence.

    Evidence that breaks a row rule does not count. Evidence shrinks to at most one row per capability
    and gate before the join.
    """
    valid = evidence.where(F.size(evidence_violations()) == 0)
    good = valid.where((F.col("status") == "PASS") & is_current(now, commit))
    passed = good.groupBy("capability_id").agg(F.collect_set("gate").alias("_passed"))  # at most one per known gate
    joined = capabilities.join(passed, "capability_id", "left")
    known = F.coalesce("_passed", F.array().cast("array<string>"))
    return joined.withColumn("maturity", maturity_level(F.col("required_gates"), known)).drop("_passed")


def validation_report(capabilities: DataFrame, evidence: DataFrame, now: Column, commit: str) -> DataFrame:
    """The report as rows: each capability with its maturity and one row per piece of evidence.

    The evidence stays flat, since a capability may own any number of records; capabilities
    without evidence keep one row.
    """
    rated = maturity(capabilities, evidence, now, commit).select("capability_id", "name", "owner", "maturity")
    with_evidence = lookup_join(evidence, rated, ["capability_id"], ["gate", "started_at"])
    columns = [c for c in evidence.columns if c != "capability_id"]
    bare = rated.join(evidence.select("capability_id").distinct(), "capability_id", "left_anti")
    empty = bare.select("*", *[F.lit(None).cast(evidence.schema[c].dataType).alias(c) for c in columns])
    order = ["capability_id", "name", "owner", "maturity", *columns]
    return with_evidence.select(*order).unionByName(empty.select(*order))


def report_summary(capabilities: DataFrame, evidence: DataFrame, now: Column, commit: str) -> DataFrame:
    """One line per capability: maturity and number of evidence records."""
    counts = evidence.groupBy("capability_id").agg(F.count("*").alias("_n"))
    rated = maturity(capabilities, evidence, now, commit).join(counts, "capability_id", "left")
    return rated.select(
        "capability_id", "name", "owner", "maturity", F.coalesce("_n", F.lit(0)).cast("long").alias("evidence_count")
    )


def reconcile(expected: DataFrame, actual: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Expected metrics against actual ones (both metric, value); extra actual metrics are ignored."""
    delta = F.col("actual") - F.col("expected")
    joined = expected.select("metric", F.col("value").alias("expected")).join(
        actual.select("metric", F.col("value").alias("actual")), "metric", "left"
    )
    within = F.coalesce(F.abs(delta) <= F.lit(tolerance), F.lit(False))
    return joined.select(
        "metric", "expected", "actual", delta.alias("delta"), F.when(within, "PASS").otherwise("FAIL").alias("status")
    )
