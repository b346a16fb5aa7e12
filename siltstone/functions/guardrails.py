"""Verdicts on proposed file changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The folders a change may touch.
ALLOWED_PATH_PREFIXES = (
    "pipelines/ingestion/contracts/",
    "pipelines/ingestion/producers/",
    "pipelines/ingestion/dags/",
    "pipelines/ingestion/common/",
    "pipelines/processing/",
    "pipelines/insights/",
    "pipelines/finops/",
    "pipelines/self_healing/",
    "pipelines/rag/",
)

# Forbidden content as (pattern named in the reason, ignore case).
DANGEROUS_PATTERNS = (
    (r"os\.system\(", False),
    (r"subprocess\.", False),
    (r"\beval\(", False),
    (r"\bexec\(", False),
    (r"DROP\s+TABLE", True),
    (r"DELETE\s+FROM\s+\w+\s*;", True),
    (r"(?i)(api[_-]?key|secret|password)\s*=\s*['\"][^'\"]+['\"]", True),
)


def path_violation(path: Column, prefixes: Sequence[str] = ALLOWED_PATH_PREFIXES) -> Column:
    """``invalid_path:`` / ``out_of_scope_path:`` reason, or NULL for an allowed path; a NULL path is invalid.

    Empty and ``.`` segments are dropped before the prefix test, as POSIX paths do.
    """
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    clean = F.array_join(parts, "/")
    escapes = path.contains("\\") | path.startswith("/") | F.array_contains(parts, "..")
    allowed = F.lit(False)
    for prefix in prefixes:
        allowed = allowed | clean.startswith(prefix)
    return F.when(path.isNull(), "invalid_path:").when(escapes, F.concat(F.lit("invalid_path:"), path)).when(
        ~allowed, F.concat(F.lit("out_of_scope_path:"), path)
    )


def content_violation(text: Column, patterns: Sequence[tuple[str, bool]] = DANGEROUS_PATTERNS) -> Column:
    """``dangerous_pattern:`` reason of the first rule that matches anywhere in the text; a NULL text is refused.

    Unicode classes are switched on so that blanks and word borders follow the same rules
    as the declared patterns.
    """
    checks = [
        F.when(F.rlike(text, F.lit(f"(?U{'i' if fold else ''})" + p)), F.lit(f"dangerous_pattern:{p}"))
        for p, fold in patterns
    ]
    return F.coalesce(F.when(text.isNull(), "missing_content"), *checks)


def verdict(
    path: Column,
    text: Column,
    prefixes: Sequence[str] = ALLOWED_PATH_PREFIXES,
    patterns: Sequence[tuple[str, bool]] = DANGEROUS_PATTERNS,
) -> Column:
    """Path reason first, then content reason; NULL accepts the change."""
    return F.coalesce(path_violation(path, prefixes), content_violation(text, patterns))
