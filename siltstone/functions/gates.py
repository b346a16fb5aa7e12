"""Small labelling rules: freshness, score gate, query and context text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score floors of the content gate and the freshness limit in minutes.
FAITHFULNESS_FLOOR = 0.7
RELEVANCY_FLOOR = 0.7
FRESH_MINUTES = 15


def freshness(observed: Column, now: Column, minutes: int = FRESH_MINUTES) -> Column:
    """STALE when observed earlier than ``now`` minus the limit; an unknown time counts as FRESH."""
    return F.when(observed < now - F.make_dt_interval(mins=F.lit(minutes)), "STALE").otherwise("FRESH")


def passes_gate(
    faithfulness: Column,
    relevancy: Column,
    faithfulness_floor: float = FAITHFULNESS_FLOOR,
    relevancy_floor: float = RELEVANCY_FLOOR,
) -> Column:
    """Both scores reach their floors. NaN and NULL scores fail (NaN would sort above any number)."""

    def reaches(score: Column, floor: float) -> Column:
        return F.coalesce(~F.isnan(score) & (score >= floor), F.lit(False))

    return reaches(faithfulness, faithfulness_floor) & reaches(relevancy, relevancy_floor)


def plain_number(value: Column) -> Column:
    """A number as text: 0.0004 and 12000000.0 in full, 4e-05 and 1e+16 beyond."""
    number = value.cast("double")
    text, size = number.cast("string"), F.abs(number)
    small = F.regexp_replace(number.try_cast("decimal(38,24)").cast("string"), "0+$", "")
    large = F.regexp_replace(F.regexp_replace(number.try_cast("decimal(38,18)").cast("string"), "0+$", ""), r"\.$", ".0")
    power = F.substring_index(text, "E", -1)
    digits = F.regexp_replace(power, "-", "")
    short = F.concat(
        F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""),
        F.when(power.startswith("-"), "e-").otherwise("e+"),
        F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits),
    )
    plain = F.when((size >= 1e-4) & (size < 1e-3), small).when((size >= 1e7) & (size < 1e16), large)
    return plain.when(text.contains("E"), short).otherwise(text)


def outlier_query(ticker: Column, score: Column) -> Column:
    """Search text of an outlier, e.g. ``PETR4 anomaly_score=-0.3``; missing parts are empty."""
    return F.concat(
        F.coalesce(ticker, F.lit("")), F.lit(" anomaly_score="), F.coalesce(plain_number(score), F.lit(""))
    )
