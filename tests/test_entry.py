import __spark_entry__ as driver
from tests_support import same_result


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["event_date", "price", "gate_passed"] and df.count() > 0


def test_every_query_has_a_twin_or_a_reason():
    apart = set(driver._training_data()[0])  # tested with their own subpackage
    without = set(driver.queries()) - set(driver.oracle_sql()) - apart
    assert without == {"isolation_forest_insights"}


def test_flagship_slice_matches_its_twin(spark):
    for name in ("contract_check", "latest_per_key", "quality_report", "decision_ledger"):
        assert same_result(spark, name, driver.queries()[name], driver.oracle_sql()[name]), name
