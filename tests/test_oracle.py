"""Every registered query agrees with its SQL, whatever the join strategy."""

import pytest

from cleartab import queries
from tests.compare import connect, differences

queries.load()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, folder, con, name):
    assert name in queries.ORACLES
    assert differences(queries.QUERIES[name](spark, folder), con, queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", ["flagship_subject_flags", "lookup_broadcast", "code_set_semi",
                                  "files_to_check", "manifest_skip", "zero_pad_join"])
def test_without_broadcast(spark, folder, con, name):
    """As on tables too large to broadcast, and with skewed partitions split."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert differences(queries.QUERIES[name](spark, folder), con, queries.ORACLES[name]) == []
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_other_time_zone(spark, folder, con):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        for name in ("date_two_formats", "date_three_formats", "timestamp_text", "job_courts"):
            assert differences(queries.QUERIES[name](spark, folder), con, queries.ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_cross_joins(spark, folder):
    for name in ("flagship_subject_flags", "range_buckets", "slice_plan", "residual_split", "reconcile_counts"):
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
