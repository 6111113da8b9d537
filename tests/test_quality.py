import pytest

from tempolake.operators import quality as Q


def failures(frame):
    return {r.column: r.failures for r in frame.collect()}


def test_not_null(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, b string")
    assert failures(Q.not_null(rows, ["a", "b"])) == {"a": 1, "b": 2}
    assert failures(Q.not_null(rows.limit(0), ["a", "b"])) == {"a": 0, "b": 0}


def test_unique_ignores_nulls(spark):
    rows = spark.createDataFrame([(None,), (None,), (1,)], "a int")
    assert failures(Q.unique(rows, "a")) == {"a": 0}
    rows = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,)], "a int")
    assert failures(Q.unique(rows, "a")) == {"a": 2}


def test_accepted_values_pass_nulls(spark):
    rows = spark.createDataFrame([("paid",), (None,), ("x",), ("x",), ("y",)], "level string")
    assert failures(Q.accepted_values(rows, "level", ["paid", "free"])) == {"level": 2}


def test_check_counts():
    assert len(Q.SILVER_CHECKS) == 13 and len(Q.GOLD_CHECKS) == 15


def test_audit_reports_every_check_and_raises(spark):
    rows = spark.createDataFrame([(1, "bad"), (None, "ok")], "a int, b string")
    checks = [
        Q.Check("t", "a", "not_null"),
        Q.Check("t", "a", "unique"),
        Q.Check("t", "b", "accepted_values", ("ok",)),
    ]
    audited = Q.audit({"t": rows}, checks)
    got = {(r.table, r.column, r.test): r.failures for r in audited.collect()}
    assert got == {
        ("t", "a", "not_null"): 1,
        ("t", "a", "unique"): 0,
        ("t", "b", "accepted_values"): 1,
    }
    with pytest.raises(Q.AuditFailed) as error:
        Q.require_passed(audited)
    assert len(error.value.failed) == 2
    assert len(Q.require_passed(Q.audit({"t": rows}, checks[1:2]))) == 1
