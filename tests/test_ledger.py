"""The ledger of live months, drifting columns and fused gates by themselves."""

import pytest
from pyspark.sql import types as T

from faremill.operators.gates import Fused, Gate, GateError, Rule, enforce_each, profile_each
from faremill.sources import columns
from faremill.sources.ledger import Entry, FolderLedger, TableLedger

MAY, JUNE = ("2031", "05"), ("2031", "06")


@pytest.fixture(params=["folder", "table"])
def ledger(request, spark, tmp_path):
    if request.param == "folder":
        return FolderLedger(spark, str(tmp_path / "ledger"))
    database = "l" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}'")
    table = TableLedger(spark, f"{database}.live")
    table.create()
    return table


def test_versions_replace_each_other(ledger):
    assert ledger.version() == 0 and ledger.state() == {}
    first = {("a", MAY): Entry("x", 3), ("b", MAY): Entry("x", 4, "s")}
    assert ledger.commit(first) == 1
    assert ledger.state() == first
    ledger.commit({("a", MAY): Entry("y", 5), ("a", JUNE): Entry("y", 1)}, drop=[("b", MAY)])
    assert ledger.state() == {("a", MAY): Entry("y", 5), ("a", JUNE): Entry("y", 1)}
    assert ledger.live("a") == {MAY: Entry("y", 5), JUNE: Entry("y", 1)}
    assert ledger.state(1) == first
    ledger.commit({}, keep=False)
    assert ledger.state() == {} and ledger.version() == 3
    ledger.restore(1)
    assert ledger.state() == first
    assert ledger.retire(keep=2) == {("a", MAY, "y"), ("a", JUNE, "y")}
    assert ledger.versions() == [3, 4] and ledger.state() == first
    with pytest.raises(ValueError, match="no version 2"):
        ledger.restore(2)


def test_two_runs_cannot_take_one_number(spark, tmp_path):
    ledger = FolderLedger(spark, str(tmp_path / "ledger"))
    ledger.commit({("a", MAY): Entry("x", 3)})
    rows = ledger.rows()
    with pytest.raises(Exception, match="already exists"):
        ledger.append(rows, 1)


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "int", "int"), ("tinyint", "bigint", "bigint"), ("float", "double", "double"),
        ("bigint", "double", "double"), ("int", "float", "double"), ("int", "string", "string"),
        ("void", "int", "int"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "int", "string"),
        ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(12,6)", "decimal(14,6)"),
        ("decimal(38,0)", "decimal(38,20)", "double"), ("decimal(5,1)", "double", "double"),
        ("boolean", "int", "string"), ("timestamp", "timestamp_ntz", "timestamp"),
    ],
)
def test_widening(spark, a, b, both):
    kinds = [T._parse_datatype_string(kind) for kind in (a, b)]
    assert columns.widen(*kinds).simpleString() == both
    assert columns.widen(*reversed(kinds)).simpleString() == both


def test_registry_folds_names(spark):
    first = T._parse_datatype_string("fee int, Note string")
    second = T._parse_datatype_string("FEE double, extra int")
    whole = columns.registry([first, second])
    assert whole.simpleString() == "struct<fee:double,Note:string,extra:int>"
    frame = spark.createDataFrame([(1.5, 2)], second)
    assert columns.unite(frame, whole).collect() == [(1.5, None, 2)]
    with pytest.raises(ValueError, match="differ only in case"):
        columns.registry([T._parse_datatype_string("a int, A int")])


SMALL = Gate("small", (Rule("big_count", "n > 5", "too big"),), extra=(("most", "max(n)"),))
NAMED = Gate("named", (Rule("big_count", "n > 5", "too big", "warning"), Rule("blank_count", "t IS NULL", "no name")))


def test_fused_gates_ask_once_and_judge_as_alone(spark):
    table = spark.createDataFrame([("05", 1, "a"), ("05", 9, None), ("06", 2, "b")], "month string, n int, t string")
    fused = Fused((SMALL, NAMED), ("t IS NOT NULL", None), (("odd", "n % 2 = 1"),))
    found = profile_each({"x": (table, fused)}, ["month"])["x"]
    gates, counts = found["05",]
    assert gates[0] == {"rows_count": 1, "most": 1, "big_count": 0}
    assert gates[1] == {"rows_count": 2, "big_count": 1, "blank_count": 1}
    assert counts == {"total_rows": 2, "odd": 2}
    for gate, part in ((SMALL, table.where("t IS NOT NULL")), (NAMED, table)):
        alone = {tuple([row["month"]]): row for row in gate.profile(part, ["month"]).collect()}
        position = fused.gates.index(gate)
        for key, row in alone.items():
            assert found[key][0][position] == {k: v for k, v in row.asDict().items() if k != "month"}
    # one aggregate, with a count that both gates want made once
    double = Fused((NAMED, NAMED))
    assert len(double.profile(table).columns) == 3


def test_fused_gates_fail_with_the_same_words(spark):
    table = spark.createDataFrame([("05", 1, None), ("06", 2, "b")], "month string, n int, t string")
    with pytest.raises(GateError) as alone:
        NAMED.enforce(table, ["month"], [("05",)])
    with pytest.raises(GateError) as fused:
        enforce_each({"x": (table, Fused((SMALL, NAMED)))}, ["month"], [("05",)])
    assert str(alone.value) == str(fused.value)
    with pytest.raises(GateError) as alone:
        SMALL.enforce(table, ["month"], [("07",)])
    with pytest.raises(GateError) as fused:
        enforce_each({"x": (table, Fused((SMALL,)))}, ["month"], [("07",)])
    assert str(alone.value) == str(fused.value)
    warnings, rows = enforce_each(
        {"x": (table.where("n = 2"), Fused((SMALL,))), "y": (table.withColumn("n", table.n * 9), Fused((Gate("w", NAMED.rules[:1]),)))},
        ["month"],
    )
    assert rows == {"x": {("06",): 1}, "y": {("05",): 1, ("06",): 1}}
    assert warnings == ["w 05: too big (1 rows)", "w 06: too big (1 rows)"]
