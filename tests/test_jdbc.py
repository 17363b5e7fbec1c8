"""What can be tested of the JDBC sink without a database."""

import pytest

from checks import queries
from faremill import schemas
from faremill.operators.gates import GateError
from faremill.sources.serving import append_month_jdbc, jdbc_options


def test_options():
    base = {"url": "jdbc:x://h/db", "driver": "d.Driver", "dbtable": "t", "user": "u"}
    assert jdbc_options("jdbc:x://h/db", "t", "u", "d.Driver") == base
    with_password = jdbc_options("jdbc:x://h/db", "t", "u", "d.Driver", "secret")
    assert with_password == {**base, "password": "secret"}


def test_a_month_without_rows_is_refused_before_any_connection(spark, small):
    daily = queries.daily(spark, small).selectExpr(
        "*", "current_timestamp() AS gold_load_timestamp"
    )
    options = jdbc_options("jdbc:none:", "t", "u", "no.such.Driver")
    with pytest.raises(GateError, match="no rows to load"):
        append_month_jdbc(schemas.DAILY.name, daily, options, ("1890", "01"))
