import pytest
from conftest import DATA

from ledgerloom import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, same_as_sql, name):
    same_as_sql(catalog.queries()[name](spark, DATA), catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_gives_rows(spark, name):
    assert catalog.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
