import pytest

import __spark_entry__ as contract
import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, name):
    count, notes = check.differences(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name])
    assert not notes
    assert count > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
