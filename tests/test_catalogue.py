"""Every query of the catalogue agrees with its SQL on the smallest tables."""

import pytest

import oracle
from catalogue import all_cases

SF_DIR = "/root/testdata/sf0.001"
CASES = all_cases()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_agrees_with_sql(spark, con, name):
    case = CASES[name]
    df = case.run(spark, SF_DIR)
    if case.sql is None:
        assert df.count() > 0
    else:
        assert oracle.compare(df, con, case.sql) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()


def test_query_names_are_plain():
    assert not [name for name in CASES if "pipeline" in name or name.startswith("op")
                and name[2:3].isdigit()]
