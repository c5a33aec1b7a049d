"""Every registered query of the core runs on the smallest tables; those with SQL give its rows."""

import pytest

from kinelake.plans import registry

from helpers import oracle, same_rows

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        ok, extra, missing = same_rows(df, oracle(sf, SQL[name]))
        assert ok, (extra, missing)
    else:
        assert df.count() >= 0


def test_entry(spark, sf):
    df = registry.entry(spark, sf)
    assert df.count() > 0 and "episode" in df.columns


def test_rest_works_without_the_optional_subpackage():
    import pathlib

    root = pathlib.Path(registry.__file__).parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "kinelake.llm" not in p.read_text(), p
