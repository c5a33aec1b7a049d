import pytest

from kinelake.llm import queries as q

from helpers import oracle, same_rows


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, sf, name):
    df = q.QUERIES[name](spark, sf)
    if name in q.ORACLES:
        ok, extra, missing = same_rows(df, oracle(sf, q.ORACLES[name]))
        assert ok, (extra, missing)
    else:
        assert df.count() > 0
