"""The agreement queries search the filter's whole range of lags (their rows are compared with SQL in test_queries)."""

from pyspark.sql import functions as F

from kinelake.operators import episode_filter
from kinelake.plans import registry

MOST = episode_filter.FilterConfig().max_lag


def test_all_lags_are_searched(spark, sf):
    for name, narrow in (("pooled_frame_agreement", 2), ("c_directional_agreement", 5)):
        far = registry.queries()[name](spark, sf).agg(F.max(F.abs("lag"))).first()[0]
        assert far <= MOST and (name != "pooled_frame_agreement" or far > narrow)
        assert "range(-10, 11)" in registry.oracle_sql()[name]
