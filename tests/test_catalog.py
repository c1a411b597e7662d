"""Registered queries against their SQL twins on the smallest tables."""

import pytest

from tests.conftest import SF
from tidemark.plans import check
from tidemark.plans.catalog import ORACLES, QUERIES

SAMPLE = [
    "flagship_daily_activity", "prd_not", "fn_convert", "win_length", "win_time", "win_sort_changes", "agg_max",
    "jn_time", "jn_length", "jn_enrich", "jn_dim_geoip", "jn_darklist", "trf_trap", "trf_split_flow", "trf_move_mse",
    "agg_rollup_flow", "pat_every_group", "pat_cross_ref", "seq_regex", "par_by_range", "tbl_update", "rate_snapshot_agg",
    "st_rule_alerts", "ts_regress_simple",
]


@pytest.fixture(scope="module")
def con():
    return check.oracle_connection(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    assert check.compare(spark, con, SF, name)[0] == "ok"


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 150
