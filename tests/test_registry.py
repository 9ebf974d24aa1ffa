"""The registered queries next to their SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from tools.compare import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not here")

QUICK = [
    "level_continents", "level_states_asn", "level_counties", "parse_addresses", "ip_sample",
    "anti_join_connections", "hop_files", "canary_stats", "export_json", "filings_by_county",
    "halfyear_wide", "map_join", "pip_join", "pip_sphere", "dissolve_edges", "exported_shard", "monthly_quantiles",
    "level_continents_sketch", "level_countries_from_files", "level_regions_spread",
    "dissolved_rings", "points_in_dissolved", "fleet_clients",
]


def test_every_query_of_the_workload_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    sql = registry.oracle_sql()[name]
    report = compare(spark, connect(SF_DIR), SF_DIR, name, registry.queries()[name], sql)
    assert ": ok, " in report, report


def test_every_sql_can_be_a_view():
    con = connect(SF_DIR)
    for name, sql in registry.oracle_sql().items():
        con.execute(f"CREATE VIEW view_{name} AS {sql}")


def test_entry(spark):
    assert registry.entry(spark).count() > 0
