"""Plans that the engine should get: pruned scans, pushed filters, one exchange where one is enough."""

import os
import re

import pytest

from skyflux.plans import queries_receiver, queries_scalar, queries_series, queries_tables

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


#: Recursions, kernels of the pipeline and readers of raw bytes.
PYTHON = {"iir_cascade", "decorrelation_time", "slip_repair_next", "detrended_masks", "tec_repaired", "minute_products", "binary_v325", "binary_v326"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_scans_are_pruned(spark):
    p = plan(queries_scalar.prn_format(spark, DATA))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in p
    p = plan(queries_scalar.time_slice(spark, DATA))
    assert re.search(r"PushedFilters: \[.*In\(event_type.*GreaterThanOrEqual\(ts|PushedFilters: \[.*GreaterThanOrEqual\(ts.*In\(event_type", p)


def test_one_exchange_is_enough(spark):
    for query in (queries_series.slip_repair, queries_series.lerp_both, queries_series.edge_gap_mask, queries_tables.products_left_join, queries_tables.s4_by_bin, queries_tables.downsample_first):
        assert exchanges(query(spark, DATA)) == 1, query.__name__


def test_no_nested_loops(spark):
    for query in (queries_tables.nearest_station, queries_tables.nearest_station_km, queries_tables.availability_days, queries_scalar.signal_dimension):
        assert not re.search("NestedLoop|Cartesian", plan(query(spark, DATA))), query.__name__


def test_no_python_but_in_recursions(spark):
    for part in (queries_scalar, queries_series, queries_tables, queries_receiver):
        for name, (query, _) in part.QUERIES.items():
            uses = bool(re.search("InPandas|InArrow|PythonUDF|ArrowEval", plan(query(spark, DATA))))
            assert uses == (name in PYTHON), name
