"""Queries against their SQL oracles. ``ALL_ORACLES=1`` runs every one."""

import importlib
import os
import sys

import pytest

import __spark_entry__

from __spark_entry__ import queries
from skyledger.catalog.oracles import oracles
from skyledger.catalog.queries import QUERIES
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUICK = [
    "load_factor_by_carrier_season", "scan_fact_csv", "r10_dedupe", "r02_names", "r03_airline_id",
    "r04_required", "r09_dominant_id", "r11_airport_seq", "v_chain_1_4", "v_chain_11_13",
    "lk_unique_carriers", "lk_carrier_history", "dense_key", "fact_vuelo", "audit_rule_counts",
    "profile_defects", "x_scd1", "x_scd2", "x_change_detect", "x_unknown_member",
]
NAMES = list(QUERIES) if os.environ.get("ALL_ORACLES") else QUICK


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, oracle, name):
    n, _, problems = compare(spark, oracle, SF, name)
    assert not problems
    assert n > 0


def test_no_python_and_no_cross_join_in_the_plan(spark):
    for name in ("clean_all_rules", "r07_distance", "fact_vuelo"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in ("Python", "Cartesian", "NestedLoop"):
            assert bad not in plan


def test_core_queries_stay_without_the_corpus_libraries(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("skyledger.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "sentencepiece", None)
    with pytest.warns(UserWarning, match="left out"):
        entry = importlib.reload(__spark_entry__)
    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
