"""Every registered query against its SQL; queries without SQL must give rows and a stable schema."""

from __future__ import annotations

import pytest
from compare import compare, connect
from paths import ROOT, SMALL

import checks.published  # noqa: F401
import checks.responses  # noqa: F401
import checks.rollups  # noqa: F401
import checks.runs  # noqa: F401
import checks.states  # noqa: F401
import checks.text  # noqa: F401
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns and df.count() > 0


def test_entry_points(spark):
    import importlib.util

    spec = importlib.util.spec_from_file_location("entry_under_test", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.oracle_sql()) <= set(module.queries())
    assert module.entry(spark).count() > 0
