"""Every registered query against its SQL on the smallest input."""

import subprocess
import sys
from pathlib import Path

import pytest
from oracle_compare import connection, difference

import __spark_entry__ as entry
from chronomart.plans.oracle import ORACLE
from chronomart.plans.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SMALL)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    assert difference(REGISTRY[name](spark, SMALL), con, ORACLE[name]) is None


def test_every_error_rule_can_fail(spark):
    rows = REGISTRY["quality_report_dirty"](spark, SMALL).filter("severity = 'ERROR'").collect()
    assert len(rows) == 8 and {r.verdict for r in rows} == {"FAIL"}


def test_entry_without_the_text_queries():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.util, __spark_entry__ as e\n"
        "from chronomart.plans.queries import REGISTRY\n"
        "assert set(e.queries()) == set(REGISTRY)"
    )
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_entry(spark):
    assert entry.entry(spark).count() == 9
