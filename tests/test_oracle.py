"""Every registered query against its SQL on the smallest tables."""

import pathlib
import subprocess
import sys

import pytest

from quarterdeck.workloads.registry import QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    query, sql = QUERIES[name]
    assert compare(spark, con, SF, query, sql) == ""


def test_entry_points_agree():
    import __spark_entry__ as entry

    own = set(QUERIES)
    assert own <= set(entry.queries()) and own <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_points_do_without_the_corpus_operators():
    code = (
        "import sys; sys.modules['quarterdeck.llm'] = None\n"
        "import __spark_entry__ as e; from quarterdeck.workloads.registry import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES)"
    )
    root = pathlib.Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
