"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import re

import pytest

from support import ROOT, SF0001


@pytest.fixture(scope="module")
def summary(spark):
    import sys

    sys.path.insert(0, ROOT + "/tools")
    import check_oracle

    return check_oracle.main(["check_oracle", SF0001])


def test_all_queries_have_oracles_or_are_rows_only(summary):
    import __spark_entry__ as E

    rows_only = {k for k in set(E.queries()) - set(E.oracle_sql())
                 if not re.match(r"op\d+_|pipeline$", k)}  # those have tests of their own
    assert not rows_only
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match(summary):
    bad = {k: v for k, v in summary.items() if v["status"] not in ("match", "rows_only")}
    assert not bad, bad
