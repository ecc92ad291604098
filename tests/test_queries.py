"""Every query of the engine: its rows are those of its SQL, or of a stated rule."""

import difflib

import oracle
import pytest

from folioscan.operators import lookup
from folioscan.plans import catalog


@pytest.fixture(scope="module")
def con():
    return oracle.connection()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert oracle.differences(spark, con, catalog.QUERIES[name], catalog.ORACLES[name]) == ""


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalog.QUERIES) <= set(e.queries())


def test_stemmed_search_finds_what_holds_the_quote(spark):
    found = {(r.qid, r.doc_id) for r in catalog.QUERIES["stemmed_search"](spark, oracle.SF).collect()}
    plain = {(r.qid, r.doc_id) for r in catalog.QUERIES["bm25_topk"](spark, oracle.SF).filter("rank = 1").collect()}
    assert len(plain & found) >= 0.9 * len(plain)


def test_close_matches_are_those_of_all_names(spark):
    """Names that begin with the asked one, else the close ones among all; "old bolt" (of "cold bolt") is a name itself, so only it is suggested."""
    rows = catalog.QUERIES["close_matches"](spark, oracle.SF).collect()
    cutoff, most = lookup.CLOSE["entity"]
    names = sorted({r.qid for r in rows})
    for r in rows:
        begins = [n for n in names if n.startswith(r.name)][:25]
        assert r.suggested == ",".join(begins or difflib.get_close_matches(r.name, names, n=most, cutoff=cutoff))
        assert begins or len(r.qid) <= 6 or r.qid in r.suggested.split(",")
    assert rows


def test_no_python_in_relational_plans(spark):
    for name in ("bm25_topk", "line_furniture", "edition_asof", "call_summary"):
        plan = catalog.QUERIES[name](spark, oracle.SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InPandas" not in plan
