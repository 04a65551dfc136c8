import re
import sys

import __spark_entry__ as E

from tests.conftest import SF0001

LLM = re.compile(r"op\d+_|pipeline$")

# Operators whose semantics SQL cannot state are listed here (none yet).
NO_ORACLE = set()


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert {k for k in q if not LLM.match(k)} - set(o) == NO_ORACLE
    assert set(o) <= set(q)


def test_queries_remain_when_an_import_of_the_subpackage_fails(monkeypatch):
    own = {k for k in E.queries() if not LLM.match(k)}
    for name in [m for m in sys.modules if m.startswith("argent.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    with monkeypatch.context() as m:
        m.setitem(sys.modules, "regex", None)          # what one of its modules needs
        assert own <= set(E.queries()) and "pipeline" not in E.queries()
        m.setitem(sys.modules, "argent.llm.queries", None)
        assert set(E.queries()) == own and not [k for k in E.oracle_sql() if LLM.match(k)]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ORDER_ID" in df.columns


def test_all_queries_plan_on_small_data(spark):
    # Every registered query builds and runs on the smallest tables.
    for name, fn in E.queries().items():
        if LLM.match(name):  # tested in tests/llm
            continue
        df = fn(spark, SF0001)
        assert df.limit(1).count() >= 0, name
