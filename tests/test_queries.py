"""Every query of the core against its SQL; those without SQL must run and keep a schema."""

import pytest
from sqlcheck import same_as_sql

from agrolith.plans import audits, dealt, evidence, reports, rules, scoring, streams

MODULES = (dealt, scoring, evidence, rules, reports, audits, streams)
CASES = [(m, n) for m in MODULES for n in m.QUERIES]


@pytest.mark.parametrize(("module", "name"), CASES, ids=[n for _, n in CASES])
def test_query(spark, data, module, name):
    if name in module.ORACLES:
        same_as_sql(spark, data, module.QUERIES[name], module.ORACLES[name])
    else:
        df = module.QUERIES[name](spark, data)
        rows = df.collect()
        assert len(df.columns) > 1 and isinstance(rows, list)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {"p1_found", "p3_found", "p5_found", "p6_found", "p7_found"} <= set(e.queries())


def test_core_does_not_need_llm():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for p in (root / "agrolith").rglob("*.py"):
        if "llm" not in p.parts:
            assert "agrolith.llm" not in p.read_text(), p
    code = "import sys; sys.modules['agrolith.llm'] = None; import agrolith.plans.dealt, agrolith.plans.evidence, agrolith.plans.scoring, agrolith.streaming.journal"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True).returncode == 0
