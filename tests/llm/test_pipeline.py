import ast
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tessera.llm import decontaminate, mixing, simhash
from tessera.llm.common import materialize
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import slow_matches
from tests.llm.test_lines import slow_deletions
from tests.llm.test_quality_rules import slow_base
from tests.llm.test_simhash import slow_components, slow_fingerprint

REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, documents):
    out, docs = [documents], documents
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF))
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "source mixing"]
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "copy"]


def test_quality(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert all(before[k] == t and not slow_base(t)[-1] for k, t in after.items())


def test_lines(stages):
    before, after = texts(stages[1]), texts(stages[2])
    lost = slow_deletions(before)
    want = {k: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in lost.get(k, ())) for k, t in before.items()}
    assert after == {k: t for k, t in want.items() if k not in lost or t.split()}


def test_near_copies(stages):
    before = texts(stages[2])
    ids = sorted(before)
    first = slow_components(ids, [slow_fingerprint(before[i]) for i in ids])
    assert texts(stages[3]) == {i: before[i] for i in set(first)}


def test_decontamination(spark, stages):
    before = texts(stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert texts(stages[4]) == {k: t for k, t in before.items() if not slow_matches(items, t)}


def test_mix(stages):
    want = {r.doc_id: r.copies for r in mixing.mix(stages[4]).collect()}
    assert Counter(r.doc_id for r in stages[5].collect()) == {k: n for k, n in want.items() if n}


def test_run_gives_the_last_stage(spark, stages):
    got = E.queries()["pipeline"](spark, SF)
    assert Counter((r.doc_id, r["copy"]) for r in got.collect()) == Counter((r.doc_id, r["copy"]) for r in stages[5].collect())


def test_empty_table_through_all_stages(spark, documents):
    docs = documents.limit(0)
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0


def test_awkward_rows_through_all_stages(spark, awkward):
    docs = awkward
    for _, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF))
        assert docs.columns == awkward.columns
    assert 5 in {r.doc_id for r in docs.collect()}
    assert P.STAGES[-1][1](spark, docs, SF).count() > 0


def test_entry_works_without_the_subpackage(tmp_path):
    for p in REPO.iterdir():
        if p.name not in ("corpus_pipeline.py", "tessera") and not p.name.startswith("."):
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "tessera").mkdir()
    for p in (REPO / "tessera").iterdir():
        if p.name != "llm":
            (tmp_path / "tessera" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((REPO / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; print(sorted(e.queries())[:2], any(k.startswith('op') for k in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split("]")[1].split() == ["False", "True"]


def test_nothing_else_imports_the_subpackage():
    for p in (REPO / "tessera").rglob("*.py"):
        if "llm" in p.parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any("llm" in n for n in names), p
    assert decontaminate and simhash
