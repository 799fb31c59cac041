"""The operators run on workers that do not have this package."""

import os
import subprocess
import sys

from tests.llm.conftest import SF

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_workers_need_no_install(tmp_path):
    """Only the driver's own path has the repository; the workers start from another folder."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from tessera.session import local_session
from tessera.llm import queries
spark = local_session(2, 2)
for name in ("op5_language_model", "op10_lines", "op11_collocations", "op12_hard_negatives", "op13_token_files"):
    print(name, queries.QUERIES[name](spark, {SF!r}).count(), flush=True)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.count("op") == 5
