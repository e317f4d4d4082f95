"""The entry point without the optional text operators."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as e
from arbor.workloads import QUERIES
from arbor.oracle import ORACLE
assert set(QUERIES) <= set(e.queries()) and set(ORACLE) <= set(e.oracle_sql())
extra = set(e.queries()) - set(QUERIES)
assert set(e.oracle_sql()) <= set(e.queries())
print(len(extra), "pipeline" in extra)
"""


@pytest.mark.parametrize("missing, want", [(("arbor.llm", "corpus_pipeline"), "0 False"), (("arbor.llm",), "0 False")])
def test_queries_without_the_text_operators(missing, want):
    out = subprocess.run([sys.executable, "-c", CHECK, *missing], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == want
