"""The entry module without its optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys, warnings
sys.modules[{missing!r}] = None  # an import of it fails
with warnings.catch_warnings(record=True) as told:
    warnings.simplefilter("always")
    import __spark_entry__ as E
assert any("not registered" in str(w.message) for w in told)
assert set(E.queries()) == set(E.oracle_sql())
assert "pickup_features" in E.queries() and "pipeline" not in E.queries()
assert not any(m.startswith("lakelet.llm.") and sys.modules[m] is not None and "queries" in m for m in sys.modules)
"""


@pytest.mark.parametrize("missing", ["lakelet.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_queries_are_there_without_the_optional_part(missing):
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
