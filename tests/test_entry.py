"""The entry file without the optional subpackage, without a module that it needs, and with a broken core."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("missing", [["threadlens.llm", "corpus_pipeline"], ["threadlens.llm"], ["corpus_pipeline"], ["xxhash"], ["ahocorasick"]])
def test_entry_without_optional_modules(missing):
    code = f"import sys; sys.modules |= dict.fromkeys({missing}); import __spark_entry__ as e; n = e.queries(); assert len(n) > 80 and 'topic_summary' in n and set(e.oracle_sql()) <= set(n)"
    done = run(code)
    assert done.returncode == 0, done.stderr


def test_a_broken_core_is_an_error():
    assert run("import sys; sys.modules['threadlens.operators.embed'] = None; import __spark_entry__").returncode != 0
    assert run("import sys; sys.modules['threadlens.session'] = None; import __spark_entry__").returncode != 0
