"""The entry point with and without its optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash", "slotledger.llm", "corpus_pipeline"])
def test_core_queries_remain_without_an_optional_module(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    count, whole = found.stdout.split()
    assert int(count) >= 100 and whole == "True"
