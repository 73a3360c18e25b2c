import subprocess
import sys

import pytest


@pytest.mark.parametrize("lost", ["public_tokenizers", "xxhash", "zstandard", "regex", "snapflow.llm", "corpus_pipeline"])
def test_entry_stands_without_optional_modules(lost):
    """A missing module of the training-data operators costs their queries only."""
    code = f"""
import sys
sys.modules[{lost!r}] = None
import __spark_entry__ as e
names = e.queries()
assert "dimension" in names and "trends" in names and e.oracle_sql().keys() <= names.keys()
assert "pipeline" not in names
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/", 2)[0])
