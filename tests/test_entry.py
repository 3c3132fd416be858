"""The entry module without the document operators, or without a package that only they need."""

from __future__ import annotations

import subprocess
import sys

import pytest

from conftest import ROOT

LISTED = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
from foyer.catalog import ENTRIES
found = entry.queries()
assert set(ENTRIES) <= set(found) and set(entry.oracle_sql()) <= set(found)
print(len(found) - len(ENTRIES))
"""
PARTS = ("foyer.llm", "corpus_pipeline", "public_tokenizers", "tiktoken", "tokenizers", "regex", "xxhash")


@pytest.mark.parametrize("name", PARTS)
def test_library_queries_need_no_document_package(name):
    run = subprocess.run([sys.executable, "-c", LISTED.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True)
    assert run.stdout.strip() == "0"
