"""The entry module where a library of the text operators is missing."""

from __future__ import annotations

import os
import subprocess
import sys

import __spark_entry__  # noqa: F401
from conftest import ROOT
from registry import catalog

HIDE = """
import sys, warnings
sys.modules[{name!r}] = None
warnings.simplefilter("ignore")
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


def test_other_queries_stay_without_a_library_of_the_text_operators():
    for name in ("xxhash", "public_tokenizers"):
        ran = subprocess.run(
            [sys.executable, "-c", HIDE.format(name=name)],
            capture_output=True, text=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT},
        )
        found = list(map(int, ran.stdout.split()))
        assert found == [len(catalog.QUERIES), len(catalog.ORACLE)], ran.stderr[-500:]
