import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(entry.SMOKE_DIR).exists(), reason="needs the test tables")
def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_nothing_outside_the_subpackage_imports_it():
    for p in (ROOT / "docprep").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"docprep\.llm|from docprep import llm", p.read_text()), p
