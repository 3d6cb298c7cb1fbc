"""Rules for the library text itself."""

import pathlib

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
FILES = sorted([*(ROOT / "lendlens").rglob("*.py"), *(ROOT / "harness").glob("loans.py")])
FILES = [path for path in FILES if "llm" not in path.parts]
FORBIDDEN = ["toPandas", "localCheckpoint", "crossJoin", ".rdd", "pandas", "@F.udf", "F.udf("]


def test_nothing_else_imports_the_llm_part():
    assert not [path for path in FILES if "llm" in path.read_text()]


@pytest.mark.parametrize("path", FILES, ids=lambda p: str(p.relative_to(ROOT)))
def test_no_row_level_python(path):
    text = path.read_text()
    assert not [word for word in FORBIDDEN if word in text]


def test_collects_are_of_bounded_metadata():
    uses = {
        str(path.relative_to(ROOT)): path.read_text().count(".collect()")
        for path in FILES
        if ".collect()" in path.read_text()
    }
    # One row per version; one per class; one per version.
    assert uses == {"lendlens/sources/layers.py": 3, "lendlens/sources/snapshots.py": 1}
