from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from blotter.session import checkpoint_dir, local_session

    session = local_session("4", app="blotter-tests", extra={"spark.sql.shuffle.partitions": "8"})
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def write_csv(tmp_path):
    """Write ``text`` to a fresh CSV file and return its path."""
    counter = {"n": 0}

    def _write(text: str, name: str | None = None) -> str:
        counter["n"] += 1
        path = tmp_path / (name or f"f{counter['n']}.csv")
        path.write_text(text.strip("\n") + "\n")
        return str(path)

    return _write


def rows(df, *cols):
    """Rows as sorted tuples (of the given columns, default all)."""
    picked = df.select(*[f"`{c}`" for c in cols]) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=_null_first)


def _null_first(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)
