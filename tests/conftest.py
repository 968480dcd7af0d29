from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marquee.session import checkpoint_dir, local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="marquee-tests")
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="marquee-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a small test result as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
