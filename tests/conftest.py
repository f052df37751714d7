from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from jobmetrics.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test data")
    return SF_DIR


@pytest.fixture(scope="session")
def tracking(spark, sf_dir):
    from jobmetrics.sources import fixtures

    return fixtures.tracking(fixtures.events(spark, sf_dir))


@pytest.fixture(scope="session")
def job_dim(spark, sf_dir):
    from jobmetrics.operators.enrich import job_dimension
    from jobmetrics.sources import fixtures

    return job_dimension(fixtures.job(spark, sf_dir))


def rows_of(df, digits: int = 6):
    """Rows as a sorted list, columns by name, doubles rounded."""
    columns = sorted(df.columns)
    plain = [
        tuple(round(v, digits) + 0.0 if isinstance(v, float) else v for v in row)
        for row in df.select(*columns).collect()
    ]
    return sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def plan_of(df) -> str:
    """The physical plan as text, through the public explain."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
