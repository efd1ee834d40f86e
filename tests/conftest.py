from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from strataflow.session import apply_defaults, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_defaults(session)
    session.stop()


@pytest.fixture(autouse=True)
def steady_width(request):
    """Runs size the shuffle to their input; tests start from the same width."""
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.set("spark.sql.shuffle.partitions", "4")
    yield


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def set_(**settings):
        for name, value in settings.items():
            key = name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield set_
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
