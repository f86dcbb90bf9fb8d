from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers import the package too (the archive source runs there).
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

from gondola.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frames from a DDL schema; ISO texts in date columns become dates."""

    def make(schema: str, *rows):
        names = [part.split()[0] for part in schema.split(",")]
        dates = [part.split()[1] == "date" for part in schema.split(",")]
        assert all(len(row) == len(names) for row in rows)
        fixed = [
            tuple(
                dt.date.fromisoformat(v) if is_date and v else v
                for v, is_date in zip(row, dates)
            )
            for row in rows
        ]
        return spark.createDataFrame(fixed, schema)

    return make
