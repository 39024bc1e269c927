from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.lake import Lake  # noqa: E402
from millrace.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        extra={"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path) -> Lake:
    return Lake(root=str(tmp_path / "lake"), raw=str(tmp_path / "raw"))


def write_lines(lake: Lake, entity: str, day: str, lines: list[str], name="data.jsonl") -> None:
    folder = Path(lake.raw) / entity / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def tuples(df, *columns) -> list[tuple]:
    """Rows as tuples in a settled order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
