from __future__ import annotations

import json
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


class Inbox:
    """A folder that receives files in a stated order: streams go by modification time."""

    def __init__(self, folder: Path):
        self.folder = folder
        self.arrived = 0
        folder.mkdir()

    @property
    def path(self) -> str:
        return str(self.folder)

    def add(self, rows: list, name: str | None = None) -> None:
        lines = [row if isinstance(row, str) else json.dumps(row, ensure_ascii=False) for row in rows]
        target = self.folder / (name or f"part_{self.arrived:03d}.json")
        target.write_text("\n".join(lines) + "\n", encoding="utf-8")
        os.utime(target, (1_700_000_000 + 10 * self.arrived,) * 2)
        self.arrived += 1


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "inbox")


def reading(**changes) -> dict:
    row = {
        "timestamp": "2031-03-09T08:18:00Z",
        "device_id": "probe-t-7",
        "building": "A",
        "floor": 2,
        "type": "temperature",
        "value": 21.5,
        "unit": "°C",
    }
    return row | changes


def sample(n: int = 60) -> list[dict]:
    """Readings over n minutes from three devices, with every sensor type."""
    kinds = [("temperature", "°C", 15, 31), ("co2", "ppm", 400, 1200), ("humidity", "%", 20, 80)]
    rows = []
    for i in range(n):
        kind, unit, low, high = kinds[i % 3]
        rows.append(
            reading(
                timestamp=f"2031-03-09T{8 + i // 60:02d}:{i % 60:02d}:{i % 7:02d}Z",
                device_id=f"sensor-{i % 3}",
                building="AB"[i % 2],
                floor=i % 4,
                type=kind,
                value=low + (i * 37 % 100) / 100 * (high - low),
                unit=unit,
            )
        )
    return rows
