from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from rollcall import Settings, Tables
from rollcall.sources.schemas import BASE_TABLES


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("rollcall-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def settings():
    return Settings(as_of=datetime(2024, 1, 20, 15, 30), junk=("ImportJob", ""))


@pytest.fixture(scope="session")
def make(spark):
    """Builds base tables from literal rows; unnamed columns and tables are empty."""

    def build(**rows: list[dict]) -> Tables:
        def load(name: str):
            schema = BASE_TABLES[name]
            full = [tuple(r.get(f.name) for f in schema) for r in rows.get(name, [])]
            return spark.createDataFrame(full, schema)

        return Tables(load)

    return build


@pytest.fixture(scope="session")
def rows():
    """A DataFrame's rows as a sorted list of tuples of the named columns."""

    def collect(df, *columns: str) -> list[tuple]:
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
