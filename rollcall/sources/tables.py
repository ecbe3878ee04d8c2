"""Table handles: named DataFrames with the declared columns and types."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rollcall.sources.schemas import BASE_TABLES


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Selects the declared columns in order, with the declared types.

    Join keys get their type here, once, so that no join compares casts.
    """
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.to(schema)


class Tables(Mapping[str, DataFrame]):
    """The base tables of one snapshot, looked up by name when first used."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(lambda name: frames[name])

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        """One parquet folder per table under ``root``."""
        return cls(lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, schemas: Mapping[str, str]) -> Tables:
        """Catalog tables; ``schemas`` maps a table name to its qualified name."""
        return cls(lambda name: spark.table(schemas.get(name, name)))

    def replaced(self, **frames: DataFrame) -> Tables:
        """The same snapshot with some tables swapped."""
        return Tables(lambda name: frames[name] if name in frames else self[name])

    def narrowed(self, **frames: DataFrame) -> Tables:
        """The same snapshot with some tables cut to fewer rows and columns; they have no others."""
        tables = Tables(self.__getitem__)
        tables._frames.update(frames)
        return tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = conform(self._load(name), BASE_TABLES[name])
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BASE_TABLES)

    def __len__(self) -> int:
        return len(BASE_TABLES)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Makes derived tables readable by name from SQL in the same session."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
