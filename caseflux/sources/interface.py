"""What a source can do: collect by date range, validate, tell about itself."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflux.sources.tables import table


class Source(ABC):
    """A source of rows; everything stays a DataFrame."""

    name: str

    @abstractmethod
    def collect(self, start: str, end: str) -> DataFrame:
        """Rows between two moments, both included."""

    @abstractmethod
    def validate(self, rows: DataFrame) -> DataFrame:
        """The rows that can be used."""

    @abstractmethod
    def info(self, start: str, end: str) -> DataFrame:
        """(name, rows_read, valid, first_day, last_day), one row."""


class TableSource(Source):
    """A table of a data folder, by a time column; the range reaches the scan."""

    def __init__(self, spark: SparkSession, folder: str, name: str, when: str, required: tuple[str, ...]):
        self.spark, self.folder, self.name, self.when, self.required = spark, folder, name, when, required

    def collect(self, start: str, end: str) -> DataFrame:
        return table(self.spark, self.folder, self.name).where(F.col(self.when).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))

    def validate(self, rows: DataFrame) -> DataFrame:
        return rows.dropna(subset=list(self.required))

    def info(self, start: str, end: str) -> DataFrame:
        usable = F.lit(True)
        for c in self.required:
            usable = usable & F.col(c).isNotNull()
        day = lambda c: c.cast("date").cast("string")
        return self.collect(start, end).agg(F.count("*").alias("rows_read"), F.count_if(usable).alias("valid"), day(F.min(self.when)).alias("first_day"), day(F.max(self.when)).alias("last_day")).select(F.lit(self.name).alias("name"), "*")
