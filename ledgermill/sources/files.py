"""File sources: CSV extracts and Parquet copies of the source tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgermill.sources.lake import SourceLake, path_exists
from ledgermill.sources.mappings import Mapping
from ledgermill.sources.quoted import read_quoted


OPTIONS = {"quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": "", "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """A header CSV with a declared schema; a bad field fails the job.

    An empty field is NULL and a quoted empty field an empty text. By default Spark reads both as
    NULL, since both equal its null text; no field equals the one set here.
    Quotes inside a field are doubled, as in JSON columns; without ``escape='"'`` Spark would split
    such a field at its commas and shift the columns after it.
    With ``multi_line``, quoted fields may hold line breaks. One file is still read by as many tasks as it has
    blocks (``sources.quoted``); only files that quote all fields that hold a quote may be read so.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"missing input file: {path}")
    optional = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    if multi_line:
        return read_quoted(spark, path, optional, OPTIONS)
    return spark.read.schema(optional).options(header=True, enforceSchema=False, **OPTIONS).csv(path)


class CsvSource:
    """``<folder>/<source table>.csv``; tables named in ``multi_line`` have line breaks in quoted fields."""

    def __init__(self, spark: SparkSession, folder: str, multi_line: Iterable[str] = ()):
        self.spark, self.folder, self.multi_line = spark, folder, frozenset(multi_line)

    def table(self, mapping: Mapping, watermark: object = None) -> DataFrame:
        name = mapping.source_table
        return read_csv(self.spark, f"{self.folder}/{name}.csv", mapping.source_schema, name in self.multi_line)


class ParquetSource:
    """``<folder>/<source table>`` as Parquet: its last complete version, or the files of the folder itself."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, mapping: Mapping, watermark: object = None) -> DataFrame:
        version = SourceLake(self.spark, self.folder).current(mapping.source_table)
        return self.spark.read.parquet(version or f"{self.folder}/{mapping.source_table}")
