"""Mission files, metadata and vectors."""

from __future__ import annotations

import io
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.functions.scalars import duration_hours
from tallytide.scale import dimension_join
from tallytide.schema import METADATA, TELEMETRY

CORRUPT = "_corrupt"
PRUNE_NAMES = 1_000  # series that are named one by one in a filter on files


def _read_csv(spark: SparkSession, paths: str | Sequence[str], known: T.StructType) -> DataFrame:
    """CSV by column name with the types of ``known``; other columns stay text.

    The header of one file gives the order; a file whose header differs is an
    error. Text ``NaN`` and empty fields are NULL, and a line that does not parse
    keeps its text in the corrupt column.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = spark.read.option("header", True).option("inferSchema", False).csv(paths).columns
    types = {f.name: f.dataType for f in known.fields}
    fields = [T.StructField(n, types.get(n, T.StringType())) for n in names]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "NaN")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(paths)
    )


def read_metadata(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per series, with ``duration_hours``; the route is text."""
    meta = _read_csv(spark, path, METADATA).drop(CORRUPT)
    if "startTime_unix" in meta.columns and "endTime_unix" in meta.columns:
        meta = meta.withColumn("duration_hours", duration_hours(F.col("startTime_unix"), F.col("endTime_unix")))
    return meta


def _empty(spark: SparkSession, schema: T.StructType, columns: Sequence[str] | None) -> DataFrame:
    wanted = [f for f in schema.fields if columns is None or f.name in columns]
    return spark.createDataFrame([], T.StructType(wanted))


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_mission(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType = TELEMETRY
) -> DataFrame:
    """One series file; an empty table of the same schema if the file does not exist."""
    try:
        rows = _read_csv(spark, path, schema)
    except AnalysisException as error:
        if _missing(error):
            return _empty(spark, schema, columns)
        raise
    return rows.select(*columns) if columns else rows.drop(CORRUPT)


def corrupt_rows(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = TELEMETRY) -> int:
    """How many lines of the files do not parse."""
    rows = _read_csv(spark, paths, schema)
    # a digest of all columns, so that a bad value in any of them is parsed and counts
    digest = F.max(F.xxhash64(*[F.col(c) for c in rows.columns if c != CORRUPT]))
    return rows.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"), digest.alias("digest")).first()["bad"]


def read_missions(
    spark: SparkSession,
    directory: str | Sequence[str],
    meta: DataFrame,
    columns: Sequence[str] | None = None,
    attributes: Sequence[str] = ("busNumber",),
    schema: T.StructType = TELEMETRY,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """All series of ``meta`` that have a file, in one scan.

    The series name is the file name without ``.csv``, or the value of a
    ``mission_name=`` folder. Metadata rows without a file drop out, as do files
    without metadata. ``only`` names a few series and prunes the other files; it is taken from
    the metadata if that has at most ``PRUNE_NAMES`` of them.
    """
    if only is None:
        names = [r["name"] for r in meta.select("name").distinct().limit(PRUNE_NAMES + 1).collect()]
        only = names if len(names) <= PRUNE_NAMES else None
    try:
        rows = _read_csv(spark, directory, schema)
    except AnalysisException as error:
        if not _missing(error):
            raise
        empty = _empty(spark, schema, columns)
        return empty.withColumn("mission_name", F.lit(None).cast("string")).join(
            meta.select(F.col("name").alias("mission_name"), *attributes), "mission_name", "inner"
        )
    if "mission_name" not in rows.columns:
        if only is not None:
            rows = rows.filter(F.col("_metadata.file_name").isin([f"{n}.csv" for n in only]))
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
        rows = rows.withColumn("mission_name", name)
    elif only is not None:
        rows = rows.filter(F.col("mission_name").isin(list(only)))
    kept = rows.select(*columns, "mission_name") if columns else rows.drop(CORRUPT)
    dim = meta.select(F.col("name").alias("mission_name"), *attributes)
    return dimension_join(kept.withColumn("mission_name", F.col("mission_name").cast("string")), dim, ["mission_name"], "inner")


def read_vectors(spark: SparkSession, path: str, name: str = "mission_name") -> DataFrame:
    """(name, embedding) from one ``.npy`` file per series."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path)

    def decode(contents: pd.Series) -> pd.Series:
        return contents.map(lambda raw: np.load(io.BytesIO(raw), allow_pickle=False).astype(float).ravel())

    vector = F.pandas_udf(decode, T.ArrayType(T.DoubleType()))
    return files.select(
        F.regexp_extract("path", r"([^/]+)\.npy$", 1).alias(name), vector("content").alias("embedding")
    )
