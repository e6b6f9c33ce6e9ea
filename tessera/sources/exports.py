"""Source exports: CSV with every column as text (S1) and parquet staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import exprs as X
from tessera.schemas import EPR_COLUMNS, PACS_COLUMNS, RIS_COLUMNS


CORRUPT, FITS = "_corrupt_record", "_fits"
#: A row's place in its source.
POSITION = T.StructType([T.StructField("file", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("n", T.LongType())])
CSV_OPTIONS = {
    "header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    # a quoted field may hold line ends and doubled quotes
    "multiLine": True, "quote": '"', "escape": '"',
    # text is kept as written: " CT " is not "CT" for the vocabulary
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    # every file's header must be the one the columns were taken from, and all fields of
    # a record are counted whatever columns a query needs
    "enforceSchema": False, "columnPruning": False,
}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of an export; reads the first record only."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", False).csv(path).columns


def read_records(spark: SparkSession, path: str | list[str], position: str) -> DataFrame:
    """Every record of a CSV export with the columns of its header, its position, ``_fits``
    (whether it has as many fields as the header) and ``_corrupt_record`` (its text if not).

    Fields belong to columns by header name; a file of the set with another header is an
    error. Records end at line ends outside quotes, so one file is read by one task; a line
    end inside quotes is read as a line feed. The position (file, start of the file's split, number within it) is unique over the set and
    sorts in source order.
    """
    names = csv_header(spark, path)
    taken = {n.lower() for n in names} & {CORRUPT, FITS, position.lower()}
    if taken:
        raise ValueError(f"{path}: columns {sorted(taken)} clash with the reader's own")
    df = spark.read.schema(text_schema([*names, CORRUPT])).options(**CSV_OPTIONS).csv(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                  F.monotonically_increasing_id().alias("n"))
    # Spark refuses plans that read no column but the record's text, hence the second term.
    ragged = F.coalesce(F.octet_length(CORRUPT), F.octet_length(F.col(names[0])) * 0 - 1, F.lit(-1)) >= 0
    return df.select(at.alias(position), (~ragged).alias(FITS), *df.columns)


def read_csv_export(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                    position: str | None = None) -> DataFrame:
    """The named columns of an export as text, in the given order, pandas-style null
    tokens made null. ``position`` names a column for the row's place in its source.
    ``path`` may be a list of files; an empty list gives no rows.

    Columns are found by header name, whatever their order; further columns of the export
    are passed over, a missing one is an error. Records with more or fewer fields than the
    header are left out here and returned by :func:`csv_bad_records`.
    """
    at = position or "_position"
    if path == []:
        return spark.createDataFrame([], T.StructType([*([T.StructField(at, POSITION)] if position else []), *text_schema(columns)]))
    df = read_records(spark, path, at)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    return df.where(FITS).select(*([at] if position else []), *[X.null_tokens_to_null(c).alias(c) for c in columns])


def csv_bad_records(spark: SparkSession, path: str | list[str], position: str = "row_ix") -> DataFrame:
    """Records that do not fit the header: position, record_sha256, record (the raw text,
    which may hold raw ids: not for a sink that outlives the run)."""
    if path == []:
        return spark.createDataFrame([], T.StructType([T.StructField(position, POSITION), *text_schema(["record_sha256", "record"])]))
    df = read_records(spark, path, position).where(~F.col(FITS))
    return df.select(position, F.sha2(F.col(CORRUPT), 256).alias("record_sha256"), F.col(CORRUPT).alias("record"))


def type_ris(df: DataFrame) -> DataFrame:
    """RIS text -> typed: the three time stamps parsed, bad values null."""
    out = df
    for c in ("exam_start_dt", "exam_end_dt", "report_issued_dt"):
        if c in df.columns and dict(df.dtypes)[c] == "string":
            out = out.withColumn(c, X.parse_timestamp(c))
    return out


def type_pacs(df: DataFrame) -> DataFrame:
    """PACS text -> typed: counts, sizes and the acquisition time."""
    d = dict(df.dtypes)
    out = df
    if d.get("num_images") == "string":
        out = out.withColumn("num_images", X.strip("num_images").try_cast("int"))
    if d.get("image_size_mb") == "string":
        out = out.withColumn("image_size_mb", X.strip("image_size_mb").try_cast("double"))
    if d.get("acquisition_dt") == "string":
        out = out.withColumn("acquisition_dt", X.parse_timestamp("acquisition_dt"))
    return out


def type_epr(df: DataFrame) -> DataFrame:
    if dict(df.dtypes).get("date_of_birth") == "string":
        return df.withColumn("date_of_birth", F.try_to_date("date_of_birth", "yyyy-MM-dd"))
    return df


def read_ris_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv_export(spark, path, RIS_COLUMNS, "row_ix")


def read_pacs_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv_export(spark, path, PACS_COLUMNS)


def read_epr_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_export(spark, path, EPR_COLUMNS)
