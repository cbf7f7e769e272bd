"""File sources and sinks.

Readers take an explicit schema, so no inference pass scans the input.
Writers are distributed (one file per partition); nothing is collected to the
driver.  Flat formats (CSV) cannot hold arrays or maps, so such columns are
rendered as JSON text first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocab


BOM = "\ufeff"


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


POSTING_SCHEMA = _strings(vocab.POSTING_COLUMNS)
CLEANED_SCHEMA = _strings([*vocab.POSTING_COLUMNS, "keyword_category"])
CLUSTERED_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in vocab.CLUSTERED_COLUMNS[:6]]
    + [T.StructField("has_salary", T.IntegerType(), True),
       T.StructField("cluster", T.IntegerType(), True)])


#: The dialect of both sides: fields quoted with ``"``, a quote inside doubled, spaces kept;
#: NULL is an empty field and the empty string a quoted empty field.
_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}
#: The reader puts ``nullValue`` for an unquoted empty field and turns it into NULL; a value
#: that no text holds keeps quoted empty strings apart.
_READ = {**_DIALECT, "nullValue": "\u0000", "emptyValue": ""}
_WRITE = {**_DIALECT, "nullValue": "", "emptyValue": '""'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             encoding: str = "utf-8", header: bool = True, multiline: bool = True) -> DataFrame:
    """CSV with a header row; a UTF-8 byte-order mark is accepted.

    Quoted fields may hold line breaks, doubled quotes and separators.  A file
    is then one split; ``multiline=False`` lets large files be split where no
    field holds a line break.  Without ``schema`` every column is read as
    string (no inference pass).
    """
    reader = (spark.read.options(**_READ).option("header", header)
              .option("encoding", encoding).option("multiLine", multiline))
    if schema is None:
        reader = reader.option("inferSchema", False)
    else:
        reader = reader.schema(schema)
    df = reader.csv(path)
    # a BOM that survives in the first header name is dropped from it
    first = df.columns[0] if df.columns else None
    if first and first.startswith(BOM):
        df = df.withColumnRenamed(first, first[len(BOM):])
    return df


def read_checked(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                 **options) -> tuple[DataFrame, DataFrame]:
    """The rows that fit ``schema``, and the rejected records.

    A CSV record with fewer or more fields than the schema, and a CSV or JSON Lines record
    that does not parse or holds a value of another type, is no row; it is given back as
    ``file, raw`` with its whole text.  Every other record is a row.  An empty CSV line is
    no record.  CSV is read in the dialect of ``write_csv``; ``options`` go to the reader.
    """
    raw = "_raw"
    while raw.lower() in {f.name.lower() for f in schema.fields}:
        raw = f"_{raw}"
    wide = T.StructType([*schema.fields, T.StructField(raw, T.StringType(), True)])
    base = {**_READ, "header": True, "enforceSchema": True, "columnPruning": False} if fmt == "csv" else {}
    df = spark.read.format(fmt).options(**{**base, **options}).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", raw).schema(wide).load(path)
    # A reader parses only the fields that a query needs, and refuses one that needs the raw text
    # alone: an always true condition on all fields keeps them in every query.
    missing = [F.col(f"`{f.name}`").isNull() for f in schema.fields]
    df = df.filter(F.xxhash64(*missing) >= F.lit(-(1 << 63)))
    rows = df.filter(F.col(raw).isNull()).select(*[f"`{f.name}`" for f in schema.fields])
    rejects = df.filter(F.col(raw).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(raw).alias("raw"))
    return rows, rejects


def flatten_for_text(df: DataFrame) -> DataFrame:
    """Render array, map and struct columns as JSON text (flat formats cannot hold them)."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out[f.name] = F.to_json(F.col(f.name))
    return df.withColumns(out) if out else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, nested columns flattened to JSON text.

    ``read_csv`` gives every value back: line breaks, quotes, edge spaces,
    empty strings and NULLs.  A single nullable column is refused: its NULL
    would be a blank line, which no reader keeps.
    """
    if len(df.columns) == 1 and df.schema.fields[0].nullable:
        raise ValueError("a CSV of one nullable column cannot hold NULL")
    flatten_for_text(df).write.mode(mode).options(**_WRITE).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, UTF-8 kept."""
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, chunk: Column, mode: str = "overwrite") -> None:
    """JSON arrays, one per line: the rows of equal ``chunk`` are one array.

    The caller bounds an array by its chunk expression (e.g. a key divided by 1,000).
    """
    rows = df.groupBy(chunk.alias("_chunk")).agg(F.collect_list(F.struct(*df.columns)).alias("_rows"))
    rows.select(F.to_json("_rows").alias("value")).write.mode(mode).text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multiline: bool = False) -> DataFrame:
    """JSON Lines - an object or an array of objects per line - or, with
    ``multiline``, one JSON array per file."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet",
                   hide: tuple[str, ...] = ("_id",)) -> DataFrame:
    """Read documents back without the hidden fields."""
    df = spark.read.format(fmt).load(path)
    drop = [c for c in hide if c in df.columns]
    return df.drop(*drop) if drop else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session temp view; returns the frame."""
    df.createOrReplaceTempView(name)
    return df
