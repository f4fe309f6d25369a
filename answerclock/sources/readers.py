"""Readers with declared schemas: no inference pass over the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerclock.schemas import POST_COLUMNS, RAW_POSTS, VECTORS

ROW_TAG = "row"  # fixed value: the element of one post in the XML dump


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal out rows that arrive in fewer partitions than there are cores.

    A gzip file cannot be split and a small file has one row group, so one task
    would do all the work on it. Inputs with enough partitions stay as they are.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def read_posts(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "json",
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Posts from ``json``, ``xml``, ``csv`` (header) or ``parquet``; columns as ``schemas.POSTS``.

    ``mode`` is Spark's: malformed records become nulls, are dropped (``DROPMALFORMED``) or end
    the job (``FAILFAST``). ``corrupt_column`` adds their text under that name.

    For repeated use of a gzip dump, write it once as Parquet (``write_posts``).
    """
    schema, names = RAW_POSTS, [F.col(n).alias(new) for n, (new, _) in POST_COLUMNS.items()]
    if corrupt_column and fmt != "parquet":
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        names = [*names, F.col(corrupt_column)]
    reader = spark.read.schema(schema).format(fmt)
    if fmt != "parquet":
        reader = reader.option("mode", mode)
        if corrupt_column:
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if fmt == "xml":
        reader = reader.option("rowTag", ROW_TAG).option("attributePrefix", "_")
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    raw = reader.load(path if isinstance(path, str) else list(path))
    posts = raw.select(names)
    # Files that are read whole get packed into a few tasks less than there are cores. They are
    # parsed by then, so moving all texts to a few more tasks would gain nothing.
    enough = len(raw.inputFiles()) >= spark.sparkContext.defaultParallelism
    return posts if enough else spread(posts)


def read_features(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headerless positional CSV table with a declared schema."""
    return spark.read.schema(schema).csv(path)


def read_positional(
    spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str]
) -> DataFrame:
    """A headerless CSV table by column position: ``names`` with Spark type ``types``."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, types, strict=True))
    return spark.read.schema(ddl).csv(path)


def read_vectors(spark: SparkSession, path: str, schema: T.StructType = VECTORS) -> DataFrame:
    """JSON rows with an ML vector column."""
    return spark.read.schema(schema).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_xml_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_POSTS,
    row_tag: str = ROW_TAG,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Elements that stand on a line each, parsed line by line; raw columns as in ``schema``.

    Text files are split anywhere, so a large dump is read by many tasks, where the XML reader
    may take one per file (a compressed file stays one task). Lines that do not begin with
    the element are left out; those that cannot be parsed become nulls, with their text in
    ``corrupt_column`` if that is given.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    element = F.ltrim("value")
    rows = lines.filter(element.rlike(rf"^<{row_tag}[\s/>]"))
    options = {"rowTag": row_tag, "attributePrefix": "_", "mode": "PERMISSIVE"}
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return rows.select(F.from_xml(F.trim("value"), schema, options).alias("row")).select("row.*")


def read_post_lines(
    spark: SparkSession, path: str | Sequence[str], corrupt_column: str | None = None
) -> DataFrame:
    """``read_posts`` of an XML dump with a post on each line, by many tasks."""
    raw = read_xml_lines(spark, path, corrupt_column=corrupt_column)
    names = [F.col(n).alias(new) for n, (new, _) in POST_COLUMNS.items()]
    return raw.select(*names, *([corrupt_column] if corrupt_column else []))
