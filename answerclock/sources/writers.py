"""Writers. A rerun replaces its output unless another mode is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerclock.schemas import POST_COLUMNS
from answerclock.sources.readers import ROW_TAG

ROOT_TAG = "posts"  # fixed value: the element around all posts in the XML dump
# Posts as text repeat their attribute names and shrink to a tenth. A compressed text file is
# read by one task, so it holds no more than so many posts.
COMPRESSION = {"json": "gzip", "xml": "gzip", "csv": "gzip", "parquet": "zstd"}
FILE_POSTS = 500_000


def _parts(df: DataFrame, files: int | None) -> DataFrame:
    """``files`` output partitions. The shuffle keeps the work before it parallel."""
    return df if files is None else df.repartition(files)


def write_csv(
    df: DataFrame,
    path: str,
    files: int | None = None,
    mode: str = "overwrite",
    header: bool = False,
) -> None:
    _parts(df, files).write.mode(mode).option("header", header).csv(path)


def write_json(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip"
) -> None:
    df.write.mode(mode).option("compression", compression).json(path)


def _raw(posts: DataFrame) -> DataFrame:
    return posts.select([F.col(new).alias(name) for name, (new, _) in POST_COLUMNS.items()])


def _dated(raw: DataFrame) -> DataFrame:
    """Times as ISO text, as the dump has them; XML has no type for times without a zone."""
    times = [f.name for f in raw.schema if f.dataType == T.TimestampNTZType()]
    return raw.withColumns({c: F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("T")) for c in times})


def write_post_lines(
    posts: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip"
) -> None:
    """Posts as XML elements, one on each line, readable with ``read_post_lines``."""
    element = F.to_xml(F.struct("*"), {"rowTag": ROW_TAG, "attributePrefix": "_", "indent": ""})
    # Line ends inside an attribute are written as references, so that a post stays on its line.
    line = F.trim(element)
    for sign, reference in (("\n", "&#10;"), ("\r", "&#13;")):
        line = F.replace(line, F.lit(sign), F.lit(reference))
    writer = _dated(_raw(posts)).select(line.alias("value")).write.mode(mode)
    writer = writer.option("maxRecordsPerFile", FILE_POSTS)
    writer.option("compression", compression).text(path)


def write_posts(
    posts: DataFrame,
    path: str,
    fmt: str = "json",
    mode: str = "overwrite",
    compression: str | None = None,
) -> None:
    """Posts under the attribute names of the dump, readable with ``read_posts``.

    ``compression`` is Spark's name of a codec (``none`` for plain files); gzip for text and
    zstd for Parquet if it is not given.
    """
    raw = _raw(posts)
    writer = (_dated(raw) if fmt == "xml" else raw).write.format(fmt).mode(mode)
    if fmt == "xml":
        writer = writer.option("rowTag", ROW_TAG).option("rootTag", ROOT_TAG)
        writer = writer.option("attributePrefix", "_")
    compression = compression or COMPRESSION.get(fmt)
    if compression:
        writer = writer.option("compression", compression)
    if fmt != "parquet":
        writer = writer.option("maxRecordsPerFile", FILE_POSTS)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
