"""Registered round trips: tables written in each format to the shared folder, and read back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerclock.operators import ml, tags
from answerclock.operators.storage import delete_at_exit, shared_folder, stored
from answerclock.plans import queries as base
from answerclock.plans.stand_in import posts
from answerclock.schemas import (
    POST_EXPORT,
    POSTS,
    RESPONSE_TIMES,
    TAG_TABLE,
)
from answerclock.sources import readers, writers

TITLE = "CASE WHEN post_type_id = 1 THEN concat('Why \"', id, '\" <b> & é?') END"
BODY = "concat('<p>first ', id, '</p>\\n\\'second\\', <code>a, b</code>')"


def _folder(spark: SparkSession) -> str:
    path = shared_folder(spark)
    delete_at_exit(spark, path)
    return path


def full_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The post table with titles and bodies that have quotes, tags, line ends and commas."""
    texts = posts(spark, sf_dir).withColumns({"title": F.expr(TITLE), "body": F.expr(BODY)})
    return texts.select(*[F.col(f.name).cast(f.dataType) for f in POSTS])


def _posts_in(fmt: str):
    def run(spark, sf_dir):
        path = _folder(spark)
        writers.write_posts(full_posts(spark, sf_dir), path, fmt)
        return readers.read_posts(spark, path, fmt)

    return run


posts_json = _posts_in("json")
posts_xml = _posts_in("xml")
posts_csv = _posts_in("csv")
posts_parquet = _posts_in("parquet")


def posts_xml_lines(spark, sf_dir):
    """An XML dump with a post on each line, split among tasks and parsed by line."""
    path = _folder(spark)
    writers.write_post_lines(full_posts(spark, sf_dir), path)
    return readers.read_post_lines(spark, path)


def posts_by_format(spark, sf_dir):
    """The same dump from each source, told apart by the format. The posts are made once."""
    source, found = stored(full_posts(spark, sf_dir)), None
    for fmt in ("json", "xml", "csv", "parquet"):
        path = _folder(spark)
        writers.write_posts(source, path, fmt)
        read = readers.read_posts(spark, path, fmt).select(
            F.lit(fmt).alias("format"), "id", "parent_id", "creation_date", "tags", "title"
        )
        found = read if found is None else found.unionByName(read)
    return found


def tag_table_csv(spark, sf_dir):
    """The tag table as one positional CSV file with declared types."""
    path = _folder(spark)
    writers.write_csv(base.tag_features(spark, sf_dir), path, files=1, mode="error")
    read = readers.read_features(spark, path, TAG_TABLE)
    return base._rounded(read).withColumn("files", F.lit(len(read.inputFiles())))


def export_csv(spark, sf_dir):
    """The narrow export, written without a header and read by position."""
    path = _folder(spark)
    writers.write_csv(base.post_projection(spark, sf_dir), path)
    names = POST_EXPORT.fieldNames()
    kinds = [f.dataType.simpleString() for f in POST_EXPORT]
    return readers.read_positional(spark, path, names, kinds)


def delays_csv_appended(spark, sf_dir):
    """Answer delays of odd and even questions, appended one after the other in eight files."""
    path = _folder(spark)
    delays = tags.answer_delays(posts(spark, sf_dir), base.ANSWERS_MIN_YEAR)
    for rest in (0, 1):
        part = delays.filter(F.col("id") % 2 == rest)
        writers.write_csv(part, path, files=8, mode="append")
    return readers.read_positional(spark, path, ["tag", "id", "delay_hours"], ["string", "long", "double"])


def labels_csv_overwritten(spark, sf_dir):
    """Labels written twice; the second time replaces the first."""
    path = _folder(spark)
    labels = base._labels(spark, sf_dir).select("id", "label")
    for _ in range(2):
        writers.write_csv(labels, path, mode="overwrite")
    return readers.read_positional(spark, path, ["id", "label"], ["long", "int"])


def labels_csv_header(spark, sf_dir):
    """Lines of one labels file with a header and of one without: (header, lines, first)."""
    labels = base._labels(spark, sf_dir).select("id", "label")
    found = None
    for header in (False, True):
        path = _folder(spark)
        writers.write_csv(labels.orderBy("id").coalesce(1), path, header=header)
        lines = spark.read.text(path)
        is_name = F.col("value") == "id,label"
        counted = lines.agg(
            F.lit(header).alias("header"),
            F.count(F.lit(1)).alias("lines"),
            F.coalesce(F.sum(is_name.cast("long")), F.lit(0)).alias("names"),
        )
        found = counted if found is None else found.unionByName(counted)
    return found


def response_times_json(spark, sf_dir):
    """Response times as gzip JSON with a declared schema."""
    path = _folder(spark)
    writers.write_json(base._times(spark, sf_dir).select(*RESPONSE_TIMES.fieldNames()), path)
    return readers.read_json(spark, path, RESPONSE_TIMES)


def vectors_json(spark, sf_dir):
    """Assembled vectors as gzip JSON, read back as one row per post and position."""
    path = _folder(spark)
    vectors = ml.assemble(base._rounded(base._all_features(spark, sf_dir)))
    writers.write_json(vectors.select("id", "label", "features"), path)
    read = readers.read_vectors(spark, path)
    return read.select(
        "id", "label", F.posexplode(vector_to_array("features")).alias("place", "value")
    )


def stored_model(spark, sf_dir):
    """Naive Bayes fitted, written, read again, and then asked for the test part."""
    held = ml.checkpointed(base._all_features(spark, sf_dir))
    train, test = ml.train_test_split(held)
    path = _folder(spark)
    ml.write_model(ml.fit(train, "nb"), path)
    return ml.read_model(path).transform(test).select("id", "label", "prediction")


_REGISTERED = [
    posts_xml_lines,
    posts_by_format,
    tag_table_csv,
    export_csv,
    delays_csv_appended,
    labels_csv_overwritten,
    labels_csv_header,
    response_times_json,
    vectors_json,
    stored_model,
]


def queries() -> dict:
    named = {query.__name__: query for query in _REGISTERED}
    return named | {
        "posts_json": posts_json,
        "posts_xml": posts_xml,
        "posts_csv": posts_csv,
        "posts_parquet": posts_parquet,
    }
