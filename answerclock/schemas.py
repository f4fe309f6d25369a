"""Declared schemas of the files the library reads and writes.

Post timestamps carry no zone, so they are ``timestamp_ntz``: differences and
year bounds then do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

# Attribute names of the post dump, and the name of each column here.
POST_COLUMNS = {
    "_Id": ("id", T.LongType()),
    "_PostTypeId": ("post_type_id", T.IntegerType()),
    "_ParentId": ("parent_id", T.LongType()),
    "_AcceptedAnswerId": ("accepted_answer_id", T.LongType()),
    "_CreationDate": ("creation_date", T.TimestampNTZType()),
    "_LastActivityDate": ("last_activity_date", T.TimestampNTZType()),
    "_Title": ("title", T.StringType()),
    "_Body": ("body", T.StringType()),
    "_Tags": ("tags", T.StringType()),
    "_ViewCount": ("view_count", T.LongType()),
    "_AnswerCount": ("answer_count", T.LongType()),
    "_CommentCount": ("comment_count", T.LongType()),
}

RAW_POSTS = T.StructType([T.StructField(raw, kind) for raw, (_, kind) in POST_COLUMNS.items()])
POSTS = T.StructType([T.StructField(name, kind) for name, kind in POST_COLUMNS.values()])

# Feature columns, in the order the feature files hold them.
TAG_FEATURES = ["PR", "ASR", "TCF", "VCF", "ACF", "latf_h", "RSR"]
TEXT_FEATURES = [
    "num_code_snippet",
    "code_len",
    "num_image",
    "body_len",
    "title_len",
    "end_que_mark",
    "begin_que_word",
    "is_weekend",
]
FEATURES = TAG_FEATURES + TEXT_FEATURES

_COUNTS = "num_code_snippet int, code_len int, num_image int, body_len int, title_len int"
_FLAGS = "end_que_mark boolean, begin_que_word boolean, is_weekend boolean"
_TAG_MEANS = ", ".join(f"{name} double" for name in TAG_FEATURES)


def _schema(ddl: str) -> T.StructType:
    fields = (part.strip().split(" ") for part in ddl.split(","))
    kinds = {
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "boolean": T.BooleanType(),
        "string": T.StringType(),
        "timestamp_ntz": T.TimestampNTZType(),
    }
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


# Intermediate tables: positional CSV without a header unless said otherwise.
ASR_PR = _schema("tag string, PR double, ASR double")
FOUR = _schema("tag string, TCF long, VCF long, ACF long, latf_h double")
DELAYS = _schema("tag string, id long, delay_hours double")
TAG_TABLE = _schema(f"tag string, {_TAG_MEANS}")
POST_TAGS = _schema(f"id long, {_TAG_MEANS}")
TEXT_TABLE = _schema(f"id long, {_COUNTS}, {_FLAGS}")
ALL_FEATURES = _schema(f"{_TAG_MEANS}, {_COUNTS}, {_FLAGS}, id long, label int")
POST_EXPORT = _schema("tags string, id long, time long, post_type_id int, parent_id long")
RESPONSE_TIMES = _schema("creation_date timestamp_ntz, response_hours double")  # JSON
VECTORS = T.StructType(  # JSON
    [
        T.StructField("id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("features", VectorUDT()),
    ]
)
