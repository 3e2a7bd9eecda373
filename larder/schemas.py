"""Fixed schemas of the tables and messages. Every production read passes one of these."""

from pyspark.sql import types as T

_S = T.StringType()
_STRINGS = T.ArrayType(T.StringType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_CORPUS = _struct(
    ("row_label", T.LongType()),
    ("title", _S),
    ("ingredients", _S),
    ("directions", _S),
    ("link", _S),
    ("source", _S),
    ("NER", _S),
)

DISH = _struct(
    ("dish_id", T.LongType()),
    ("uid", _S),
    ("dish", _S),
    ("ingredients", _S),
    ("quantities", _S),
    ("directions", _S),
    ("description", _S),
    ("prep_time", T.LongType()),
    ("cook_time", T.LongType()),
    ("total_time", T.LongType()),
    ("yields", _S),
    ("category", _S),
    ("cuisine", _S),
    ("ratings", T.DoubleType()),
    ("url", _S),
    ("img", _S),
    ("source", _S),
)
DISH_COLUMNS = DISH.fieldNames()

SCRAPED_DISH_COLUMNS = [
    *DISH_COLUMNS[: DISH_COLUMNS.index("url") + 1],
    "base_url",
    "img",
    "source",
]

SCRAPED = _struct(
    ("uid", _S),
    ("url", _S),
    ("author", _S),
    ("canonical_url", _S),
    ("category", _S),
    ("cuisine", _S),
    ("description", _S),
    ("host", _S),
    ("image", _S),
    ("ingredients", _STRINGS),
    ("instructions", _S),
    ("instructions_list", _STRINGS),
    ("language", _S),
    ("ratings", _S),
    ("site_name", _S),
    ("title", _S),
    ("total_time", _S),
    ("cook_time", _S),
    ("prep_time", _S),
    ("yields", _S),
    ("ingredient_tags", _STRINGS),
)

# The sanitized record: key -> kind, in the fixed output order.
SANITIZED_KEYS = {
    "host": "text",
    "title": "text",
    "category": "list",
    "total_time": "int",
    "cook_time": "int",
    "prep_time": "int",
    "yields": "text",
    "image": "text",
    "ingredients": "list",
    "instructions": "list",
    "ratings": "int",
    "author": "text",
    "cuisine": "list",
    "description": "text",
    "uid": "text",
    "url": "text",
    "ingredient_tags": "list",
}
_KINDS = {"text": _S, "int": T.LongType(), "list": _STRINGS}
SANITIZED = _struct(*((key, _KINDS[kind]) for key, kind in SANITIZED_KEYS.items()))

UNIQUE_INGREDIENTS = _struct(
    ("ingredients_id", T.LongType()), ("ingredients", _S), ("count", T.LongType())
)

URL_LIST = _struct(("uid", _S), ("url", _S))

CHUNK_MANIFEST = _struct(
    ("start_index", T.LongType()),
    ("nrows", T.LongType()),
    ("s3_bucket", _S),
    ("s3_file_path", _S),
)

QUEUE_MESSAGE = _struct(("messageId", _S), ("body", _S))

OBJECT_EVENT = _struct(
    (
        "Records",
        T.ArrayType(
            _struct(
                (
                    "s3",
                    _struct(
                        ("bucket", _struct(("name", _S))),
                        ("object", _struct(("key", _S))),
                    ),
                )
            )
        ),
    )
)

FAILURE = _struct(
    ("uid", _S), ("url", _S), ("status_code", T.LongType()), ("timestamp", T.LongType())
)

PAGE = _struct(("url", _S), ("html", _S))
