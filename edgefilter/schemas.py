"""Fixed record layouts shared by the batch, file and stream paths."""

from pyspark.sql import types as T

# Edit record: batch CSV (no header) and stream JSON use the same nine fields.
EDIT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("bot", T.BooleanType(), True),
    T.StructField("length", T.IntegerType(), True),
    T.StructField("wiki", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("minor", T.BooleanType(), True),
    T.StructField("comment", T.StringType(), True),
])

EDIT_COLUMNS = [f.name for f in EDIT_SCHEMA.fields]

# Stream messages are parsed as an array of records; a single object is
# accepted by the same schema and yields a one-element array.
EDIT_STREAM_SCHEMA = T.ArrayType(EDIT_SCHEMA)

# Raw change event of the public edit feed (nested length, epoch seconds).
RAW_CHANGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("server_name", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("bot", T.BooleanType(), True),
    T.StructField("wiki", T.StringType(), True),
    T.StructField("minor", T.BooleanType(), True),
    T.StructField("comment", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("length", T.StructType([
        T.StructField("new", T.IntegerType(), True),
        T.StructField("old", T.IntegerType(), True),
    ]), True),
])

# Page-view top list: items[].articles[].article
PAGEVIEW_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("articles", T.ArrayType(T.StructType([
            T.StructField("article", T.StringType(), True),
        ])), True),
    ])), True),
])

# Listings: only the name column is used downstream.
LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
])
