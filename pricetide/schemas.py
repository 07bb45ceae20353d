"""Schemas of the tables this package reads and writes."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 2)


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REQUIRED_COLUMNS = ["isin", "name", "long_name", "price"]

INSTRUMENTS = T.StructType(
    [
        T.StructField("isin", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("long_name", T.StringType()),
        T.StructField("price", PRICE),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("update_iteration", T.LongType()),
    ]
)

PRICE_CHANGES = _struct(
    isin=T.StringType(),
    price=PRICE,
    updated_at=T.TimestampType(),
    update_iteration=T.LongType(),
)

UPDATE_METRICS = _struct(
    timestamp=T.TimestampType(),
    iteration=T.LongType(),
    total_instruments=T.LongType(),
    success_count=T.LongType(),
    error_count=T.LongType(),
    duration_seconds=T.DoubleType(),
    updates_per_second=T.DoubleType(),
)

SAMPLE = T.ArrayType(
    _struct(isin=T.StringType(), price=T.DoubleType(), long_name=T.StringType())
)

SEARCH_METRICS = _struct(
    timestamp=T.TimestampType(),
    search_id=T.LongType(),
    search_type=T.StringType(),
    query_type=T.StringType(),
    min_price=T.DoubleType(),
    max_price=T.DoubleType(),
    price_range_width=T.DoubleType(),
    text_query=T.StringType(),
    success=T.BooleanType(),
    duration_ms=T.DoubleType(),
    total_hits=T.LongType(),
    returned_hits=T.LongType(),
    hits_per_ms=T.DoubleType(),
    sample_data=SAMPLE,
    error=T.StringType(),
)

QUERIES = _struct(
    query_id=T.LongType(),
    search_type=T.StringType(),
    query_type=T.StringType(),
    min_price=T.DoubleType(),
    max_price=T.DoubleType(),
    terms=T.StringType(),
)

QUERY_TYPES = ["price_range", "text_search", "combined"]
