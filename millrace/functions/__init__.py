from millrace.functions.columns import (
    business_columns,
    cast_columns,
    feature_columns,
    with_arrival,
    with_audit,
    with_partitions,
)
from millrace.functions.joins import any_null, anti_join
from millrace.functions.rules import RuleBook
from millrace.functions.times import from_micros, processing_time, time_literal, to_micros

__all__ = [
    "RuleBook",
    "any_null",
    "anti_join",
    "business_columns",
    "cast_columns",
    "feature_columns",
    "from_micros",
    "processing_time",
    "time_literal",
    "to_micros",
    "with_arrival",
    "with_audit",
    "with_partitions",
]
