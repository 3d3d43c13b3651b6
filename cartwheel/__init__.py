"""cartwheel: retail-order warehouse load on PySpark.

CSV lines -> dedupe -> clean (Column expressions) -> staging Parquet ->
key upsert into dimensions -> calendar dimension -> transaction fact.

Every operator is a function from DataFrames to a DataFrame; nothing is
collected to the driver and no Python UDF runs in the hot path.
"""

from cartwheel.session import get_session

__all__ = ["get_session"]
