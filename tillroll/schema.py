"""The three order schemas: raw CSV, aligned and enriched table."""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tillroll.functions.names import clean_names

_INT, _DOUBLE, _STRING = IntegerType(), DoubleType(), StringType()

# Header and type of every CSV column, in file order.
RAW_COLUMNS: dict[str, DataType] = {
    "Customer ID": _INT,
    "Age": _INT,
    "Gender": _STRING,
    "Item Purchased": _STRING,
    "Category": _STRING,
    "Purchase Amount (USD)": _DOUBLE,
    "Location": _STRING,
    "Size": _STRING,
    "Color": _STRING,
    "Season": _STRING,
    "Review Rating": _DOUBLE,
    "Subscription Status": _STRING,
    "Shipping Type": _STRING,
    "Discount Applied": _STRING,
    "Promo Code Used": _STRING,
    "Previous Purchases": _INT,
    "Payment Method": _STRING,
    "Frequency of Purchases": _STRING,
}

# Name and type of every computed column, in table order.
COMPUTED_COLUMNS: dict[str, DataType] = {
    "final_amount_usd": _DOUBLE,
    "amount_category": _STRING,
    "customer_segment": _STRING,
    "satisfaction_level": _STRING,
    "is_anomaly": BooleanType(),
    "estimated_clv": _DOUBLE,
    "frequency_category": _STRING,
    "estimated_profit_usd": _DOUBLE,
    "season_type": _STRING,
    "loyalty_score": _STRING,
}


def _struct(columns: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


#: The 18 business columns under their clean names; also what the row hash covers.
BUSINESS_COLUMNS: dict[str, DataType] = dict(
    zip(clean_names(RAW_COLUMNS), RAW_COLUMNS.values(), strict=True)
)
PROCESSED_TIME = "processed_time"
#: Day the row was ingested, the partition column of the stored table.
PROCESSED_DATE = "processed_date"
ROW_HASH = "row_hash"
#: The stream and the micro-batch that wrote a row; partition columns too.
STREAM_ID = "stream_id"
BATCH_ID = "batch_id"

ALIGNED_COLUMNS: dict[str, DataType] = BUSINESS_COLUMNS | {PROCESSED_TIME: TimestampType()}

RAW_SCHEMA = _struct(RAW_COLUMNS)
#: Text of a record of which a cell did not convert, or with a wrong number of cells.
REJECTED = "_rejected"
RAW_SCHEMA_WITH_REJECTED = _struct(RAW_COLUMNS | {REJECTED: _STRING})
ALIGNED_SCHEMA = _struct(ALIGNED_COLUMNS)
TABLE_SCHEMA = _struct(ALIGNED_COLUMNS | COMPUTED_COLUMNS)
#: What lies in the files of a stored table: the table plus its helper columns.
STORED_SCHEMA = _struct(
    ALIGNED_COLUMNS
    | COMPUTED_COLUMNS
    | {ROW_HASH: _STRING, PROCESSED_DATE: DateType(), STREAM_ID: _STRING, BATCH_ID: LongType()}
)
