"""Raw CSV scans with explicit schemas (S1-S5).

Every column is read as text with ``mode=FAILFAST`` (a row with the wrong
number of fields fails the job), null tokens are mapped to NULL, then each
column is cast under ANSI rules, so malformed values raise instead of turning
into NULL silently. Numbers must fit their type without loss: ``123.0`` (how a
float-typed export writes a nullable integer) becomes 123, ``1.9`` for an
integer or a third decimal in a two-decimal amount fails the job.

By default only the empty field is NULL; ``na_tokens`` adds more (e.g. the
pandas defaults, under which the country code ``NA`` would vanish).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import at_once, path_exists

RAW_COLUMNS = {
    "customers": ["customer_id", "signup_date", "country", "age", "gender", "loyalty_tier", "acquisition_channel"],
    "products": ["product_id", "category", "brand", "base_price", "launch_date", "is_premium"],
    "campaigns": ["campaign_id", "channel", "objective", "start_date", "end_date", "target_segment",
                  "expected_uplift"],
    "transactions": ["transaction_id", "timestamp", "customer_id", "product_id", "quantity", "discount_applied",
                     "gross_revenue", "campaign_id", "refund_flag"],
    "events": ["event_id", "timestamp", "customer_id", "session_id", "event_type", "product_id", "device_type",
               "traffic_source", "campaign_id", "page_category", "session_duration_sec", "experiment_group"],
}

_L, _I, _S, _D, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()
RAW_TYPES = {
    "customer_id": _L, "signup_date": _D, "country": _S, "age": _I, "gender": _S, "loyalty_tier": _S,
    "acquisition_channel": _S, "product_id": _L, "category": _S, "brand": _S, "base_price": T.DecimalType(10, 2),
    "launch_date": _D, "is_premium": _I, "campaign_id": _L, "channel": _S, "objective": _S, "start_date": _D,
    "end_date": _D, "target_segment": _S, "expected_uplift": T.DecimalType(6, 4), "transaction_id": _L,
    "timestamp": _TS, "quantity": _I, "discount_applied": T.DecimalType(5, 4), "gross_revenue": T.DecimalType(10, 2),
    "refund_flag": _I, "event_id": _L, "session_id": _L, "event_type": _S, "device_type": _S,
    "traffic_source": _S, "page_category": _S, "session_duration_sec": T.DecimalType(8, 2),
    "experiment_group": _S,
}

# Text that pandas' CSV reader turns into NaN by default (its documented list).
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _checked_number(text: Column, name: str, target: T.DataType) -> Column:
    """The number as ``target``; an error where the text has digits that it cannot hold."""
    wide = text.cast(T.DecimalType(38, 18))
    narrow = wide.cast(target)
    lossy = (wide != narrow) | text.rlike(r"\.\d{18}0*[1-9]")
    return (F.when(text.isNull(), F.lit(None).cast(target))
            .when(lossy, F.raise_error(F.concat(F.lit(f"{name}: "), text, F.lit(f" is not a {target.simpleString()}"))).cast(target))
            .otherwise(narrow))


def _exact_number(text: Column, name: str, target: T.DataType) -> Column:
    """``_checked_number``, in one parse where the spelling shows that nothing is lost: an integer without a point, a decimal
    with no exponent and no more digits after its point than ``target`` has. All other text is checked; as a function over an
    array, which keeps that long expression out of the compiled loop (a loop as long as that of eight checks is not compiled)."""
    plain = text.try_cast(target)
    if isinstance(target, T.DecimalType):
        point = F.instr(text, ".")
        short = (point == 0) | (F.length(text) - point <= target.scale)
        plain = F.when(short & (F.instr(text, "e") == 0) & (F.instr(text, "E") == 0), plain)
    checked = F.transform(F.array(text), lambda t: _checked_number(t, name, target))[0]
    return F.coalesce(plain, F.when(text.isNotNull(), checked))


def read_raw_csv(spark: SparkSession, path: str, entity: str,
                 na_tokens: Sequence[str] | None = None) -> DataFrame:
    cols = RAW_COLUMNS[entity]
    text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    df = (spark.read.schema(text_schema).option("header", True).option("mode", "FAILFAST")
          .option("enforceSchema", False).csv(path))
    tokens = list(na_tokens or ())
    out = []
    for c in cols:
        v = F.col(c)
        if tokens:
            v = F.when(v.isin(tokens), F.lit(None).cast("string")).otherwise(v)
        target = RAW_TYPES[c]
        if isinstance(target, (T.LongType, T.IntegerType, T.DecimalType)):
            v = _exact_number(v, c, target)
        elif isinstance(target, T.TimestampNTZType):
            v = F.to_timestamp_ntz(v)
        else:
            v = v.cast(target)
        out.append(v.alias(c))
    return df.select(*out)


#: CSV entity of each star table.
ENTITY = {"dim_customers": "customers", "dim_products": "products", "dim_campaigns": "campaigns",
          "fct_transactions": "transactions", "fct_events": "events"}


def read_raw_tables(spark: SparkSession, folder: str, na_tokens: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The five raw CSVs ``<folder>/<entity>.csv`` under their star-table names."""
    return {t: read_raw_csv(spark, f"{folder.rstrip('/')}/{e}.csv", e, na_tokens) for t, e in ENTITY.items()}


def raw_schema(table: str) -> T.StructType:
    """Columns and types of a star table as its raw CSV gives them."""
    return T.StructType([T.StructField(c, RAW_TYPES[c]) for c in RAW_COLUMNS[ENTITY[table]]])


def read_present_tables(spark: SparkSession, folder: str, na_tokens: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Those of the five raw CSVs that the folder has (an increment may lack some)."""
    base = folder.rstrip("/")
    return {t: read_raw_csv(spark, f"{base}/{e}.csv", e, na_tokens) for t, e in ENTITY.items() if path_exists(spark, f"{base}/{e}.csv")}


def write_raw_csv(tables: dict[str, DataFrame], folder: str) -> str:
    """Write star tables as raw CSVs (a folder of part files per entity)."""
    def write(table, raw):
        entity = ENTITY[table]
        df = raw.select(*RAW_COLUMNS[entity])
        df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(
            f"{folder.rstrip('/')}/{entity}.csv")

    if tables:
        at_once(next(iter(tables.values())).sparkSession, {t: partial(write, t, df) for t, df in tables.items()})
    return folder
