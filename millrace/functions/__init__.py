"""Column expressions used by the pipelines; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State names spelled differently in the boundary table.
STATE_RECODE = {"AndamanandNicobarIslands": "AndamanandNicobar"}
# Events that end a user's activity.
TERMINAL_EVENTS = ("account_deleted", "session_ended")


def clean_state(state: Column) -> Column:
    """Remove every space, then apply the fixed respellings."""
    compact = F.replace(state, F.lit(" "), F.lit(""))
    cleaned = compact
    for spelled, wanted in STATE_RECODE.items():
        cleaned = F.when(compact == spelled, F.lit(wanted)).otherwise(cleaned)
    return cleaned


def is_terminal(event: Column, terminal=TERMINAL_EVENTS) -> Column:
    return event.isin(*terminal)


def leading_int(text: Column, length: int) -> Column:
    """The first ``length`` characters as an integer, NULL when they are no number."""
    return F.substring(text, 1, length).try_cast("int")


def fold_event_id(event_id: Column) -> Column:
    return F.when(event_id > 5, event_id - 5).otherwise(event_id)


def address_country(address: Column, strict: bool = False) -> Column:
    """Fourth comma-separated part, trimmed; NULL (or an error if strict) when absent."""
    parts = F.split(address, ",")
    return F.trim(parts[3] if strict else F.get(parts, F.lit(3)))


def convert(value: Column, to: str, strict: bool = False) -> Column:
    return value.cast(to) if strict else value.try_cast(to)


def price_amount(price: Column, strict: bool = False) -> Column:
    return convert(F.replace(price, F.lit("$"), F.lit("")), "float", strict)


def joined_timestamp(date: Column, time: Column, strict: bool = False) -> Column:
    text = F.concat(date, F.lit(" "), time)
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def transaction_id(step: Column, origin: Column, destination: Column) -> Column:
    return F.concat(F.lit("txn_"), step.cast("string"), origin, destination)


def batch_number(file_name: Column) -> Column:
    """Trailing number of ``…_<n>.parquet``; NULL for any other name."""
    digits = F.regexp_extract(file_name, r"_(\d+)\.parquet/?$", 1)
    return F.when(digits != "", digits).try_cast("int")


def row_json(*columns) -> Column:
    return F.to_json(F.struct(*(columns or ("*",))))
