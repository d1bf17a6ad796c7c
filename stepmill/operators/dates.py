"""Date and time steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions import temporal
from stepmill.functions.text import to_number
from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_columns


def parse_date_columns(format_mapping: dict[str, str], slice_length: int | None = 10) -> Step:
    """Parse text columns by strptime format; what does not fit becomes null.

    By default only the first ten characters are read. A format with a time part then never fits:
    pass ``slice_length=None`` for those. A format with an offset (``%z``) or the name of a zone (``%Z``) gives
    instants, ``timestamp``, so rows of several zones are comparable; all others give ``timestamp_ntz``.
    """

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, format_mapping)
        ntz = df.sparkSession.conf.get("spark.sql.timestampType") == "TIMESTAMP_NTZ"
        named = any("%Z" in f.replace("%%", "") for f in format_mapping.values())
        zones = sorted(df.sparkSession._jvm.java.time.ZoneId.getAvailableZoneIds()) if named else []
        parsed = {}
        for name, date_format in format_mapping.items():
            c, dtype = F.col(quoted(name)), df.schema[name].dataType
            if isinstance(dtype, T.StringType):
                text = c if slice_length is None else F.substring(c, 1, slice_length)
                parsed[name] = temporal.parse_timestamp(text, date_format, ntz, zones)
            elif slice_length is not None:
                raise TypeError(f"column {name} is {dtype.simpleString()}; only text can be sliced")
            elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                parsed[name] = c.cast("timestamp_ntz")
            else:
                parsed[name] = temporal.parse_timestamp(c.cast("string"), date_format, ntz, zones)
        return df.withColumns(parsed)

    return step


def parse_military_time_column(column: str, output_column: str | None = None) -> Step:
    """HHMM values (``845`` is 08:45) to a day-time interval; unreadable values count as 00:00."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [column])
        number = to_number(F.col(quoted(column)), df.schema[column].dataType)
        return df.withColumn(output_column or column, temporal.military_time(number))

    return step


def combine_date_and_time(
    date_column: str,
    time_column: str,
    output_column: str,
    columns_to_drop: Sequence[str] | None = None,
) -> Step:
    """Date or timestamp plus day-time interval; then drop the listed columns, which must exist."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [date_column, time_column])
        date_type, time_type = df.schema[date_column].dataType, df.schema[time_column].dataType
        if not isinstance(date_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise TypeError(f"column {date_column} is {date_type.simpleString()}, not a date or timestamp")
        if not isinstance(time_type, T.DayTimeIntervalType):
            raise TypeError(f"column {time_column} is {time_type.simpleString()}, not a day-time interval")
        start = F.col(quoted(date_column))
        if isinstance(date_type, T.DateType):
            start = start.cast("timestamp_ntz")
        out = df.withColumn(output_column, start + F.col(quoted(time_column)))
        require_columns(out, columns_to_drop or ())
        return out.drop(*(columns_to_drop or ()))

    return step


def keep_workdays(column: str) -> Step:
    """Rows dated Tuesday to Saturday."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [column])
        return df.filter(temporal.is_workday(F.col(quoted(column))))

    return step
