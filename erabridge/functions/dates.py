"""The two date formats: compact event days and dashed history days."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erabridge.functions.strict import or_raise

SECONDS_OF_DAY = 86_400
FIRST_DAY = 10101  # 1 January of the year 1
DIGITS = (ord("0"), ord("9"))

# Year, month and day. A bare year or a timestamp, which Spark's own cast would
# take as a date, is not a date here.
DAY_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*\z"


def parse_event_date(day: Column) -> Column:
    """``yyyyMMdd``, held as text or as a number, to DATE; bad text raises.

    Runs on every event, so the day is taken apart by integer arithmetic: a
    pattern parser costs about ten times as much.
    """
    text = day.cast("string")
    number = text.try_cast("int")
    # Eight characters that make a number and neither begin with a sign nor begin
    # or end with a blank are eight digits.
    first, last = F.ascii(text), F.ascii(F.right(text, F.lit(1)))
    digits = first.between(*DIGITS) & last.between(*DIGITS)
    compact = (F.length(text) == 8) & digits & (number >= FIRST_DAY)
    date = F.make_date(_div(number, 10000), _div(number, 100) % 100, number % 100)
    return or_raise(F.when(compact, date), text, "yyyyMMdd day")


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by)).cast("int")


def history_date(day: Column, dtype: T.DataType = T.StringType()) -> Column:
    """``yyyy-mm-dd`` text, a DATE or a timestamp to DATE; bad text raises.

    An instant belongs to its day in UTC, whatever the session's time zone.
    """
    if isinstance(dtype, T.TimestampType):
        days = F.floor(F.unix_seconds(day) / SECONDS_OF_DAY)
        return F.date_from_unix_date(days.cast("int"))
    if not isinstance(dtype, T.StringType):
        return day.cast("date")
    date = F.when(day.rlike(DAY_TEXT), day.try_cast("date"))
    return or_raise(date, day, "yyyy-mm-dd day")
