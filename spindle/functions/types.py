"""The six value types, and casts of raw text that never fail and never guess."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, WHOLE, REAL, DAY, INSTANT, TRUTH = "VARCHAR", "BIGINT", "DOUBLE", "DATE", "TIMESTAMP", "BOOLEAN"

SPARK_TYPES: dict[str, T.DataType] = {
    TEXT: T.StringType(),
    WHOLE: T.LongType(),
    REAL: T.DoubleType(),
    DAY: T.DateType(),
    INSTANT: T.TimestampNTZType(),
    TRUTH: T.BooleanType(),
}
#: Names that stand for a type (fixed values).
SYNONYMS = {
    TEXT: ("STRING", "TEXT", "STR", "CATEGORICAL", "CATEGORY", "CHAR", "OBJECT"),
    WHOLE: ("INTEGER", "INT", "INT64", "COUNT"),
    REAL: ("FLOAT", "FLOAT64", "NUMERIC", "DECIMAL", "NUMBER", "REAL", "CONTINUOUS"),
    DAY: (),
    INSTANT: ("DATETIME",),
    TRUTH: ("BOOL", "BINARY"),
}
FAMILY = {TEXT: "text", WHOLE: "numeric", REAL: "numeric", DAY: "temporal", INSTANT: "temporal", TRUTH: "boolean"}
#: Blanks that count as surrounding space (not tabs or line ends).
BLANKS = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
_DATE = r"^[0-9]{1,6}-[0-9]{1,2}-[0-9]{1,2}"


def canonical(name: str | None) -> str | None:
    """The type that ``name`` means; a size in brackets is ignored; None if unknown."""
    word = (name or "").split("(")[0].strip().upper()
    return next((kind for kind, also in SYNONYMS.items() if word == kind or word in also), None)


def compatible(target: str, source: str | None) -> bool:
    """Whether values of type ``source`` may feed a column of type ``target``."""
    source = canonical(source)
    if source is None or target == TEXT:
        return True
    if target == WHOLE:
        return source in (WHOLE, TRUTH)
    if source == TEXT:
        return FAMILY[target] == "temporal"
    return FAMILY[target] == FAMILY[source]


def type_of(data_type: T.DataType) -> str:
    """The value type of a Spark column."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return WHOLE
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return REAL
    if isinstance(data_type, T.DateType):
        return DAY
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return INSTANT
    return TRUTH if isinstance(data_type, T.BooleanType) else TEXT


def stripped(raw: Column) -> Column:
    """Text without surrounding blanks."""
    text = raw.cast("string")
    plain = F.length(text) == F.octet_length(text)  # ASCII alone: its only blank is the space
    return F.when(plain, F.trim(text)).otherwise(F.btrim(text, F.lit(BLANKS)))


def trimmed(raw: Column) -> Column:
    """Text without surrounding blanks; null where nothing is left."""
    return F.nullif(stripped(raw), F.lit(""))


def safe_cast(raw: Column, kind: str, compat: bool = False) -> Column:
    """``raw`` as ``kind``, null where the text is not a value of it.

    Strict by default: a fraction is no whole number, dates need year, month and day,
    and type letters after a number are refused.  With ``compat`` a fraction or an
    exponent is rounded, half away from zero, when a whole number is wanted."""
    return cast_stripped(trimmed(raw), kind, compat)


def cast_stripped(text: Column, kind: str, compat: bool = False) -> Column:
    """``safe_cast`` of text without surrounding blanks (a column: it is read more than once);
    no text is a value of no kind."""
    if kind == TEXT:
        return F.nullif(text, F.lit(""))
    if kind == WHOLE:
        whole = text.try_cast("bigint")
        return F.coalesce(whole, F.round(text.try_cast("decimal(38,10)")).try_cast("bigint")) if compat else whole
    if kind == REAL:
        lettered = text.contains("d") | text.contains("D") | text.contains("f") | text.contains("F")
        return F.when(~lettered | ~text.rlike(r"[dDfF]$") | text.rlike(r"(?i)^[+-]?inf$"), text.try_cast("double"))
    if kind in (DAY, INSTANT):
        dashed = F.regexp_replace(text, r"^([0-9]{1,6})/([0-9]{1,2})/([0-9]{1,2})", "$1-$2-$3")
        slow = F.when(dashed.rlike(_DATE), dashed.try_cast(SPARK_TYPES[kind]))
        if kind == INSTANT:
            return slow
        usual = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
        return F.when(usual, text.try_cast(SPARK_TYPES[kind])).otherwise(slow)  # a day cast from such a text has all parts
    return text.try_cast("boolean")


def null_of(kind: str) -> Column:
    return F.lit(None).cast(SPARK_TYPES[kind])


def plain_name(name: str) -> str:
    """Lower case, with runs of other signs than a-z and 0-9 as one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def plain_name_column(value: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), F.lit("_"))


def plain_label(value: object) -> str:
    """A label for comparison: white space collapsed, trimmed, lower case."""
    return re.sub(r"\s+", " ", str(value), flags=re.ASCII).strip().lower()


def plain_label_column(value: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(value.cast("string"), r"\s+", " ")))
