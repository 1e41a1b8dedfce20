"""Text to typed value; anything unparsable becomes NULL and the row is kept.

``try_cast`` is more lenient than the warehouse these reports were modelled in: it reads
``'1d'`` as a double, ``'2026'`` as a date and ``'10:00'`` as a timestamp of today. The
patterns below shut those doors. They also come first because a failing ``try_cast`` to a
number costs a caught exception per row, and blank cells are common.

Every function takes an SQL expression, usually a column name, and comes in two forms: the
``*_sql`` one gives SQL text to be put into a ``selectExpr``, the other a column. A table of
twenty columns is then one expression each, instead of hundreds of calls into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms.
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
HEX_INTEGER = r"^\s*[+-]?0[xX]0*[0-9a-fA-F]{1,16}\s*$"
HEX_PREFIX = r"^[+-]?0[xX]0*(?=[0-9a-fA-F])"
FLOAT_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
TIMESTAMP_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ Tt].*)?$"


def int_sql(text: str) -> str:
    sign = f"CASE WHEN startswith(trim({text}), '-') THEN '-' ELSE '' END"
    digits = f"conv(regexp_replace(trim({text}), r'{HEX_PREFIX}', ''), 16, 10)"
    return (
        f"CASE WHEN {text} RLIKE r'{INTEGER_TEXT}' THEN try_cast({text} AS BIGINT) "
        f"WHEN {text} RLIKE r'{HEX_INTEGER}' "
        f"THEN try_cast(concat({sign}, {digits}) AS BIGINT) END"
    )


def float_sql(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{FLOAT_TEXT}' THEN try_cast({text} AS DOUBLE) END"


def date_sql(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{DATE_TEXT}' THEN try_cast({text} AS DATE) END"


def timestamp_sql(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{TIMESTAMP_TEXT}' THEN try_cast({text} AS TIMESTAMP) END"


def day_sql(text: str) -> str:
    """Calendar day (UTC) of a timestamp text."""
    return f"to_date({timestamp_sql(text)})"


def json_scalar_sql(text: str, path: str) -> str:
    kind = f"schema_of_variant(try_variant_get(try_parse_json({text}), '{path}', 'variant'))"
    return (
        f"CASE WHEN {kind} LIKE 'OBJECT%' OR {kind} LIKE 'ARRAY%' THEN NULL "
        f"ELSE get_json_object({text}, '{path}') END"
    )


def json_fragment_sql(text: str, path: str) -> str:
    value = f"try_variant_get(try_parse_json({text}), '{path}', 'variant')"
    return (
        f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN to_json({value}) "
        f"ELSE get_json_object({text}, '{path}') END"
    )


# How a contract's type is read from raw text.
_PARSERS = {
    "string": lambda text: text,
    "bigint": int_sql,
    "double": float_sql,
    "date": date_sql,
    "timestamp": timestamp_sql,
    "day": day_sql,
}


def parse_sql(text: str, type_name: str) -> str:
    """Raw text read as one of the contract types."""
    return _PARSERS[type_name](text)


def safe_int(text: str) -> Column:
    """Text to bigint. Decimals, exponents and blanks are NULL; ``0x1F`` is 31."""
    return F.expr(int_sql(text))


def safe_float(text: str) -> Column:
    """Text to double, without Java's ``1d`` / ``1f`` / hexadecimal forms."""
    return F.expr(float_sql(text))


def safe_date(text: str) -> Column:
    """ISO text to date. A bare year, a year-month or a trailing time is NULL."""
    return F.expr(date_sql(text))


def safe_timestamp(text: str) -> Column:
    """ISO text to timestamp; offsets are honoured, text without one is UTC."""
    return F.expr(timestamp_sql(text))


def timestamp_day(moment: Column | str) -> Column:
    """Calendar day (UTC) of a timestamp."""
    return F.to_date(moment)


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Unix seconds to timestamp; NULL stays NULL."""
    return F.timestamp_seconds(seconds)


def json_scalar(text: str, path: str) -> Column:
    """The scalar at ``path`` as text; NULL where there is an object, an array or nothing.

    The JSON type decides, not the look of the text: ``"[promo] spring sale"`` is a scalar.
    """
    return F.expr(json_scalar_sql(text, path))


def json_fragment(text: str, path: str) -> Column:
    """The JSON text at ``path``: objects and arrays compact, string scalars still quoted."""
    return F.expr(json_fragment_sql(text, path))
