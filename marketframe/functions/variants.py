"""Reading loosely typed JSON values held as VARIANT."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketframe.functions.numbers import safe_double


# Asking for the kind of a value costs several times what reading it as text costs.  So each function
# decides by the text where the text settles it; CASE branches that ask for the kind are then not run.


def kind_of(value: Column) -> Column:
    """Type of a JSON value as text: ``VOID`` for null, ``STRING``, ``BIGINT``, ``OBJECT<...>`` and so on."""
    return F.schema_of_variant(value)


def to_text(value: Column) -> Column:
    """Strings as they are, JSON null as null, other values in their JSON form."""
    return F.try_variant_get(value, "$", "string")


def is_object(value: Column) -> Column:
    """Only objects can be read as a struct, whatever their fields.  False for null."""
    return F.try_variant_get(value, "$", "struct<_:variant>").isNotNull()


def truthy(value: Column, text: Column | None = None) -> Column:
    """Whether a JSON value counts as present: not absent, null, false, zero, "" or an empty container.

    A digit other than zero settles it for every type.
    """
    text = to_text(value) if text is None else text
    kind = kind_of(value)
    present = (
        F.when(text.rlike("[1-9]"), True)
        .when(text.isNull() | text.isin("", "{}", "[]", "false"), (kind == "STRING") & (text != ""))
        .when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), False)
        .otherwise(True)
    )
    return F.coalesce(present, F.lit(False))


def first_truthy(value: Column, chosen: Column, fallback: Column, text: Column | None = None) -> Column:
    """``chosen``, a reading of ``value``, if ``value`` is truthy, else ``fallback`` as it is.

    Not ``coalesce``: a zero or an empty string gives way to the fallback too.
    """
    return F.when(truthy(value, text), chosen).otherwise(fallback)


def to_number(value: Column, text: Column | None = None) -> Column:
    """JSON numbers as they are, strings by :func:`safe_double`, everything else null.

    A number that Spark prints with an exponent does not pass for a plain number as text, and is read
    as a double instead.
    """
    text = to_text(value) if text is None else text
    exponent = F.when(text.contains("E"), kind_of(value) == "DOUBLE")
    return F.coalesce(safe_double(text), F.when(exponent, F.try_variant_get(value, "$", "double")))
