"""Which call errors are worth another attempt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error classes (with the subclasses a log may name) and message
# parts that end a request at once.
FATAL_CLASSES = (
    "BadRequestError",
    "ValueError",
    "TypeError",
    "ValidationError",
    "JSONDecodeError",
    "UnicodeDecodeError",
    "UnicodeEncodeError",
)
FATAL_WORDS = ("api_key", "authentication")


def fatal_reason(error_class: Column, message: Column) -> Column:
    """Why a fatal error ends a request: ``key``, ``schema``, ``request`` or ``reply``; null for others.

    ``schema`` is a request whose reply schema the endpoint refuses, which may be sent again without it.
    """
    text = F.lower(F.coalesce(message, F.lit("")))
    key = F.lit(False)
    for word in FATAL_WORDS:
        key = key | text.contains(word)
    reason = (
        F.when(key, "key")
        .when((error_class == "BadRequestError") & (text.contains("schema") | text.contains("response_format")), "schema")
        .when(error_class == "BadRequestError", "request")
        .otherwise("reply")
    )
    return F.when(classify_error(error_class, message) == "fatal", reason)


def classify_error(error_class: Column, message: Column) -> Column:
    """``success`` without an error class, else ``fatal`` or ``retryable``."""
    text = F.lower(F.coalesce(message, F.lit("")))
    fatal = error_class.isin(*FATAL_CLASSES)
    for word in FATAL_WORDS:
        fatal = fatal | text.contains(word)
    return (
        F.when(error_class.isNull(), "success")
        .when(fatal, "fatal")
        .otherwise("retryable")
    )
