"""Text clean-up and scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a phone number keeps, and the e-mail pattern.
NOT_PHONE = "[^0-9+]"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def normalise_email(email: Column | str) -> Column:
    return F.lower(F.trim(email))


def normalise_phone(phone: Column | str) -> Column:
    return F.regexp_replace(phone, NOT_PHONE, "")


def quality_score(text: Column | str, pattern: str = EMAIL_PATTERN) -> Column:
    """1.0 where the text matches, else 0.0; a null scores 0.0."""
    value = F.col(text) if isinstance(text, str) else text
    return F.when(value.rlike(pattern), F.lit(1.0)).otherwise(F.lit(0.0))


def message_key(fields: list[str], payload: Column | str = "value") -> Column:
    """The named payload fields as one JSON key, in the given order; absent ones are left out."""
    schema = ", ".join(f"`{name}` STRING" for name in fields)
    return F.to_json(F.from_json(payload, schema))
