"""Text columns: trimming, slugs and hashed keys."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.numbers import as_column

# Fixed value: what stands for NULL inside a hashed key.
KEY_NULL_MARK = "_dbt_utils_surrogate_key_null_"


def is_blank(text: Column) -> Column:
    """Nothing but white space of any kind; Spark's ``trim`` knows only the blank."""
    return F.rlike(text, F.lit(r"(?U)\A\s*\z"))


def slugify(text: Column) -> Column:
    """Lower case, blanks and dashes as ``_``, other signs dropped, ``_`` before a leading digit."""
    joined = F.regexp_replace(F.lower(text), "[ -]+", "_")
    cleaned = F.regexp_replace(joined, "[^a-z0-9_]+", "")
    return F.regexp_replace(cleaned, "^([0-9])", "_$1")


def slugify_name(name: str) -> str:
    """The same rule for one column name."""
    cleaned = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", name.lower()))
    return f"_{cleaned}" if cleaned[:1].isdigit() else cleaned


def surrogate_key(fields: Sequence[Column | str], nulls_as_empty: bool = False) -> Column:
    """MD5 of the fields as text joined with ``-``; NULL is a mark of its own, or empty text."""
    null_text = F.lit("" if nulls_as_empty else KEY_NULL_MARK)
    parts = [F.coalesce(as_column(field).cast("string"), null_text) for field in fields]
    return F.md5(F.concat_ws("-", *parts))
