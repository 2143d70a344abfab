"""Parts of a URL held in a text column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _without(text: Column, *prefixes: str) -> Column:
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def _before(text: Column, sign: str) -> Column:
    return F.split_part(text, F.lit(sign), F.lit(1))


def url_host(url: Column) -> Column:
    """Text before the first ``/`` or ``?``, without the scheme; a port stays."""
    bare = _without(url, "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(url: Column) -> Column:
    """Text after the host's ``/`` up to ``?``; empty when there is no path."""
    bare = _before(_without(url, "http://", "https://"), "?")
    return F.when(F.contains(bare, F.lit("/")), F.regexp_replace(bare, r"^[^/]*/", "")).when(
        bare.isNotNull(), F.lit("")
    )


def url_parameter(url: Column, name: str) -> Column:
    """Value of a query parameter, NULL when it is absent or empty."""
    found = F.regexp_extract(url, f"[?&]{re.escape(name)}=([^&#]*)", 1)
    return F.nullif(found, F.lit(""))
