"""The site of a record: the host of its URL in lower case without a leading ``www.``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site(url: Column) -> Column:
    """Null for a null URL; the empty string where the URL has no host."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")
