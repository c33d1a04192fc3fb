"""Hash keys: pseudonyms, surrogate keys and compact numeric keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pseudonym(col) -> Column:
    """SHA-256 hex of the id's text; NULL stays NULL."""
    return F.sha2(_c(col).cast("string"), 256)


def key60(col) -> Column:
    """Stable 60-bit BIGINT key from text: first 15 hex digits of md5."""
    return F.conv(F.substring(F.md5(_c(col)), 1, 15), 16, 10).cast("bigint")


def murmur_key(col) -> Column:
    """The 31-bit channel key of the source: abs(Murmur3 hash) of the
    lower-cased, trimmed name, as BIGINT. Widened before ``abs`` so the
    minimum int cannot overflow under ANSI mode; NULL hashes to the seed.
    ``key60`` is the default key (reproducible outside Spark)."""
    return F.abs(F.hash(F.lower(F.trim(_c(col)))).cast("bigint"))


def surrogate(*cols, sep: str = "|", null: str = "") -> Column:
    """md5 over ids joined by a separator (NULL parts become ``null``).

    The separator keeps ('1', '23') and ('12', '3') apart; the source's own
    key has none, and '0' for NULL.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null)) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def row_hash(*cols) -> Column:
    """Content hash of a row, used to detect changed records cheaply."""
    return F.sha2(F.to_json(F.struct(*[_c(c) for c in cols])), 256)
