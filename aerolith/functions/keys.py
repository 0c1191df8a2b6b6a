"""Record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "|"


def business_key(parts: Sequence[Column], *, null_safe: bool = False) -> Column:
    """The parts as text, joined by `|`.

    The key is null as soon as one part is null. `null_safe` puts empty text in place of a
    null part, so that such rows keep keys of their own.
    """
    texts = [part.cast("string") for part in parts]
    if null_safe:
        texts = [F.coalesce(text, F.lit("")) for text in texts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit(KEY_SEPARATOR), text]
    return F.concat(*joined)


def row_hash_key(parts: Sequence[Column]) -> Column:
    """Hash of all parts; each is written with its length so that two rows never read alike."""

    def tagged(part: Column) -> Column:
        text = part.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))

    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[tagged(part) for part in parts]), 256)


def ordinal_key() -> Column:
    """Unique row number as text, for data without any column that identifies a row."""
    return F.monotonically_increasing_id().cast("string")
