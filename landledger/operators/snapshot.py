"""Comparison of an incoming snapshot with a stored one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_checksum(column: str):
    """SHA-256 of text or binary content as hexadecimal text."""
    return F.sha2(F.col(column).cast("binary"), 256)


def diff_snapshots(incoming: DataFrame, stored: DataFrame, key: Sequence[str], checksum: str = "sha256") -> DataFrame:
    """What loading ``incoming`` over ``stored`` would do, one row per object.

    ``uploaded`` when the key is new (or stored without a checksum), ``skipped``
    when the checksums agree, ``changed`` when they differ. Keys are unique on
    both sides.
    """
    old = stored.select(*key, F.col(checksum).alias("stored_checksum"))
    new = incoming.select(*key, F.col(checksum).alias("checksum"))
    status = (
        F.when(F.col("stored_checksum").isNull(), "uploaded")
        .when(F.col("stored_checksum") == F.col("checksum"), "skipped")
        .otherwise("changed")
    )
    return new.join(old, list(key), "left").select(*key, status.alias("status"), "checksum", "stored_checksum")


def to_load(diff: DataFrame) -> DataFrame:
    """The objects that a load has to transfer."""
    return diff.filter(~F.col("status").isin("skipped", "refused"))


def audited_diff(audit: DataFrame, stored: DataFrame, checksum: str = "sha256") -> DataFrame:
    """What loading the audited files over ``stored`` (path, checksum) would do.

    A file that the audit refuses is ``refused`` whatever is stored, with the
    reason; the others are as in :func:`diff_snapshots`, with an empty reason.
    """
    diff = diff_snapshots(audit.select("path", checksum, "is_valid", "reason"), stored, ["path"], checksum)
    verdicts = audit.select("path", "is_valid", "reason")
    status = F.when(F.col("is_valid"), F.col("status")).otherwise("refused")
    return diff.join(verdicts, "path").select("path", status.alias("status"), "reason", "checksum", "stored_checksum")
