"""Attribute store: ingest by source and attribute name, and expiry lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ingest_attributes(incoming: DataFrame, sources: DataFrame, meta: DataFrame) -> DataFrame:
    """Attribute rows for incoming values whose source and attribute are known.

    ``incoming`` has source_name, user_id, attr_name, value and created_at. The id is a digest of
    the natural key, so a repeated run gives the same rows; a row is last updated when it is made. Values with unknown names are left out;
    ``audit_fk`` lists them.
    """
    source = sources.select(F.col("id").alias("source_id"), "source_name")
    attribute = meta.select(F.col("id").alias("attr_meta_id"), "attr_name")
    parts = ("source_id", "user_id", "attr_meta_id", "created_at")
    # a NULL is told from an empty text and from a missing part
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in parts])
    return (
        incoming.join(source, "source_name")
        .join(attribute, "attr_name")
        .select(
            F.sha2(key, 256).alias("id"),
            "source_id",
            "user_id",
            "attr_name",
            "attr_meta_id",
            F.encode("value", "UTF-8").alias("data"),
            "created_at",
            F.col("created_at").alias("updated_at"),
        )
    )


def attributes_with_expiry(data: DataFrame, meta: DataFrame) -> DataFrame:
    """Attribute rows with the days they stay valid."""
    expiry = meta.select(F.col("id").alias("attr_meta_id"), "expiration_policy")
    return data.join(expiry, "attr_meta_id").select(*data.columns, "expiration_policy")
