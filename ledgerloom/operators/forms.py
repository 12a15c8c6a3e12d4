"""Application forms: required fields in order, and the state of a filled-in application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.ranking import ranked

ORDER_CELL = 1_000_000


def form_fields(
    products: DataFrame, windows: DataFrame, fields: DataFrame,
    product_windows: DataFrame, window_fields: DataFrame,
) -> DataFrame:
    """Active fields of each product's active windows, numbered in display order.

    Display orders are unique within a product's windows and within a window's fields, so the
    numbering is total.
    """
    window = windows.filter("is_active").select("window_id", "window_name")
    field = fields.filter("is_active").select("field_id", "field_name")
    rows = (
        product_windows.select("product_id", "window_id", F.col("display_order").alias("window_order"))
        .join(products.select("product_id", "product_name"), "product_id")
        .join(window, "window_id")
        .join(
            window_fields.select("window_id", "field_id", F.col("display_order").alias("field_order")).join(
                field, "field_id"
            ),
            "window_id",
        )
        .select("product_id", "product_name", "window_name", "window_order", "field_name", "field_order")
    )
    cells = [F.col("window_order"), F.floor(F.col("field_order") / ORDER_CELL)]
    return ranked(rows, ["product_id"], ["window_order", "field_order"], cells, "overall_order").select(
        "product_id", "product_name", "window_name", "window_order", "field_name", "field_order", "overall_order"
    )


def merged_values(patches: DataFrame) -> DataFrame:
    """Newest value per application and key: JSON merge where the later patch wins.

    A maximum per key, combined map-side; patches of one application are never gathered. A patch that is not
    a JSON object is an error, as it would be in the source.
    """
    return (
        patches.select("application_id", "seq", F.explode_outer(F.from_json("patch", "map<string,string>", {"mode": "FAILFAST"})))
        .filter(F.col("key").isNotNull())
        .groupBy("application_id", "key")
        .agg(F.max_by("value", "seq").alias("value"))
    )


def application_state(patches: DataFrame) -> DataFrame:
    """Per application its last window, last status and merged data as a map.

    Window and status are the newest ones given; a patch that leaves them NULL does not change them.
    The map has one entry per form field, whatever the number of patches.
    """
    def newest(column: str):
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("seq"))).alias(column)

    steps = patches.groupBy("application_id").agg(
        newest("window_id").alias("current_window_id"), newest("status").alias("status")
    )
    data = merged_values(patches).groupBy("application_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("application_data")
    )
    empty = F.create_map().cast("map<string,string>")
    return steps.join(data, "application_id", "left").withColumn(
        "application_data", F.coalesce("application_data", empty)
    )


# What a patch may set beside its document, with the type it is kept as.
APPLICATION_COLUMNS = {"product_id": "int", "client_id": "string", "current_window_id": "int", "status": "string"}


def application_documents(patches: DataFrame) -> DataFrame:
    """Per application its columns and ``application_data``, the merged document as a VARIANT object.

    ``patches`` has application_id, seq, patch (a JSON object) and any of product_id, client_id, window_id and status.
    Per key of the document the latest patch wins, as with the source's ``||``: numbers, booleans, nested objects,
    arrays and null keep their type, and a nested object is replaced whole. A column that a patch leaves NULL does not
    change. A patch that is not a JSON object is an error.

    Every value, of a key or a column, is one entry of its application; the newest of each is found in one sum that
    combines map-side, so patches are read and shuffled once and those of one application are never gathered. The
    document has one entry per form field, whatever the number of patches.
    """
    document = F.from_json("patch", "map<string,variant>", {"mode": "FAILFAST"})
    of_document = F.transform(
        F.map_entries(document),
        lambda e: F.struct(F.lit(True).alias("inside"), e["key"].alias("name"), F.coalesce(F.to_json(e["value"]), F.lit("null")).alias("value")),
    )
    given = {"current_window_id" if c == "window_id" else c: F.col(c) for c in patches.columns}
    of_columns = F.array(*[
        F.struct(F.lit(False).alias("inside"), F.lit(c).alias("name"), given[c].cast("string").alias("value"))
        for c in APPLICATION_COLUMNS if c in given
    ])
    known = F.filter(F.concat(F.coalesce(of_document, F.array().cast("array<struct<inside:boolean,name:string,value:string>>")), of_columns), lambda e: e["value"].isNotNull())
    newest = (
        patches.select("application_id", "seq", F.inline_outer(known))
        .groupBy("application_id", "inside", "name").agg(F.max_by("value", "seq").alias("value"))
    )
    entry = F.when(F.col("inside"), F.struct("name", "value"))
    columns = [
        F.max(F.when(~F.col("inside") & (F.col("name") == c), F.col("value"))).cast(kind).alias(c)
        for c, kind in APPLICATION_COLUMNS.items()
    ]
    merged = newest.groupBy("application_id").agg(*columns, F.collect_list(entry).alias("_entries"))
    values = F.transform_values(F.map_from_entries("_entries"), lambda _, v: F.parse_json(v))
    return merged.withColumn("application_data", F.to_variant_object(values)).drop("_entries")
