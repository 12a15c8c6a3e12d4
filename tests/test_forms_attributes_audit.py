import datetime as dt_
import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import attributes, audit, forms, rewrites
from tests.seed_frames import frame

ORDERED = ["CURP", "RFC", "address_country", "address_city", "address_zipcode", "bank_code", "bank_account"]


def form(spark):
    """Seed rows of the form tables."""
    return {
        "products": frame(spark, [(1, "general_loan"), (2, "repeated_loan"), (3, "newbies_loan")], schemas.FORM_PRODUCTS),
        "windows": frame(spark, [(1, "curp_and_rfc", True), (2, "address_info", True), (3, "bank_details", True)], schemas.WINDOWS),
        "fields": frame(spark, [(i + 1, name, True) for i, name in enumerate(ORDERED)], schemas.FIELDS),
        "product_windows": frame(spark, [(p, w, w) for p in (1, 2) for w in (1, 2, 3)], schemas.PRODUCT_WINDOWS),
        "window_fields": frame(
            spark, [(1, 1, 1), (1, 2, 2), (2, 3, 1), (2, 4, 2), (2, 5, 3), (3, 6, 1), (3, 7, 2)], schemas.WINDOW_FIELDS
        ),
    }


def fields_of(df, product=1):
    rows = df.filter(F.col("product_id") == product).orderBy("overall_order").collect()
    assert [r.overall_order for r in rows] == list(range(1, len(rows) + 1))
    return [r.field_name for r in rows]


def test_form_fields(spark):
    tables = form(spark)
    whole = forms.form_fields(**tables)
    assert fields_of(whole) == ORDERED and fields_of(whole, 2) == ORDERED and fields_of(whole, 3) == []
    windows = rewrites.set_where(tables["windows"], F.col("window_name") == "bank_details", "is_active", False)
    assert fields_of(forms.form_fields(**{**tables, "windows": windows})) == ORDERED[:5]
    fields = rewrites.set_where(tables["fields"], F.col("field_name") == "address_zipcode", "is_active", False)
    left = fields_of(forms.form_fields(**{**tables, "fields": fields}))
    assert left == [f for f in ORDERED if f != "address_zipcode"]


def test_application_walk(spark):
    patches = [
        (1, 1, None, None, "IN_PROGRESS"),
        (1, 2, None, 1, None),
        (1, 3, '{"CURP": "AAAA000000", "RFC": "BBBB111111"}', 2, None),
        (1, 4, '{"address_country": "Land","address_city": "Town","address_zipcode": "00001"}', 3, None),
        (1, 5, '{"bank_account": "0000000001","bank_code": "000"}', None, "COMPLETED"),
        (2, 1, None, None, "IN_PROGRESS"),
        (3, 1, '{"a": "1", "b": "2"}', 1, None),
        (3, 2, '{"a": "3", "b": null}', 2, "IN_PROGRESS"),
    ]
    rows = {r.application_id: r for r in forms.application_state(frame(spark, patches, schemas.PATCHES)).collect()}
    assert (rows[1].current_window_id, rows[1].status, set(rows[1].application_data)) == (3, "COMPLETED", set(ORDERED))
    assert rows[1].application_data["address_city"] == "Town"
    assert (rows[2].current_window_id, rows[2].application_data) == (None, {})
    assert rows[3].application_data == {"a": "3", "b": None} and rows[3].current_window_id == 2


def test_a_broken_patch_is_an_error(spark):
    patches = frame(spark, [(1, 1, '{"a": "1"', 1, None)], schemas.PATCHES)
    with pytest.raises(Exception, match="MALFORMED"):
        forms.application_state(patches).collect()


TYPED = "application_id INT, seq INT, patch STRING, product_id INT, client_id STRING, window_id INT, status STRING"


def test_documents_keep_their_types(spark):
    patches = [
        (1, 1, None, 7, "client a", None, "IN_PROGRESS"),
        (1, 2, '{"n": 127, "s": "127", "yes": true, "o": {"a": 1, "b": [1, null]}, "z": 0}', None, None, 2, None),
        (1, 3, '{"o": {"c": 2.5}, "z": null, "big": 12345678901234567890, "Ключ \\"q\\"": "line\\nbreak"}', None, None, None, "COMPLETED"),
        (2, 1, "{}", None, None, None, None),
        (3, 1, None, None, None, None, None),
    ]
    state = forms.application_documents(frame(spark, patches, TYPED))
    assert state.schema["application_data"].dataType.simpleString() == "variant"
    rows = {r.application_id: r for r in state.withColumn("text", F.to_json("application_data")).collect()}
    assert (rows[1].product_id, rows[1].client_id, rows[1].current_window_id, rows[1].status) == (7, "client a", 2, "COMPLETED")
    assert json.loads(rows[1].text) == {
        "n": 127, "s": "127", "yes": True, "o": {"c": 2.5}, "z": None, "big": 12345678901234567890,
        'Ключ "q"': "line\nbreak",
    }
    assert rows[2].text == rows[3].text == "{}" and rows[3].product_id is None
    kinds = state.select(F.schema_of_variant("application_data").alias("k")).filter("application_id = 1").first().k
    assert "n: BIGINT" in kinds and "s: STRING" in kinds and "yes: BOOLEAN" in kinds and "z: VOID" in kinds
    assert forms.application_documents(frame(spark, [], TYPED)).count() == 0


def test_documents_of_the_walk_equal_the_text_state(spark):
    patches = frame(spark, [
        (1, 1, None, None, "IN_PROGRESS"), (1, 2, '{"a": "1", "b": "2"}', 1, None), (1, 3, '{"a": "3"}', 2, "COMPLETED"),
    ], schemas.PATCHES)
    typed, text = forms.application_documents(patches).first(), forms.application_state(patches).first()
    assert (typed.current_window_id, typed.status) == (text.current_window_id, text.status) == (2, "COMPLETED")
    assert typed.application_data.toPython() == text.application_data


def test_patches_are_read_once_and_must_be_objects(spark, tmp_path):
    path = str(tmp_path / "patches")
    frame(spark, [(1, 1, '{"a": 1}', 1, "c", 1, "s")], TYPED).write.parquet(path)
    state = forms.application_documents(spark.read.parquet(path))
    assert state._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    for broken in ('{"a": 1', "[1]", "7"):
        with pytest.raises(Exception, match="MALFORMED"):
            forms.application_documents(frame(spark, [(1, 1, broken, 1, "c", 1, "s")], TYPED)).collect()


def test_attributes(spark):
    sources = frame(spark, [("s1", "service_db", 1), ("s2", "partner_API", 2)], schemas.SOURCES)
    meta = frame(
        spark, [("m1", "email", 365, "string"), ("m2", "phone", 180, "string"), ("m3", "birthday", 730, "date")],
        schemas.ATTRIBUTE_META,
    )
    incoming = frame(
        spark,
        [("service_db", "u1", "email", "someone@example.com", "t1"), ("service_db", "u1", "phone", "+100000001", "t1"),
         ("service_db", "u1", "shoe_size", "44", "t1"), ("unlisted", "u1", "email", "x", "t1")],
        "source_name STRING, user_id STRING, attr_name STRING, value STRING, created_at STRING",
    )
    rows = attributes.attributes_with_expiry(attributes.ingest_attributes(incoming, sources, meta), meta)
    got = {r.attr_name: r for r in rows.collect()}
    assert set(got) == {"email", "phone"}
    assert bytes(got["email"].data) == b"someone@example.com" and got["email"].expiration_policy == 365
    assert got["phone"].expiration_policy == 180 and got["phone"].source_id == "s1"
    assert got["phone"].created_at == got["phone"].updated_at == "t1"
    again = attributes.ingest_attributes(incoming, sources, meta)
    assert {r.id for r in again.collect()} == {r.id for r in rows.collect()}


def test_audits(spark):
    rows = spark.createDataFrame([(1, 10, None), (2, None, "x"), (3, 10, "yy"), (4, None, None)], "id INT, fk INT, t STRING")
    nulls = {r.id: r.null_columns for r in audit.audit_not_null(rows, ["fk", "t"]).collect()}
    assert nulls == {1: "t", 2: "fk", 4: "fk,t"}
    assert [(r.fk, r.copies) for r in audit.audit_unique(rows, ["fk"]).collect()] == [(10, 2)]
    parents = spark.createDataFrame([(11,)], "id INT")
    assert sorted(r.id for r in audit.audit_fk(rows, "fk", parents, "id").collect()) == [1, 3]
    assert [r.id for r in audit.audit_length(rows, "t", 1).collect()] == [3]


def test_all_rules_in_one_scan(spark, tmp_path):
    rows = [(1, 10, None, 5), (2, None, "x", 1), (3, 10, "yy", 9), (3, 12, "z", None), (None, 11, "z", 2), (None, 11, "z", 2), (7, 11, "ok", 3)]
    path, parents = str(tmp_path / "rows"), str(tmp_path / "parents")
    spark.createDataFrame(rows, "id INT, fk INT, t STRING, n INT").write.parquet(path)
    spark.createDataFrame([(11,), (11,), (None,)], "id INT").write.parquet(parents)
    df, parent = spark.read.parquet(path), spark.read.parquet(parents)
    rules = [
        audit.not_null("t"), audit.at_most("t", 1), audit.holds("n is small", F.col("n") < 9), audit.unique("id"),
        audit.references("fk", parent, "id"),
    ]
    counts = Observation()
    got = audit.audit_rules(df, rules, counts)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2  # the table and the parents
    found = sorted((r.id or 0, r.fk or 0, tuple(r.violations)) for r in got.collect())
    assert found == [
        (1, 10, ("t is null", "fk has no parent")),
        (3, 10, ("t is longer than 1", "n is small", "id is not unique", "fk has no parent")),
        (3, 12, ("id is not unique", "fk has no parent")), (7, 11, ("t is longer than 1",)),
    ]
    assert counts.get == {
        "rows": 7, "t is null": 1, "t is longer than 1": 2, "n is small": 1, "id is not unique": 2, "fk has no parent": 3,
    }
    # the same rows as the single audits
    assert {r.id for r in audit.audit_not_null(df, ["t"]).collect()} == {1}
    assert {r.id for r in audit.audit_unique(df, ["id"]).collect()} == {3}
    assert sorted(r.fk for r in audit.audit_fk(df, "fk", parent, "id").collect()) == [10, 10, 12]


def test_unique_and_reference_on_one_key_share_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 7 AS n").write.parquet(path)
    df, parent = spark.read.schema("id BIGINT, n BIGINT").parquet(path), spark.range(50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = audit.audit_rules(df, [audit.references("id", parent, "id"), audit.unique("id")])
        alone = audit.audit_rules(df, [audit.references("id", parent, "id")])
        count = lambda x: x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert both.count() == 50 and count(both) <= count(alone) + 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_overlapping_periods(spark):
    rng = random.Random(2)
    at = lambda n: None if n is None else dt_.date(2024, 11, 1) + dt_.timedelta(days=n)
    rows = []
    for i in range(300):
        start = rng.choice([None, *range(200)]) if rng.random() < 0.1 else rng.randrange(200)
        end = None if rng.random() < 0.02 else (start or 0) + rng.randrange(0, 9)
        rows.append((i, rng.choice(["a", "b", None]), at(start), at(end)))
    df = spark.createDataFrame(rows, "id INT, k STRING, since DATE, until DATE")
    far = dt_.date(9999, 12, 31)
    want = {}
    for i, k, since, until in rows:
        mine = since or dt_.date(1, 1, 1)
        earlier = [u or far for j, l, s, u in rows if l == k and ((s or dt_.date(1, 1, 1)), j) < (mine, i)]
        if earlier and max(earlier) >= mine:
            want[i] = max(earlier)
    got = audit.audit_overlaps(df, ["k"], "since", "until", "id")
    assert got.columns == [*df.columns, "reaches"]
    assert {r.id: r.reaches for r in got.collect()} == want
