"""The stored SQL functions against the column forms, on any text."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostrata.functions import personal_data as P
from aerostrata.functions.sql_functions import FUNCTIONS
from aerostrata.operators import governance, views
from aerostrata.plans import pipeline
from aerostrata.sources import catalog
from tests.test_personal_data import CASES

FORMS = {
    "email_rule": P.email_rule,
    "phone_rule": P.phone_rule,
    "passport_rule": P.passport_rule,
    "content_type": P.content_type,
    "mask_name": P.mask_name,
    "mask_email": P.mask_email,
    "mask_phone": P.mask_phone,
    "mask_name_by_word": P.mask_name_by_word,
    "mask_email_keep_domain": P.mask_email_keep_domain,
    "mask_phone_tail": P.mask_phone_tail,
}
MORE = ["Ada Ash", "Ada  Ash", "éa Ö", "ada@x.org", "@", "a@b@c.de", "+1-555-123-4567", "P12345678", "😀 a", "it's", "\\d$1"]


@pytest.fixture(scope="module")
def layers(spark):
    made = catalog.scratch_layers(spark)
    catalog.replace_functions(spark, made.meta)
    yield made
    catalog.drop_databases(spark, made)


def differing(spark, layers, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = [F.expr(f"{layers.meta}.{name}(t)").eqNullSafe(form(F.col("t"))).alias(name) for name, form in FORMS.items()]
    return [(r.t, name) for r in df.select("t", *both).collect() for name in FORMS if not r[name]]


def test_functions_equal_columns_on_the_cases(spark, layers):
    assert differing(spark, layers, [*CASES, *MORE]) == []


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(), st.text("aPé@. -+()0123456789\n", max_size=20)), min_size=20, max_size=60))
def test_functions_equal_columns_on_any_text(spark, layers, texts):
    assert differing(spark, layers, texts) == []


def test_every_function_is_covered():
    assert {f.name for f in FUNCTIONS} == set(FORMS) | {"detection_confidence", "mask_passport"}


def test_views_call_the_functions_and_equal_the_operators(spark, layers, make_customers):
    customers = make_customers(
        {},
        {"customer_id": "CUST000002", "email": None, "phone": "555-0199", "passport_no": "X1"},
        {"customer_id": "CUST000003", "full_name": "a", "email": "x@y", "phone": None, "passport_no": None},
        {"customer_id": "CUST000004", "full_name": None, "phone": "5551234567"},
    ).withColumnRenamed("ingestion_timestamp", "transformation_timestamp")
    catalog.replace_table(customers, layers.customer_silver)
    pipeline.publish_views(spark, layers, views.CUSTOMER_VIEWS)
    wanted = {
        "customer_masked_view": governance.masked_customers(customers),
        "documented_masks_view": governance.masked_customers_documented(customers),
        "rule_types_view": governance.rule_types(customers),
        "detection_view": governance.detection(customers).drop("detection_timestamp"),
    }
    for name, frame in wanted.items():
        view = getattr(layers, name)
        found = spark.table(view)
        assert found.columns == frame.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, frame.collect()))
        assert f"{layers.meta}." in spark.sql(f"SHOW CREATE TABLE {view}").first()[0]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_functions_can_be_replaced_and_called_from_sql(spark, layers):
    catalog.replace_functions(spark, layers.meta)
    row = spark.sql(f"SELECT {layers.meta}.mask_passport('P1') a, {layers.meta}.detection_confidence(true, NULL, true) b").first()
    assert row[:] == (P.PASSPORT_MASK, "MEDIUM")
