from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostrata.functions import personal_data as P
from aerostrata.operators import governance, silver
from aerostrata.plans import registry
from tests.conftest import DATA

SLOW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def classified(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", P.content_type(F.col("t")).alias("kind")).collect()
    return [r.kind for r in sorted(rows)]


CASES = {
    None: "NONE",
    "": "NONE",
    " ": "UNKNOWN",
    "ada@example.com": "EMAIL",
    "ada@example.com\n": "EMAIL",
    "ada@example.com\r": "EMAIL_LIKE",
    "ada@example.com ": "EMAIL_LIKE",
    "ada@example.c|m": "EMAIL",
    "a@b.c": "EMAIL_LIKE",
    ".@": "EMAIL_LIKE",
    "ada.example.com": "UNKNOWN",
    "a@b": "UNKNOWN",
    "+1-555-123-4567": "PHONE",
    "5551234567": "PHONE",
    "4111111111111111": "PHONE",
    "call 555 123 4567 now": "PHONE",
    "555-0199": "UNKNOWN",
    "٥٥٥١٢٣٤٥٦٧": "PHONE",
    "P12345678": "PASSPORT",
    "PABCDEFGH": "PASSPORT",
    "Pia Klein": "PASSPORT",
    "Paul Klein": "NAME",
    "Ada Ash": "NAME",
    "  Ada\t Ash\n": "NAME",
    "Zoë Łukasz": "NAME",
    "李 明": "NAME",
    "Ada Ash": "NAME",
    "Ada Ash": "NAME",
    "Ada Ash2": "UNKNOWN",
    "Ada-Ash Elm": "UNKNOWN",
    "Ada": "UNKNOWN",
    "CUST000001": "CUSTOMER_ID",
    "CUST00001": "UNKNOWN",
    "cust000001": "UNKNOWN",
    "CUST0000012": "UNKNOWN",
    "P1234567": "UNKNOWN",
    "P123456789": "UNKNOWN",
    "p12345678": "UNKNOWN",
    "555-123-456": "UNKNOWN",
    "555  123 4567": "UNKNOWN",
    "555.123.4567": "UNKNOWN",
    "Ada  Ash": "NAME",
    "Ada Ash.": "UNKNOWN",
}


def test_known_texts(spark):
    assert dict(zip(CASES, classified(spark, list(CASES)), strict=True)) == CASES


ALPHABET = st.sampled_from("PCUSTadAZ019@@..-+ \t\n|_é李٣ \x1c\x85")


@SLOW
@given(
    st.lists(
        st.one_of(
            st.text(ALPHABET, max_size=12),
            st.text(st.characters(exclude_categories=["Cs"]), max_size=12),
            st.from_regex(re.compile(P.EMAIL_PATTERN, re.ASCII)),
            st.from_regex(re.compile(P.LOOSE_PHONE_PATTERN, re.ASCII)),
        ),
        min_size=30,
        max_size=60,
    )
)
@example(["a@b.cc\n\n", "٣" * 10, "ab cd\x1c", "Ps\x85aaaaaa"])
def test_labels_say_what_a_text_is(spark, texts):
    """What each label implies about its text, and that no stronger label was passed over."""
    for text, kind in zip(texts, classified(spark, texts), strict=True):
        address = "@" in text and "." in text
        digits = sum(c.isdecimal() for c in text)
        if kind == "NONE":
            assert text == ""
        elif kind in ("EMAIL", "EMAIL_LIKE"):
            assert address
        else:
            assert text and not address
        if kind == "EMAIL":
            assert text.rstrip("\n").split("@")[-1].rsplit(".", 1)[-1].replace("|", "a").isalpha()
        elif kind == "PHONE":
            assert digits >= 10
        elif kind == "PASSPORT":
            assert text[0] == "P" and len(text) == 9
        elif kind == "NAME":
            assert len(text.split()) > 1 and digits == 0
        elif kind == "CUSTOMER_ID":
            assert text[:4] == "CUST" and len(text) == 10


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("a@b.cc 5551234567", ["EMAIL_LIKE"]),
        ("P55512345", ["PASSPORT"]),
        ("P5551234567", ["PHONE"]),
        ("CUST5551234567", ["PHONE"]),
        ("CUST Ab Cd", ["NAME"]),
        ("Paul Kle9", ["PASSPORT"]),
    ],
)
def test_the_first_label_wins(spark, text, kinds):
    assert classified(spark, [text]) == kinds


def test_very_long_texts(spark):
    words = "Ada " * 200_000
    texts = [words, words + "1", "a" * 1_000_000 + "@" + "b." * 300_000, "1-" * 500_000]
    assert classified(spark, texts) == ["NAME", "UNKNOWN", "EMAIL_LIKE", "UNKNOWN"]


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("value", "kind"),
    [
        ("+1-555-123-4567", "PHONE"),
        ("1 (555) 123-4567", "PHONE"),
        ("123-555-123-4567", "PHONE"),
        ("555-123-4567", "INVALID"),
        ("5551234567", "INVALID"),
        ("15551234567", "PHONE"),
        ("+1-555-123-456", "INVALID"),
        (None, "INVALID"),
    ],
)
def test_phone_rule_needs_a_country_code(spark, value, kind):
    assert one(spark, value, P.phone_rule) == kind


@pytest.mark.parametrize(
    ("value", "kind"),
    [("a@b.co", "EMAIL"), ("a@b.c", "INVALID"), ("@b.co", "INVALID"), ("a@b.c|", "EMAIL"), (None, "INVALID")],
)
def test_email_rule(spark, value, kind):
    assert one(spark, value, P.email_rule) == kind


@pytest.mark.parametrize(
    ("value", "kind"),
    [("P12345678", "PASSPORT"), ("P1234567", "INVALID"), ("p12345678", "INVALID"), (None, "INVALID")],
)
def test_passport_rule(spark, value, kind):
    assert one(spark, value, P.passport_rule) == kind


BAD = {"email": "x@", "phone": "555-123-4567", "passport_no": "PABCDEFGH"}


@pytest.mark.parametrize(
    ("wrong", "level"),
    [
        ([], "HIGH"),
        (["passport_no"], "MEDIUM"),
        (["email"], "MEDIUM"),
        (["phone"], "MEDIUM"),
        (["email", "passport_no"], "MEDIUM"),
        (["email", "phone"], "LOW"),
        (["email", "phone", "passport_no"], "LOW"),
    ],
)
def test_confidence(make_customers, wrong, level):
    found = governance.detection(silver.customers(make_customers({c: BAD[c] for c in wrong})))
    row = found.first()
    assert row.detection_confidence == level and row.detection_timestamp is not None
    assert governance.discrepancy_count(found).first()[0] == bool(wrong)
    shown = governance.discrepancy_sample(found).count()
    assert shown == bool({"email", "phone"} & set(wrong))


def test_missing_name_is_still_a_name_by_rule(make_customers):
    row = governance.detection(silver.customers(make_customers({"full_name": None}))).first()
    assert (row.name_pii_type, row.ai_name_type) == ("NAME", "NONE")


def test_report_shares_and_empty_report(make_customers):
    raw = make_customers({}, {}, {"email": None})
    found = governance.detection(silver.customers(raw))
    assert governance.report_overall(found).first()[:] == (3, 2, 1, 0, 66.7, 33.3, 0.0)
    assert governance.report_overall(found.limit(0)).first()[:] == (0, 0, 0, 0, None, None, None)
    assert {tuple(r) for r in governance.type_distribution(found).collect()} == {
        ("Email", 2), ("Phone", 3), ("Passport", 3), ("Name", 3),
    }


def test_masks(make_customers):
    raw = make_customers(
        {},
        {"full_name": None, "email": None, "phone": None, "passport_no": None},
        {"full_name": "李 明", "email": "ab", "phone": "12"},
        {"email": "a@b@example.org"},
    )
    rows = governance.masked_customers(silver.customers(raw)).collect()
    shown = [(r.full_name_masked, r.email_masked, r.phone_masked, r.passport_masked) for r in rows]
    assert shown == [
        ("A***", "ada***@***example.com", "+1-555***-****", "***MASKED***"),
        (None, None, None, "***MASKED***"),
        ("李***", "ab***@***ab", "12***-****", "***MASKED***"),
        ("A***", "a@b***@***example.org", "+1-555***-****", "***MASKED***"),
    ]


def test_documented_masks(make_customers):
    raw = make_customers({"full_name": "John Doe", "email": "john.doe@example.com"})
    assert governance.masked_customers_documented(silver.customers(raw)).first()[1:] == (
        "J*** D***", "j***@example.com", "+1-555-***-****",
    )


def test_documented_masks_show_nothing_of_other_shapes(make_customers):
    """Values without the documented shape are masked as a whole."""
    odd = [
        {"full_name": "Bob2 Smith", "email": "nobody", "phone": "5551234567"},
        {"full_name": "O'Neil Ann", "email": "a@b@example.org", "phone": "+1 555 123 4567"},
        {"full_name": "Ann  Lee", "email": "ann@x.", "phone": "+1-555-123-4567 ext 9"},
        {"full_name": "", "email": "", "phone": ""},
    ]
    rows = governance.masked_customers_documented(silver.customers(make_customers(*odd))).collect()
    assert {tuple(r[1:]) for r in rows} == {("***", "***@***", "***-****")}
    none = make_customers({"full_name": None, "email": None, "phone": None})
    assert governance.masked_customers_documented(silver.customers(none)).first()[1:] == (None, None, None)


@SLOW
@given(st.lists(st.from_regex(r"\A[a-z0-9]{3,12}@[a-z]{1,8}\.com\Z"), min_size=5, max_size=20))
def test_masked_address_shows_three_characters_and_the_domain(spark, addresses):
    df = spark.createDataFrame([(a,) for a in addresses], "v string")
    masked = [r[0] for r in df.select(P.mask_email(F.col("v"))).collect()]
    assert masked == [a[:3] + "***@***" + a.split("@")[1] for a in addresses]


def counts(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(*[P.occurrences(F.col("t"), k).alias(k) for k in P.TEXT_TYPES]).first().asDict()


@pytest.mark.parametrize(
    ("text", "hits"),
    [
        ("nothing here", {}),
        ("write to a@b.com, or x.y@z.org", {"EMAIL": 2}),
        ("a@b.com_x@y.org", {"EMAIL": 2}),
        ("a@b.c @d.com e@f", {}),
        ("4111111111111111 4111-1111-1111-1111", {"CARD": 2}),
        ("4111 1111 1111 1111 5500 0000 0000 0004", {"CARD": 2}),
        ("41111111111111112", {}),
        ("id 123-45-6789, 123-45-6789 and 1123-45-6789 123-45-67890", {"SSN": 2}),
        ("900101-1234567 900101-9234567", {"RESIDENT_NO": 1}),
        ("call 555-123-4567", {}),
    ],
)
def test_shapes_in_text(spark, text, hits):
    phones = len(re.findall(P.LOOSE_PHONE_PATTERN, text))
    assert counts(spark, text) == dict.fromkeys(P.TEXT_TYPES, 0) | {"PHONE": phones} | hits


def test_shapes_in_no_text_and_in_long_runs(spark):
    assert set(counts(spark, None).values()) == {None}
    long_run = "x" * 2_000_000 + " a@b.com " + "1" * 2_000_000
    found = counts(spark, long_run)
    assert (found["EMAIL"], found["CARD"], found["SSN"], found["PHONE"]) == (1, 0, 0, 200_000)


@SLOW
@given(st.lists(st.text(st.sampled_from("aB1@.-_% "), max_size=30), min_size=20, max_size=40))
def test_address_search_equals_a_plain_search(spark, texts):
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", P.occurrences(F.col("t"), "EMAIL").alias("n")).collect()
    assert [r.n for r in sorted(rows)] == [len(plain.findall(t)) for t in texts]


def test_text_scan_counts_texts_and_hits(spark):
    docs = spark.createDataFrame(
        [("en", "a@b.com a@b.com"), ("en", None), ("fr", "555-123-4567")], "lang string, text string"
    )
    rows = {(r.lang, r.pii_type): tuple(r)[1:2] + tuple(r)[3:] for r in governance.text_scan(docs).collect()}
    assert len(rows) == 10
    assert rows["en", "EMAIL"] == (2, 1, 2) and rows["fr", "PHONE"] == (1, 1, 1)
    assert rows["en", "CARD"] == (2, 0, 0)


def test_fair_sample_has_every_class_and_is_repeatable(spark):
    detected = registry.Inputs(spark, DATA).detected
    classes = governance.discrepancy_class(detected).groupBy("differs_on").count().collect()
    sample = governance.fair_discrepancy_sample(detected, k=3).collect()
    drawn = Counter(r.differs_on for r in sample)
    assert drawn == {r.differs_on: min(3, r["count"]) for r in classes} and len(drawn) >= 3
    again = governance.fair_discrepancy_sample(detected.repartition(5), k=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, sample))
    other = governance.fair_discrepancy_sample(detected, k=3, key="another").collect()
    assert {r.customer_id for r in other} != {r.customer_id for r in sample}
    # the few of each task are chosen before the shuffle
    plan = governance.fair_discrepancy_sample(detected)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
