"""Personal-data detection, masking and reporting on customers and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions import personal_data as P
from aerostrata.functions.shape import tall

CHECKED = ["email", "phone", "passport"]
_IDENTITY = ["customer_id", "full_name", "email", "phone", "passport_no"]


def _agrees(kind: str) -> Column:
    return F.col(f"{kind}_pii_type") == F.col(f"ai_{kind}_type")


def rule_types(customers: DataFrame) -> DataFrame:
    """Type of each personal column by its validation rule, else INVALID."""
    return customers.select(
        *_IDENTITY,
        P.email_rule(F.col("email")).alias("email_pii_type"),
        P.phone_rule(F.col("phone")).alias("phone_pii_type"),
        P.passport_rule(F.col("passport_no")).alias("passport_pii_type"),
        F.lit("NAME").alias("name_pii_type"),
    )


def rule_counts(types: DataFrame) -> DataFrame:
    """Valid e-mails, phones and passports in one pass."""
    return types.agg(
        F.count_if(F.col("email_pii_type") == "EMAIL").alias("valid_emails"),
        F.count_if(F.col("phone_pii_type") == "PHONE").alias("valid_phones"),
        F.count_if(F.col("passport_pii_type") == "PASSPORT").alias("valid_passports"),
    )


def content_types(customers: DataFrame) -> DataFrame:
    """What each personal column looks like to the content classifier."""
    return customers.select(
        "*",
        P.content_type(F.col("full_name")).alias("ai_name_type"),
        P.content_type(F.col("email")).alias("ai_email_type"),
        P.content_type(F.col("phone")).alias("ai_phone_type"),
        P.content_type(F.col("passport_no")).alias("ai_passport_type"),
    )


def detection(customers: DataFrame) -> DataFrame:
    """Rule types, content types and how far the two agree."""
    both = content_types(rule_types(customers))
    email, phone, passport = (_agrees(kind) for kind in CHECKED)
    confidence = (
        F.when(email & phone & passport, "HIGH").when(email | phone, "MEDIUM").otherwise("LOW")
    )
    return both.select(
        "*",
        confidence.alias("detection_confidence"),
        F.current_timestamp().alias("detection_timestamp"),
    )


def confidence_distribution(detected: DataFrame) -> DataFrame:
    return detected.groupBy("detection_confidence").agg(F.count("*").alias("count"))


def report_overall(detected: DataFrame) -> DataFrame:
    """Records per confidence level and their percentages to one place."""
    levels = ["high", "medium", "low"]
    total = F.count("*")
    counts = detected.agg(
        total.alias("total_records"),
        *[
            F.count_if(F.col("detection_confidence") == level.upper()).alias(f"{level}_confidence")
            for level in levels
        ],
    )
    share = lambda c: F.round(F.try_divide(F.col(c) * 100, F.col("total_records")), 1)
    return counts.select(
        "*", *[share(f"{level}_confidence").alias(f"{level}_pct") for level in levels]
    )


def type_distribution(detected: DataFrame) -> DataFrame:
    """Records per detected type, counted in one pass."""
    kinds = ["email", "phone", "passport", "name"]
    wide = detected.agg(
        *[F.count_if(F.col(f"{kind}_pii_type") == kind.upper()).alias(kind) for kind in kinds]
    )
    return tall(wide, "pii_type", "count", {kind.capitalize(): F.col(kind) for kind in kinds})


def discrepancy_count(detected: DataFrame) -> DataFrame:
    """Records where rule and content disagree on e-mail, phone or passport."""
    email, phone, passport = (_agrees(kind) for kind in CHECKED)
    return detected.agg(F.count_if(~(email & phone & passport)).alias("discrepant_records"))


def discrepancy_sample(detected: DataFrame, k: int = 5) -> DataFrame:
    """The first records by id that disagree on e-mail or phone."""
    shown = ["email_pii_type", "ai_email_type", "phone_pii_type", "ai_phone_type"]
    return (
        detected.where(~(_agrees("email") & _agrees("phone")))
        .select("customer_id", *shown)
        .orderBy("customer_id", *shown)
        .limit(k)
    )


def discrepancy_class(detected: DataFrame) -> DataFrame:
    """Records that disagree on e-mail, phone or passport, with the list of what they disagree on."""
    named = F.concat_ws(",", *[F.when(~_agrees(kind), kind) for kind in CHECKED])
    return detected.withColumn("differs_on", named).where(F.col("differs_on") != "")


def fair_discrepancy_sample(detected: DataFrame, k: int = 5, key: str = "review") -> DataFrame:
    """``k`` records of every class of disagreement, each as likely as any other of its class.

    Records are ordered by a hash of ``key`` and their identity, so every run draws the same ones and another
    key draws others.  Only the ``k`` smallest of a class in each task are shuffled, as the
    rank filter is applied before the exchange as well.
    """
    shown = ["email_pii_type", "ai_email_type", "phone_pii_type", "ai_phone_type", "passport_pii_type", "ai_passport_type"]
    identity = [F.coalesce(F.col(c), F.lit("")) for c in _IDENTITY]
    drawn = F.sha2(F.concat_ws("\x1f", F.lit(key), *identity), 256)
    ranked = discrepancy_class(detected).select("differs_on", drawn.alias("draw"), "customer_id", *shown)
    within = Window.partitionBy("differs_on").orderBy("draw", "customer_id")
    place = F.row_number().over(within)
    return ranked.withColumn("place", place).where(F.col("place") <= k).drop("draw")


def masked_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        P.mask_name(F.col("full_name")).alias("full_name_masked"),
        P.mask_email(F.col("email")).alias("email_masked"),
        P.mask_phone(F.col("phone")).alias("phone_masked"),
        F.lit(P.PASSPORT_MASK).alias("passport_masked"),
        "country",
        "segment",
        "transformation_timestamp",
    )


def masked_customers_documented(customers: DataFrame) -> DataFrame:
    """The documented masking style: word initials, whole domain, phone prefix."""
    return customers.select(
        "customer_id",
        P.mask_name_by_word(F.col("full_name")).alias("full_name_masked"),
        P.mask_email_keep_domain(F.col("email")).alias("email_masked"),
        P.mask_phone_tail(F.col("phone")).alias("phone_masked"),
    )


def text_scan(documents: DataFrame) -> DataFrame:
    """Personal data inside whole texts: texts affected and hits, by language and type.

    Every text is searched once per type; only counts per language are shuffled.
    """
    hits = documents.select(
        "lang", *[P.occurrences(F.col("text"), kind).alias(kind) for kind in P.TEXT_TYPES]
    )
    by_lang = hits.groupBy("lang").agg(
        F.count("*").alias("documents"),
        *[F.count_if(F.col(kind) > 0).alias(f"{kind}_documents") for kind in P.TEXT_TYPES],
        *[F.sum(F.col(kind).cast("bigint")).alias(f"{kind}_hits") for kind in P.TEXT_TYPES],
    )
    rows = [
        F.struct(
            F.lit(kind).alias("pii_type"),
            F.col(f"{kind}_documents").alias("documents_with_type"),
            F.coalesce(F.col(f"{kind}_hits"), F.lit(0)).alias("matches"),
        )
        for kind in P.TEXT_TYPES
    ]
    return by_lang.select("lang", "documents", F.inline(F.array(*rows)))
