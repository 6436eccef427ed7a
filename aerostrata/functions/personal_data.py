"""Detection and masking of personal data as native column expressions.

Nothing here needs a Python worker: the rules, the content classifier and the
masks are ordinary Catalyst expressions and stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three validation patterns, the loose phone pattern and the
# mask literals.  The email class really contains a vertical bar.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}$"
PHONE_PATTERN = r"^\+?\d{1,3}[-\s]?\(?\d{3}\)?[-\s]?\d{3}[-\s]?\d{4}$"
PASSPORT_PATTERN = r"^P\d{8}$"
LOOSE_PHONE_PATTERN = r"\d{3}[-\s]?\d{3}[-\s]?\d{4}"
NAME_MASK = "***"
EMAIL_MASK = "***@***"
PHONE_MASK = "***-****"
PASSPORT_MASK = "***MASKED***"

# The classifier is defined over Unicode text: any decimal digit, any letter,
# and every character that counts as white space when splitting words.
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNICODE_PHONE_PATTERN = rf"\p{{Nd}}{{3}}[-{_SPACE}]?\p{{Nd}}{{3}}[-{_SPACE}]?\p{{Nd}}{{4}}"
# Possessive quantifiers: words and gaps cannot overlap, so nothing is ever
# retried and a text of any length is matched in one pass without recursion.
WORDS_PATTERN = rf"\A[{_SPACE}]*+\p{{L}}++(?:[{_SPACE}]++\p{{L}}++)++[{_SPACE}]*+\z"
# (?d): only a newline ends a line, so "$" allows nothing else after the match.
UNIX_EMAIL_PATTERN = "(?d)" + EMAIL_PATTERN


def email_rule(email: Column) -> Column:
    return F.when(email.rlike(EMAIL_PATTERN), "EMAIL").otherwise("INVALID")


def phone_rule(phone: Column) -> Column:
    return F.when(phone.rlike(PHONE_PATTERN), "PHONE").otherwise("INVALID")


def passport_rule(passport: Column) -> Column:
    return F.when(passport.rlike(PASSPORT_PATTERN), "PASSPORT").otherwise("INVALID")


def content_type(text: Column) -> Column:
    """Guess what kind of personal data a whole text is; the first hit wins."""
    size = F.char_length(text)
    address_like = text.contains("@") & text.contains(".")
    return (
        F.when(text.isNull() | (size == 0), "NONE")
        .when(address_like & text.rlike(UNIX_EMAIL_PATTERN), "EMAIL")
        .when(address_like, "EMAIL_LIKE")
        .when(text.rlike(UNICODE_PHONE_PATTERN), "PHONE")
        .when(text.startswith("P") & (size == 9), "PASSPORT")
        .when(text.rlike(WORDS_PATTERN), "NAME")
        .when(text.startswith("CUST") & (size == 10), "CUSTOMER_ID")
        .otherwise("UNKNOWN")
    )


def mask_name(name: Column) -> Column:
    return F.concat(F.substring(name, 1, 1), F.lit(NAME_MASK))


def mask_email(email: Column) -> Column:
    return F.concat(
        F.substring(email, 1, 3), F.lit(EMAIL_MASK), F.substring_index(email, "@", -1)
    )


def mask_phone(phone: Column) -> Column:
    return F.concat(F.substring(phone, 1, 6), F.lit(PHONE_MASK))


# The second, documented masking style: J*** D***, j***@example.com, +1-555-***-****.
# A value that does not have the documented shape is masked as a whole.
NAME_SHAPE = r"^\p{L}+( \p{L}+)*\z"
EMAIL_SHAPE = r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+\z"
PHONE_SHAPE = r"^\+[0-9]{1,3}-[0-9]{3}-[0-9]{3}-[0-9]{4}\z"
WORD_LETTERS, WORD_MASK = r"(\p{L})\p{L}*", "$1***"
PHONE_TAIL = r"\d{3}-\d{4}$"


def _masked(value: Column, shape: str, shown: Column, hidden: str) -> Column:
    return F.when(value.rlike(shape), shown).when(value.isNotNull(), hidden)


def mask_name_by_word(name: Column) -> Column:
    shown = F.regexp_replace(name, WORD_LETTERS, WORD_MASK)
    return _masked(name, NAME_SHAPE, shown, NAME_MASK)


def mask_email_keep_domain(email: Column) -> Column:
    shown = F.concat(F.substring(email, 1, 1), F.lit("***@"), F.substring_index(email, "@", -1))
    return _masked(email, EMAIL_SHAPE, shown, "***@***")


def mask_phone_tail(phone: Column) -> Column:
    shown = F.regexp_replace(phone, PHONE_TAIL, PHONE_MASK)
    return _masked(phone, PHONE_SHAPE, shown, PHONE_MASK)


# Shapes searched for inside free text.  A shape may not start or end in the
# middle of a longer digit run; the look-behind stands after the first digits so
# that it is only tried where there are digits.  An address is only tried at the
# start of a run of its characters or where the last one ended, so long unbroken
# runs are read once.
_LOCAL = "[A-Za-z0-9._%+-]"
_TEXT_SHAPES = {
    "EMAIL": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}",
    "PHONE": LOOSE_PHONE_PATTERN,
    "CARD": r"[0-9]{4}(?<![0-9]{5})(?:[0-9]{9,12}|(?:[ -][0-9]{4}){3})(?![0-9])",
    "SSN": r"[0-9]{3}(?<![0-9]{4})-[0-9]{2}-[0-9]{4}(?![0-9])",
    "RESIDENT_NO": r"[0-9]{6}(?<![0-9]{7})-[1-8][0-9]{6}(?![0-9])",
}
TEXT_TYPES = list(_TEXT_SHAPES)


def occurrences(text: Column, kind: str) -> Column:
    """How often a shape of the given kind occurs in the whole text.

    An address needs an at-sign and every other shape three digits in a row, so
    texts without them (nearly all) are settled by one cheap shared test.
    """
    possible = text.contains("@") if kind == "EMAIL" else text.rlike("[0-9]{3}")
    found = F.regexp_count(text, F.lit(_TEXT_SHAPES[kind]))
    return F.when(possible, found).when(text.isNotNull(), 0)
