"""Rules, classifier and masks as persistent SQL functions, for users of SQL alone.

Every function is one expression over its arguments; Spark puts it into the calling query, so a view that calls
it has the plan of the column form in ``personal_data`` and needs no Python worker.  Patterns and
literals are taken from there, so both forms follow the same values.
"""

from __future__ import annotations

from dataclasses import dataclass

from aerostrata.functions import personal_data as P


@dataclass(frozen=True)
class SqlFunction:
    name: str
    arguments: str
    body: str
    comment: str

    def statement(self, database: str) -> str:
        return (
            f"CREATE OR REPLACE FUNCTION {database}.{self.name}({self.arguments}) RETURNS STRING "
            f"COMMENT '{self.comment}' RETURN {self.body}"
        )


def _raw(pattern: str) -> str:
    """A literal without escapes, as patterns are full of backslashes."""
    return f"r'{pattern}'"


def _rule(kind: str, pattern: str) -> SqlFunction:
    name = kind.lower()
    body = f"CASE WHEN {name} RLIKE {_raw(pattern)} THEN '{kind}' ELSE 'INVALID' END"
    return SqlFunction(f"{name}_rule", f"{name} STRING", body, f"{kind} or INVALID by its validation rule")


def _shaped(name: str, argument: str, shape: str, shown: str, hidden: str) -> SqlFunction:
    body = f"CASE WHEN {argument} RLIKE {_raw(shape)} THEN {shown} WHEN {argument} IS NOT NULL THEN '{hidden}' END"
    return SqlFunction(name, f"{argument} STRING", body, "Documented mask; other shapes are hidden as a whole")


_CONTENT_TYPE = f"""CASE
    WHEN value IS NULL OR char_length(value) = 0 THEN 'NONE'
    WHEN contains(value, '@') AND contains(value, '.')
      THEN CASE WHEN value RLIKE {_raw(P.UNIX_EMAIL_PATTERN)} THEN 'EMAIL' ELSE 'EMAIL_LIKE' END
    WHEN value RLIKE {_raw(P.UNICODE_PHONE_PATTERN)} THEN 'PHONE'
    WHEN startswith(value, 'P') AND char_length(value) = 9 THEN 'PASSPORT'
    WHEN value RLIKE {_raw(P.WORDS_PATTERN)} THEN 'NAME'
    WHEN startswith(value, 'CUST') AND char_length(value) = 10 THEN 'CUSTOMER_ID'
    ELSE 'UNKNOWN' END"""

_CONFIDENCE = """CASE
    WHEN email_agrees AND phone_agrees AND passport_agrees THEN 'HIGH'
    WHEN email_agrees OR phone_agrees THEN 'MEDIUM'
    ELSE 'LOW' END"""

FUNCTIONS = [
    _rule("EMAIL", P.EMAIL_PATTERN),
    _rule("PHONE", P.PHONE_PATTERN),
    _rule("PASSPORT", P.PASSPORT_PATTERN),
    SqlFunction("content_type", "value STRING", _CONTENT_TYPE, "What a whole text looks like"),
    SqlFunction(
        "detection_confidence",
        "email_agrees BOOLEAN, phone_agrees BOOLEAN, passport_agrees BOOLEAN",
        _CONFIDENCE,
        "How far rule types and content types agree",
    ),
    SqlFunction("mask_name", "name STRING", f"left(name, 1) || '{P.NAME_MASK}'", "First letter only"),
    SqlFunction(
        "mask_email",
        "email STRING",
        f"left(email, 3) || '{P.EMAIL_MASK}' || substring_index(email, '@', -1)",
        "Three characters and the domain",
    ),
    SqlFunction("mask_phone", "phone STRING", f"left(phone, 6) || '{P.PHONE_MASK}'", "Six characters only"),
    SqlFunction("mask_passport", "passport STRING", f"'{P.PASSPORT_MASK}'", "Nothing is shown"),
    _shaped(
        "mask_name_by_word", "name", P.NAME_SHAPE,
        rf"regexp_replace(name, {_raw(P.WORD_LETTERS)}, '{P.WORD_MASK}')", P.NAME_MASK,
    ),
    _shaped(
        "mask_email_keep_domain", "email", P.EMAIL_SHAPE,
        "left(email, 1) || '***@' || substring_index(email, '@', -1)", P.EMAIL_MASK,
    ),
    _shaped(
        "mask_phone_tail", "phone", P.PHONE_SHAPE,
        f"regexp_replace(phone, {_raw(P.PHONE_TAIL)}, '{P.PHONE_MASK}')", P.PHONE_MASK,
    ),
]
