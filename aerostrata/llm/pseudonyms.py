"""Format-preserving pseudonyms for private values in texts.

Values are found by shape, validated, and replaced by a keyed permutation of
themselves: a Feistel network over the positions of the value.  Equal values get
equal pseudonyms wherever they stand and however they are separated, different values different ones, and a
pseudonym has the format of its value and passes the same validation.

Each value becomes a list of slots, a slot being a number below its own radix (a digit
below 10, a letter below 26, an octet below 256, one part of a day number).  Rounds
change one half of the slots by a keyed hash of the other half, in turns, so
every round can be undone and the whole maps the format one to one onto itself.
Blanks, dashes and brackets of numbers are no slots; the result is put back among them.

==========  =================================================================
kind        validation; what is permuted
==========  =================================================================
email       local part and domain by shape; letters and digits of the local part
iban        length of its country, remainder 1 by 97; the account part, check digits anew
card        13 to 19 digits at once or in groups, Luhn; all but the last digit, which is computed anew
ssn         area, group and serial in their ranges; all three within these ranges
ip          four octets up to 255; the octets
date        a day of the calendar from 1800 to 2199, year first; the day
phone       7 to 15 digits with a country code, or ten in groups; the national digits
secret      16 or more hexadecimal digits named as token, key, secret or password
==========  =================================================================

Cards and accounts often stand among other numbers and words (an expiry date, a code, a second
account).  They are looked for in whole runs of groups: every stretch of groups that passes the validation
is replaced, the longest from each group on, wherever in the run it begins and ends.

Everything is column expressions: each text is read once and nothing is shuffled.  Dates in other orders
or with names of months, IPv6 addresses and the domains of e-mail addresses are left as they are.

Defined cases: a null text stays null; an empty text or one without private values stays as it is;
a value that fails its validation stays; repeated rows are treated alike; where two valid stretches overlap
the one that begins first counts; an empty table gives no rows; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY = "1800-01-01"
#: The days of 400 years, and their two factors.
DAYS, HIGH, LOW = 146_097, 189, 773

_GROUP = r"(?:[ .-]?\(?[0-9]{2,4}\)?)"
SHAPES: list[tuple[str, str]] = [
    (
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)*"
        r"(?<=\.[A-Za-z]{2,24})",
    ),
    (
        "secret",
        r"(?i:token|key|secret|password)[\"']? {0,3}[=:] {0,3}[\"']?[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])",
    ),
    (
        "iban",
        r"(?<![0-9A-Za-z])(?=[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11})[A-Z0-9]++(?![a-z])(?: [A-Z0-9]++(?![a-z])){0,200}+",
    ),
    ("ip", r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"),
    ("date", r"(?<![0-9A-Za-z/-])[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}(?:(?=[Tt][0-9]{2}:?[0-9]{2})|(?![0-9A-Za-z/-]))"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"),
    ("phone", r"(?<![0-9A-Za-z+])\+[0-9]{1,3}" + _GROUP + r"{2,5}(?![0-9A-Za-z])"),
    (
        "phone",
        r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\2[0-9]{4})"
        r"(?![0-9A-Za-z]|[.-][0-9])",
    ),
    (
        "card",
        r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z])){0,200}+",
    ),
]
#: Digits of a card stand together or in groups; lists of short numbers are none.
CARD_GROUPS = "^(?:[0-9]{13,19}|[0-9]{3,7}(?:[ -][0-9]{3,7}){1,5})$"
#: Country codes end by themselves, whatever separates them: 1, 7, those of two digits, or three.
COUNTRY_CODE = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# Characters of an IBAN by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 "
    "SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)
PATTERN = "|".join(f"(?:{shape})" for _, shape in SHAPES)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(values: Column, radixes: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of ``values``, where slot ``i`` stays below ``radixes[i]``."""
    half = F.floor(F.size(values) / 2).cast("int")

    def rounds(state: Column, k: Column) -> Column:
        first = k % 2 == 0
        other = F.when(first, F.slice(state, half + 1, F.size(state) - half)).otherwise(
            F.slice(state, F.lit(1), half)
        )

        def change(seed: Column) -> Column:
            def slot(x: Column, i: Column) -> Column:
                drawn = F.conv(F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 12), 16, 10)
                moved = (x + drawn.cast("long")) % F.get(radixes, i)
                return F.when((i < half) == first, moved).otherwise(x)

            return F.transform(state, slot)

        text = F.array_join(F.transform(other, lambda x: x.cast("string")), ",")
        return _let(F.concat_ws("|", F.lit(key), tweak, k.cast("string"), text), change)

    return F.aggregate(F.array(*[F.lit(k) for k in range(ROUNDS)]), values, rounds)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _is(c: Column, low: str, high: str) -> Column:
    return (c >= low) & (c <= high)


def _permute_characters(text: Column, key: str, tweak: str, letters: int = 26) -> Column:
    """Digits by digits and letters by letters of the same case; the rest stays."""

    def classed(c: Column, digit: Column, upper: Column, lower: Column, other: Column) -> Column:
        return (
            F.when(_is(c, "0", "9"), digit).when(_is(c, "A", "Z"), upper).when(_is(c, "a", "z"), lower).otherwise(other)
        )

    def render(chars: Column) -> Column:
        values = F.transform(
            chars,
            lambda c: classed(c, F.ascii(c) - 48, F.ascii(c) - 65, F.ascii(c) - 97, F.lit(0)).cast("long"),
        )
        radixes = F.transform(
            chars, lambda c: classed(c, F.lit(10), F.lit(letters), F.lit(letters), F.lit(1)).cast("long")
        )
        moved = feistel(values, radixes, key, F.lit(tweak))
        shown = F.zip_with(
            chars,
            moved,
            lambda c, x: classed(c, F.char(x + 48), F.char(x + 65), F.char(x + 97), c),
        )
        return F.array_join(shown, "")

    return _let(_characters(text), render)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _compact(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9A-Za-z]", "")


def _laid_out(hit: Column, new: Column) -> Column:
    """The letters and digits of ``new`` in place of those of ``hit``, one by one."""

    def shown(c: Column, i: Column) -> Column:
        n = F.length(_compact(F.substring(hit, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9A-Za-z]"), F.substring(new, n, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_characters(hit), shown), "")


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """The Luhn sum of a digit string, from the right."""

    def digit(c: Column, i: Column) -> Column:
        x = F.ascii(c) - 48
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.when((i % 2 == 0) == F.lit(doubled_first), twice).otherwise(x)

    return F.aggregate(
        F.transform(_characters(F.reverse(digits)), digit), F.lit(0), lambda a, b: a + b
    )


def _within(run: Column, separator: str, most: int, valid: Callable[[Column], Column], new: Callable[[Column], Column]) -> Column:
    """A run of groups in which every stretch of whole groups that is valid is replaced.

    From each group on the longest valid stretch of up to ``most`` groups counts, and the search goes on
    behind it, so a value is found whatever groups stand before and after it.
    """

    def replaced(parts: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            stretch = lambda j: F.array_join(F.slice(parts, i + 1, j - i + 1), "")
            last = F.least(F.size(parts) - 1, i + 2 * most - 2)
            ends = F.filter(F.reverse(F.sequence(i, last)), lambda j: ((j - i) % 2 == 0) & valid(stretch(j)))

            def on(end: Column) -> Column:
                shown = F.when(end.isNull(), F.get(parts, i)).otherwise(new(stretch(end)))
                return F.struct(
                    F.concat(state["done"], shown).alias("done"), (F.coalesce(end, i) + 1).cast("int").alias("next")
                )

            # separators stand at odd places
            found = _let(F.when(i % 2 == 0, F.get(ends, F.lit(0))), on)
            return F.when(i < state["next"], state).otherwise(found)

        start = F.struct(F.lit("").alias("done"), F.lit(0).alias("next"))
        return F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, step, lambda state: state["done"])

    return _let(F.split(run, f"(?<={separator})|(?={separator})"), replaced)


def _card(run: Column, key: str) -> Column:
    def valid(text: Column) -> Column:
        digits = _digits(text)
        shaped = text.rlike(CARD_GROUPS) & F.length(digits).between(13, 19)
        return F.when(shaped, _luhn_sum(digits, False) % 10 == 0).otherwise(False)

    def new(hit: Column) -> Column:
        def checked(moved: Column) -> Column:
            check = (10 - _luhn_sum(moved, True) % 10) % 10
            return F.concat(moved, check.cast("string"))

        digits = _digits(hit)
        payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
        return _let(_let(_permute_characters(payload, key, "card"), checked), lambda x: _laid_out(hit, x))

    return _within(run, "[ -]", 6, valid, new)


def _mod97(text: Column) -> Column:
    """The remainder by 97 of letters and digits, letters counting from 10."""

    def step(total: Column, c: Column) -> Column:
        digit = _is(c, "0", "9")
        return F.when(digit, total * 10 + F.ascii(c) - 48).otherwise(total * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(_characters(text), F.lit(0), step)


def _iban(run: Column, key: str) -> Column:
    lengths = F.create_map(*[F.lit(x) for entry in IBAN_LENGTHS.split() for x in (entry[:2], int(entry[2:]))])

    def valid(text: Column) -> Column:
        compact = F.regexp_replace(text, " ", "")
        body = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
        whole = F.length(compact) == F.coalesce(lengths[F.substring(compact, 1, 2)], F.lit(0))
        return F.when(whole & compact.rlike("^[A-Z]{2}[0-9]{2}"), _mod97(body) == 1).otherwise(False)

    def new(hit: Column) -> Column:
        def renewed(account: Column) -> Column:
            country = F.substring(hit, 1, 2)
            rest = _mod97(F.concat(account, country, F.lit("00")))
            return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)

        compact = F.regexp_replace(hit, " ", "")
        account = F.substring(compact, F.lit(5), F.length(compact))
        return _let(_let(_permute_characters(account, key, "iban"), renewed), lambda x: _laid_out(hit, x))

    return _within(run, " ", 16, valid, new)


def _numbers(text: Column, separator: str) -> Column:
    return F.transform(F.split(text, separator), lambda x: x.cast("long"))


def _radixes(*values: int) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _ip(hit: Column, key: str) -> Column:
    def moved(octets: Column) -> Column:
        shown = F.transform(
            feistel(octets, _radixes(256, 256, 256, 256), key, F.lit("ip")), lambda x: x.cast("string")
        )
        return F.when(F.forall(octets, lambda x: x < 256), F.array_join(shown, ".")).otherwise(hit)

    return _let(_numbers(hit, r"\."), moved)


def _ssn(hit: Column, key: str) -> Column:
    """Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999."""

    def moved(parts: Column) -> Column:
        area, group, serial = (F.get(parts, F.lit(i)) for i in range(3))
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        slots = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)

        def render(out: Column) -> Column:
            first = F.get(out, F.lit(0)) + 1
            shown = [
                F.lpad((first + F.when(first >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
                F.lpad((F.get(out, F.lit(1)) + 1).cast("string"), 2, "0"),
                F.lpad((F.get(out, F.lit(2)) + 1).cast("string"), 4, "0"),
            ]
            return F.concat_ws("-", *shown)

        permuted = feistel(slots, _radixes(898, 99, 9999), key, F.lit("ssn"))
        return F.when(valid, _let(permuted, render)).otherwise(hit)

    return _let(_numbers(hit, "-"), moved)


def _date(hit: Column, key: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    plain = F.regexp_replace(hit, "/", "-")

    def moved(given: Column) -> Column:
        number = F.datediff(given, first).cast("long")
        slots = F.array(F.floor(number / LOW), number % LOW)

        def render(out: Column) -> Column:
            shown = F.date_add(first, (F.get(out, F.lit(0)) * LOW + F.get(out, F.lit(1))).cast("int"))
            separator = F.substring(hit, 5, 1)
            month, day = (F.lpad(part(shown).cast("string"), 2, "0") for part in (F.month, F.day))
            return F.concat(F.year(shown).cast("string"), separator, month, separator, day)

        valid = given.isNotNull() & (number >= 0) & (number < DAYS)
        permuted = feistel(slots, _radixes(HIGH, LOW), key, F.lit("date"))
        return F.when(valid, _let(permuted, render)).otherwise(hit)

    return _let(plain.try_cast("date"), moved)


def _phone(hit: Column, key: str) -> Column:
    digits = _digits(hit)
    code = F.when(hit.startswith("+"), F.regexp_extract(digits, COUNTRY_CODE, 0)).otherwise("")
    national = F.substring(digits, F.length(code) + 1, F.length(digits))
    new = F.concat(code, _permute_characters(national, key, "phone"))
    valid = F.length(digits).between(7, 15)
    return F.when(valid, _let(new, lambda x: _laid_out(hit, x))).otherwise(hit)


def _email(hit: Column, key: str) -> Column:
    local = F.substring_index(hit, "@", 1)
    return F.concat(_permute_characters(local, key, "email"), F.substring(hit, F.length(local) + 1, F.length(hit)))


def _secret(hit: Column, key: str) -> Column:
    value = F.regexp_extract(hit, "[0-9A-Fa-f]+$", 0)
    name = F.substring(hit, F.lit(1), F.length(hit) - F.length(value))
    return F.concat(name, _permute_characters(value, key, "secret", letters=6))


_RULES = {
    "email": _email,
    "secret": _secret,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


def _kind(hit: Column) -> Column:
    """The kind of a hit, from its own characters (that of a secret has its name)."""
    full = lambda pattern: hit.rlike(f"^(?:{pattern})$")
    return (
        F.when(hit.contains("@"), "email")
        .when(full("(?i:token|key|secret|password).*[=:].*"), "secret")
        .when(full(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"), "ip")
        .when(full(r"[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}"), "date")
        .when(full(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), "ssn")
        .when(full(r"\+.*|\(.*|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}"), "phone")
        .when(full(r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]*"), "iban")
        .otherwise("card")
    )


def pseudonym(hit: Column, key: str) -> Column:
    """What replaces a found value; the value itself where it fails its validation."""

    def by_kind(kind: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, rule in _RULES.items():
            out = F.when(kind == name, rule(hit, key)).otherwise(out)
        return out

    return _let(_kind(hit), by_kind)


def pseudonymized(
    docs: DataFrame, key: str, text_col: str = "text", counts_col: str | None = None
) -> DataFrame:
    """``docs`` with private values in ``text_col`` replaced.

    ``counts_col`` adds the number of values that were replaced.
    """
    columns = docs.columns
    text = F.col("text")
    may_have = text.rlike("[0-9@]") | text.rlike("(?i)token|key|secret|password")
    df = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"))
    none = F.array().cast("array<string>")
    df = df.withColumn("hits", F.when(may_have, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(none))
    df = df.withColumn("new", F.transform("hits", lambda hit: pseudonym(hit, key)))
    # the texts between the hits are one more than the hits
    df = df.withColumn("gaps", F.when(F.size("hits") > 0, F.split("text", PATTERN)))
    joined = F.concat(
        F.array_join(F.zip_with(F.slice("gaps", F.lit(1), F.size("hits")), "new", lambda gap, new: F.concat(gap, new)), ""),
        F.element_at("gaps", -1),
    )
    out = [
        (F.when(F.size("hits") > 0, joined).otherwise(text) if c == text_col else F.col(f"doc.`{c}`")).alias(c)
        for c in columns
    ]
    if counts_col:
        changed = F.filter(F.arrays_zip("hits", "new"), lambda x: x["hits"] != x["new"])
        out.append(F.size(changed).cast("long").alias(counts_col))
    return df.select(*out)
