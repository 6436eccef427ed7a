"""Pseudonyms, quality rules and licences against plain Python."""

from __future__ import annotations

import datetime
import hashlib
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerostrata.llm import licences, pseudonyms, quality_rules
from tests.conftest import SMALL

KEY = "k"


def moved(values, radixes, tweak):
    """The Feistel rounds in Python."""
    values, half = list(values), len(values) // 2
    for k in range(pseudonyms.ROUNDS):
        first = k % 2 == 0
        other = ",".join(map(str, values[half:] if first else values[:half]))
        for i in range(len(values)):
            if (i < half) == first:
                seed = f"{KEY}|{tweak}|{k}|{other}|{i}"
                drawn = int(hashlib.sha256(seed.encode()).hexdigest()[:12], 16)
                values[i] = (values[i] + drawn) % radixes[i]
    return values


def by_class(text, tweak, letters=26):
    base = [48 if c.isdigit() else 65 if c.isupper() else 97 if c.islower() else None for c in text]
    radixes = [1 if b is None else 10 if b == 48 else letters for b in base]
    out = moved([0 if b is None else ord(c) - b for c, b in zip(text, base, strict=True)], radixes, tweak)
    return "".join(c if b is None else chr(b + v) for c, b, v in zip(text, base, out, strict=True))


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


@pytest.fixture(scope="module")
def replace(spark):
    def run(*texts):
        rows = [(i, t, "doc", 1) for i, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, "doc_id int, text string, hits string, new int")
        out = pseudonyms.pseudonymized(docs, KEY, counts_col="n")
        assert out.columns == ["doc_id", "text", "hits", "new", "n"]
        return [(r.text, r.n) for r in out.orderBy("doc_id").collect()]

    return run


def test_values_keep_their_format(replace):
    card = by_class("411111111111111", "card")
    card += str((10 - luhn(card + "0")) % 10)
    spaced = by_class("550000000000000", "card")
    spaced += str((10 - luhn(spaced + "0")) % 10)
    spaced = " ".join(spaced[i : i + 4] for i in range(0, 16, 4))
    number = by_class("0175557713", "phone")
    number = f"({number[:3]}) {number[3:6]}-{number[6:]}"
    octets = ".".join(map(str, moved([10, 0, 255, 7], [256] * 4, "ip")))
    days = (datetime.date(1999, 12, 31) - datetime.date(1800, 1, 1)).days
    high, low = moved(divmod(days, 773), [189, 773], "date")
    day = datetime.date(1800, 1, 1) + datetime.timedelta(high * 773 + low)
    area, group, serial = moved([123 - 1, 45 - 1, 6789 - 1], [898, 99, 9999], "ssn")
    ssn = f"{area + 1 + (area + 1 >= 666):03}-{group + 1:02}-{serial + 1:04}"
    account = by_class("370400440532013000", "iban")
    iban = f"DE{98 - mod97(account + 'DE00'):02}{account}"
    cases = {
        "4111111111111111": card,
        "5500 0000 0000 0004": spaced,
        "10.0.255.7": octets,
        "1999-12-31": day.isoformat(),
        "1999/12/31": day.isoformat().replace("-", "/"),
        "123-45-6789": ssn,
        "DE89370400440532013000": iban,
        "jo.Doe7@mail.example.com": by_class("jo.Doe7", "email") + "@mail.example.com",
        "+1 (017) 555-7713": "+1 " + number,
        "(017) 555-7713": number,
        "+49 30 1234567": None,
    }
    found = replace(*[f"see {v}, {v}!!\n{v}" for v in cases])
    for (value, wanted), (text, n) in zip(cases.items(), found, strict=True):
        if wanted is not None:
            assert (text, n) == (f"see {wanted}, {wanted}!!\n{wanted}", 3), value
            assert wanted != value and len(wanted) == len(value) or "." in value
        else:
            assert value not in text
    assert luhn(card) == luhn(re.sub("[^0-9]", "", spaced)) == 0
    assert mod97(iban[4:] + iban[:4]) == 1


def test_values_among_other_words_are_found(replace):
    """Cards and accounts between dates, codes, words and each other, as a scan of all stretches finds them."""
    card, spaced, iban = "4111111111111111", "5500 0000 0000 0004", "DE89 3704 0044 0532 0130 00"
    amex = "378282246310005"
    texts = [
        f"{spaced} 12/27", f"{card} 123", f"{iban} AND BIC", "DE89370400440532013000 2024", f"123 {card} 45 {spaced} 6",
        f"{iban} GB82 WEST 1234 5698 7654 32 OK", f"{amex} {amex}", f"No 7 {spaced}-99", f"{iban} Only", f"12-{card}-34",
        "1 " * 300 + card + " 2" * 300,
    ]
    for text, (new, n) in zip(texts, replace(*texts), strict=True):
        kept = re.sub(r"[0-9A-Z]", "x", text) == re.sub(r"[0-9A-Z]", "x", new)
        assert kept and n == 1 and new != text, text
        for value in (card, spaced, iban, amex, "DE89370400440532013000", "WEST 1234 5698 7654 32"):
            assert value not in new
    hidden = {text: new for text, (new, _) in zip(texts, replace(*texts), strict=True)}
    assert hidden[f"{spaced} 12/27"].endswith(" 12/27") and hidden[f"{card} 123"].endswith(" 123")
    assert hidden[f"{iban} AND BIC"].endswith(" AND BIC") and hidden["DE89370400440532013000 2024"].endswith(" 2024")
    first, second = hidden[f"{amex} {amex}"].split()
    assert first == second
    assert hidden[f"{iban} AND BIC"].replace(" ", "")[:22] == hidden["DE89370400440532013000 2024"][:22]


def valid_stretches(text):
    """Stretches of digit groups that are valid cards, by trying all of them; the first and longest count."""
    found, end = [], 0
    groups = list(re.finditer(r"[0-9]+", text))
    for i, first in enumerate(groups):
        if first.start() < end:
            continue
        best = None
        for last in groups[i:]:
            stretch = text[first.start() : last.end()]
            if re.search(r"[^0-9 -]|[ -]{2}", stretch):
                break
            around = text[max(0, first.start() - 1) : first.start()] + text[last.end() : last.end() + 1]
            digits = re.sub("[^0-9]", "", stretch)
            sizes = [len(g) for g in re.findall("[0-9]+", stretch)]
            grouped = len(sizes) == 1 or all(3 <= n <= 7 for n in sizes)
            if grouped and 13 <= len(digits) <= 19 and luhn(digits) == 0 and not re.search("[A-Za-z]", around):
                best = last
        if best:
            end = best.end()
            found.append(text[first.start() : end])
    return found


def test_no_card_of_the_given_documents_is_left(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    new = {r.doc_id: r.text for r in pseudonyms.pseudonymized(docs, KEY).collect()}
    cards = [(i, card) for i, text in texts.items() for card in valid_stretches(text or "")]
    assert cards and not [card for i, card in cards if card in new[i]]


def test_secrets_need_their_name(replace):
    token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    changed = by_class(token, "secret", 6)
    assert re.fullmatch("[0-9a-f]{40}", changed)
    found = replace(f'token = "{token}"###', f"commit {token}", f"PASSWORD: {token.upper()}")
    assert found[0] == (f'token = "{changed}"###', 1)
    assert found[1] == (f"commit {token}", 0)
    assert found[2][1] == 1


def test_what_is_not_valid_stays(replace):
    texts = [
        None, "", "no value", "4111111111111112", "1.2.3.456", "1.2.3.4.5", "2023-02-30", "000-12-3456",
        "666-12-3456", "DE88370400440532013000", "a@b", "12345", "x4111111111111111", "@@@ +1 ( 99", "1799-12-31",
        "Version 2.0 of 2024, 100,000 words", "3.14159 and 10:30",
    ]
    assert replace(*texts) == [(t, 0) for t in texts]


def test_values_stay_linked_and_apart(replace):
    values = [f"{a}.{b}.10.20" for a in range(12) for b in range(12)]
    found = [text for text, _ in replace(*values, *values)]
    assert found[: len(values)] == found[len(values) :]
    assert len(set(found)) == len(values)


def test_a_small_format_is_permuted_whole(spark):
    """All pairs of 3 by 5 values, and a single slot of 7."""
    from pyspark.sql import functions as F

    pairs = spark.range(15).select(F.array(F.floor(F.col("id") / 5), F.col("id") % 5).alias("v"))
    radixes = F.array(F.lit(3).cast("long"), F.lit(5).cast("long"))
    out = pairs.select(pseudonyms.feistel(F.col("v"), radixes, KEY, F.lit("t")).alias("v")).collect()
    assert sorted(tuple(r.v) for r in out) == [(a, b) for a in range(3) for b in range(5)]
    single = spark.range(7).select(
        pseudonyms.feistel(F.array("id"), F.array(F.lit(7).cast("long")), KEY, F.lit("t"))[0].alias("v")
    )
    assert sorted(r.v for r in single.collect()) == list(range(7))


def test_long_texts_are_read_once(replace):
    text = "a" * 200_000 + " 1" * 100_000 + " " + "9" * 100_000 + " x@" * 1000 + " 4111111111111111"
    ((out, n),) = replace(text)
    assert n == 1 and out[:500_000] == text[:500_000]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é#", "\n", " \t", "c\n\n", "日本", "  "]), max_size=60), max_size=12))
def test_measurements_on_any_text(spark, parts):
    texts = [" ".join(p) for p in parts] + [None, "", "same words again and again and so on " * 9]
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "id int, text string, words string")
    rows = quality_rules.with_ledger(docs).orderBy("id").collect()
    assert [tuple(r.quality[m] for m in quality_rules.MEASURES) for r in rows] == [measures(t) for t in texts]


def test_rules_policies_and_ablations(spark):
    good = " ".join(f"word{i}" for i in range(40))
    texts = [good, "few words", "again " * 40, good + " ### $$$ %%%", "\n".join([good] + ["x y"] * 9), None, good]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    judged = quality_rules.with_ledger(docs)
    names = [name for name, _ in quality_rules.RULES]
    failing = [
        sorted(n for i, n in enumerate(names) if r.quality.failed >> i & 1) for r in judged.collect()
    ]
    assert failing == [
        [], ["few_words"], ["repeated_words"], ["symbols"], ["repeated_lines", "repeated_words"], ["few_words"], [],
    ]
    policy = quality_rules.POLICIES["v1"]
    kept = judged.where(~quality_rules.rejected(judged["quality.failed"], policy))
    assert kept.count() == 2
    found = {r.rule: (r.failing, r.failing_only_this, r.kept_without_it) for r in quality_rules.ablations(judged, policy).collect()}
    assert found == {
        "few_words": (2, 2, 4), "repeated_words": (2, 1, 3), "symbols": (1, 1, 3), "repeated_lines": (1, 0, 2),
    }
    assert quality_rules.ablations(judged.limit(0), policy).collect() == []


def test_a_filter_on_the_ledger_is_not_moved_below_it(spark):
    docs = spark.createDataFrame([("a b",)], "text string")
    judged = quality_rules.with_ledger(docs)
    plan = judged.where(~quality_rules.rejected(judged["quality.failed"], 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_clashing_names_are_refused(spark):
    docs = spark.createDataFrame([("a", 1)], "text string, Quality int")
    with pytest.raises(ValueError):
        quality_rules.with_ledger(docs)
    with pytest.raises(ValueError):
        licences.with_licences(docs.withColumnRenamed("Quality", "licences"))


LICENCES = {
    "": "", None: "", "Words only.": "",
    "Some text.\nReleased under the MIT License.": "MIT",
    "RELEASED### under$$$ the*** MIT&&& LICENSE.%%%": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "A. Licensed under the Apache License, Version 2.0. B.": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.": "CC-BY-NC-4.0,MIT",
    "We read about the MIT license and released it.": "",
    "You may not use this file except in compliance with the License. Words. "
    "You may obtain a copy of the License at\nhttp://x": "Apache-2.0",
    "You may obtain a copy of the License at\nhttp://x\n"
    "You may not use this file except in compliance with the License.": "",
}


def test_licences(spark):
    docs = spark.createDataFrame([(t, "n") for t in LICENCES], "text string, names string")
    rows = licences.with_licences(docs).collect()
    assert {r.text: ",".join(r.licences) for r in rows} == LICENCES


def test_every_known_sentence_can_be_found():
    known = list(licences.SENTENCES.values())
    assert len(set(known)) == len(known)
    assert all(re.search(licences.MARK_WORDS, text) for text in known)
    assert all(name in licences.SENTENCES for _, names in licences.RULES for name in names)


MIT = """MIT License

Copyright (c) 2024 Ada Ash

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
WRAPPED = {
    MIT: "MIT", BSD_2: "BSD-2-Clause", BSD_3: "BSD-3-Clause", GPL_3: "GPL-3.0", APACHE: "Apache-2.0", ISC: "ISC",
    MPL: "MPL-2.0", BSD_3 + BSD_2: "BSD-2-Clause,BSD-3-Clause", GPL_3.replace("version 3", "version 2"): "GPL-2.0",
    GPL_3.replace("General", "Affero General"): "AGPL-3.0",
    "A heading\nReleased under\nthe MIT License\nby Ada": "MIT", "Released under\n\nthe MIT License": "",
    "Not released under\nthe MIT License.": "", "Released under\nthe MIT License and others.": "",
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_licence_texts(spark, mark):
    texts = {"\r\n".join(mark + line for line in t.split("\n")): wanted for t, wanted in WRAPPED.items()}
    texts |= {"\n".join(mark + line for line in t.split("\n")): wanted for t, wanted in WRAPPED.items()}
    rows = licences.with_licences(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.text: ",".join(r.licences) for r in rows} == texts


def test_separators_do_not_change_a_pseudonym(replace):
    same = [
        ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"],
        ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"],
        ["(017) 555-7713", "017-555-7713", "017.555.7713"],
        ["+49 30 1234567", "+4930 1234567", "+49-30-123-4567"],
        ["+1 (017) 555-7713", "+1 017 555 7713", "+1-017-555-7713"],
    ]
    for values in same:
        found = replace(*values)
        assert len({re.sub("[^0-9A-Z]", "", text) for text, _ in found}) == 1, found
        for value, (text, n) in zip(values, found, strict=True):
            assert n == 1 and text != value and re.sub("[0-9]", "9", text) == re.sub("[0-9]", "9", value)


def test_dates_of_timestamps(replace):
    (day, _), (stamp, n), (other, m) = replace("2024-03-05", "at 2024-03-05T10:00:00Z", "2024-03-05x")
    assert day != "2024-03-05" and (stamp, n) == (f"at {day}T10:00:00Z", 1) and (other, m) == ("2024-03-05x", 0)
