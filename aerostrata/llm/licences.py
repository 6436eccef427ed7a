"""Licence recognition by sentence rules.

A text is normalized (lower case, letters, digits and inner dots only) and known licence
sentences are looked for from one cut to another: line ends and the ends of sentences.  A
cut inside a known sentence counts as a blank, so lines may be wrapped, behind comment
marks too; a line without letters and digits ends a paragraph, which no sentence crosses.
The longest known sentence from a cut on counts.  What remains of a
text is the sequence of the identifiers found; a rule is an ordered list of
identifiers and recognises its licence where these stand in the text in that order, whatever
stands between.  A BSD text with the third clause is not reported as one with two as well.

All of it is column expressions in one pass; the sentences and rules are a fixed
list inside the plan.

Defined cases: a null or empty text has no sentences; a sentence that occurs twice is listed
twice, a licence once; several licences are all reported; repeated rows are treated
alike; of known sentences from one cut the longest counts, so ties cannot occur; a text of any length
is read paragraph by paragraph in its row; an empty table gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalized sentences of public licences, by identifier.
SENTENCES: dict[str, str] = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-notice-3": "this project is licensed under the mit license",
    "apache-notice": "licensed under the apache license version 2.0",
    "apache-notice-2": "licensed under the apache license version 2.0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl3-notice-2": "licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation either version 3 of the "
    "license or at your option any later version",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "cc-by-nc-4": "licensed under cc by nc 4.0",
    "cc-by-4": "licensed under cc by 4.0",
    "cc-by-sa-4": "licensed under cc by sa 4.0",
    "cc0": "released under cc0 1.0",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
    "of the software and to permit persons to whom the software is furnished to do so subject to the "
    "following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided with the "
    "distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-2": "neither the name of the university nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-3": "neither the name of google inc nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "apache-grant": "licensed under the apache license version 2.0 the license you may not use this file except "
    "in compliance with the license",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation either version 2 of the "
    "license or at your option any later version",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of "
    "the gnu lesser general public license as published by the free software foundation either version 2.1 of "
    "the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of "
    "the gnu lesser general public license as published by the free software foundation either version 3 of "
    "the license or at your option any later version",
    "lgpl3-free-2": "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu lesser general public license as published by the free software foundation either version 3 of "
    "the license or at your option any later version",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu affero general public license as published by the free software foundation either version 3 of "
    "the license or at your option any later version",
    "mpl2-notice": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice appear in all "
    "copies",
    "isc-grant-2": "permission to use copy modify and distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice appear in all "
    "copies",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial "
    "applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-notice": "distributed under the boost software license version 1.0",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy "
    "of the software and accompanying documentation covered by this license the software to use reproduce "
    "display distribute execute and transmit the software and to prepare derivative works of the software and "
    "to permit third parties to whom the software is furnished to do so all subject to the following",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-sa-4-long": "this work is licensed under a creative commons attribution sharealike 4.0 international "
    "license",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4.0 "
    "international license",
}

#: Rules by licence; any one of them is enough.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-notice-2"]),
    ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["apache-use", "apache-copy"]),
    ("AGPL-3.0", ["agpl3-free"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-2"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-3"]),
    ("BSL-1.0", ["boost-notice"]),
    ("BSL-1.0", ["boost-grant"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-long"]),
    ("CC0-1.0", ["cc0"]),
    ("GPL-2.0", ["gpl2-free"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0", ["gpl3-notice-2"]),
    ("GPL-3.0", ["gpl-free", "gpl-copy"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-grant-2"]),
    ("LGPL-2.1", ["lgpl21-free"]),
    ("LGPL-3.0", ["lgpl3-free"]),
    ("LGPL-3.0", ["lgpl3-free-2"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("MIT", ["mit-notice-3"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("Unlicense", ["unlicense"]),
    ("Zlib", ["zlib-grant"]),
]

#: Every known sentence has one of these; other paragraphs need no normalizing.
MARK_WORDS = "license|cc0|copyright|redistribution|permission|public domain"

# A sentence ends at a line end, or after . ! ? : before white space.
SENTENCE_END = r"\n|(?<=[.!?:])\s+"
PARAGRAPH_END = r"\n[^a-z0-9\n]*+(?=\n)"
DROPPED = r"[^a-z0-9.\n]+"
LOOSE_DOT = r"\.(?![0-9])|(?<![0-9])\."
CUTS = r" *+\n[ \n]*+"
_LONGEST_FIRST = sorted(SENTENCES.values(), key=len, reverse=True)
KNOWN = (
    r"(?<![^\n])(?:"
    + "|".join(text.replace(".", r"\.").replace(" ", r"[ \n]") for text in _LONGEST_FIRST)
    + r")(?![^\n])"
)


def normalized(paragraph: Column) -> Column:
    """The words of a paragraph in lower case, with one line end for every cut."""
    cut = F.regexp_replace(paragraph, SENTENCE_END, "\n")
    spaced = F.regexp_replace(cut, DROPPED, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, LOOSE_DOT, ""), CUTS, "\n"))


def _like(names: list[str]) -> str:
    return "%" + "%".join(f"<{n}>" for n in names) + "%"


def with_licences(
    docs: DataFrame,
    text_col: str = "text",
    out: str = "licences",
    found: str = "licence_sentences",
) -> DataFrame:
    """``docs`` with the identifiers of known sentences in order and the licences recognised."""
    clash = {out.lower(), found.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    known = F.create_map(*[F.lit(x) for name, text in SENTENCES.items() for x in (text, name)])
    df = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"))
    marked = F.filter(F.split(F.lower("text"), PARAGRAPH_END), lambda p: p.rlike(MARK_WORDS))
    hits = F.flatten(F.transform(marked, lambda p: F.regexp_extract_all(normalized(p), F.lit(KNOWN), F.lit(0))))
    names = F.transform(hits, lambda hit: F.get(F.array(known[F.translate(hit, "\n", " ")]), F.lit(0)))
    df = df.withColumn("names", F.coalesce(names, F.array().cast("array<string>")))
    sequence = F.concat(F.lit("<"), F.array_join("names", "><"), F.lit(">"))
    df = df.withColumn("sequence", sequence)
    hits = [F.when(F.col("sequence").like(_like(names)), licence) for licence, names in RULES]
    licences = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))
    # what follows each grant of a BSD licence; two clauses are one of its own only without the third
    grants = F.split("sequence", "<bsd-grant>")
    two = _like(["bsd-source", "bsd-binary"])
    alone = F.exists(F.slice(grants, F.lit(2), F.size(grants)), lambda g: g.like(two) & ~g.like(f"{two}<bsd-endorse%"))
    licences = F.when(F.array_contains(licences, "BSD-3-Clause") & ~alone, F.array_remove(licences, "BSD-2-Clause")).otherwise(
        licences
    )
    return df.select("doc.*", F.col("names").alias(found), licences.alias(out))
