"""SQL for the training-data queries that SQL can express.

Tokenizers, keyed permutations, fingerprints, components and nearest neighbours are
compared with brute force in the tests instead.  The licence check shares the table of known
sentences with the operator, as that is data; everything else is written here on its own.
"""

from __future__ import annotations

from aerostrata.llm.licences import RULES, SENTENCES

OP5 = r"""
WITH split AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), every AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM split
), worded AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS ord,
           sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS sums
    FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM every)
    WHERE words > 0
), own AS (
    SELECT doc_id, list(line ORDER BY ord) AS lines, list(pos ORDER BY ord) AS places,
           list(sums ORDER BY ord) AS sums, list(sums - words + 50 ORDER BY ord) AS needs
    FROM worded GROUP BY doc_id
), starts AS (
    SELECT *, unnest(generate_series(1, len(lines))) AS first FROM own
), spans AS (
    SELECT *, 1 + len([x FOR x IN sums IF x < needs[first]]) AS shortest FROM starts
), nexts AS (
    SELECT *, lead(shortest, 1, len(lines) + 1) OVER (PARTITION BY doc_id ORDER BY first) - 1 AS longest FROM spans
), stretches AS (
    SELECT *, unnest(generate_series(shortest, greatest(shortest, longest))) AS last
    FROM nexts WHERE shortest <= len(lines)
), windows AS (
    SELECT doc_id, places[first] AS from_line, places[last] AS to_line,
           array_to_string(list_slice(lines, first, last), chr(10)) AS content
    FROM stretches
), later AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, from_line) AS n FROM windows
    ) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(from_line, to_line)) AS pos FROM later
), counts AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
    FROM every ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n, 0) AS BIGINT) AS n_deleted_lines,
       CASE WHEN split.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM split LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _op6() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in SENTENCES.items())
    hits = ", ".join(
        f"CASE WHEN listed LIKE {_text('%' + '%'.join(f'<{n}>' for n in names) + '%')} THEN {_text(licence)} END"
        for licence, names in RULES
    )
    return rf"""
WITH cut AS (
    SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?:])\s+', '\1' || chr(10), 'g'), chr(10)) AS s
    FROM documents
), spaced AS (
    SELECT doc_id, pos, regexp_replace(lower(s), '[^a-z0-9.]+', ' ', 'g') AS s
    FROM (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS pos FROM cut)
), dotted AS (
    SELECT doc_id, pos,
           regexp_replace(regexp_replace(s, '([0-9])\.([0-9])', '\1@\2', 'g'), '([0-9])\.([0-9])', '\1@\2', 'g') AS s
    FROM spaced
), normal AS (
    SELECT doc_id, pos, trim(replace(replace(s, '.', ''), '@', '.')) AS s FROM dotted
), found AS (
    SELECT doc_id, list(known.name ORDER BY pos) AS names
    FROM normal JOIN (VALUES {known}) AS known(name, s) ON normal.s = known.s GROUP BY doc_id
), listed AS (
    SELECT doc_id, coalesce(names, []) AS names,
           '<' || coalesce(array_to_string(names, '><'), '') || '>' AS listed
    FROM documents LEFT JOIN found USING (doc_id)
)
SELECT doc_id, CAST(len(names) AS BIGINT) AS n_sentences, array_to_string(names, ',') AS sentences,
       array_to_string(list_sort(list_distinct([x FOR x IN [{hits}] IF x IS NOT NULL])), ',') AS licences
FROM listed
"""


OP10 = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words,
           [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS content
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM cut)
), twice AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, content) AS n FROM windows
    ) WHERE n > 1
), covered AS (
    SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n FROM (
        SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice
    ) GROUP BY doc_id
), measured AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM cut LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *,
           n_words < 20 AS few,
           100 * n_repeat_words > 30 * n_words AS repeated,
           n_symbols > 2 AND 10 * n_symbols > n_words AS symbols,
           n_dup_lines > 1 AND 100 * n_dup_lines > 30 * n_lines AS dup
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       CAST(few AS BIGINT) + 2 * CAST(repeated AS BIGINT) + 4 * CAST(symbols AS BIGINT) + 8 * CAST(dup AS BIGINT)
       + 16 * CAST(word_chars < 2 * n_words AS BIGINT) + 32 * CAST(word_chars > 15 * n_words AS BIGINT) AS failed_rules,
       few OR repeated AS base_failed, NOT (few OR repeated OR symbols OR dup) AS kept
FROM judged
"""

OP10_ABLATIONS = f"""
WITH ledger AS ({OP10}), rules AS (
    SELECT * FROM (VALUES ('base', 'few_words', 1, 3), ('base', 'repeated_words', 2, 3),
        ('v1', 'few_words', 1, 15), ('v1', 'repeated_words', 2, 15), ('v1', 'symbols', 4, 15),
        ('v1', 'repeated_lines', 8, 15)) AS t(policy, rule, bit, mask)
)
SELECT policy, rule,
       count(*) FILTER ((failed_rules & bit) <> 0) AS failing,
       count(*) FILTER ((failed_rules & mask) = bit) AS failing_only_this,
       count(*) FILTER ((failed_rules & mask & ~bit) = 0) AS kept_without_it
FROM ledger, rules GROUP BY policy, rule
"""

ORACLES: dict[str, str] = {
    "op5_line_dedup": OP5,
    "op6_licences": _op6(),
    "op10_quality_rules": OP10,
    "op10_ablations": OP10_ABLATIONS,
}
