"""SimHash links, components and line dedup against brute force."""

from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import pytest
import xxhash

from aerostrata.llm import simhash, winnowing
from aerostrata.llm.components import components
from aerostrata.llm.staging import run_folder


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_random_links(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    links += [(draw.randint(1000, 1100), draw.randint(1000, 1100)) for _ in range(70)] + [(7, 7), (-5, 3)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(frame, run_folder(spark, "test")).collect()}
    wanted = roots({n for pair in links for n in pair}, links)
    assert found == {n: r for n, r in wanted.items() if n != r}


def test_components_without_links(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, run_folder(spark, "test")).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_masks_cover_every_pair_of_the_radius(radius):
    masks = simhash.masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(64), radius):
        changed = sum(1 << b for b in bits)
        assert any(m & changed == 0 for m in masks)


def expected_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [
    "", None, " \n\t ", "One", "one", "one two", "a b c d e f", "A B C D E F", "a b c d e g", "ÀB àb x",
    "x y z w", "word " * 70_000, "no-break\x1cword here now",
]


def test_fingerprints():
    assert [simhash.fingerprint(t, 3) for t in TEXTS] == [expected_fingerprint(t) for t in TEXTS]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_lose_no_pair(spark, radius):
    """Random fingerprints around a few centres: components equal those of all pairs."""
    draw = random.Random(radius)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            values.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash.linked(frame, radius, run_folder(spark, "test")).collect()}
    near = [
        (i, j)
        for (i, a), (j, b) in itertools.combinations(enumerate(signed), 2)
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    ]
    wanted = roots(range(len(signed)), near)
    assert found == {v: wanted[i] for i, v in enumerate(signed)}


def test_near_duplicates_with_odd_rows(spark):
    rows = [(i * 3 + 1, t, "x") for i, t in enumerate(TEXTS)] + [(None, "One", "y"), (4, "other text here", "z"), (4, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    found = simhash.near_duplicates(docs, run_folder(spark, "test"), 3, 2).collect()
    prints = [expected_fingerprint(t) for _, t, _ in rows]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    classes = roots(range(len(rows)), near)
    wanted = []
    for i, (doc_id, _, _) in enumerate(rows):
        ids = [r[0] for j, r in enumerate(rows) if classes[j] == classes[i] and r[0] is not None]
        wanted.append((str(doc_id), prints[i], min(ids)))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in found) == sorted(wanted)

    kept = simhash.one_of_each(docs, run_folder(spark, "test"), 3, 2)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(c) for _, _, c in wanted})


def test_near_duplicates_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none, run_folder(spark, "test"), 3, 2).collect() == []
    assert simhash.one_of_each(none, run_folder(spark, "test"), 3, 2).collect() == []


def without_repeated_runs(rows, min_words):
    """Every shortest run of enough words is looked up at its earlier places and followed from there."""
    places, out = defaultdict(list), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc_id] = (None, 0, 0)
            continue
        lines = text.split("\n")
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in lines]
        at = [i for i, n in enumerate(words) if n]
        here = [lines[i] for i in at]
        gone = set()
        for a in range(len(at)):
            sums = itertools.accumulate(words[i] for i in at[a:])
            n = next((k for k, total in enumerate(sums, 1) if total >= min_words), None)
            if n is None:
                break
            for there, p in places[tuple(here[a : a + n])]:
                k = n
                while a + k < len(here) and p + k < len(there) and here[a + k] == there[p + k]:
                    k += 1
                gone.update(range(at[a], at[a + k - 1] + 1))
            places[tuple(here[a : a + n])].append((here, a))
        out[doc_id] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def deduplicated(spark, rows, min_words):
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, lines int").repartition(3)
    left = winnowing.deduplicated(docs, run_folder(spark, "test"), min_words, lines_col="n", deleted_col="gone")
    assert left.columns == ["doc_id", "text", "lines", "n", "gone"]
    return {r.doc_id: (r.text, r.n, r.gone) for r in left.collect()}


def test_line_dedup_on_random_documents(spark):
    draw = random.Random(5)
    lines = ["", "  ", "a b", "c d e", "f", "g h i j", "k l m n o p", "q r", "s t u"]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randint(0, 14)))) for i in range(80)]
    assert deduplicated(spark, rows, 8) == without_repeated_runs(rows, 8)


def test_line_dedup_cases(spark):
    passage = "\n".join(f"line {i} of a passage with nine words here" for i in range(6))
    short = "\n".join(f"just line {i}" for i in range(4))
    rows = [
        (None, "null id comes first\n" + "z " * 60),
        (1, "before\n" + passage + "\nafter"),
        (2, "other\n" + passage + "\nend"),
        (3, "z " * 60),
        (4, short), (5, short), (6, ""), (7, None), (8, "one line " * 400), (9, "one line " * 400 + "!"),
    ]
    found = deduplicated(spark, rows, 50)
    assert found == without_repeated_runs(rows, 50)
    assert found[2][0] == "other\nend" and found[3][0] == "" and found[5][0] == short
    assert found[1][2] == 0 and found[9][2] == 0


def test_a_run_is_found_beside_its_first_places(spark):
    """Parts of a run stand earlier elsewhere; its whole earlier copy still counts."""
    part = [f"w{i}a w{i}b w{i}c w{i}d" for i in range(8)]
    rows = [(1, "\n".join(["x", *part[2:5], "y"])), (2, "\n".join(part)), (3, "\n".join(["new", *part, "end"]))]
    assert deduplicated(spark, rows, 10)[3][0] == "new\nend"


def test_repeated_rows_are_one_document(spark):
    text = "some words in a line " * 20
    found = [(1, text), (1, text), (2, text)]
    docs = spark.createDataFrame(found, "doc_id long, text string")
    left = winnowing.deduplicated(docs, run_folder(spark, "test"), 50).orderBy("doc_id").collect()
    assert [r.text for r in left] == [text, text, ""]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert winnowing.deduplicated(none, run_folder(spark, "test"), 50).collect() == []


def test_the_end_of_a_run_goes_with_it(spark):
    run = [" ".join(f"w{n}x{i}" for i in range(n)) for n in (30, 25, 5)]
    rows = [(1, "\n".join([*run, "one end"])), (2, "\n".join(["start", *run, "", "other end"]))]
    assert deduplicated(spark, rows, 50)[2] == ("start\n\nother end", 6, 3)


def test_whole_runs_on_random_documents(spark):
    draw = random.Random(6)
    lines = ["", "  ", "a b", "c d e", "f", "g h i j", "k l m n o p", "q r", "s t u"]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randint(0, 16)))) for i in range(120)]
    assert deduplicated(spark, rows, 8) == without_repeated_runs(rows, 8)
