"""Repair of conversations and their prefix trie against plain Python."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from aerostrata.llm import conversation_repair, prefix_trie, queries
from aerostrata.llm.staging import run_folder
from tests.conftest import DATA, SMALL

INFINITE = (1 << 60, "")


def cheapest(rows):
    """Cost and audit of the cheapest repair, from the end of the conversation on.

    ``rows`` are (initial, must go, truncated); a place in the pattern is "first", "user" (a user
    turn or, after a pair, the end) or "answer".
    """

    @functools.cache
    def best(i, place, inserted):
        offers = []
        if i == len(rows) and place in ("first", "user after pair"):
            offers.append((0, ""))

        def on(cost, edit, after, i, inserted=0):
            rest = best(i, after, inserted)
            offers.append((cost + rest[0], edit + rest[1]))

        needed = "a" if place == "answer" else "u"
        after = "user after pair" if needed == "a" else "answer"
        if inserted < 4:
            on(3, "I", after, i, inserted + 1)
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            on(4, "D", place, i + 1)
            if not must_go:
                extra = 3 * truncated
                on(3 + extra, "R", after, i + 1)
                if initial == needed:
                    on(extra, "K", after, i + 1)
                if initial == "s" and place == "first":
                    on(extra, "K", "user", i + 1)
        return min(offers, default=INFINITE)

    for i in range(len(rows), 0, -1):  # known ends keep the recursion short
        for place in ("first", "user", "user after pair", "answer"):
            best(i, place, 0)
    return best(0, "first", 0)


def faults(rows):
    """One fault or None for each (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        left = text.strip(" \t\n\x0b\x0c\r")
        if not left:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if left[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def expected_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found = faults(rows)
    cost, audit = cheapest(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, found)))
    turns = [r[0] for r in rows if r[0] is not None]
    lines, i, odd = [], 0, 0
    for edit in audit:
        role, text = (None, "") if edit == "I" else rows[i][1:]
        i += edit != "I"
        if edit == "K":
            lines.append(f"{role}:{text}")
        elif edit != "D":
            lines.append(f"{'assistant' if odd else 'user'}:{text}")
        if edit != "D" and not lines[-1].startswith("s"):
            odd = not odd
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        found.count("blank"), found.count("duplicate"), found.count("truncated"),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damage(conv_id, turn, role, text):
    shown = lambda x: " " if x is None else str(x)
    role, text = shown(role), shown(text)
    kind = zlib.crc32(f"{shown(conv_id)}:{shown(turn)}".encode()) % 20
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def expected_op11(rows):
    conversations = defaultdict(list)
    for conv_id, *row in rows:
        conversations[conv_id] += damage(conv_id, *row)
    return {c: expected_repair(r) for c, r in conversations.items()}


REPAIR = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repairs(df):
    return {r.conv_id: tuple(r[c] for c in REPAIR) for r in df.collect()}


@pytest.mark.parametrize("folder", [SMALL, DATA])
def test_repair_of_the_given_conversations(spark, folder):
    assert repairs(queries.op11_conversation_repair(spark, folder)) == expected_op11(read_turns(spark, folder))


def conversations_of(spark, tmp_path, rows, partitions=3):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, depth int")
    frame.repartition(partitions).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def odd_conversations(draw, conversations, longest):
    texts = ["hi.", "so?", "cut", "", " \n", None, "end!", "a. b", "x\x0b.", "é."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for c in range(conversations):
        for i in range(draw.randint(1, longest)):
            turn = draw.choice([i, i, i, i + 1, None])
            text = draw.choice(texts + [f"t{draw.randint(0, 30)}."] * 8)
            rows.append((draw.choice([c, c, c, None]) if c < 3 else c, turn, draw.choice(roles), text, "clash", c))
    return rows


def test_repair_of_odd_conversations(spark, tmp_path):
    rows = odd_conversations(random.Random(11), 60, 9)
    folder = conversations_of(spark, tmp_path, rows)
    assert repairs(queries.op11_conversation_repair(spark, folder)) == expected_op11([r[:4] for r in rows])


def test_repair_over_many_blocks(spark):
    """Conversations that are longer than a block, and equal rows that fill several."""
    draw = random.Random(12)
    roles = ["user", "assistant", "system"]
    rows = [(5, i, draw.choice(roles), draw.choice(["", f"{i}.", f"{i}"]), "", 0) for i in range(3000)]
    rows += [(6, 1, "user", "same.", "", 0)] * 2500 + [(6, 2, "assistant", "so.", "", 0), (6, 0, "user", " ", "", 0)]
    rows += [(7, None, "system", "x.", "", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, a string, b int")
    found, left = conversation_repair.repaired(turns, run_folder(spark, "test"))
    digest = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digests(left).collect()}
    whole = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        whole[conv_id].append((turn, role, text))
    wanted = {c: expected_repair(r) for c, r in whole.items()}
    nothing = hashlib.sha256(b"").hexdigest()
    repairs = {r.conv_id: (*(r[c] for c in REPAIR[:-1]), digest.get(r.conv_id, nothing)) for r in found.collect()}
    assert repairs == wanted


def test_repair_without_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found, left = conversation_repair.repaired(none, run_folder(spark, "test"))
    assert found.collect() == left.collect() == conversation_repair.digests(left).collect() == []


def test_every_short_sequence_of_roles():
    """The stack's minimum against trying every way from the end on."""
    draw = random.Random(4)
    for _ in range(400):
        rows = tuple((draw.choice("sua t"), draw.random() < 0.15, draw.random() < 0.2) for _ in range(draw.randint(0, 9)))
        ways, ends = conversation_repair.parsed(list(rows), "0"), conversation_repair._ends()
        best = min((c + ends[s][0], a + ends[s][1]) for s, (c, a) in ways.items())
        assert best == cheapest(rows)


def expected_nodes(rows):
    """The trie node by node, from all prefixes of all rebuilt conversations."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                children[whole[: d - 1]].add(whole[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[n] for n in below) if below else 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[n] for n in below) + (len(members[node]) - 1) * size
    return {
        (members[n][0], len(n)): (
            members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in members
    }


def nodes_of(df):
    found = df.collect()
    columns = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = {(r.conv_id, r.depth): tuple(r[c] for c in columns) for r in found}
    assert len(out) == len(found)
    return out


def read_turns(spark, folder):
    columns = ["conv_id", "turn", "role", "text"]
    return [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(*columns).collect()]


@pytest.mark.parametrize("folder", [SMALL, DATA])
def test_trie_of_the_given_conversations(spark, folder):
    assert nodes_of(queries.op13_prefix_trie(spark, folder)) == expected_nodes(read_turns(spark, folder))


@pytest.mark.parametrize("shard_nodes", [12, 1 << 16])
def test_trie_of_odd_conversations(spark, tmp_path, monkeypatch, shard_nodes):
    """Few different turns, so that many conversations are equal or begin alike; also in many small shards."""
    draw = random.Random(13)
    rows = odd_conversations(draw, 40, 7)
    for c in range(100, 400):
        rows += [(c, i, "user", draw.choice(["a", "b"]), "", 0) for i in range(draw.randint(1, 14))]
    rows += [(c, i, "user", f"t{i}", "", 0) for c in (500, 501, 506) for i in range(300)]
    folder = conversations_of(spark, tmp_path, rows)
    monkeypatch.setattr(prefix_trie, "SHARD_NODES", shard_nodes)
    assert nodes_of(queries.op13_prefix_trie(spark, folder)) == expected_nodes([r[:4] for r in rows])


def test_trie_without_rows(spark, tmp_path):
    assert queries.op13_prefix_trie(spark, conversations_of(spark, tmp_path, [])).collect() == []
    lone = conversations_of(spark, tmp_path / "lone", [(7, None, None, None, "", 0)])
    assert nodes_of(queries.op13_prefix_trie(spark, lone)) == expected_nodes([(7, None, None, None)])


def test_closing_parentheses():
    draw = random.Random(14)
    for n in [1, 2, 31, 32, 33, 500, 5000]:
        parens, depth, left = [], 0, n
        while left or depth:
            up = left and (depth < 1 or draw.random() < 0.6) and not (parens and depth == 0)
            up = up or (left and depth == 1)  # one root
            parens.append(bool(up))
            depth += 1 if up else -1
            left -= bool(up)
        stack, wanted = [], {}
        for i, opens in enumerate(parens):
            if opens:
                stack.append(i)
            else:
                wanted[stack.pop()] = i
        opens = np.flatnonzero(parens)
        assert prefix_trie.find_close(np.array(parens), opens).tolist() == [wanted[i] for i in opens.tolist()]
