"""Repair of the role order of conversations by generalised LR parsing.

The roles of a conversation should be an optional system turn and then pairs of user
and assistant, or nothing: ``(s?(ua)+)?`` over the roles' initials, as a grammar

    Q -> empty | N        N -> P | s P | N P        P -> u a

Each row is kept, given another role or deleted, and rows without text may be inserted.
All edits are tried at once by the grammar's LR automaton on a graph-structured stack:
after each row there is one stack top per state, and tops of equal state are merged to
the one of minimum (cost, audit), the audit being the initials of its edits so far.
Audits of equal cost over the same rows are never beginnings of each other, as each
insertion costs, so a minimum stays the minimum whatever follows.

A conversation may be longer than one task should hold, so

1. rows are stored in the order of conversation and turn, identical ones once with
   their number, and cut into blocks of ``BLOCK`` neighbours;
2. in each block every part of a conversation is parsed from every state it may begin in:
   from each first state to each last one the best (cost, audit);
3. the parts of a conversation are joined in order, as a stream of their tables;
4. the edits chosen for each part give its repaired rows, again block by block.

A row has at most one fault, the first that holds: ``blank`` (no character other than white
space), ``duplicate`` (role and text stand earlier in the conversation), ``truncated`` (the last
such character is none of ``.!?``).  Blank and duplicate rows must be deleted.

Defined cases: a null role or text is one blank; rows are ordered by turn, null first, then by role
and text; rows that agree in all four columns are duplicates of the first; a null conversation id is
a conversation like others; a role that starts with another letter cannot be kept; an empty table gives
no rows; other columns play no part.  Texts never pass through Python, so their length
does not matter; an audit is one value per conversation and must fit in a row.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.ordered import in_order
from aerostrata.llm.staging import map_arrow, shipped, stored

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS
#: Places of repaired rows in a block: at most every row and two insertions before each.
_PLACE_BITS = BLOCK_BITS + 2
ROLES = {"u": "user", "a": "assistant"}

# The LR(0) automaton.  "0" is its first state; "s", "u" and "N" follow those symbols; the others
# are only passed on the way to a reduction (of so many symbols to which one).
_SHIFT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("N", "u"): "u", ("u", "a"): "ua"}
_REDUCE = {"ua": ("P", 2), "P": ("N", 1), "sP": ("N", 2), "NP": ("N", 2)}
_GOTO = {("0", "P"): "P", ("s", "P"): "sP", ("N", "P"): "NP", ("0", "N"): "N"}
_ACCEPTING = ("0", "N")


class Stack(NamedTuple):
    """A stack of the automaton; stacks share what lies below their tops."""

    state: str
    below: Stack | None = None


_START = Stack("0")
#: A stack for every state that can stand between two rows.  What lies below "u" is of no
#: influence: every reduction over it ends in "N".
_STACKS = {"0": _START, "s": Stack("s", _START), "u": Stack("u", _START), "N": Stack("N", _START)}


@functools.lru_cache(maxsize=64)
def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and all reductions, or None where it cannot follow."""
    state = _SHIFT.get((stack.state, symbol))
    if state is None:
        return None
    stack = Stack(state, stack)
    while stack.state in _REDUCE:
        symbol, size = _REDUCE[stack.state]
        for _ in range(size):
            stack = stack.below
        stack = Stack(_GOTO[stack.state, symbol], stack)
    return stack


def _offer(tops: dict, stack: Stack | None, cost: int, audit: str) -> bool:
    """Merge equal tops by minimum (cost, audit)."""
    if stack is None:
        return False
    best = tops.get(stack.state)
    if best is not None and (best[0], best[1]) <= (cost, audit):
        return False
    tops[stack.state] = (cost, audit, stack)
    return True


def _inserted(tops: dict) -> dict:
    """The tops and those reached from them by insertions."""
    tops = dict(tops)
    todo = list(tops)
    while todo:
        cost, audit, stack = tops[todo.pop()]
        for symbol in ROLES:
            follower = shifted(stack, symbol)
            if _offer(tops, follower, cost + INSERT, audit + "I"):
                todo.append(follower.state)
    return tops


def _after(tops: dict, initial: str, must_go: bool, truncated: bool) -> dict:
    """The tops after a row, from those before it."""
    out: dict = {}
    extra = TRUNCATED if truncated else 0
    for cost, audit, stack in _inserted(tops).values():
        _offer(out, stack, cost + DELETE, audit + "D")
        if must_go:
            continue
        _offer(out, shifted(stack, initial), cost + KEEP + extra, audit + "K")
        for symbol in ROLES:
            _offer(out, shifted(stack, symbol), cost + REROLE + extra, audit + "R")
    return out


def parsed(rows: list[tuple[str, bool, bool]], start: str) -> dict[str, tuple[int, str]]:
    """For every state after the rows (initial, must go, truncated) the best cost and audit."""
    tops = {start: (0, "", _STACKS[start])}
    for row in rows:
        tops = _after(tops, *row)
    return {state: (cost, audit) for state, (cost, audit, _) in tops.items()}


@functools.lru_cache(maxsize=1)
def _ends() -> dict[str, tuple[int, str]]:
    """From every state the cheapest insertions that complete a conversation."""
    ends = {}
    for start, stack in _STACKS.items():
        tops = _inserted({start: (0, "", stack)})
        ends[start] = min(tops[state][:2] for state in _ACCEPTING if state in tops)
    return ends


def expanded(start: str, edits: str, rows: list[tuple[int, str, int]]):
    """Repaired rows ``(edit, role or None, row number or None)`` of a part; a kept role is None.

    ``rows`` are (number, initial, copies); the copies after the first are deleted.
    """
    stack, at, left = _STACKS[start], 0, rows[0][2] if rows else 0
    for edit in edits:
        if edit != "I":
            number, initial, copies = rows[at]
            first = left == copies
            left -= 1
            if not left:
                at += 1
                left = rows[at][2] if at < len(rows) else 0
            if edit == "D":
                continue
            assert first, "only the first of equal rows can stay"
        if edit == "K":
            stack = shifted(stack, initial)
            yield edit, None, number
        else:
            symbol = "a" if stack.state == "u" else "u"
            stack = shifted(stack, symbol)
            yield edit, ROLES[symbol], None if edit == "I" else number


def classified(turns: DataFrame, folder: str) -> DataFrame:
    """The different rows of each conversation in order: ``at``, ``copies``, ``initial`` and ``fault``.

    ``fault`` is that of the first copy; the others are blank as well, or duplicates.
    """
    filled = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    keys = ["conv_id", "turn", "role", "text"]
    counted = stored(filled.groupBy(*keys).agg(F.count("*").alias("n")), f"{folder}/different")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = counted.groupBy("conv_id", F.unhex(said).alias("said")).agg(F.min(place).alias("first"))
    same = F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("c.said") == F.col("f.said"))
    # the first place of everything said is stored, so that the join can split a long conversation
    first = stored(first, f"{folder}/first")
    joined = counted.withColumn("said", F.unhex(said)).alias("c").join(first.alias("f"), same)
    ended = F.rtrim("c.text", F.lit(BLANKS))
    fault = (
        F.when(ended == "", "blank")
        .when(~place.eqNullSafe(F.col("first")), "duplicate")
        .when(~F.substring(ended, -1, 1).isin(".", "!", "?"), "truncated")
    )
    # more copies than a block has rows are several rows
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long")))
    rows = joined.select(*(f"c.{k}" for k in keys), "n", fault.alias("fault"), chunk.alias("chunk"))
    rows = rows.select(
        *keys,
        F.when((F.col("chunk") > 0) & F.coalesce(F.col("fault") != "blank", F.lit(True)), "duplicate")
        .otherwise(F.col("fault"))
        .alias("fault"),
        F.least(F.lit(BLOCK), F.col("n") - F.col("chunk")).cast("int").alias("copies"),
        F.substring("role", 1, 1).alias("initial"),
        "chunk",
    )
    # beginnings of texts are enough to deal rows out
    ranges = ["conv_id", "turn", "role", F.substring("text", 1, 100), "chunk"]
    return in_order(rows, [*keys, "chunk"], f"{folder}/rows", ranges)


_TABLE = (
    "conv_id long, block long, first string, last string, illegal long, "
    "table array<struct<start:string,stop:string,cost:long,audit:string>>"
)
_CHOSEN = "conv_id long, block long, start string, stop string, ends boolean, across long"


def _parts(table: pa.Table):
    """The parts of conversations in a block: id and (number, initial, copies, fault) in order."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("at", "conv_id", "initial", "copies", "fault")), strict=True))
    part: list[tuple] = []
    conv_id = None
    for at, conv, initial, copies, fault in rows:
        if part and conv != conv_id:
            yield conv_id, part
            part = []
        conv_id = conv
        part.append((at, initial, copies, fault))
    if part:
        yield conv_id, part


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _tables(narrow: DataFrame) -> DataFrame:
    """For every part of a conversation in a block: the best way from each state to each other."""

    def parse(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        out = []
        for conv_id, part in _parts(table):
            rows = []
            for _, initial, copies, fault in part:
                rows.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
                rows += [(initial, True, False)] * (copies - 1)
            ways = [
                {"start": start, "stop": stop, "cost": cost, "audit": audit}
                for start in _STACKS
                for stop, (cost, audit) in parsed(rows, start).items()
            ]
            illegal = sum(not _legal(a[0], b[0]) for a, b in zip(rows, rows[1:], strict=False))
            out.append((conv_id, block, rows[0][0], rows[-1][0], illegal, ways))
        return _arrow(out, _TABLE_ARROW)

    return shipped(narrow).groupBy("block").applyInArrow(parse, _TABLE)


def _chosen(tables: DataFrame) -> DataFrame:
    """For every part the states between which the best repair of its conversation passes.

    The tables of a conversation are read in order, as a stream; of each part only the best
    predecessor of every state is remembered until the conversation ends.
    """

    def follow(batches):
        conv_id, tops, parts = None, None, []

        def finished():
            ends = _ends()
            state = min(tops, key=lambda s: (tops[s][0] + ends[s][0], tops[s][1] + ends[s][1]))
            out = []
            for i in range(len(parts) - 1, -1, -1):
                block, before, across = parts[i]
                out.append((conv_id, block, before[state], state, i == len(parts) - 1, across))
                state = before[state]
            return _batch(out, _CHOSEN_ARROW)

        last = ""
        for batch in batches:
            for row in batch.to_pylist():
                if tops is None or row["conv_id"] != conv_id:
                    if tops is not None:
                        yield finished()
                    conv_id, tops, parts, last = row["conv_id"], {"0": (0, "")}, [], None
                best: dict = {}
                for way in row["table"]:
                    if way["start"] in tops:
                        cost, audit = tops[way["start"]]
                        offer = (cost + way["cost"], audit + way["audit"], way["start"])
                        if way["stop"] not in best or offer < best[way["stop"]]:
                            best[way["stop"]] = offer
                tops = {stop: (cost, audit) for stop, (cost, audit, _) in best.items()}
                across = int(last is not None and not _legal(last, row["first"]))
                parts.append((row["block"], {stop: start for stop, (_, _, start) in best.items()}, across))
                last = row["last"]
        if tops is not None:
            yield finished()

    # parts that are not needed to be kept together are a few numbers and audits
    ordered = tables.select("conv_id", "block", "first", "last", "table")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return map_arrow(ordered, follow, _CHOSEN)


_WAY = pa.struct([("start", pa.string()), ("stop", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_TABLE_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("first", pa.string()), ("last", pa.string()),
        ("illegal", pa.int64()), ("table", pa.list_(_WAY)),
    ]
)
_CHOSEN_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("start", pa.string()), ("stop", pa.string()),
        ("ends", pa.bool_()), ("across", pa.int64()),
    ]
)
_ROWS = "conv_id long, place long, edit string, role string, at long"
_ROWS_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("at", pa.int64())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


def _expanded_rows(narrow: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows of every block, without texts."""

    def expand(rows: pa.Table, chosen: pa.Table) -> pa.Table:
        edits_of = {r["conv_id"]: (r["start"], r["edits"]) for r in chosen.to_pylist()}
        out, n = [], 0
        for conv_id, part in _parts(rows):
            start, edits = edits_of[conv_id]
            for edit, role, at in expanded(start, edits, [p[:3] for p in part]):
                out.append((conv_id, (part[0][0] >> BLOCK_BITS << _PLACE_BITS) + n, edit, role, at))
                n += 1
        return _arrow(out, _ROWS_ARROW)

    return shipped(narrow).groupBy("block").cogroup(edits.groupBy("block")).applyInArrow(expand, _ROWS)


def repaired(turns: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Findings per conversation, and the repaired rows.

    The first has ``conv_id``, ``gaps`` (turn numbers missing between the first and the last),
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose initials are not su,
    ua or au), ``cost`` and ``audit``; the second ``conv_id``, ``place`` (ascending within a conversation),
    ``edit`` (K, R or I), ``role`` and ``text``.
    """
    rows = classified(turns, folder)
    block = F.shiftright("at", BLOCK_BITS).alias("block")
    narrow = rows.select("at", block, "conv_id", "initial", "copies", "fault")
    tables = stored(_tables(narrow), f"{folder}/tables")
    chosen = stored(_chosen(tables), f"{folder}/chosen")

    same = F.col("c.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("c.block") == F.col("t.block"))
    way = F.get(
        F.filter("table", lambda w: (w["start"] == F.col("c.start")) & (w["stop"] == F.col("c.stop"))), F.lit(0)
    )
    end = F.create_map(*[F.lit(x) for state, (_, audit) in _ends().items() for x in (state, audit)])
    end = F.when(F.col("ends"), end[F.col("c.stop")]).otherwise("")
    pieces = chosen.alias("c").join(tables.alias("t"), same).select(
        "c.conv_id",
        "c.block",
        "c.start",
        (way["cost"] + F.length(end) * INSERT).alias("cost"),
        F.concat(way["audit"], end).alias("edits"),
        (F.col("illegal") + F.col("across")).alias("illegal"),
    )
    pieces = stored(pieces, f"{folder}/pieces")

    parts = F.array_sort(F.collect_list(F.struct("block", "edits")))
    edits = pieces.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(parts, lambda p: p["edits"]), "").alias("audit"),
    )
    copies = F.col("copies").cast("long")
    is_blank = F.col("fault") == "blank"
    n = lambda fault: F.coalesce(F.sum(F.when(fault, 1)), F.lit(0)).cast("long")
    per_turn = rows.groupBy("conv_id", "turn").agg(
        F.coalesce(F.sum(F.when(is_blank, copies)), F.lit(0)).alias("blank"),
        (
            F.coalesce(F.sum(F.when(~F.coalesce(is_blank, F.lit(False)), copies - 1)), F.lit(0))
            + n(F.col("fault") == "duplicate")
        ).alias("duplicate"),
        n(F.col("fault") == "truncated").alias("truncated"),
    )
    faults = per_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
    )
    found = faults.alias("f").join(edits.alias("e"), F.col("f.conv_id").eqNullSafe(F.col("e.conv_id")))
    found = found.select("f.*", "e.illegal", "e.cost", "e.audit")

    plan = _expanded_rows(narrow, pieces.select("conv_id", "block", "start", "edits"))
    texts = rows.select(F.col("at").alias("row"), F.col("role").alias("said_by"), "text")
    left = plan.join(texts, F.col("at") == F.col("row"), "left").select(
        "conv_id",
        "place",
        "edit",
        F.coalesce("role", "said_by").alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"),
    )
    return found, left


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id`` and the SHA-256 of its repaired rows as lines ``role:text``.

    A hash can only be taken in order, so the rows of a conversation pass through one task, as a
    sorted stream of which nothing is held.
    """

    def hashed(batches):
        import hashlib

        conv_id, state = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or conv != conv_id:
                    if state is not None:
                        done.append((conv_id, state.hexdigest()))
                    conv_id, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n")
                    state.update(line.encode())
            yield _batch(done, _DIGEST_ARROW)
        if state is not None:
            yield _batch([(conv_id, state.hexdigest())], _DIGEST_ARROW)

    lines = rows.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "line")
    return map_arrow(ordered, hashed, "conv_id long, repaired_sha256 string")


_DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def damaged(turns: DataFrame) -> DataFrame:
    """The damage that the query repairs, by the checksum of conversation and turn.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 takes the ends of sentences
    out of it, 3 repeats it and 4 makes the user say it.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", ""))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(filled("role")).alias("role"),
        text.otherwise(filled("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")
