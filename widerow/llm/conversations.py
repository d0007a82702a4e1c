"""Conversation structure repair: generalised LR parsing with weighted edits.

The roles of a conversation should be a word of the grammar ``RULES``: perhaps a system
turn, then pairs of user and assistant; or nothing. Rows are parsed in order of turn (nulls
first, then role, then text). A row is kept (cost 0), given the role user or assistant (1)
or deleted (2), and an empty turn of user or assistant may be inserted anywhere (5). Rows
that are blank, or repeat an earlier row's role and text, must be deleted; one whose text
doesn't end as a sentence costs 5 more unless deleted. The repair is the cheapest; of
equally cheap ones that whose audit (K, R, D, I in order) is least as ASCII text.

The parser is a graph-structured stack over LR(0) tables made from the rules. All stacks
with the same top after the same rows are one node, which keeps the least (cost, audit).
That loses nothing: the grammar's stacks with equal tops are equal; and of equally cheap
audits over the same rows none is a prefix of another, as it would differ by insertions,
which cost, so what follows can't change their order.

No conversation has to fit one task. Rows are range-partitioned by conversation and turn;
a task walks its sorted rows and parses runs of at most ``RUN`` rows of a conversation
(fewer if their texts are long). A run with the whole conversation is finished there. Others are parsed once from each stack
that may lie below, which gives, for each stack before and after, the least (cost, audit).
Those are joined in order per conversation, without texts, and the runs' rows are then
edited by the audit chosen for them. Equal rows are counted first and travel as one. Only
the result's ``audit`` and ``repaired`` hold a whole conversation.

Null ids are one conversation. A role's initial is its first character; other roles than
the three are possible in rows, but don't fit the grammar. Null roles and texts count as
one space. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import group_key, small, stored

# Symbols: start, turns; s, u, a are the initials of roles.
RULES = [("S", ""), ("S", "T"), ("T", "ua"), ("T", "sua"), ("T", "Tua")]
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
KEEP_IT, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # a row's first fault
RUN, RUN_CHARS = 1024, 1 << 22  # rows of a run; characters after which it ends

Stack = tuple[int, ...]
Best = tuple[int, str]  # cost, audit


class Tables:
    """LR(0) tables: ``goto`` by state and symbol, the rule that a state reduces by, and
    the states that may end the input."""

    def __init__(self, rules: list[tuple[str, str]], start: str) -> None:
        inner = {left for left, _ in rules}

        def closed(items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            found = set(items)
            while True:
                wanted = {rules[r][1][at] for r, at in found if at < len(rules[r][1])} & inner
                more = {(r, 0) for r, (left, _) in enumerate(rules) if left in wanted} - found
                if not more:
                    return frozenset(found)
                found |= more

        first = closed({(r, 0) for r, (left, _) in enumerate(rules) if left == start})
        states, self.goto = [first], {}
        for n, state in enumerate(states):
            for symbol in sorted({rules[r][1][at] for r, at in state if at < len(rules[r][1])}):
                moved = closed(
                    {(r, at + 1) for r, at in state if rules[r][1][at : at + 1] == symbol}
                )
                if moved not in states:
                    states.append(moved)
                self.goto[n, symbol] = states.index(moved)
        self.ends, self.reduces = set(), {}
        for n, state in enumerate(states):
            for r, at in state:
                left, right = rules[r]
                if at == len(right) and left == start:
                    self.ends.add(n)
                elif at == len(right):
                    self.reduces[n] = (left, len(right))

    def shifted(self, stack: Stack, symbol: str) -> Stack | None:
        """The stack after a symbol and all reductions, if it may follow."""
        to = self.goto.get((stack[-1], symbol))
        if to is None:
            return None
        stack = (*stack, to)
        while stack[-1] in self.reduces:
            left, size = self.reduces[stack[-1]]
            stack = stack[: len(stack) - size]
            stack = (*stack, self.goto[stack[-1], left])
        return stack

    def stacks(self, symbols: str) -> list[Stack]:
        """All stacks that words lead to; the grammar has few."""
        found = [(0,)]
        for stack in found:
            for symbol in symbols:
                to = self.shifted(stack, symbol)
                if to is not None and to not in found:
                    found.append(to)
        return found


TABLES = Tables(RULES, "S")
STACKS = TABLES.stacks("sua")
_NUMBER = {stack: k for k, stack in enumerate(STACKS)}
# The graph's edges: the number of the stack that a symbol leads to.
_NEXT = [
    {c: _NUMBER[to] for c in "sua" if (to := TABLES.shifted(stack, c)) is not None}
    for stack in STACKS
]
_ENDS = {k for k, stack in enumerate(STACKS) if stack[-1] in TABLES.ends}
Row = tuple[str, int, int]  # initial, fault, number of equal rows


def _offer(tops: dict[int, Best], top: int, best: Best) -> bool:
    if top in tops and tops[top] <= best:
        return False
    tops[top] = best
    return True


def _inserted(tops: dict[int, Best]) -> None:
    open_ = list(tops)
    while open_:
        top = open_.pop()
        cost, audit = tops[top]
        for symbol in ROLES:
            to = _NEXT[top].get(symbol)
            if to is not None and _offer(tops, to, (cost + INSERT, audit + "I")):
                open_.append(to)


def parsed(rows: list[Row], top: int) -> dict[int, Best]:
    """The least (cost, audit) of each stack top after the rows, from one before them.
    Insertions after the last row belong to what follows."""
    tops: dict[int, Best] = {top: (0, "")}
    for initial, fault, n in rows:
        _inserted(tops)
        after: dict[int, Best] = {}
        again = n - 1 if fault in (KEEP_IT, CUT) else n  # equal rows after the first
        dropped, copies = DELETE * again, "D" * again
        extra = TRUNCATED if fault == CUT else 0
        for at, (cost, audit) in tops.items():
            if again == n:
                _offer(after, at, (cost + dropped, audit + copies))
                continue
            _offer(after, at, (cost + DELETE + dropped, audit + "D" + copies))
            kept = cost + extra + dropped
            to = _NEXT[at].get(initial)
            if to is not None:
                _offer(after, to, (kept, audit + "K" + copies))
            for symbol in ROLES:
                to = _NEXT[at].get(symbol)
                if to is not None:
                    _offer(after, to, (kept + REROLE, audit + "R" + copies))
        tops = after
    return tops


def ended(tops: dict[int, Best]) -> tuple[int, Best]:
    """The last stack and the least (cost, audit) that ends a conversation."""
    tops = dict(tops)
    _inserted(tops)
    best, end = min((tops[k], k) for k in tops if k in _ENDS)
    return end, best


def edited(rows: list[tuple[str, str, int]], audit: str, top: int) -> list[str]:
    """The lines ``role:text`` that an audit makes of rows (role, text, number of equal
    ones), from the stack top before them."""
    # The grammar allows one symbol beside s at each stack, so the role is settled.
    lines, edits = [], iter(audit)
    symbol = next((c for c in ROLES if c in _NEXT[top]), "u")

    def put(role: str, text: str) -> None:
        nonlocal symbol
        lines.append(f"{role}:{text}")
        symbol = "u" if role[:1] in ("s", "a") else "a"

    for role, text, n in rows:
        for _ in range(n):
            edit = next(edits)
            while edit == "I":
                put(ROLES[symbol], "")
                edit = next(edits)
            if edit == "K":
                put(role, text)
            elif edit == "R":
                put(ROLES[symbol], text)
    for _ in edits:
        put(ROLES[symbol], "")
    return lines


_PATHS = T.ArrayType(
    T.StructType(
        [
            T.StructField("before", T.IntegerType()),
            T.StructField("after", T.IntegerType()),
            T.StructField("cost", T.LongType()),
            T.StructField("audit", T.StringType()),
        ]
    )
)
_ROWS = T.ArrayType(
    T.StructType(
        [
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("n", T.LongType()),
        ]
    )
)
# A run of rows of a conversation. ``whole``: it is all of it, and paths hold the repair.
_RUN = T.StructType(
    [
        T.StructField("conv", T.StringType()),
        T.StructField("task", T.IntegerType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("blank", T.LongType()),
        T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("paths", _PATHS),
        T.StructField("rows", _ROWS),
        T.StructField("repaired", T.StringType()),
    ]
)
_PAIRS = {"su", "ua", "au"}


def _run(conv: str, at: tuple[int, int], rows: list[tuple], whole: bool) -> dict:
    """A run's record. Rows: role, text, fault of the first of n equal rows, n."""
    initials = [r[0][:1] for r in rows]
    faults = [0, 0, 0, 0]
    for _, _, fault, n in rows:
        faults[fault] += 1
        faults[BLANK if fault == BLANK else DUPLICATE] += n - 1
    illegal = sum(
        (n - 1) * (c + c not in _PAIRS) for c, (_, _, _, n) in zip(initials, rows)
    ) + sum(x + y not in _PAIRS for x, y in zip(initials, initials[1:]))
    out = {
        "conv": conv, "task": at[0], "run": at[1], "whole": whole,
        "blank": faults[BLANK], "duplicate": faults[DUPLICATE], "truncated": faults[CUT],
        "illegal": illegal, "first": initials[0], "last": initials[-1],
    }
    slim = [(c, fault, n) for c, (_, _, fault, n) in zip(initials, rows)]
    plain = [(role, text, n) for role, text, _, n in rows]
    if whole:
        end, (cost, audit) = ended(parsed(slim, 0))
        out["paths"] = [{"before": 0, "after": end, "cost": cost, "audit": audit}]
        out["repaired"] = "\n".join(edited(plain, audit, 0))
    else:
        out["paths"] = [
            {"before": k, "after": to, "cost": cost, "audit": audit}
            for k in range(len(STACKS))
            for to, (cost, audit) in parsed(slim, k).items()
        ]
        out["rows"] = [{"role": r, "text": t, "n": n} for r, t, n in plain]
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, task, role, text, fault, n) as runs. The first and the last
    conversation of a task may go on in another, so they aren't whole."""
    kinds = to_arrow_schema(_RUN)
    out: list[dict] = []
    conv, task, run, held, first = None, 0, 0, [], True
    size = waiting = 0  # characters in held, in out

    def flush(last: bool, ends: bool) -> None:
        nonlocal held, run, size, waiting
        if held:
            whole = ends and run == 0 and not first and not last
            out.append(_run(conv, (task, run), held, whole))
            run += 1
        waiting += size
        held, size = [], 0

    for batch in batches:
        names = ("conv", "task", "role", "text", "fault", "n")
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if row[0] != conv:
                flush(False, True)
                first = conv is None
                conv, task, run = row[0], row[1], 0
            elif len(held) == RUN or size > RUN_CHARS:
                flush(False, False)
            held.append(row[2:])
            size += len(row[3])
            if len(out) >= 256 or waiting > RUN_CHARS:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out, waiting = [], 0
    flush(True, True)
    if out:
        yield pa.RecordBatch.from_pylist(out, kinds)


def _joined(group: pa.Table) -> pa.Table:
    """The repair of one conversation from its runs' paths: a row per run with the stack
    before it and its audit, and the whole cost."""
    runs = sorted(group.to_pylist(), key=lambda r: (r["task"], r["run"]))
    tops: dict[int, Best] = {0: (0, "")}
    back = []  # of each run: by the stack after it, the stack before and the audit within
    for r in runs:
        after: dict[int, Best] = {}
        via: dict[int, tuple[int, str]] = {}
        for p in r["paths"]:
            if p["before"] in tops:
                cost, audit = tops[p["before"]]
                if _offer(after, p["after"], (cost + p["cost"], audit + p["audit"])):
                    via[p["after"]] = (p["before"], p["audit"])
        tops = after
        back.append(via)
    cost, audit = ended(tops)[1]
    # Insertions at the end belong to the last run.
    top = min(tops, key=lambda k: ended({k: tops[k]})[1])
    rest = audit[len(tops[top][1]) :]
    out = []
    for r, via in zip(reversed(runs), reversed(back)):
        before, part = via[top]
        out.append(
            {"conv": r["conv"], "task": r["task"], "run": r["run"], "before": before,
             "part": part + rest, "cost": cost}
        )
        top, rest = before, ""
    return pa.Table.from_pylist(
        out,
        pa.schema([("conv", pa.string()), ("task", pa.int32()), ("run", pa.int32()),
                   ("before", pa.int32()), ("part", pa.string()), ("cost", pa.int64())]),
    )


def _edited(rows: pa.Array, parts: pa.Array, before: pa.Array) -> pa.Array:
    out = []
    for run, part, top in zip(rows.to_pylist(), parts.to_pylist(), before.to_pylist()):
        plain = [(r["role"], r["text"], r["n"]) for r in run]
        out.append(edited(plain, part, top))
    return pa.array(out, pa.list_(pa.string()))


def _fault(text: Column) -> Column:
    """Blank and cut texts; a text's last visible character tells."""
    visible = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return (
        F.when(visible == "", BLANK).when(~visible.isin(".", "!", "?"), CUT).otherwise(KEEP_IT)
    )


def repair(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row a conversation: its id, ``gaps`` (turns missing between the least and the
    greatest), numbers of ``blank``, ``duplicate`` and ``truncated`` rows, ``illegal``
    (neighbours that don't fit), ``cost`` and ``audit`` of the repair, and ``repaired``,
    the lines role:text."""
    rows = (
        turns.select(
            group_key(conv).alias("conv"),
            F.col(conv).alias("conv_id"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        )
        .groupBy("conv", "turn", "role", "text")
        .agg(F.first("conv_id").alias("conv_id"), F.count("*").alias("n"))
        .withColumn("content", F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text")))
        .withColumn("fault", _fault(F.col("text")))
    )
    rows = stored(rows)
    seen = (
        rows.groupBy("conv", "content")
        .agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("places"))
        .filter(F.col("places") > 1)
        .drop("places")
    )
    later = F.struct("turn") > F.col("earliest")
    repeats = F.coalesce(later, F.lit(False)) & (F.col("fault") != BLANK)
    judged = rows.join(small(seen), ["conv", "content"], "left").select(
        "conv", "turn", "role", "text", "n",
        F.when(repeats, DUPLICATE).otherwise(F.col("fault")).alias("fault"),
    )
    runs = stored(
        # A range ends at a place in the order, so the start of the text will do there.
        judged.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64))
        .sortWithinPartitions("conv", "turn", "role", "text")
        .select("conv", F.spark_partition_id().alias("task"), "role", "text", "fault", "n")
        .mapInArrow(_runs, _RUN)
    )
    names = ["blank", "duplicate", "truncated", "illegal"]
    path = F.col("paths")[0]
    whole = runs.filter("whole").select(
        "conv", *names, path["cost"].alias("cost"), path["audit"].alias("audit"), "repaired"
    )
    spans = rows.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"),
        (F.max("turn") - F.min("turn") + 1).alias("span"),
        F.count_distinct("turn").alias("turns"),
    )
    found = spans.join(whole.unionByName(_spread(runs.filter(~F.col("whole")), names)), "conv")
    return found.select(
        F.col("conv_id").alias(conv),
        F.coalesce(F.col("span") - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        *names,
        "cost",
        "audit",
        "repaired",
    )


def _spread(runs: DataFrame, names: list[str]) -> DataFrame:
    """Conversations of several runs."""
    chosen = runs.select("conv", "task", "run", "paths").groupBy("conv").applyInArrow(
        _joined, "conv string, task int, run int, before int, part string, cost long"
    )
    lines = F.arrow_udf(_edited, T.ArrayType(T.StringType()))
    done = runs.drop("paths").join(chosen, ["conv", "task", "run"]).select(
        "conv", "task", "run", *names, "first", "last", "cost", "part",
        lines("rows", "part", "before").alias("lines"),
    )
    by_place = F.sort_array(
        F.collect_list(F.struct("task", "run", "first", "last", "part", "lines"))
    )
    seams = F.transform(
        F.sequence(F.lit(1), F.size("all") - 1),
        lambda i: F.concat(F.col("all")[i - 1]["last"], F.col("all")[i]["first"]),
    )
    illegal = F.when(
        F.size("all") > 1, F.size(F.filter(seams, lambda pair: ~pair.isin(*sorted(_PAIRS))))
    ).otherwise(0)
    return (
        done.groupBy("conv")
        .agg(
            *(F.sum(c).cast("long").alias(c) for c in names),
            F.first("cost").alias("cost"),
            by_place.alias("all"),
        )
        .select(
            "conv",
            *names[:3],
            (F.col("illegal") + illegal).cast("long").alias("illegal"),
            "cost",
            F.array_join(F.col("all.part"), "").alias("audit"),
            F.array_join(F.flatten("all.lines"), "\n").alias("repaired"),
        )
    )
