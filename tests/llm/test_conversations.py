"""Conversation repair against a search through all edits; edge cases."""

import hashlib
import heapq
import itertools
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from widerow.llm import conversations  # noqa: E402
from widerow.llm.conversations import STACKS, TABLES, repair  # noqa: E402
from widerow.llm.queries import queries  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"
SF_DIR = "/root/testdata/sf0.001"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
NAMES = {"u": "user", "a": "assistant"}


def judged(rows):
    """Faults of sorted (turn, role, text) rows, and the numbers of the result."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = VISIBLE.findall(text)
        if not shown:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if shown[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return faults, (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal)


def cheapest(rows, faults):
    """Dijkstra over (cost, audit, rows used, word so far as a state of the pattern)."""
    # States of (s?(ua)+)?: 0 start, 1 after s, 2 after u, 3 after a.
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, "\n".join(lines)
        if (i, state) in done:
            continue
        done.add((i, state))
        moves = [(5, "I", i, symbol, f"{name}:") for symbol, name in NAMES.items()]
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                moves.append((more, "K", i + 1, role[:1], f"{role}:{text}"))
                moves += [(1 + more, "R", i + 1, s, f"{name}:{text}") for s, name in NAMES.items()]
        for price, letter, at, symbol, line in moves:
            if (state, symbol) in step:
                heapq.heappush(
                    heap, (cost + price, audit + letter, at, step[state, symbol], (*lines, line))
                )
    raise AssertionError


def expected(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, numbers = judged(own)
        out.append((conv, *numbers, *cheapest(own, faults)))
    return sorted(out, key=str)


def got(spark, rows, partitions=8):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sorted(map(tuple, repair(df).collect()), key=str)


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["", " \t", "Yes.", "No!", "Why?  ", "cut", "a b, c", "Yes.", "Done.", "So."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "usr"]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(longest)):
            at = rng.choice([turn, turn, turn, None, turn + 5])
            text = rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.random()}."
            role = roles[1 + turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows += [(conv, at, role, text)] * (3 if rng.random() < 0.1 else 1)
    return rows


def test_stacks_of_the_grammar():
    assert len(STACKS) == 6 and len({s[-1] for s in STACKS}) == 6
    for n in range(7):
        for word in itertools.product("sua", repeat=n):
            stack = (0,)
            for c in word:
                stack = stack and TABLES.shifted(stack, c)
            fits = re.fullmatch("(s?(ua)+)?", "".join(word)) is not None
            assert fits == bool(stack and stack[-1] in TABLES.ends)


@pytest.mark.parametrize("run", [2, 1024])
def test_repair_matches_search(spark, monkeypatch, run):
    monkeypatch.setattr(conversations, "RUN", run)
    rows = random_rows(run, 150, 9)
    assert got(spark, rows) == expected(rows)


def test_a_long_conversation_is_split(spark, monkeypatch):
    monkeypatch.setattr(conversations, "RUN", 16)
    monkeypatch.setattr(conversations, "RUN_CHARS", 300)
    rows = random_rows(7, 3, 6) + [(99, *r[1:]) for r in random_rows(8, 1, 2000)]
    rows += [(99, i, "user", f"Q{i}?") for i in range(700)]
    assert got(spark, rows) == expected(rows)


def test_edges(spark):
    rows = [
        (None, None, None, None), (None, None, "user", "Hi."), (None, None, "assistant", "Ho."),
        (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "x" * 300_000 + "."),
        (2, None, "system", "S."), (2, 7, None, "Q?"), (3, 0, "assistant", " "), (4, 0, "user", ""),
    ]
    assert got(spark, rows) == expected(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    clash = "conv run task n fault content first last paths audit cost blank".split()
    more = df.select("*", *(F.lit("clash").alias(c) for c in clash))
    assert sorted(map(str, repair(more).collect())) == sorted(map(str, repair(df).collect()))
    assert repair(df.limit(0)).collect() == []


def test_query_matches_search(spark):
    source = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_DIR}/conversations.parquet'")
    rows = []
    everything = source.fetchall()
    for conv, turn, role, text in everything:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = {r[0]: r[1:] for r in expected(rows)}
    result = queries()["op12_conversation_structure_repair"](spark, SF_DIR)
    names = "gaps blank duplicate truncated illegal cost audit".split()
    assert result.count() == len({r[0] for r in everything})
    for r in result.collect():
        *numbers, lines = found.get(r["conv_id"], (0, 0, 0, 0, 0, 0, "", ""))
        assert [r[c] for c in names] == numbers
        assert r["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
