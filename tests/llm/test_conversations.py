import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beaconlake.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, conv string, kind int, part int, copies long"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, lines) of the best repair, by keeping the least (cost, audit) for each pattern state; rows are (role, text, fault)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    word = {"u": "user", "a": "assistant"}

    def inserted(states):
        todo = list(states.items())
        while todo:
            state, (cost, audit, lines) = todo.pop()
            new = (cost + 2, audit + "I", [*lines, word[after[state]] + ":"])
            if after[state] not in states or new[:2] < states[after[state]][:2]:
                states[after[state]] = new
                todo.append((after[state], new))
        return states

    states = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        found = {}

        def offer(state, *way):
            if state not in found or way[:2] < found[state][:2]:
                found[state] = way

        for state, (cost, audit, lines) in states.items():
            offer(state, cost + 3, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                offer(after[state], cost + 2 + cut, audit + "R", [*lines, f"{word[after[state]]}:{text}"])
                if role[:1] == after[state] or (role[:1] == "s" and state == ""):
                    offer(role[:1], cost + cut, audit + "K", [*lines, f"{role}:{text}"])
        states = inserted(found)
    return min(states[s] for s in ("", "a") if s in states)


def plain(rows):
    out, names = [], dict.fromkeys(r[0] for r in rows)
    for conv in names:
        mine = []
        for c, turn, role, text, *_ in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            mine += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faulty = set(), []
        for _, role, text in mine:
            kept = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        initials = [r[:1] for r, _, _ in faulty]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(faulty)
        faults = [f for _, _, f in faulty]
        out.append((conv, min(gaps, 2**63 - 1), faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(codes):
    role, fault = ("system", "user", "assistant", "tool"), ("", "truncated", "duplicate", "blank")
    return [(role[c % 4], "x", fault[c // 4]) for c in codes]


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=14).map(lambda b: bytes(c % 16 for c in b)), st.integers(1, 5))
def test_blocks_of_auctions_give_the_least_of_the_cheapest_repairs(codes, size):
    blocks = [codes[i : i + size] for i in range(0, len(codes), size)]
    exits = [cv.END]
    for block in reversed(blocks):
        table = cv.costs(block)
        exits.append(tuple(min(table[4 * s + e] + exits[-1][e] for e in range(4)) for s in range(4)))
    state, audit = 0, ""
    for block, prices in zip(blocks, exits[-2::-1]):
        _, piece, state = cv.traces(block, prices, (0, 1, 2, 3))[state]
        audit += piece
    assert (exits[-1][0], audit + cv.ENDING[state]) == cheapest(rows_of(codes))[:2]


def test_prices_converge_to_distances_and_arcs_of_the_path_are_tight():
    codes = bytes([1, 1, 2, 3, 8, 1, 5, 2, 2, 0])
    auction = cv.Auction(codes, cv.END)
    cost, letters, _ = auction.run(0)
    assert cost == auction.prices[0][0] == cheapest(rows_of(codes))[0]
    at, state, prices = 0, 0, [*auction.prices[:-1], list(cv.END)]
    for letter in letters:
        options = [(prices[at + step][after] + price, name, step, after) for name, step, after, price in cv.ARCS[codes[at]][state]]
        assert prices[at][state] == min(options)[0]
        _, name, step, after = min(options)
        assert name == letter
        at, state = at + step, after


def odd_rows():
    draw = random.Random(3)
    texts = ["Fine.", "Cut", "", " \t\n", None, "Same text!", "Why? \n", "é.", "a.b", "."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
    rows = [(c, t, draw.choice(roles), draw.choice(texts), "x", 1, 2, 3) for c in range(40) for t in range(draw.randrange(12))]
    rows += [(50, None, draw.choice(roles), draw.choice(texts), None, None, None, None) for _ in range(30)]
    rows += [(None, t, "user", "Text.", None, 1, 1, 1) for t in (None, None, 3, 3, 9)]
    rows += [(60, t, ("user", "assistant")[t % 2], f"Turn {t % 37}.", "x", 1, 1, 1) for t in range(400)]
    rows += [(61, 5, "user", "Same.", "x", 1, 1, 1)] * 150 + [(62, -(2**63), "user", "a." * 40000, "", 0, 0, 0), (62, 2**63 - 1, "assistant", "b.", "", 0, 0, 0)]
    rows += [(63, 7, r, t, "x", 1, 1, 1) for r in ("user", "assistant") for t in ("One.", "Two.", "Three", "One.")]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Gone.", "x", 1, 1, 1), (None,) * 8]


def test_odd_conversations(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(cv.repaired(df)) == plain(rows)


@pytest.mark.parametrize("size", [1, 3])
def test_conversations_cut_into_blocks_over_many_tasks(spark, size, monkeypatch):
    monkeypatch.setattr(cv, "BLOCK", size)
    monkeypatch.setattr(cv, "FLUSH", 2)
    rows = odd_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(cv.repaired(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_conversations(spark, data):
    df = spark.read.parquet(f"{data}/conversations.parquet")
    assert found(cv.repaired(df)) == plain([tuple(r) for r in df.collect()])


def test_no_rows(spark):
    assert cv.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
