"""Conversation repair: against all lists of edits, and against a plain program on damaged rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from statlake.llm import repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")
SHAPE = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        letters = BLANK.findall(text)
        faults.append("blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """Cheapest edits, kept as text for each last role of the turns so far."""
    def offer(to, last, role, found):
        if (last + role[:1] in ("su", "ua", "au") if last else role[:1] in ("s", "u")) and (role[:1] not in to or found[:2] < to[role[:1]][:2]):
            to[role[:1]] = found

    def widen(to):
        for _ in range(3):
            for last, (cost, edits, turns) in list(to.items()):
                for name in ("user", "assistant"):
                    offer(to, last, name, (cost + 3, edits + "I", turns + ((name, ""),)))
        return to

    best = widen({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults):
        after = {last: (cost + 4, edits + "D", turns) for last, (cost, edits, turns) in best.items()}
        for last, (cost, edits, turns) in best.items():
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role:
                    offer(after, last, role, (cost + extra, edits + "K", turns + ((role, text),)))
                for name in ("user", "assistant"):
                    offer(after, last, name, (cost + 3 + extra, edits + "R", turns + ((name, text),)))
        best = widen(after)
    return min((best[last] for last in ("", "a") if last in best), key=lambda v: v[:2])


def plain_results(rows):
    damaged = plain_damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in damaged if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()))
        pairs = [(r[2], r[3]) for r in own]
        faults = plain_faults(pairs)
        turns = [r[1] for r in own if r[1] is not None]
        cost, edits, kept = plain_repair(pairs, faults)
        count = Counter(faults)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"],
                    count["truncated"], illegal, cost, edits, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_the_plain_program_finds_the_least_of_all_lists():
    """Every list of edits of up to four rows with up to five insertions."""
    for roles in itertools.product(("user", "assistant", "system", "bot"), repeat=3):
        rows = [(r, f"text {i % 2}.") for i, r in enumerate(roles)]
        faults = ["truncated" if i == 1 and roles[0] == "bot" else "" for i in range(3)]
        found = []
        for edits in itertools.product("DKR", repeat=3):
            for gaps in itertools.product(range(3), repeat=4):
                text = "".join("I" * n + e for n, e in zip(gaps, edits)) + "I" * gaps[-1]
                state, at, cost = "", 0, 0
                for e in text:
                    if e == "D":
                        cost, at = cost + 4, at + 1
                        continue
                    needed = "a" if state[-1:] == "u" else "u"
                    if e == "K":
                        state += rows[at][0][0]
                    else:
                        state, cost = state + needed, cost + 3
                    if e != "I":
                        cost, at = cost + (3 if faults[at] == "truncated" else 0), at + 1
                if SHAPE.fullmatch(state):
                    found.append((cost, text))
        assert plain_repair(rows, faults)[:2] == min(found), roles


@pytest.mark.parametrize("modulus", [1, 2, 7, repair.MODULUS])
def test_search_agrees_with_the_plain_program_also_when_hashes_collide(modulus):
    draw = random.Random(5)
    for _ in range(150):
        rows = [(draw.choice(["user", "assistant", "system", "bot", ""]), f"t{draw.randrange(9)}" + draw.choice([".", "", "?"])) for _ in range(draw.randrange(30))]
        faults = plain_faults(rows)
        states = repair.search([repair.Row(r, f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, faults)], None, modulus)
        cost, edits = repair.finished(states)
        want = plain_repair(rows, faults)
        assert (cost, edits) == want[:2]
        lines, _ = repair.repaired(edits, repair.START, [r for r, _ in rows], [t for _, t in rows])
        assert lines == [f"{r}:{t}" for r, t in want[2]]


def test_segments_join_to_the_whole():
    draw = random.Random(6)
    for _ in range(200):
        rows = [repair.Row(draw.choice(["user", "assistant", "system", "x"]), draw.random() < .2, draw.random() < .3) for _ in range(draw.randrange(1, 25))]
        whole = repair.finished(repair.search(rows, None))
        paths, at = dict(repair.BEGINNING), 0
        while at < len(rows):
            size = draw.randrange(1, 6)
            paths = repair.joined(paths, {e: repair.search(rows[at:at + size], e) for e in range(4)})
            at += size
        cost, _, path = repair.finished(paths)
        edits = ""
        while path is not None:
            path, _, part = path
            edits = part + edits
        assert (cost, edits) == whole


def some_rows(seed, conversations, hot=0):
    draw, rows = random.Random(seed), []
    words = ["So it is.", "no end", "What?", "", " \t", None, "So it is.", "x" * 50 + "!"]
    for conv in [None, *range(conversations)]:
        for turn in range(draw.randrange(1, 9)):
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None]) if conv != 1 else None,
                         draw.choice(["user", "assistant", "system", "tool", None, ""]), draw.choice(words)))
    rows += [(77_000, t, ["user", "assistant"][t % 2], f"turn {t % 40}" + ".?"[t % 2]) for t in range(hot)]
    return rows + rows[:5]  # some rows twice


@pytest.mark.parametrize("segment_rows, hot", [(4096, 0), (3, 150), (50, 400)])
def test_damaged_rows_against_the_plain_program(spark, segment_rows, hot):
    rows = some_rows(segment_rows, 60, hot)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS part", "'x' AS digest")
    got = repair.repair_damaged(df.repartition(5), segment_rows)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_results(rows)


def test_a_conversation_that_loses_all_rows(spark):
    lost = next((c, t) for c in range(99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*lost, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert list(map(tuple, repair.repair_damaged(df).collect())) == [(lost[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repair_damaged(df.limit(0)).count() == 0


def test_the_query_on_given_conversations(spark):
    import os
    from statlake.llm import queries
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    rows = list(map(tuple, spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    assert sorted(map(tuple, queries.queries()["op13_conversation_repair"](spark, sf).collect()), key=repr) == plain_results(rows)
