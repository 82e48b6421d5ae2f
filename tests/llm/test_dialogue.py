"""Conversation repair against exhaustive search, and the query against a plain restatement."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from sievemark.llm import dialogue
from sievemark.llm.queries import op13_dialogue_repair

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?")
GAPS = ("", "u", "a", "uu", "ua", "au", "aa")
ROLE = {"u": "user", "a": "assistant"}


def exhaustive(turns):
    """Least (cost, audit) over all edits, up to two inserts in each gap."""
    best = None
    options = []
    for role, text, fault in turns:
        mine = [("D", None, 2)]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            mine.append(("K", role, extra))
            mine += [("R", ROLE[r], 1 + extra) for r in "ua" if r != role[:1]]
        options.append(mine)
    for edits in itertools.product(*options):
        for gaps in itertools.product(GAPS, repeat=len(turns) + 1):
            initials, audit, cost, lines = "", "", 0, []
            for i in range(len(turns) + 1):
                for g in gaps[i]:
                    initials, audit, cost = initials + g, audit + "I", cost + 5
                    lines.append(f"{ROLE[g]}:")
                if i < len(turns):
                    kind, role, c = edits[i]
                    audit, cost = audit + kind, cost + c
                    if role is not None:
                        initials += role[:1]
                        lines.append(f"{role}:{turns[i][1]}")
            if GRAMMAR.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def _random_turns(rng, n):
    roles = ["system", "user", "assistant", " ", "tool"]
    faults = [None, None, "blank", "duplicate", "truncated"]
    return [(rng.choice(roles), f"t{rng.randrange(3)}", rng.choice(faults)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_repair_equals_exhaustive_search(seed):
    rng = random.Random(seed)
    for n in range(4):
        turns = _random_turns(rng, n)
        assert dialogue.repair(turns) == exhaustive(turns), turns


def test_known_repairs():
    assert dialogue.repair([]) == (0, "", [])
    assert dialogue.repair([("system", "s.", None), ("user", "q?", None), ("assistant", "a.", None)])[:2] == (0, "KKK")
    # A lone user turn: an assistant turn is inserted, or the user turn goes.
    assert dialogue.repair([("user", "q?", None)])[:2] == (2, "D")
    assert dialogue.repair([("assistant", "a.", None), ("assistant", "b.", None)])[:2] == (1, "RK")


def plain(rows):
    """conv_id -> result tuple, restated from the contract."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (2 if code == 3 else 1)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, counted, marked = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, text in turns:
            fault = None
            if not re.search(r"[^\x20\x09-\x0D]", text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif re.sub(r"[\x20\x09-\x0D]+$", "", text)[-1:] not in (".", "!", "?"):
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counted[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = dialogue.repair(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counted["blank"], counted["duplicate"], counted["truncated"], illegal, cost, audit, digest)
    return out


def test_query_equals_a_plain_restatement(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in op13_dialogue_repair(spark, SF).collect()}
    assert got == plain(rows)


def test_nulls_repeats_empty_and_long(spark):
    rows = [
        (1, 0, "user", "hello."), (1, 0, "user", "hello."), (1, None, None, None), (1, 5, "assistant", "x" * 200_000),
        (None, 1, "user", "q?"), (None, 2, "assistant", "a."),
        (2, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.repair_all(df.withColumn("audit", df.text)).collect()}
    assert got == plain(rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.repair_all(empty).count() == 0
