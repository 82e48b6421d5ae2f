"""Conversation structure repair: generalised LR parsing with weighted repairs.

The role grammar is ``C -> e | H B``, ``H -> e | s``, ``B -> u a | B u a`` over role
initials (s: system, u: user, a: assistant): an optional system turn, then one or more
user-assistant pairs. Its LR automaton has four states after reductions: 0 start, 1
after the system turn, 2 after a user turn, 3 after a complete pair; 0 and 3 accept.

Repair reads a conversation's turns in order and keeps a graph-structured stack of
parses. Every turn may be deleted (cost 2, ``D``; required for blank and duplicate
turns), kept as it is if the automaton can shift its role (0, ``K``), or re-roled to
user or assistant (1, ``R``); between turns empty user or assistant turns may be
inserted (5 each, ``I``). A turn kept or re-roled whose fault is truncation adds 5.
Stack tops that reach the same automaton state are merged, keeping the one of least
(cost, audit): ties go to the ASCII-least audit. With four states that is a bounded
frontier per turn, so a conversation costs time linear in its turns.

Faults (blank, duplicate, truncated; a turn's first fault counts), gaps and illegal
adjacencies are computed in the JVM; only the turns of one conversation at a time meet
in Python.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Repair costs and the automaton of the role grammar.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
ROLE_OF = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, TRUNC = "blank", "duplicate", "truncated"
SPACE = r"[\x20\x09-\x0D]"

RESULT = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
        T.StructField("n_repaired", T.LongType()),
    ]
)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def repair(turns: list[tuple[str, str, str | None]]) -> tuple[int, str, list[str]]:
    """Least (cost, audit) repair of turns given as (role, text, fault) in order.

    Returns the cost, the audit (one initial per edit, in order) and the repaired
    ``role:text`` lines.
    """
    # A stack top: state -> (cost, audit, lines as a linked list).
    tops: dict[int, tuple[int, str, tuple | None]] = {0: (0, "", None)}

    def offer(into: dict, state: int, candidate: tuple) -> bool:
        held = into.get(state)
        if held is None or candidate[:2] < held[:2]:
            into[state] = candidate
            return True
        return False

    def inserts(current: dict) -> dict:
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, lines) in list(current.items()):
                for initial in "ua":
                    target = SHIFT.get((state, initial))
                    if target is not None:
                        line = f"{ROLE_OF[initial]}:"
                        changed |= offer(current, target, (cost + INSERT, audit + "I", (lines, line)))
        return current

    tops = inserts(tops)
    for role, text, fault in turns:
        initial = role[:1]
        extra = TRUNCATED if fault == TRUNC else 0
        following: dict = {}
        for state, (cost, audit, lines) in tops.items():
            offer(following, state, (cost + DELETE, audit + "D", lines))
            if fault in (BLANK, DUPLICATE):
                continue
            target = SHIFT.get((state, initial))
            if target is not None:
                offer(following, target, (cost + KEEP + extra, audit + "K", (lines, f"{role}:{text}")))
            for new in "ua":
                target = SHIFT.get((state, new))
                if new != initial and target is not None:
                    line = f"{ROLE_OF[new]}:{text}"
                    offer(following, target, (cost + REROLE + extra, audit + "R", (lines, line)))
        tops = inserts(following)
    cost, audit, lines = min((tops[s] for s in ACCEPT if s in tops), key=lambda t: t[:2])
    out = []
    while lines is not None:
        lines, line = lines
        out.append(line)
    return cost, audit, out[::-1]


def _repair_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("__pos", kind="stable")
    turns = list(zip(rows["role"], rows["text"], rows["fault"]))
    cost, audit, lines = repair(turns)
    digest = hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest() if lines else EMPTY_SHA
    conv = rows["conv_id"].iloc[0]
    return pd.DataFrame(
        {
            "conv_id": [None if pd.isna(conv) else int(conv)],
            "cost": [cost],
            "audit": [audit],
            "repaired_sha256": [digest],
            "n_repaired": [len(lines)],
        }
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage by crc32 of ``conv_id:turn`` (nulls written as one space) mod 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it at the
    same turn, 4 makes it a user turn. Null roles and texts read as one space.
    """
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    code = F.crc32(key) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("__code"))
        .where(F.col("__code") != 0)
        .withColumn("text", F.when(F.col("__code") == 1, F.lit("")).when(F.col("__code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("__code") == 4, F.lit("user")).otherwise(F.col("role")))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__code") == 3, 2).otherwise(1))))
        .drop("__code", "__copy")
    )


def faults(turns: DataFrame) -> DataFrame:
    """Each turn's position in its conversation (turn, nulls first; then role and text) and first fault."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)) - 1
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(*order)) > 1
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){SPACE}*$", 1)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = (
        F.when(blank, F.lit(BLANK))
        .when(seen, F.lit(DUPLICATE))
        .when(~last.isin(".", "!", "?"), F.lit(TRUNC))
    )
    return turns.withColumn("fault", fault).withColumn("__pos", place)


def repair_all(conversations: DataFrame) -> DataFrame:
    """One row per original ``conv_id``: gaps, fault counts, illegal adjacencies, cost, audit, hash.

    Defined cases: a conversation without rows after damage has zeros, an empty audit and
    the digest of the empty string; a null ``conv_id`` is a conversation of its own;
    repeated rows are turns like others (the later ones duplicates); an empty table gives
    an empty result; columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are ignored.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    turns = faults(damaged(conversations))
    by_pos = Window.partitionBy("conv_id").orderBy("__pos")
    pair = F.concat(F.substring(F.lag("role").over(by_pos), 1, 1), F.substring("role", 1, 1))
    illegal = F.when(F.lag("role").over(by_pos).isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0)
    marked = turns.withColumn("__illegal", illegal)
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum((F.col("fault") == f).cast("long")).alias(f) for f in (BLANK, DUPLICATE, TRUNC)],
        F.sum("__illegal").cast("long").alias("illegal"),
    )
    repaired = turns.select("conv_id", "__pos", "role", "text", "fault").groupBy("conv_id").applyInPandas(_repair_group, RESULT)
    found = counts.join(repaired, counts["conv_id"].eqNullSafe(repaired["conv_id"])).drop(repaired["conv_id"])
    everyone = conversations.select("conv_id").distinct()
    joined = everyone.join(found, everyone["conv_id"].eqNullSafe(found["conv_id"]), "left").drop(found["conv_id"])
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", BLANK, DUPLICATE, TRUNC, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"),
    )
