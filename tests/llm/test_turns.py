"""Conversation repair against a search over all edits."""

import functools
import random
import sys

import pytest
from pyspark.sql import functions as F

from loomtok.llm import ordered, queries, turn_repair

sys.setrecursionlimit(20_000)

WHITE = " \t\n\x0b\x0c\r"
NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}
FOLLOWS = {"s": [""], "u": ["", "s", "a"], "a": ["u"]}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        left = text.rstrip(WHITE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) by trying every edit at every place."""
    found = faults(rows)

    @functools.cache
    def rest(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def way(cost, letter, line, then):
            if then is not None:
                ways.append((cost + then[0], letter + then[1], line + then[2]))

        if inserts < 2:
            who = NEXT[last]
            way(3, "I", (who + ":",), rest(i, who[0], inserts + 1))
        if i < len(rows):
            role, text = rows[i]
            way(4, "D", (), rest(i + 1, last, 0))
            if found[i] not in ("blank", "duplicate"):
                more = 3 if found[i] else 0
                if last in FOLLOWS.get(role[:1], []):
                    way(more, "K", (role + ":" + text,), rest(i + 1, role[:1], 0))
                way(3 + more, "R", (NEXT[last] + ":" + text,), rest(i + 1, NEXT[last][0], 0))
        return min(ways, default=None)

    return rest(0, "", 0)


def expected(rows):
    """rows: (turn, role, text) in order -> a row of ``summary`` without its key."""
    plain = [(" " if r is None else r, " " if t is None else t) for _, r, t in rows]
    cost, audit, lines = cheapest(plain)
    found, turns = faults(plain), [t for t, _, _ in rows if t is not None]
    odd = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), odd, cost, audit, "\n".join(lines))


def conversations(rng, n, longest):
    out = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
            text = rng.choice(["yes.", "no", "what? ", "a b c!\n", "", "  ", f"text {turn}.", f"cut {turn}", None])
            if rng.random() < 0.9:
                out.append((c, turn, role, text))
    return out


def check(spark, rows, **columns):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({k: F.lit(v) for k, v in columns.items()})
    edits = turn_repair.repair(frame)
    got = {r[0]: tuple(r)[1:] for r in turn_repair.summary(edits).collect()}
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn, role, text))
    assert got == {c: expected(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0))) for c, x in own.items()}
    return edits


@pytest.mark.parametrize("size", [1024, 3])
def test_repair(spark, monkeypatch, size):
    """Ranges of three rows cut most conversations into parts."""
    monkeypatch.setattr(ordered, "RANGE_ROWS", size)
    monkeypatch.setattr(ordered, "PER_RANGE", 1000)
    rng = random.Random(5)
    rows = conversations(rng, 60, 9) + [(None, 3, "user", "null id."), (None, 5, "assistant", "and more"), (-4, 2, None, None), (-4, None, "user", "first.")]
    edits = check(spark, rows, part="clash", edit=1, _key="clash", n=3)
    kept = edits.where("edit <> 'D'")
    assert kept.where("role IS NULL OR text IS NULL").count() == 0 and edits.where("edit = 'I' AND (text <> '' OR turn IS NOT NULL)").count() == 0


def test_a_conversation_far_longer_than_a_range(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 40)
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["yes.", f"t{t}.", f"cut {t}"])) for t in range(400)]
    rows += [(2, t, ["user", "assistant"][t % 2], f"fine {t}.") for t in range(150)]
    check(spark, rows)


def test_copies_and_order(spark):
    """Copies of a row follow it and go; rows of one turn keep one order."""
    rows = [(1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, 1, "assistant", "ho."), (2, 0, "user", ""), (2, 0, "user", "")]
    edits = check(spark, rows)
    assert sorted((r.conv_id, r.place, r.edit, r.times) for r in edits.collect() if r.conv_id == 1) == [(1, 0, "K", 1), (1, 1, "D", 2), (1, 2, "K", 1)]
    assert sorted((r.edit, r.times) for r in edits.where("conv_id = 2").collect()) == [("D", 2)]
    tied = [(3, 0, "user", "b."), (3, 0, "assistant", "a."), (3, 0, "user", "c.")]
    frame = spark.createDataFrame(tied, "conv_id long, turn long, role string, text string")
    one, two = (turn_repair.summary(turn_repair.repair(f)).first() for f in (frame, frame.orderBy(F.desc("text")).repartition(3)))
    assert one == two


def test_very_long_texts_and_empty_tables(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "word " * 300_000)]
    check(spark, rows)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.summary(turn_repair.repair(none)).count() == 0


def test_the_query_keeps_conversations_without_rows(spark, tmp_path):
    import hashlib
    import zlib
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 1)
    rows = [(gone, 0, "user", "x."), (empty, 0, "user", "x."), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.op12_turn_repair(spark, str(tmp_path)).collect()}
    blank = hashlib.sha256(b"").hexdigest()
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", blank)
    assert tuple(got[empty])[1:] == (0, 1, 0, 0, 0, 4, "D", blank) and set(got) == {gone, empty, None}


def test_a_brute_force_damage(spark):
    import zlib
    rows = conversations(random.Random(9), 30, 6)
    out = []
    for c, turn, role, text in rows:
        h = zlib.crc32(f"{c}:{turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        elif h == 2:
            text = text.translate({ord(x): None for x in ".!?"})
        elif h == 4:
            role = "user"
        out += [(c, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    got = queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(out)
