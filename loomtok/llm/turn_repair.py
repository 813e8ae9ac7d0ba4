"""Conversation structure repair at least cost.

A conversation's rows stand in the order of ``turn`` (nulls first), rows of
one turn by a hash of role and text.  Each row's first fault counts: *blank*
(no character but white space), *duplicate* (role and text seen earlier in
the conversation), *truncated* (the last character that isn't white space
is none of ``.!?``).  The repaired role initials must read ``(s?(ua)+)?``.
Keep costs nothing, Rerole to user or assistant 3, Delete 4 (blank and
duplicate rows must go), Insert of an empty user or assistant turn 3; a
truncated row that stays adds 3.  Of the cheapest edits those whose initials
(K, R, D, I, in order) come first in ASCII are taken.

Method.  A node is a place between rows and what came last before it (none,
system, user, assistant).  The cost of the way to the end is a product of one
4 x 4 min-plus matrix for each row, taken over 1, 2, 4, ... rows.  Arcs on
cheapest ways are kept; their nodes are ranked by the least audits of 1, 2,
4, ... letters, a pair of ranks for each doubling, and pointers over as many
letters are doubled alongside.  A letter leads from a node to one node, so
the least audit of a length has one end and one pointer is enough.  The ranks
choose each node's arc; the audit is read off through the doubled pointers.

Scale.  Rows that are alike in all but number are one row with a count.  Rows
are dealt to ranges of (conversation, turn, hash), so a task holds one range
however long a conversation is.  A conversation that crosses ranges is solved
in parts: each part's matrix (16 numbers) reaches the driver, which gives each
part the costs behind it; then each part's ends by entry, and the driver gives
each part its entry.  That is two parts for each range at most.

``repair`` returns a row for each letter of the audits: conv_id, part, place
(the order within a conversation), turn, edit, times (letters; over 1 for
copies that go), cost, fault, initial (of the role as it was: s, u, a or -;
null if inserted), role and text as repaired (null if deleted).  ``summary``
gives a row for each conversation that has rows.  Null roles and texts count
as one space, a null conv_id is a conversation, a null turn comes first and
takes no part in gaps.  Other columns are ignored, whatever their names; an
empty table gives an empty result.  ``summary`` puts a conversation's letters
and lines into one cell each, as its digest asks, so there a conversation is
bounded by Spark's 2 GB for a cell; ``repair`` has no such bound.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.llm.ordered import LONG_KEY, Ranges, hash_key, long_key
from loomtok.llm.shared import table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = "-DIKR"  # 0 ends an audit, the others in ASCII order
FAULTS = [None, "blank", "duplicate", "truncated"]
WHITE = " \t\n\x0b\x0c\r"
FAR = 1 << 50

#: The state after an inserted or reroled turn.
TURN = np.array([USER, USER, ASSISTANT, USER])
#: By initial (s, u, a, other) and state: the state after a row that is kept, -1 if it can't be.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices."""
    out = x[..., :, 0, None] + y[..., 0, None, :]
    for m in range(1, 4):
        out = np.minimum(out, x[..., :, m, None] + y[..., m, None, :])
    return np.minimum(out, FAR)


NOTHING = np.where(np.eye(4, dtype=bool), 0, FAR)
#: Costs of inserts between two rows, by the state before and after.
INSERTS = NOTHING.copy()
INSERTS[np.arange(4), TURN] = INSERT
INSERTS = times(INSERTS, INSERTS)
#: Costs of the way to the end behind a conversation's last row.
AT_END = np.minimum(INSERTS[:, START], INSERTS[:, ASSISTANT])


class Part:
    """Rows of one or several conversations, each whole or a part.  ``lengths``
    has the rows of each; the other arrays lie one after the other:
    ``initial`` (0 to 3), ``must_go``, ``cut`` (truncated) and ``copies``."""

    def __init__(self, lengths: np.ndarray, initial: np.ndarray, must_go: np.ndarray, cut: np.ndarray, copies: np.ndarray):
        self.n, self.lengths = len(lengths), lengths
        # places: one before each row and one after the last of each conversation
        self.first = np.cumsum(lengths + 1) - (lengths + 1)
        self.last = self.first + lengths
        self.whose = np.repeat(np.arange(self.n), lengths + 1)
        self.is_row = np.ones(len(self.whose), bool)
        self.is_row[self.last] = False
        spread = lambda x: self._spread(np.asarray(x))
        self.initial, self.must_go, self.cut, self.copies = map(spread, (initial, must_go, cut, copies))
        each = np.full((len(self.whose), 4, 4), FAR)
        state = np.arange(4)
        stay = np.where(self.cut > 0, TRUNCATED, 0)[:, None]
        each[:, state, state] = (DELETE * self.copies)[:, None]
        free = self.is_row & (self.must_go == 0)
        for s in range(4):
            for to, cost in ((np.full(len(free), TURN[s]), REROLE + stay[:, 0]), (KEPT[self.initial, s], stay[:, 0])):
                at = np.flatnonzero(free & (to >= 0))
                each[at, s, to[at]] = np.minimum(each[at, s, to[at]], cost[at])
        each = times(np.broadcast_to(INSERTS, each.shape), each)
        each[self.last] = NOTHING
        ahead, n = np.arange(len(each)), 1
        while n <= (lengths.max() if self.n else 0):
            each = times(each, each[np.minimum(ahead + n, self.last[self.whose])])
            n *= 2
        self.ways = each  # to the end of the part, by state before and after

    def _spread(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.whose), np.int64)
        out[self.is_row] = x
        return out

    def matrices(self) -> np.ndarray:
        return self.ways[self.first]

    def solve(self, behind: np.ndarray, ends: np.ndarray) -> None:
        """``behind``: for each conversation the costs by state after the part;
        ``ends``: whether nothing follows."""
        cost = (self.ways + behind[self.whose][:, None, :]).min(axis=2)
        self.cost = cost.reshape(-1)
        p, n = np.arange(len(self.whose)), len(self.whose)
        ahead = np.minimum(p + 1, n - 1)
        row, stay = self.is_row, np.where(self.cut > 0, TRUNCATED, 0)
        free = row & (self.must_go == 0)
        may = np.zeros((5, n, 4), bool)
        to = np.zeros((5, n, 4), np.int64)
        for s in range(4):
            kept, turned = KEPT[self.initial, s], TURN[s]
            for letter, ok, place, state, price in (
                    (1, row, ahead, np.full(n, s), DELETE * self.copies), (2, row | ends[self.whose], p, np.full(n, turned), np.full(n, INSERT)),
                    (3, free & (kept >= 0), ahead, kept, stay), (4, free, ahead, np.full(n, turned), REROLE + stay)):
                may[letter, :, s] = ok & (price + cost[place, np.maximum(state, 0)] == cost[:, s])
                to[letter, :, s] = place * 4 + state
        self._rank(may.reshape(5, -1), to.reshape(5, -1))

    def _rank(self, may: np.ndarray, to: np.ndarray) -> None:
        nodes = np.arange(may.shape[1])
        may[0], to[0] = ~may[1:].any(axis=0), nodes  # an end stays where it is
        rank = may.argmax(axis=0)  # audits of one letter: the least one
        leap, doubled = to[rank, nodes], 1
        while doubled < 4 * len(nodes) and (leap[leap] != leap).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[leap], return_inverse=True)[1]
            leap, doubled = leap[leap], 2 * doubled
        # the least arc: by its letter, then by the rank of where it leads
        key = np.where(may, np.arange(5)[:, None] * (len(nodes) + 1) + rank[to], FAR)
        self.letter = key.argmin(axis=0)
        self.leaps = [to[self.letter, nodes]]
        while (self.leaps[-1][self.leaps[-1]] != self.leaps[-1]).any():
            self.leaps.append(self.leaps[-1][self.leaps[-1]])

    def exits(self) -> np.ndarray:
        """The state after the part, by conversation and the state before."""
        return self.leaps[-1][self.first[:, None] * 4 + np.arange(4)] % 4

    def paths(self, entry: np.ndarray) -> list[np.ndarray]:
        """The nodes of each conversation's letters."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * self.n
        own, nodes = np.arange(self.n), (self.first * 4 + entry)[:, None]
        for leap in self.leaps:
            more = leap[nodes]
            done = self.letter[more[:, 0]] == 0
            for i in np.flatnonzero(done):
                out[own[i]] = nodes[i]
            own, nodes = own[~done], np.concatenate([nodes, more], axis=1)[~done]
        for i, x in zip(own, nodes):
            out[i] = x
        return [x[self.letter[x] > 0] for x in out]


def _part(rows: pd.DataFrame) -> tuple[Part, np.ndarray, np.ndarray]:
    """Rows in order -> the part, the row of each item, where conversations begin."""
    conv, n = rows["_c"].to_numpy(), rows["n"].to_numpy()
    fault = rows["fault"].to_numpy()
    # the further copies of a row are duplicates; of a row that must go, all are
    more = (n > 1) & ~np.isin(fault, (1, 2))
    of = np.repeat(np.arange(len(rows)), 1 + more)
    second = np.concatenate([[False], of[1:] == of[:-1]])[:len(of)]
    fault = np.where(second, 2, fault[of])
    copies = np.where(second, n[of] - 1, np.where(more[of], 1, n[of]))
    begins = np.flatnonzero(np.concatenate([[True], conv[of][1:] != conv[of][:-1]]))
    lengths = np.diff(np.append(begins, len(of)))
    part = Part(lengths, rows["sym"].to_numpy()[of], np.isin(fault, (1, 2)), fault == 3, copies)
    part.fault = fault
    return part, of, begins


EDITS = ("conv_id long, part int, place long, turn long, edit string, times long, cost long, fault string, "
         "initial string, role string, text string")


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Distinct rows with their number, fault, key and range."""
    space = F.lit(" ")
    named = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"))
    each = named.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    same = [F.xxhash64("conv_id", "role", "text"), F.xxhash64(F.lit(1), "conv_id", "role", "text")]
    each = each.withColumns({"_k1": same[0], "_k2": same[1], "_turn": long_key(F.col("turn"))})
    # one row for each text that comes again, the hot ones summed up in each task
    again = each.groupBy("_k1", "_k2").agg(F.min("_turn").alias("_from"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    each = each.join(again, ["_k1", "_k2"], "left")
    end = F.rtrim("text", F.lit(WHITE))
    fault = (F.when(end == "", 1).when(F.col("_from") < F.col("_turn"), 2)
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0))
    first = F.substring("role", 1, 1)
    sym = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    key = F.concat(long_key(F.col("conv_id")), F.col("_turn"), hash_key(F.col("role"), F.col("text")))
    return each.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"), sym.alias("sym"), key.alias("_key"))


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["_key", *[c for c in ("role", "text") if c in rows]], kind="stable", ignore_index=True)
    return rows.assign(_c=rows["_key"].str[:LONG_KEY])


def _crossing(dealt: DataFrame) -> dict[tuple[int, str], tuple[int, list[int] | None]]:
    """(range, conversation) -> (entry, costs behind) of the parts of
    conversations that lie in several ranges; costs None: nothing follows."""
    c = F.substring("_key", 1, LONG_KEY)
    spans = sorted(tuple(r) for r in dealt.groupBy("_range").agg(F.min(c), F.max(c)).collect())
    parts: dict[str, list[int]] = {}
    for (a, _, high), (b, low, _) in zip(spans, spans[1:]):
        if high == low:
            parts.setdefault(low, [a])
            parts[low].append(b)
    if not parts:
        return {}
    spark = dealt.sparkSession
    rows = [(r, conv) for conv, own in parts.items() for r in own]

    def ask(run, returns: str, more: dict) -> dict:
        listed = spark.createDataFrame([(*x, more.get(x)) for x in rows], "_range int, _conv string, behind array<long>")
        own = dealt.select("_range", "_key", c.alias("_conv"), "n", "fault", "sym").join(F.broadcast(listed), ["_range", "_conv"])
        got = own.groupBy("_range", "_conv").applyInPandas(run, f"_range int, _conv string, found {returns}").collect()
        return {(r[0], r[1]): r.found for r in got}

    def matrix(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = _part(_in_order(rows))[0].matrices()[0]
        return pd.DataFrame({"_range": [key[0]], "_conv": [key[1]], "found": [found.reshape(-1).tolist()]})

    def exits(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        behind = rows["behind"].iloc[0]
        part = _part(_in_order(rows))[0]
        part.solve(np.array([AT_END if behind is None else behind]), np.array([behind is None]))
        return pd.DataFrame({"_range": [key[0]], "_conv": [key[1]], "found": [part.exits()[0].tolist()]})

    ways, behind = ask(matrix, "array<long>", {}), {}
    for conv, own in parts.items():
        costs = AT_END
        for r in reversed(own):
            behind[r, conv] = None if r == own[-1] else [int(x) for x in costs]
            costs = (np.array(ways[r, conv]).reshape(4, 4) + costs).min(axis=1)
    found, out = ask(exits, "array<long>", behind), {}
    for conv, own in parts.items():
        state = START
        for r in own:
            out[r, conv] = state, behind[r, conv]
            state = int(found[r, conv][state])
    return out


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    rows = table(_rows(turns, conv_col, turn_col, role_col, text_col), "turns")
    dealt = rows.withColumn("_range", Ranges(rows, "_key").of(F.col("_key")).cast("int"))
    shared = rows.sparkSession.sparkContext.broadcast(_crossing(dealt))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = _in_order(rows)
        part, of, begins = _part(rows)
        known = [shared.value.get((key[0], c), (START, None)) for c in rows["_c"].to_numpy()[of[begins]]]
        ends = np.array([b is None for _, b in known])
        part.solve(np.array([AT_END if b is None else b for _, b in known]), ends)
        paths = part.paths(np.array([entry for entry, _ in known]))
        nodes = np.concatenate([np.zeros(0, np.int64), *paths])
        place, state, letter = nodes // 4, nodes % 4, part.letter[nodes]
        conv = np.repeat(np.arange(part.n), [len(x) for x in paths])
        item = place - conv  # a conversation has one place more than items
        added = letter == 2
        at = of[np.where(added, 0, item)]
        fault = np.where(added, 0, part.fault[np.where(added, 0, item)])
        count = np.where(letter == 1, part.copies[place], 1)
        price = np.select([letter == 1, added], [DELETE * count, INSERT], np.where(letter == 4, REROLE, 0) + np.where(fault == 3, TRUNCATED, 0))
        role = np.select([letter == 1, letter == 3], [None, rows["role"].to_numpy(object)[at]],
                         np.where(TURN[state] == USER, "user", "assistant").astype(object))
        text = np.select([letter == 1, added], [None, ""], rows["text"].to_numpy(object)[at])
        turn = rows["turn"].astype("Int64").to_numpy(object)
        own = rows["conv_id"].astype("Int64").to_numpy(object)[of[begins]]
        return pd.DataFrame({
            "conv_id": pd.array(own[conv], "Int64"), "part": np.full(len(nodes), key[0]), "place": np.arange(len(nodes)),
            "turn": pd.array(np.where(added, None, turn[at]), "Int64"), "edit": np.array(list(LETTERS), object)[letter], "times": count, "cost": price,
            "fault": np.array(FAULTS, object)[fault], "initial": np.where(added, None, np.array(list("sua-"), object)[rows["sym"].to_numpy()[at]]),
            "role": role, "text": text})

    return dealt.groupBy("_range").applyInPandas(run, EDITS)


def summary(edits: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired (lines ``role:text``) of each conversation that has rows."""
    line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    each = F.struct("part", "place", F.repeat("edit", F.col("times").cast("int")).alias("audit"),
                    F.repeat("initial", F.col("times").cast("int")).alias("initials"), line.alias("line"))
    faults = [F.sum(F.when(F.col("fault") == f, F.col("times")).otherwise(0)).alias(f) for f in FAULTS[1:]]
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    found = edits.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("_e"), *faults, F.sum("cost").alias("cost"))
    # counted apart, so that a distinct count doesn't multiply the collected rows
    turns = edits.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"))
    both = found.join(turns, found.conv_id.eqNullSafe(turns.conv_id)).drop(turns.conv_id)
    both = both.withColumn("_i", F.array_join("_e.initials", ""))
    pairs = F.transform(F.sequence(F.lit(1), F.length("_i") - 1), lambda i: F.substr(F.col("_i"), i, F.lit(2)))
    illegal = F.when(F.length("_i") < 2, 0).otherwise(F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))))
    return both.select("conv_id", "gaps", *FAULTS[1:], illegal.cast("long").alias("illegal"), "cost",
                       F.array_join("_e.audit", "").alias("audit"), F.array_join("_e.line", "\n").alias("repaired"))
