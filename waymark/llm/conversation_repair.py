"""Repair of conversation structure by depth-first branch and bound."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.storage import materialize

#: Rows of a conversation that are searched at a time, and segments that are joined at a time.
SEGMENT_ROWS, FAN = 128, 64
#: Costs of rerole, delete, insert, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The white space that makes a row blank, and the ends of a whole text.
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Repaired roles read ``(s?(ua)+)?``.  States: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (NOTHING, ASSISTANT)
STEP = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: The state that a new role leads to, and the pairs (entry, exit) that a segment can have.
NEW = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
PAIRS = [
    (a, b) for a in range(4) for b in range(4) if b >= USER or a == b or (a, b) == (NOTHING, SYSTEM)
]
LEGAL = ("su", "ua", "au")


Step = tuple[str | None, int, int]


def suffix_bounds(steps: list[Step], goals: tuple[int, ...] = FINAL) -> list[list[float]]:
    """A lower bound of what each suffix costs from each state, read from the end.

    It looks at costs only, so four numbers a row do; audits, which decide between edits of
    equal cost, are left to the search.
    """
    last = [0 if q in goals else math.inf for q in range(4)]
    bounds = [_inserted(last)]
    for initial, extra, times in reversed(steps):
        after = bounds[-1]
        here = [after[q] + DELETE * times for q in range(4)]
        if initial is not None:
            here = [min(here[q], after[NEW[q]] + REROLE + extra) for q in range(4)]
            for (q, role), nxt in STEP.items():
                if role == initial:
                    here[q] = min(here[q], after[nxt] + extra)
        bounds.append(_inserted(here))
    return bounds[::-1]


def _inserted(costs: list[float]) -> list[float]:
    """What each state costs if rows may be inserted first; two lead to every state there is."""
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[NEW[q]]) for q in range(4)]
    return costs


def branch_and_bound(
    steps: list[Step],
    entry: int = NOTHING,
    goals: tuple[int, ...] = FINAL,
    bounds: list[list[float]] | None = None,
) -> tuple[int, str] | None:
    """The cheapest edits from ``entry`` to one of ``goals``, of these the least audit.

    A step is (initial, cost of staying, 1), or (None, 0, n) for n rows that must go.  The
    stack goes down the most promising branch first.  A prefix is cut off if its cost and
    the suffix's bound exceed the incumbent's, or equal them with a greater audit, and if its
    node (row, state) has been reached by a lesser (cost, audit).  That is safe: prefixes of
    one node and cost have equally many letters that stand for rows, so none begins with the
    other, and what follows cannot turn their order.  When the stack is empty the incumbent
    is proved to be the optimum.
    """
    n, bounds = len(steps), bounds or suffix_bounds(steps, goals)
    if bounds[0][entry] == math.inf:
        return None
    best: tuple[int, str] | None = None
    table = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if table[i, state] != (cost, audit):
            continue
        if best is not None:
            least = cost + bounds[i][state]
            if least > best[0] or least == best[0] and audit > best[1][: len(audit)]:
                continue
        if i == n and state in goals and (best is None or (cost, audit) < best):
            best = (cost, audit)
        moves = [(cost + INSERT, audit + "I", i, NEW[state])]
        if i < n:
            initial, extra, times = steps[i]
            moves.append((cost + DELETE * times, audit + "D" * times, i + 1, state))
            if initial is not None:
                moves.append((cost + REROLE + extra, audit + "R", i + 1, NEW[state]))
                if (state, initial) in STEP:
                    moves.append((cost + extra, audit + "K", i + 1, STEP[state, initial]))
        moves.sort(key=lambda m: (m[0] + bounds[m[2]][m[3]], m[1]), reverse=True)
        for c, a, j, q in moves:
            known = table.get((j, q))
            if bounds[j][q] < math.inf and (known is None or (c, a) < known):
                table[j, q] = (c, a)
                stack.append((j, q, c, a))
    return best


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: c, t (keys of conversation and turn), role, text, copies.

    Nulls are one space.  ``crc32(conv_id:turn) % 20`` drops a row (0), empties its text (1),
    removes its full stops (2), repeats it (3) or makes it the user's (4).
    """
    as_text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.encode(F.concat(as_text["conv_id"], F.lit(":"), as_text["turn"]), "UTF-8")) % 20
    key = {c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("conv_id", "turn")}
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(as_text["text"], "[.!?]", "")).otherwise(as_text["text"])
    return conversations.where(kind != 0).select(
        key["conv_id"].alias("c"),
        key["turn"].alias("t"),
        F.when(kind == 4, "user").otherwise(as_text["role"]).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def with_hash(rows: DataFrame) -> DataFrame:
    """Add ``h``, by which texts are compared (128 bits)."""
    return rows.withColumn("h", F.md5(F.encode("text", "UTF-8")))


def mark_faults(rows: DataFrame) -> DataFrame:
    """Different rows of each conversation: c, t, role, h, n (times), blank, truncated, and
    ``first`` (no earlier row has this role and text).

    Equal rows are counted before they are shuffled, and the first turns are joined by a key
    that is different for every row, so no text or conversation is too common.
    """
    core = F.rtrim("text", F.lit(BLANKS))
    kinds = rows.withColumns(
        {"blank": core == "", "truncated": ~F.right(core, F.lit(1)).isin(*ENDS)}
    )
    narrow = with_hash(kinds).groupBy("c", "t", "role", "h").agg(
        F.sum("copies").alias("n"), F.bool_or("blank").alias("blank"), F.bool_or("truncated").alias("truncated")
    )
    turn = _turn(F.col("t"))
    firsts = narrow.groupBy("c", "role", "h").agg(F.min(F.struct(turn.isNotNull(), turn, F.col("t").alias("t"))).alias("at"))
    firsts = firsts.select("c", F.col("at.t").alias("t"), "role", "h", F.lit(True).alias("first"))
    return narrow.join(firsts, ["c", "t", "role", "h"], "left").withColumn("first", F.coalesce("first", F.lit(False)))


def _turn(t):
    return F.when(t != "", F.substring(t, 2, 40).cast("long"))


SUMMARY = (
    "c string, at long, rows long, first_turn long, last_turn long, turns long, first_initial string, "
    "last_initial string, blank long, duplicate long, truncated long, illegal long, "
    "paths array<struct<entry: int, exit: int, cost: long, audit: string>>, "
    "blocks array<struct<at: long, rows: long>>"
)
SEGMENT = SUMMARY + ", whole boolean, members array<struct<t: string, role: string, h: string, n: long>>"
NAMES = [
    "c", "at", "rows", "first_turn", "last_turn", "turns", "first_initial", "last_initial",
    "blank", "duplicate", "truncated", "illegal", "paths", "blocks",
]


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    """Rows as a frame whose turns stay whole numbers beside nulls."""
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"first_turn": "Int64", "last_turn": "Int64"})


def _segment(c: str, at: int, rows: list[tuple], whole: bool) -> dict:
    """Summary of consecutive rows (t, role, h, n, blank, truncated, first) of a conversation."""
    steps: list[tuple[str | None, int, int]] = []
    out = dict.fromkeys(("rows", "blank", "duplicate", "truncated", "illegal", "turns"), 0)
    first_turn = last_turn = None
    before = ""
    for t, role, _, n, blank, truncated, first in rows:
        out["rows"] += n
        if t and (last_turn is None or int(t[1:]) != last_turn):
            last_turn = int(t[1:])
            first_turn = last_turn if first_turn is None else first_turn
            out["turns"] += 1
        initial = role[:1]
        out["illegal"] += n - 1 + bool(steps and before + initial not in LEGAL)
        before = initial
        gone = n if blank or not first else n - 1
        out["blank"] += n if blank else 0
        out["duplicate"] += 0 if blank else gone
        if gone < n:
            out["truncated"] += truncated
            steps.append((initial, TRUNCATED if truncated else 0, 1))
        if gone:
            steps.append((None, 0, gone))
    if whole:
        cost, audit = branch_and_bound(steps)
        paths = [(NOTHING, ASSISTANT, cost, audit)]
    else:
        bounds = {b: suffix_bounds(steps, (b,)) for b in range(4)}
        found = [(a, b, branch_and_bound(steps, a, (b,), bounds[b])) for a, b in PAIRS]
        paths = [(a, b, *best) for a, b, best in found if best is not None]
    return out | {
        "c": c, "at": at, "first_turn": first_turn, "last_turn": last_turn, "whole": whole,
        "first_initial": rows[0][1][:1], "last_initial": before, "paths": paths, "blocks": [(at, out["rows"])],
        "members": [r[:4] for r in rows],
    }


def search_segments(marked: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Rows in the order conversation, turn (null first), role, text's hash, cut into segments.

    One range shuffle spreads a long conversation over tasks.  A conversation that lies
    inside one task and segment is solved at once (``whole``); of all other segments every
    way from state to state is solved, to be joined later.
    """
    order = [F.col("c"), _turn(F.col("t")).asc_nulls_first(), F.col("role"), F.col("h")]
    sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows = sorted_rows.select("c", "t", "role", "h", "n", "blank", "truncated", "first")
    names = [*NAMES, "whole", "members"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, made = TaskContext.get().partitionId() << 33, []
        c, rows, inner = None, [], False
        for batch in batches:
            columns = [batch[k].tolist() for k in ("t", "role", "h", "n", "blank", "truncated", "first")]
            for name, *row in zip(batch["c"], *columns):
                if name != c or len(rows) == segment_rows:
                    if rows:
                        made.append(_segment(c, at, rows, inner and name != c))
                        at += 1
                    inner = name != c and c is not None
                    c, rows = name, []
                rows.append(tuple(row))
            yield _frame(made, names)
            made = []
        if rows:
            yield _frame([_segment(c, at, rows, False)], names)

    return sorted_rows.mapInPandas(cut, SEGMENT)


def join_summaries(parts: list[dict]) -> dict:
    """One summary of consecutive ones; for each pair of states the least (cost, audit)."""
    out = dict(parts[0])
    ways = {(p["entry"], p["exit"]): (p["cost"], [p["audit"]]) for p in out["paths"]}
    blocks = list(out["blocks"])
    for part in parts[1:]:
        longer: dict[tuple[int, int], tuple[int, list[str]]] = {}
        steps = [(p["entry"], p["exit"], p["cost"], p["audit"]) for p in part["paths"]]
        for (a, mid), (cost, audit) in ways.items():
            for entry, b, more, letters in steps:
                if entry == mid:
                    way, known = (cost + more, [*audit, letters]), longer.get((a, b))
                    if known is None or way[0] < known[0] or way[0] == known[0] and "".join(way[1]) < "".join(known[1]):
                        longer[a, b] = way
        ways = {k: (cost, ["".join(audit)]) for k, (cost, audit) in longer.items()}
        for k in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
            out[k] += part[k]
        out["illegal"] += out["last_initial"] + part["first_initial"] not in LEGAL
        if not pd.isna(part["first_turn"]):
            out["turns"] -= out["last_turn"] == part["first_turn"]
            out["first_turn"] = part["first_turn"] if pd.isna(out["first_turn"]) else out["first_turn"]
            out["last_turn"] = part["last_turn"]
        out["last_initial"] = part["last_initial"]
        blocks.extend(part["blocks"])
    out["paths"] = [(a, b, cost, audit[0]) for (a, b), (cost, audit) in ways.items()]
    out["blocks"] = [(b["at"], b["rows"]) for b in blocks]
    return out


def _joined(summaries: DataFrame, shift: int | None) -> DataFrame:
    """Summaries joined within a conversation (``shift`` None) or runs of ``FAN`` positions."""
    keys = ["c"] if shift is None else ["c", F.shiftright("at", shift).alias("run")]
    row = F.struct(*[c for c in NAMES if c != "c"])
    grouped = summaries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", row.alias("row")))).alias("parts"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [
                join_summaries([_plain(p["row"]) for p in parts]) | {"c": c}
                for c, parts in zip(batch["c"], batch["parts"])
            ]
            yield _frame(made, NAMES)

    return grouped.select("c", "parts").mapInPandas(join, SUMMARY)


def _plain(row) -> dict:
    return row if isinstance(row, dict) else row.asDict(recursive=True)


def solve(segments: DataFrame, fan: int = FAN) -> DataFrame:
    """One summary a conversation with ``cost`` and ``audit`` of its repair.

    Segments are joined in runs of ``fan`` until a conversation has at most that many, then to
    one.  What a task holds is the audits of the ways through the rows it joins; a
    conversation's own audit is one value of the result.
    """
    parts = segments.where("not whole").select(*NAMES)
    shift = 0
    while (parts.groupBy("c").count().agg(F.max("count")).first()[0] or 0) > fan:
        shift += fan.bit_length() - 1
        parts = materialize(_joined(parts, shift), "conversation-runs")
    rows = segments.where("whole").select(*NAMES).unionByName(_joined(parts, None).select(*NAMES))
    ends = F.filter("paths", lambda p: (p["entry"] == NOTHING) & p["exit"].isin(*FINAL))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"))))
    return rows.withColumn("best", best).select(*[c for c in NAMES if c != "paths"], "best.*")


def _slices(audit: str, blocks: list) -> list[tuple[int, str, int, bool, bool]]:
    """(position, letters, outputs before, begins with s, is last) of each segment."""
    system = (len(audit) - audit.count("D")) % 2 == 1
    out, begin, before = [], 0, 0
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        end, left = begin, block["rows"]
        if last:
            end = len(audit)
        while left and not last:
            left -= audit[end] != "I"
            end += 1
        letters = audit[begin:end]
        out.append((block["at"], letters, before, system, last))
        before += len(letters) - letters.count("D")
        begin = end
    return out


def _outputs(members: list, letters: str, before: int, system: bool) -> list[tuple]:
    """(t, role, h, new role, own text, position) of what each row gives and is given before it."""
    def role_at(pos: int) -> str:
        return "assistant" if (pos - system) % 2 else "user"

    out, k, pos = [], 0, before
    for member in members:
        t, role, h, n = member["t"], member["role"], member["h"], member["n"]
        while k < len(letters) and n:
            letter, k = letters[k], k + 1
            if letter == "I":
                out.append((t, role, h, role_at(pos), False, pos))
            elif letter != "D":
                out.append((t, role, h, role if letter == "K" else role_at(pos), True, pos))
            n -= letter != "I"
            pos += letter != "D"
    # only the last segment has letters left: insertions at the end
    out.extend((t, role, h, role_at(pos + i), False, pos + i) for i in range(len(letters) - k))
    return out


def repaired_rows(rows: DataFrame, segments: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired conversations: c, pos (gapless from 0), role, text.

    Audits are cut back into the segments' letters, which meet the segments by position; the
    rows that stay meet their texts by a key that is different for every row.
    """
    spec = "array<struct<at: long, letters: string, before: long, system: boolean, last: boolean>>"
    edits = "array<struct<t: string, role: string, h: string, new_role: string, own: boolean, pos: long>>"

    @F.pandas_udf(spec)
    def cut(audits: pd.Series, blocks: pd.Series) -> pd.Series:
        return pd.Series([_slices(a, [_plain(x) for x in b]) for a, b in zip(audits, blocks)])

    @F.pandas_udf(edits)
    def outputs(members: pd.Series, letters: pd.Series, before: pd.Series, system: pd.Series) -> pd.Series:
        made = zip(members, letters, before, system)
        return pd.Series([_outputs([_plain(x) for x in m], w, int(b), bool(s)) for m, w, b, s in made])

    slices = solved.select(F.explode(cut("audit", "blocks")).alias("s")).select("s.*")
    ways = segments.select("c", "at", "members").join(slices, "at")
    made = ways.select("c", F.explode(outputs("members", "letters", "before", "system")).alias("e")).select("c", "e.*")
    made = materialize(made, "edits")
    texts = with_hash(rows.drop("copies")).dropDuplicates(["c", "t", "role", "h"])
    own = made.where("own").join(texts, ["c", "t", "role", "h"]).select("c", "pos", F.col("new_role").alias("role"), "text")
    new = made.where("not own").select("c", "pos", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return own.unionByName(new)


def digests(repaired: DataFrame) -> DataFrame:
    """(c, repaired_sha256) of the lines ``role:text``, joined by newlines.

    A digest reads its conversation from front to end, so that is one task's stream; no
    conversation is held in memory.
    """
    lines = repaired.select("c", "pos", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("c").sortWithinPartitions("c", "pos").select("c", "line")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = sha = None
        for batch in batches:
            done = []
            for name, line in zip(batch["c"], batch["line"]):
                if name != c:
                    if sha:
                        done.append((c, sha.hexdigest()))
                    c, sha = name, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.encode("utf-8", "surrogatepass"))
            yield pd.DataFrame(done, columns=["c", "repaired_sha256"])
        if sha:
            yield pd.DataFrame([(c, sha.hexdigest())], columns=["c", "repaired_sha256"])

    return lines.mapInPandas(digest, "c string, repaired_sha256 string")


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(one summary a conversation with cost and audit, repaired rows) of ``rows``: c, t,
    role, text, copies, as ``damaged`` gives them.

    A row is blank, else duplicate (an earlier row of the conversation has its role and
    text), else truncated.  Blank and duplicate rows are deleted; the repaired roles begin
    with s?(ua)+ or there are none.  Rows of equal turn go by role and a hash of their text;
    rows equal in all are copies of one.
    """
    marked = mark_faults(rows)
    segments = materialize(search_segments(marked, segment_rows), "segments")
    solved = materialize(solve(segments, fan), "repairs")
    return solved, repaired_rows(rows, segments, solved)


def repair_conversations(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of
    every conversation after the contract's damage.

    A null conv_id is a conversation of its own, null turns come first.  One without rows
    after the damage has zeros, an empty audit and the digest of nothing.  An empty table
    gives an empty result.
    """
    solved, repaired = repair(damaged(conversations), segment_rows, fan)
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    ids = conversations.select("conv_id", key.alias("c")).distinct()
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    told = solved.withColumn("gaps", gaps)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        ids.join(told.select("c", *counts, "audit"), "c", "left")
        .join(digests(repaired), "c", "left")
        .select(
            "conv_id",
            *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )
