"""Repair of conversations to the form "a system turn or none, then user and assistant in turn".

A conversation's rows are taken by turn (nulls first; equal turns by role, then text). Its first fault counts for
a row: blank (nothing but ASCII white space), duplicate (role and text stand earlier in the conversation) or truncated (the last
character that is not white space is none of ``.!?``). Edits keep a row (cost 0), give it the role user or
assistant (3), delete it (4; blanks and duplicates must go) or insert an empty turn of user or assistant anywhere
(3). A truncated row that is not deleted costs 3 more. Wanted are the cheapest edits after which the roles' first letters
read ``(s?(ua)+)?``; of equally cheap ones those whose letters (D, I, K, R, in order: the audit) sort first.

The search is depth-first branch-and-bound with an explicit stack over (rows done, state of the form). A prefix goes if its
cost and what the rows left cost at least (4 for each that must go, 3 for each truncated one, 4 for each system row past
the start) cannot beat the incumbent (cost, audit), or if the dominance table has a prefix
at the same node that is no worse. It ends when the stack is empty, so the incumbent is proved best.

Rows never stand together by conversation: they are sorted once over all tasks (by range, so that a long conversation
spreads), and cut into segments of at most ``SEGMENT`` rows in that order. A segment is searched from each state the form
can be in and gives the best edits to each state it may end in; as dominance also holds between segments, their
tables are joined, ``SEGMENT`` at a time, into that of the conversation. Only ``replay``, which writes
the repaired rows (and their SHA-256, a sequential sum), streams a conversation through one task, row by row.

Null roles and texts count as one blank. Rows without a conv_id are one conversation, without an id. Repeated rows are duplicates.
A role that does not start with s, u or a can only be changed or deleted; so can an empty one. An empty table gives an empty result. Only ``conv_id``,
``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from longform.llm.shipping import ship
from longform.llm.text import SPACES
from longform.llm.workers import enter
from longform.sources.storage import settle, store

SEGMENT = 32
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing written, after system, after user, after assistant; the form ends in DONE.
START, SYSTEM, USER, ASSISTANT = range(4)
DONE = (START, ASSISTANT)
#: The state after a turn of this first letter, by state; None where the form does not allow it.
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: The state after the one turn of user or assistant that the form allows, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")

Best = dict[tuple[int, int], tuple[int, str]]


# -- search ---------------------------------------------------------------------------


def suffix_bounds(initials: str, faults: str) -> list[int]:
    """What the rows from each place on cost at least, if anything has been written before them."""
    bound = [0] * (len(faults) + 1)
    for i in range(len(faults) - 1, -1, -1):
        if faults[i] == "x":
            least = DELETE
        else:
            least = (TRUNCATED if faults[i] == "t" else 0) + (REROLE if initials[i] in "so" else 0)
            least = min(least, DELETE)
        bound[i] = bound[i + 1] + least
    return bound


def search(initials: str, faults: str, entry: int) -> dict[int, tuple[int, str]]:
    """The best (cost, audit) to each state in which the rows can end, entered in the state ``entry``.

    ``initials`` has s, u, a or o (any other) for each row, ``faults`` x for rows that must go, t for truncated ones, k for others.
    """
    n, bound = len(faults), suffix_bounds(initials, faults)
    incumbent: dict[int, tuple[int, str]] = {}
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        here = (cost, audit)
        if (i, state) in table and table[i, state] <= here:
            continue
        # a system row can stay only where nothing has been written: there its change is no sure cost
        least = cost + bound[i] - (REROLE if state == START and i < n and "s" in initials[i:] else 0)
        if len(incumbent) == 4 and all(least > c or (least == c and audit > a[: len(audit)]) for c, a in incumbent.values()):
            continue
        table[i, state] = here
        if i == n and (state not in incumbent or here < incumbent[state]):
            incumbent[state] = here
        moves = [(i, NEXT[state], cost + INSERT, audit + "I")]
        if i < n:
            moves.append((i + 1, state, cost + DELETE, audit + "D"))
            if faults[i] != "x":
                extra = TRUNCATED if faults[i] == "t" else 0
                moves.append((i + 1, NEXT[state], cost + REROLE + extra, audit + "R"))
                kept = AFTER.get(initials[i], (None,) * 4)[state]
                if kept is not None:
                    moves.append((i + 1, kept, cost + extra, audit + "K"))
        # the most promising is taken first: it stands on top of the stack
        moves.sort(key=lambda m: (m[2] + bound[m[0]], -m[0], m[3]), reverse=True)
        stack += [m for m in moves if (m[0], m[1]) not in table or table[m[0], m[1]] > m[2:]]
    return incumbent


def joined(tables: list[Best]) -> Best:
    """The table of consecutive segments from theirs: of all ways through the states between them the best prefix at each stays."""
    out = tables[0]
    for later in tables[1:]:
        best: Best = {}
        for (entry, middle), (cost, audit) in out.items():
            for (begin, end), (more, rest) in later.items():
                if begin == middle:
                    way = (cost + more, audit + rest)
                    if (entry, end) not in best or way < best[entry, end]:
                        best[entry, end] = way
        out = best
    return out


def _illegal(initials: str) -> int:
    return sum(x not in ("su", "ua", "au") for x in map("".join, zip(initials, initials[1:])))


# -- tables ---------------------------------------------------------------------------

#: A segment: its conversation and place, first and last letter, illegal neighbours, and the best way for each two states.
FIELDS = ["key", "part", "first", "last", "illegal", "entry", "exit", "cost", "audit"]
TABLE = "key string, part long, first string, last string, illegal long, entry array<int>, exit array<int>, cost array<long>, audit array<string>"


def _key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def plain_rows(conversations: DataFrame) -> DataFrame:
    """key (of the conversation, never null), turn, role and text, without nulls in the last two."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(_key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), clean("role"), clean("text"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``seq``, ascending in the order of key, turn (nulls first), role and text; written once."""
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(placed.withColumn("seq", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """key, seq, turn, the first letter of the role (o for other than s, u, a) and the fault (blank, duplicate, truncated or null) of ordered rows."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    narrow = rows.select(
        "key", "seq", "turn", "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o").alias("initial"),
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    first = narrow.groupBy("key", "role", "digest").agg(F.min("seq").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = narrow.join(first, ["key", "role", "digest"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("seq") > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    return known.select("key", "seq", "turn", "initial", fault.alias("fault"))


def segment_tables(marked: DataFrame) -> DataFrame:
    """One row per segment: key, part (its place), and what its search found, as ``FIELDS``."""
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", "t").otherwise("k")
    part = F.floor(F.col("seq") / SEGMENT)
    grouped = marked.groupBy("key", part.cast("long").alias("part")).agg(F.array_sort(F.collect_list(F.struct("seq", "initial", code.alias("code")))).alias("turns"))
    strings = grouped.select("key", "part", F.array_join("turns.initial", "").alias("initials"), F.array_join("turns.code", "").alias("codes"))

    def solve(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("conversation_repair")
        seen: dict[tuple[str, str], list] = {}
        for batch in batches:
            rows = []
            for key, part, initials, codes in batch.itertuples(index=False):
                found = seen.get((initials, codes))
                if found is None:
                    if len(seen) > 50_000:
                        seen.clear()
                    ways = [(e, x, c, a) for e in range(4) for x, (c, a) in sorted(search(initials, codes, e).items())]
                    found = seen[initials, codes] = [initials[0], initials[-1], _illegal(initials), *map(list, zip(*ways, strict=True))]
                rows.append((key, part, *found))
            yield pd.DataFrame(rows, columns=FIELDS)

    return strings.mapInPandas(solve, TABLE)


def _joined_rows(segments) -> tuple:
    """First and last letter, illegal neighbours and table of consecutive segments."""
    segments = sorted(segments, key=lambda s: s["part"])
    tables = [{(e, x): (c, a) for e, x, c, a in zip(s["entry"], s["exit"], s["cost"], s["audit"], strict=True)} for s in segments]
    between = sum(_illegal(a["last"] + b["first"]) for a, b in zip(segments, segments[1:]))
    return segments[0]["first"], segments[-1]["last"], between + sum(int(s["illegal"]) for s in segments), joined(tables)


def join_segments(segments: DataFrame) -> DataFrame:
    """key, illegal, cost and audit of every conversation from the tables of its segments."""
    packed = lambda df: df.groupBy("key", "group").agg(F.collect_list(F.struct(*FIELDS[1:])).alias("segments"))
    most = lambda: segments.groupBy("key").count().agg(F.max("count")).first()[0] or 0

    def shorten(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = []
            for key, group, found in batch.itertuples(index=False):
                first, last, illegal, table = _joined_rows(found)
                ways = [(e, x, c, a) for (e, x), (c, a) in sorted(table.items())]
                rows.append((key, group, first, last, illegal, *map(list, zip(*ways, strict=True))))
            yield pd.DataFrame(rows, columns=FIELDS)

    while most() > SEGMENT:  # a long conversation: its places are consecutive in a task, so groups of SEGMENT places are full
        grouped = packed(segments.withColumn("group", F.floor(F.col("part") / SEGMENT).cast("long")))
        segments = store(grouped.mapInPandas(shorten, TABLE), "segments")

    def finish(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = []
            for key, _, found in batch.itertuples(index=False):
                _, _, illegal, table = _joined_rows(found)
                cost, audit = min(way for (entry, end), way in table.items() if entry == START and end in DONE)
                rows.append((key, illegal, cost, audit))
            yield pd.DataFrame(rows, columns=["key", "illegal", "cost", "audit"])

    return packed(segments.withColumn("group", F.lit(0))).mapInPandas(finish, "key string, illegal long, cost long, audit string")


def repairs(rows: DataFrame) -> DataFrame:
    """For every conversation of ordered rows: key, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    ship(rows.sparkSession)
    marked = store(faults(rows), "turn-faults")
    counts = marked.groupBy("key").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
    )
    turns = marked.where("turn IS NOT NULL").select("key", "turn").distinct().groupBy("key").agg(F.count("*").alias("turns"))
    found = join_segments(store(segment_tables(marked), "segments"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return (
        counts.join(turns, "key", "left")
        .join(found, "key")
        .select("key", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )


# -- the repaired conversations ---------------------------------------------------------


def _replayed(batches: Iterator) -> Iterator[tuple[str, str | None, str, str]]:
    """(key, edit, role, text) of each turn that is written; edit None opens a conversation. Rows come by key, the audit before the turns."""
    audit, at, state, open_ = "", 0, START, None

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield (open_, "I", ROLE[state], "")
            at, state = at + 1, NEXT[state]

    for batch in batches:
        for key, seq, role, text in batch.itertuples(index=False):
            if seq < 0:
                yield from inserted()
                audit, at, state, open_ = text, 0, START, key
                yield (key, None, "", "")
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                yield (key, edit, role, text)
                state = AFTER[role[0]][state]
            elif edit == "R":
                yield (key, edit, ROLE[state], text)
                state = NEXT[state]
    yield from inserted()


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    head = audits.select("key", F.lit(-1).cast("long").alias("seq"), F.lit("").alias("role"), F.col("audit").alias("text"))
    return rows.select("key", "seq", "role", "text").unionByName(head).repartition("key").sortWithinPartitions("key", "seq")


def replay(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: key, place (from 0), edit, role, text."""

    def write(batches: Iterator) -> Iterator:
        import pandas as pd

        held, size, place = [], 0, 0
        for key, edit, role, text in _replayed(batches):
            if edit is None:
                place = 0
                continue
            held.append((key, place, edit, role, text))
            place, size = place + 1, size + len(text)
            if size > 4_000_000 or len(held) >= 10_000:
                yield pd.DataFrame(held, columns=["key", "place", "edit", "role", "text"])
                held, size = [], 0
        yield pd.DataFrame(held, columns=["key", "place", "edit", "role", "text"])

    ship(rows.sparkSession)
    return _with_audits(rows, audits).mapInPandas(write, "key string, place long, edit string, role string, text string")


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """key and SHA-256 of the repaired turns, ``role:text`` joined by line breaks."""

    def write(batches: Iterator) -> Iterator:
        import pandas as pd

        done, key, total, first = [], None, None, True
        for name, edit, role, text in _replayed(batches):
            if edit is None:
                if total:
                    done.append((key, total.hexdigest()))
                key, total, first = name, hashlib.sha256(), True
                if len(done) >= 10_000:
                    yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
                    done = []
            else:
                total.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "replace"))
                first = False
        if total:
            done.append((key, total.hexdigest()))
        yield pd.DataFrame(done, columns=["key", "repaired_sha256"])

    ship(rows.sparkSession)
    return _with_audits(rows, audits).mapInPandas(write, "key string, repaired_sha256 string")


# -- damage -----------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """``plain_rows`` damaged by the checksum of conv_id:turn (nulls: one blank), modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes it the user's.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(_key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), clean("role").alias("role"), clean("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    rows = rows.where("kind <> 0").select("key", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def repair_report(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row for every conv_id of the table: faults, cost, audit and digest of its repair.

    ``rows``: its rows if they differ from the table's own, as ``plain_rows`` gives them.
    """
    turns = ordered(plain_rows(conversations) if rows is None else rows)
    found = store(repairs(turns), "repairs")
    written = digests(turns, found)
    ids = conversations.select(F.col("conv_id")).distinct().withColumn("key", _key(F.col("conv_id")))
    joined_ = ids.join(found.join(written, "key"), "key", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined_.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
