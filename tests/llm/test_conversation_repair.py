import hashlib
import random
import re
import zlib

import pytest

from longform.llm import conversation_repair as repair
from longform.llm.conversation_repair import DONE, START, digests, ordered, plain_rows, repair_report, repairs, replay, search
from longform.llm.queries import QUERIES

COLUMNS = "conv_id long, turn long, role string, text string, key string, seq long, audit string, cost double, fault int"
WORD = r"[^\x20\x09-\x0D]"


def cheapest(initials, faults):
    """Least (cost, audit) over every sequence of edits, from the definition: prefixes by the letters written so far."""
    form = lambda s: re.fullmatch("(s?(ua)*u?)", s)  # noqa: E731  a prefix of the form

    def settle(table):
        """Insertions, cheapest first, until nothing improves; what was written matters by its last letter and whether anything was."""
        queue = list(table)
        while queue:
            written = queue.pop()
            cost, audit = table[written]
            for letter in "ua":
                if form(written + letter):
                    put(table, queue, written + letter, (cost + 3, audit + "I"))
        return table

    def put(table, queue, written, way):
        short = {"": "", "s": "s"}.get(written, "u" if written.endswith("u") else "ua")
        if short not in table or way < table[short]:
            table[short] = way
            queue.append(short)

    table = settle({"": (0, "")})
    for initial, fault in zip(initials, faults, strict=True):
        after: dict = {}
        for written, (cost, audit) in table.items():
            put(after, [], written, (cost + 4, audit + "D"))
            if fault != "x":
                extra = 3 if fault == "t" else 0
                if form(written + initial):
                    put(after, [], written + initial, (cost + extra, audit + "K"))
                for letter in "ua":
                    if form(written + letter):
                        put(after, [], written + letter, (cost + extra + 3, audit + "R"))
        table = settle(after)
    return min(way for written, way in table.items() if re.fullmatch("(s?(ua)+)?", written))


def by_hand(conversations, damaged=True):
    rows: dict = {}
    for conv, turn, role, text in conversations:
        kept = rows.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if damaged else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, turns in rows.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            body = re.findall(WORD, text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in turns]
        codes = [{"blank": "x", "duplicate": "x", "truncated": "t"}.get(f, "k") for f in faults]
        cost, audit = cheapest([i if i and i in "sua" else "o" for i in initials], codes)
        written, left = [], list(turns)
        for edit in audit:
            last = written[-1].split(":")[0][:1] if written else ""
            other = ("assistant" if last == "u" else "user")
            if edit == "I":
                written.append(f"{other}:")
                continue
            _, role, text = left.pop(0)
            if edit != "D":
                written.append(f"{role if edit == 'K' else other}:{text}")
        assert not left and re.fullmatch("(s?(ua)+)?", "".join(w[0] for w in written))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(written).encode()).hexdigest())
    return out


def chats(seed, n=60, longest=12):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        turn = 0
        for k in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[k % 2]
            role = rng.choice(["system", "tool", "", None, "Sys"]) if rng.random() < 0.12 else role
            text = rng.choice(["Yes.", "No!", "what", "é?\n", " ", None, "", "A.b", "fine. \t", f"text {rng.random()}."])
            turn += rng.choice([1, 1, 1, 2, 0])
            rows.append((conv, None if rng.random() < 0.05 else turn, role, text))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1, "y", 2.0, 3) for r in rows], COLUMNS)


def collected(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_search_is_optimal(seed):
    rng = random.Random(seed)
    for n in [*range(9), 20, 45]:
        for _ in range(25):
            initials = "".join(rng.choice("suao") if rng.random() < 0.5 else "ua"[k % 2] for k in range(n))
            faults = "".join(rng.choice("kkktx") for _ in range(n))
            ways = search(initials, faults, START)
            assert min(ways[s] for s in DONE if s in ways) == cheapest(initials, faults), (initials, faults)


def test_report_matches_hand(table):
    rows = chats(7)
    damaged = repair_report(table(rows), repair.damage(table(rows)))
    assert collected(damaged) == by_hand(rows)
    assert collected(repair_report(table(rows))) == by_hand(rows, damaged=False)


def test_long_conversations_are_joined_from_segments(table, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 4)
    rows = chats(11, n=6, longest=150)
    assert collected(repair_report(table(rows), repair.damage(table(rows)))) == by_hand(rows)


def test_repaired_turns(table):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "assistant", "B."), (2, 0, "user", "u?"), (2, 1, "user", "u?")]
    turns = ordered(plain_rows(table(rows)))
    found = repairs(turns)
    written: dict = {}
    for r in sorted(replay(turns, found).collect(), key=lambda r: (r.key, r.place)):
        written.setdefault(r.key, []).append((r.edit, r.role, r.text))
    audits = {r.key: r.audit for r in found.collect()}
    assert "".join(r[1][0] for r in written["=1"]) in ("sua", "ua", "suaua") and "".join(e for e, *_ in written["=1"]) == audits["=1"].replace("D", "")
    sums = {r.key: r.repaired_sha256 for r in digests(turns, found).collect()}
    assert sums["=1"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in written["=1"]).encode()).hexdigest()


def test_awkward(table, spark):
    long = "word " * 40_000 + "end."
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, 5, "assistant", long), (5, 1, "user", "same."), (5, 1, "user", "same."), (6, None, "assistant", "a" * 90_000)]
    assert collected(repair_report(table(rows))) == by_hand(rows, damaged=False)
    assert collected(repair_report(table(rows), repair.damage(table(rows)))) == by_hand(rows)
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    report = collected(repair_report(table([(gone, 1, "user", "x.")]), repair.damage(table([(gone, 1, "user", "x.")]))))
    assert report == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    empty = table(rows).where("false")
    assert repair_report(empty, repair.damage(empty)).count() == 0


def test_query_matches_hand(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op12_conversation_repair"](spark, sf)) == by_hand(rows)
