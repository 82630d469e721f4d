import hashlib
import heapq
import random
import re
import zlib

import pytest

from moorage.llm import conversations
from moorage.llm.conversations import Search, damaged, repair_report, repaired_rows
from moorage.llm.queries import op13_conversation_repair

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
WHITE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """Cost, letters and repaired rows by trying everything, cheapest first, ties by letters.

    ``rows``: role, text, forced, truncated. Repaired initials are cut off where no ending can be legal any more.
    """
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, initials, out = heapq.heappop(heap)
        if at == len(rows) and GRAMMAR.match(initials):
            return cost, letters, out
        if (at, letters, initials) in seen:
            continue
        seen.add((at, letters, initials))

        def offer(extra, letter, place, initial="", line=None):
            longer = initials + initial
            if re.match(r"s?(ua)*u?\Z", longer):
                heapq.heappush(heap, (cost + extra, letters + letter, place, longer, out if line is None else (*out, line)))

        if not letters.endswith("III"):
            for initial, name in NAMES.items():
                offer(5, "I", at, initial, f"{name}:")
        if at < len(rows):
            role, text, forced, truncated = rows[at]
            offer(2, "D", at + 1)
            if not forced:
                if role:
                    offer(5 * truncated, "K", at + 1, role[0], f"{role}:{text}")
                for initial, name in NAMES.items():
                    offer(1 + 5 * truncated, "R", at + 1, initial, f"{name}:{text}")
    raise AssertionError


def digest(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def brute(rows):
    """Report on the rows (turn, role, text) of one conversation after damage, in order."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    judged, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.strip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, letters, out = cheapest(judged)
    return (gaps, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, digest(out))


def damage(rows):
    """Rows (conv, turn, role, text) as the contract damages them, by conversation."""
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        held[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in held.items()}


def random_rows(draw, size):
    roles = ["user", "assistant", "system", "tool", "", "u", "s"]
    return [(draw.choices(roles, (6, 6, 2, 1, 1, 1, 1))[0], draw.choice(["a.", "b.", "c", "d!", "é?"]) + str(i) * draw.randrange(2), draw.random() < 0.2, draw.random() < 0.25) for i in range(size)]


@pytest.mark.parametrize("pending", [0, 5, 1 << 20])
def test_search_against_trying_everything(pending):
    draw = random.Random(pending)
    for _ in range(250):
        rows = [(r, t, f, c and not f) for r, t, f, c in random_rows(draw, draw.randrange(8))]
        search = Search(pending)
        for row in rows:
            search.push(*row)
        cost, letters, out = cheapest(rows)
        assert search.finish() == (cost, letters, digest(out)), rows


def test_long_conversations_agree_early_and_whatever_waits():
    draw = random.Random(2)
    rows = [(r, t, f, c and not f) for r, t, f, c in random_rows(draw, 5000)]
    for fixed in (rows, [("tool", "x.", False, False)] * 3000, [("system", "x.", False, False)] * 3000, [("user", "", True, False)] * 3000):
        found = []
        for pending in (1, 1000, 1 << 30):
            search, most = Search(pending), 0
            for row in fixed:
                search.push(*row)
                most = max(most, search.waiting)
            found.append(search.finish())
            assert most <= max(pending, 1) + 5 or pending == 1 << 30
        assert len(set(found)) == 1


def test_survivors_agree_within_a_few_rows():
    search = Search()
    for i in range(10_000):
        search.push(("user", "assistant")[i % 2], "text.", False, False)
    assert search.waiting < 100 and len(search.survivors) <= 3


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def many(draw, conversations_=400):
    rows = []
    for conv in range(conversations_):
        for turn in range(draw.randrange(7)):
            role = draw.choices(["user", "assistant", "system", "tool", "", None], (8, 8, 2, 1, 1, 1))[0]
            text = draw.choice([f"t {turn}.", "again.", "cut", "", None, " \t\n", "end! \n", " ", "é. "])
            rows.append((conv, draw.choices([turn, None, turn * 3], (8, 1, 2))[0], role, text))
    return rows + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, "system", "c.")]


def test_query_against_brute_force(spark, stored):
    rows = many(random.Random(4))
    extra = [(*r, "conv") for r in rows]
    folder = stored(conversations=(extra, SCHEMA + ", digest string"))
    got = {r.conv_id: tuple(r)[1:] for r in op13_conversation_repair(spark, folder).collect()}
    wanted = {conv: brute(held) for conv, held in damage(rows).items()}
    assert got == wanted
    assert any(not held for held in damage(rows).values())


def test_repeated_rows_and_repeated_turns(spark, stored):
    rows = [(1, 1, "user", "a."), (1, 2, "assistant", "b.")] * 3 + [(2, None, "user", "x" * 100 + e) for e in (".", "?", "!")]
    folder = stored(conversations=(rows, SCHEMA))
    got = {r.conv_id: r for r in op13_conversation_repair(spark, folder).collect()}
    wanted = {conv: brute(held) for conv, held in damage(rows).items()}
    assert tuple(got[1])[1:] == wanted[1] and got[1].duplicate >= 4
    assert (got[2].duplicate, got[2].gaps, got[2].illegal) == (wanted[2][2], 0, wanted[2][4]) and got[2].cost == wanted[2][5]


def test_repaired_rows_have_the_digest_of_the_report(spark):
    rows = spark.createDataFrame(many(random.Random(9)), SCHEMA)
    broken = damaged(rows)
    report = repair_report(broken)
    lines = {}
    for r in sorted(repaired_rows(broken, report).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(r)
    for r in report.collect():
        mended = lines.get(r.conv_id, [])
        assert r.repaired_sha256 == digest([f"{m.role}:{m.text}" for m in mended])
        assert "".join(m.edit for m in mended) == r.audit.replace("D", "")
        assert GRAMMAR.match("".join(m.role[0] for m in mended))


def test_whole_table(spark):
    from tests.llm.conftest import SMALL

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in op13_conversation_repair(spark, SMALL).collect()}
    assert got == {conv: brute(held) for conv, held in damage(rows).items()}


def test_long_conversation_in_small_waiting_room(spark, monkeypatch):
    rows = [(1, i, ("user", "tool")[i % 7 == 0], f"t{i}.") for i in range(3000)]
    df = damaged(spark.createDataFrame(rows, SCHEMA))
    whole = [tuple(r) for r in repair_report(df).collect()]
    monkeypatch.setattr(conversations, "PENDING", 10)
    assert whole == [tuple(r) for r in repair_report(df).collect()]
