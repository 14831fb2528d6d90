import hashlib
import random
import re
from collections import defaultdict

import pytest

from corpusloom.llm import repair as R

FIELDS = "conv_id bigint, turn bigint, role string, text string, conv string, place int"
GIVE, LEAD = {0: "user", 1: "user", 2: "assistant", 3: "user"}, {0: 2, 1: 2, 2: 3, 3: 2}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "sound" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, audit) with its lines, by trying every edit from every state, forward."""
    best = {0: (0, "", ())}

    def inserted(ways):
        ways, todo = dict(ways), list(ways)
        while todo:
            s = todo.pop()
            cost, audit, lines = ways[s]
            made = (cost + 5, audit + "I", (*lines, f"{GIVE[s]}:"))
            if LEAD[s] not in ways or made[:2] < ways[LEAD[s]][:2]:
                ways[LEAD[s]] = made
                todo.append(LEAD[s])
        return ways
    for (role, text), fault in zip(rows, faults(rows)):
        new = {}
        for s, (cost, audit, lines) in inserted(best).items():
            steps = [(s, 2, "D", ())]
            if fault in ("sound", "truncated"):
                extra = 5 * (fault == "truncated")
                steps.append((LEAD[s], 1 + extra, "R", (f"{GIVE[s]}:{text}",)))
                if (s == 0 and role[:1] == "s") or role[:1] == GIVE[s][0]:
                    steps.append(({"s": 1, "u": 2, "a": 3}[role[0]], extra, "K", (f"{role}:{text}",)))
            for to, more, letter, said in steps:
                made = (cost + more, audit + letter, lines + said)
                if to not in new or made[:2] < new[to][:2]:
                    new[to] = made
        best = new
    return min(way for s, way in inserted(best).items() if s in (0, 3))


def expected(table):
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        groups[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        said = [r[2:] for r in rows]
        found, turns = faults(said), {r[1] for r in rows if r[0]}
        cost, audit, lines = cheapest(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines))
    return out


def check(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], FIELDS).repartition(3)
    repair = R.Repair(table)
    want = expected(rows)
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert sorted((tuple(r) for r in repair.summary().select(*names).collect()), key=repr) == sorted((w[:-1] for w in want), key=repr)
    turns = defaultdict(dict)
    for r in repair.turns().collect():
        turns[r.conv_id][r.nth] = f"{r.role}:{r.text}"
    assert {c: tuple(t[i] for i in range(len(t))) for c, t in turns.items()} == {w[0]: w[-1] for w in want if w[-1]}
    for w in want:
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in w[-1]))


AWKWARD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 4, "assistant", "Yes."), (1, 5, "user", "cut"),
    (2, None, None, None), (2, None, "user", "a."), (2, 3, "", "b."), (2, 3, "", "b."), (None, 1, "user", "x."), (None, None, "assistant", "y!"),
    (3, 1, "tool", "z."), (4, 1, "user", " \n\t"), (5, 7, "user", "é.  "), (5, 9, "Assistant", "w" * 200_000), (6, 1, "system", "only."),
    (7, 1, "user", "same."), (7, 1, "user", "same."), (7, 1, "user", "same."), (8, 2**40, "user", "u."), (8, -2**40, "assistant", "a.\r\n"),
]


def test_awkward_rows(spark):
    check(spark, AWKWARD)
    empty = R.Repair(spark.createDataFrame([], FIELDS))
    assert empty.summary().count() == 0 and empty.turns().count() == 0


def test_conversations_over_many_blocks(spark, monkeypatch):
    """Blocks of four rows; one conversation holds a third of all rows."""
    monkeypatch.setattr(R, "SHORTEST_BLOCK", 4)
    monkeypatch.setattr(R.Repair, "_block_size", lambda self: 4)
    rng = random.Random(7)
    rows = []
    for conv, size in [(1, 400), *((c, rng.randrange(1, 30)) for c in range(2, 60))]:
        for turn in range(size):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            text = rng.choice([f"t{turn}.", f"t{turn}!", f"t{turn}", "", "again.", f"u{rng.randrange(9)}?"])
            rows.append((conv, turn + rng.randrange(2), role, text))
    check(spark, rows)


def test_damage_is_laid_in_by_checksum(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = defaultdict(list)
    for r in R.damage(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect():
        got[r.conv_id, r.turn].append((r.role, r.text))
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        want = {0: [], 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: [(role, text)] * 2, 4: [("user", text)]}.get(fate, [(role, text)])
        assert got[conv, turn] == want


@pytest.mark.parametrize("size", (1, 5000))
def test_block_size_follows_the_longest_conversation(spark, size):
    rows = spark.range(size).selectExpr("1L as conv_id", "id as turn", "'user' as role", "'x.' as text")
    assert R.Repair(rows)._block_size() == (64 if size == 1 else 128)
