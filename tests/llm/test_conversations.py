import hashlib
import random
import re
import zlib

import pytest

from voltframe.llm import conversations as C

LAST = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)")


def plain(rows):
    """All labels of the lattice of one conversation, row by row to a fixed point; rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = LAST.search(text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last.group() not in ".!?" else None)
        seen.add((role, text))
    labels, todo = {(0, ""): (0, "", [])}, [(0, "")]
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    while todo:
        todo.sort(key=lambda v: (-v[0], -labels[v][0]))     # row by row
        i, state = node = todo.pop()
        cost, audit, kept = labels[node]
        moves = [((i, x), 3, "I", [({"u": "user", "a": "assistant"}[x], "")]) for x in after[state] if x != "s"]
        if i < len(rows):
            _, role, text = rows[i]
            moves.append(((i + 1, state), 4, "D", []))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if role[:1] and role[:1] in after[state]:
                    moves.append(((i + 1, role[:1]), more, "K", [(role, text)]))
                moves += [((i + 1, x), 3 + more, "R", [({"u": "user", "a": "assistant"}[x], text)]) for x in after[state] if x != "s"]
        for to, more, letter, row in moves:
            label = (cost + more, audit + letter, kept + row)
            if to not in labels or label[:2] < labels[to][:2]:
                labels[to] = label
                todo.append(to)
    cost, audit, kept = min(labels[len(rows), s] for s in ("", "a") if (len(rows), s) in labels)
    turns = [t for t, _, _ in rows if t is not None]
    roles = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def brute(rows):
    """The contract's rows; rows of one turn are taken to be equal."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        code = zlib.crc32(name.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        convs.setdefault(conv, []).extend([] if code == 0 else [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1))
    order = lambda r: (r[0] is not None, r[0] or 0)                     # noqa: E731
    return sorted(((c, *plain(sorted(found, key=order))) for c, found in convs.items()), key=str)


def ran(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    return asked(C.repair(C.damaged(df), dropped="dropped", times="times", digest=True, **options))


def asked(done):
    got = C.digests(done).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in got.collect()), key=str)


def made(seed, convs, longest):
    rng, rows = random.Random(seed), []
    words = ["Yes.", "No", "Why? ", " ", "", None, "Fine!\n", "Go on", "Hm.", "So be it."]
    for c in range(convs):
        for turn in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(words) if rng.random() < 0.4 else f"{turn} {rng.random()}" + rng.choice([".", "", "?"])
            rows.append((c, turn + rng.choice([0, 0, 0, 1000]), role, text))
    return list({(r[0], r[1]): r for r in rows}.values())


def test_least_audit_of_the_cheapest_edits():
    rng = random.Random(5)
    for _ in range(500):
        rows = [(t, rng.choice(["user", "assistant", "system", "x", ""]), rng.choice(["a", "a.", "", f"{t}", f"{t}?"])) for t in range(rng.randint(0, 9))]
        seen, entries = set(), []
        for t, role, text in rows:
            fault = "blank" if not text else "duplicate" if (role, text) in seen else "truncated" if text[-1] not in ".?" else None
            entries.append((t, role, text, 1, fault))
            seen.add((role, text))
        (way,), _ = C._whole(entries)
        assert (way["cost"], way["audit"]) == plain(rows)[5:7]


def test_no_way_between_some_states():
    assert C.cheapest([], (C.USER,), (C.SYSTEM,)) is None and C.cheapest([("u", False, False)], (C.ASSISTANT,), (C.START,)) is None
    assert C.cheapest([], (C.START,), C.ACCEPTED) == (0, "")


@pytest.mark.parametrize("size", [3, C.SEGMENT])
def test_conversations_in_one_and_in_many_segments(spark, size):
    rows = made(1, 60, 12) + [(1000, t, "user" if t % 2 else "assistant", f"{t // 5}.") for t in range(700)]
    rows += [(None, 3, "user", "Null conversation."), (None, None, "system", "first"), (1001, None, "user", "only a null turn"), (1002, 0, None, None)]
    assert ran(spark, rows, size=size) == brute(rows)


def test_repeated_rows_are_counted_not_carried(spark):
    rows = [(5, 1, "user", "Same.")] * 500 + [(5, 2, "assistant", "Other.")] * 3 + [(6, 1, "user", "Same.")]
    assert ran(spark, rows) == brute(rows)
    cut = C.segments(C.laid_out(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text", None, None))
    assert cut.agg({"n": "max"}).first()[0] <= 503 and cut.count() < 10


def test_dropped_rows_leave_their_conversation(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    want = [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert ran(spark, [(gone, 0, "user", "Dropped.")]) == want == brute([(gone, 0, "user", "Dropped.")])


def test_what_remains_as_rows_and_other_names(spark):
    rows = [("c", 1, "system", "Be brief.", 9), ("c", 2, "user", "Hi.", 9), ("c", 3, "user", "Hi.", 9), ("d", 1, "assistant", "Alone.", 9)]
    df = spark.createDataFrame(rows, "talk string, nth int, who string, said string, PART int")
    done = C.repair(df, "talk", "nth", "who", "said")
    left = {r.conv: [(x.edit, x.turn, x.role, x.text) for x in r.fixed] for r in done.segments.collect() if r.fixed}
    # deleting the copy costs 4, an answer 3
    assert left["c"] == [("K", 1, "system", "Be brief."), ("K", 2, "user", "Hi."), ("I", None, "assistant", "")]
    assert left["d"] == [("I", None, "user", ""), ("K", 1, "assistant", "Alone.")]
    assert {(r.conv, r.cost, r.audit) for r in done.conversations.collect()} == {("c", 7, "KKDI"), ("d", 3, "IK")}
    assert C.repair(df.where("false"), "talk", "nth", "who", "said").conversations.count() == 0
