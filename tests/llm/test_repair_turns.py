"""Repair of conversations against the cheapest of all edits, written out."""

import hashlib
import random
import re
import zlib

from gridtide.llm import repair_turns as rt

PATTERN = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """Least (cost, audit) by going through all states row by row; ``rows``: (initial, must go, truncated)."""

    def with_inserts(states):
        for _ in range(3):
            for given, (cost, audit) in list(states.items()):
                for role in "ua":
                    add(states, given, role, cost + 2, audit + "I")
        return states

    def add(states, given, role, cost, audit):
        # What the pattern asks next depends only on whether there is anything, and on the last role.
        if (given, role) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
            if role not in states or (cost, audit) < states[role]:
                states[role] = (cost, audit)

    states = with_inserts({"": (0, "")})
    for initial, must_go, truncated in rows:
        after = {}
        for given, (cost, audit) in states.items():
            gone = (cost + 3, audit + "D")
            if given not in after or gone < after[given]:
                after[given] = gone
            if not must_go:
                add(after, given, initial, cost + truncated, audit + "K")
                for role in "ua":
                    add(after, given, role, cost + 2 + truncated, audit + "R")
        states = with_inserts(after)
    return min(states[s] for s in ("", "a") if s in states)


def test_search():
    draw = random.Random(1)
    number = {"s": rt.S, "u": rt.U, "a": rt.A, "x": rt.OTHER}
    for k in range(3000):
        n = draw.randrange(200) if k % 50 == 0 else draw.randrange(14)
        rows = [(draw.choice("suauax"), draw.random() < 0.15, draw.random() < 0.3) for _ in range(n)]
        coded = bytes(number[i] | rt.MUST_GO * must | rt.TRUNCATED * (cut and not must) for i, must, cut in rows)
        assert rt.search(coded) == cheapest([(i, must, cut and not must) for i, must, cut in rows])


def test_search_is_quick_for_long_conversations():
    draw = random.Random(2)
    rows = bytes(draw.choice([rt.S, rt.U, rt.A, rt.OTHER]) | draw.choice([0, 0, rt.MUST_GO, rt.TRUNCATED]) for _ in range(30_000))
    cost, audit = rt.search(rows)
    assert len(audit) - audit.count("I") == len(rows)
    assert cost >= rt.suffix_bounds(rows)[0][rt.START]


def plain(rows):
    conversations = {}
    for conv_id, turn, role, text in rows:
        after = conversations.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        after += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    out = []
    for conv_id, after in conversations.items():
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        seen, faced, faults = set(), [], [0, 0, 0]
        for _, role, text in after:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            faced.append((role[:1] or "-", fault in (0, 1), fault == 2))
        turns = [r[0] for r in after if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faced, faced[1:]))
        cost, audit = cheapest(faced)
        kept, place = [], 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else after[place][1:]
            place += edit != "I"
            if edit != "D":
                kept.append((edit, role, text))
        odd = len(kept) % 2
        lines = [f"{role if edit == 'K' else ['user', 'assistant'][(k - odd) % 2]}:{text}" for k, (edit, role, text) in enumerate(kept)]
        initials = "".join(line[0] for line in lines)
        assert PATTERN.fullmatch(initials)
        out.append((conv_id, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_repair(llm):
    draw = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(draw.randrange(1, 9)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            text = draw.choice([f"Turn {turn}.", "Same words?", "cut off in the", None, "", " \n", "Ends. \t", "é!\n"])
            rows.append((conv, None if draw.random() < 0.05 else turn + draw.choice([0, 0, 0, 1]), role, text))
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (700, 5, "user", "long " * 50_000 + "."), (700, 6, "assistant", "Yes.")]
    rows += [(800, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(1500)]
    gone = next(c for c in range(900, 2000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    rows += [(gone, 0, "user", "All of this goes.")]
    frame = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS kind", "2 AS gone", "'z' AS audit", "4 AS same").repartition(7)
    got = sorted(map(tuple, rt.op13(llm, frame).collect()), key=repr)
    want = plain(rows)
    assert got == want
    assert [r[1:] for r in want if r[0] == gone] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert rt.op13(llm, frame.limit(0)).count() == 0
