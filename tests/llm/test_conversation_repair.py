"""Conversation repair against a plain search over (cost, audit) for each state."""
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from retailcast.llm import conversation_repair as C
from retailcast.llm.conversation_repair import repair_conversations

R = random.Random(12)
SCHEMA = "conv_id long, turn long, role string, text string, span int, kinds string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(kept):
    """Least (cost, audit) of all edits; kept: (initial, forced, truncated) for each row."""
    best = {"": (0, "")}

    def add(table, state, cost, audit):
        if state not in table or (cost, audit) < table[state]:
            table[state] = cost, audit

    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    for initial, forced, truncated in kept:
        for _ in range(3):
            for q, (c, w) in list(best.items()):
                add(best, after[q], c + 3, w + "I")
        new = {}
        for q, (c, w) in best.items():
            add(new, q, c + 4, w + "D")
            if not forced:
                if initial == after[q] or (initial == "s" and q == ""):
                    add(new, initial, c + 3 * truncated, w + "K")
                add(new, after[q], c + 3 + 3 * truncated, w + "R")
        best = new
    for _ in range(3):
        for q, (c, w) in list(best.items()):
            add(best, after[q], c + 3, w + "I")
    return min(best[q] for q in ("", "a") if q in best)


def want(rows, damage=True):
    convs = {r[0]: [] for r in rows}
    for r in damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]:
        convs[r[0]].append(r)
    out = {}
    for conv, rs in convs.items():
        tie = lambda r: hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).hexdigest()
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:256].encode(), tie(r)))
        seen, faults, kept = set(), Counter(), []
        for _, _, role, text in rs:
            fault = "blank" if not re.search(r"[^\x20\x09-\x0d]", text) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            kept.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = cheapest(kept)
        turns = [r[1] for r in rs if r[1] is not None]
        lines, at, state = [], 0, ""
        for letter in audit:
            if letter in "IR":
                role, text = ("assistant" if state == "u" else "user"), (rs[at][3] if letter == "R" else "")
            elif letter == "K":
                role, text = rs[at][2:]
            at += letter != "I"
            if letter != "D":
                lines.append(f"{role}:{text}")
                state = role[:1]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
                     sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
    return out


TEXTS = ["Yes.", "No!", "cut off", "Why? ", " ", None, "", "same.", "Ünï\ncode…", "e.", "\x0b", "long " * 300 + "end."]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def check(spark, rows, parts=3, damage=True, **sizes):
    got = repair_conversations(table(spark, rows).repartition(parts), damage=damage, **sizes)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows_got = [tuple(r) for r in got.collect()]
    assert len({r[0] for r in rows_got}) == len(rows_got)
    assert {r[0]: r[1:] for r in rows_got} == want(rows, damage)


def some(n_convs, n_rows, roles):
    return [(c if c else None, R.choice([t, t, t, None, t + R.randint(0, 3)]), R.choice(roles), R.choice(TEXTS)) for c in range(n_convs) for t in range(R.randint(1, n_rows))]


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "Å", "agent"]
SMALL = some(60, 9, ROLES)
LONG = [(5, t, "user" if (t + (t > 77)) % 2 else "assistant", f"row {t}." if t % 13 else "cut") for t in range(300)] + [(6, t // 3, "system", "same.") for t in range(90)] + [(7, t, "tool", f"x {t}.") for t in range(120)]


@pytest.mark.parametrize("rows_of_chunk", [4096, 3, 1])
def test_against_search(spark, rows_of_chunk):
    check(spark, SMALL, chunk_rows=rows_of_chunk)


@pytest.mark.parametrize(("rows_of_chunk", "most"), [(7, 4), (20, 1), (5, 0)])
def test_long_conversations_in_chunks(spark, rows_of_chunk, most):
    """Rows that fit no role keep the vectors apart for ever; products settle them."""
    check(spark, LONG, chunk_rows=rows_of_chunk, most_passes=most)
    check(spark, LONG, damage=False, chunk_rows=rows_of_chunk, most_passes=most)


def test_chunks_converge(spark):
    """Of a usual conversation only the chunks whose end vector was wrong run again, once, and not whole."""
    passes, rows = [], [(1, t, "assistant" if t % 2 else "user", f"row {t}.") for t in range(400)]
    check(spark, rows, damage=False, chunk_rows=40, passes=passes)
    assert 1 < len(passes) <= 3 and passes[0] >= 10
    kinds = bytes([2, 4] * 200)
    spoiled = C.run_back(kinds, (0, 6, 3, 0))
    vectors, added, n = C.run_back(kinds, (-1, 3, 0, 0), spoiled[:2])
    fresh = C.run_back(kinds, (-1, 3, 0, 0))
    assert n < 10 and vectors == fresh[0] and added == fresh[1]


def test_nothing_and_nothing_left(spark):
    assert repair_conversations(table(spark, []), damage=True).count() == 0
    gone = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    check(spark, gone)
    got = repair_conversations(table(spark, gone), damage=True).first()
    assert tuple(got)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_all_rows_alike(spark):
    """A conversation of copies is spread over ranges; all but one of them are repeats."""
    check(spark, [(3, None, "user", "hi.")] * 200 + [(4, 2, "assistant", "ho")] * 100, damage=False, chunk_rows=16)


def test_every_short_conversation():
    """All sequences of four kinds of rows: costs and audits of the backward run and trace."""
    import itertools
    kinds = {("s", False, False): 0, ("u", False, False): 2, ("u", False, True): 3, ("a", False, False): 4, ("a", False, True): 5, ("t", False, False): 6, ("u", True, False): 8}
    for rows in itertools.product(kinds, repeat=4):
        code = bytes(kinds[r] for r in rows)
        vectors, added, _ = C.run_back(code, C.relative(C.END))
        assert (sum(added) + vectors[0][0], C.trace(code, vectors, 0, True)[0]) == cheapest(rows)
