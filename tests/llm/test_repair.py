"""Structure repair against brute force over whole edit sequences, and its SQL over odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from granary.llm import repair
from granary.llm.oracles import REPAIR

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _space(x):
    return " " if x is None else str(x)


def _after_damage(conv, rows):
    out = []
    for turn, role, text in rows:
        kind = zlib.crc32(f"{_space(conv)}:{_space(turn)}".encode()) % 20
        role, text = _space(role), _space(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def _cheapest(rows, faults):
    """(cost, audit, turns), the least of all edit sequences, forward with whole strings."""

    def inserts(ways):
        for _ in range(3):
            for state, (cost, audit, turns) in list(ways.items()):
                to = "a" if state == "u" else "u"
                put(ways, to, (cost + 3, audit + "I", turns + (("user:" if to == "u" else "assistant:"),)))
        return ways

    def put(ways, state, way):
        if state not in ways or way < ways[state]:
            ways[state] = way

    ways = inserts({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new, more = {}, 3 * (fault == "truncated")
        for state, (cost, audit, turns) in ways.items():
            put(new, state, (cost + 4, audit + "D", turns))
            if fault in ("", "truncated"):
                to = "a" if state == "u" else "u"
                if role[:1] == to or (role[:1] == "s" and state == ""):
                    put(new, role[:1], (cost + more, audit + "K", turns + (f"{role}:{text}",)))
                put(new, to, (cost + more + 3, audit + "R", turns + (("user:" if to == "u" else "assistant:") + text,)))
        ways = inserts(new)
    return min(ways[s] for s in ("", "a") if s in ways)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        said, faults, seen = _after_damage(conv, [r[1:] for r in rows if r[0] == conv]), [], set()
        for _, role, text in said:
            marks = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in said if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, kept = _cheapest(said, faults)
        out[conv] = (conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def some_rows(seed, convs, turns):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "assistant", "user", None, "", "tool", "under", "éa"]
    texts = ["a.", "b?", "c", "d ", "e!\n", "", "  ", None, "é.", "f . x", "\u0085", "g. ", " "]
    return [(rng.choice([None, *range(convs)]), rng.choice([None, *range(turns)]), rng.choice(roles), rng.choice(texts)) for _ in range(convs * turns)]


def _check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n long, audit string").repartition(3)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.structure_repair(df).collect()}
    assert got == brute(rows)
    return got


def test_against_all_edits(spark):
    rows = some_rows(1, 120, 7)
    got = _check(spark, rows)
    con = duckdb.connect()
    con.register("conversations", spark.createDataFrame(rows, SCHEMA).toArrow())
    assert {r[0]: r for r in con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({REPAIR})").fetchall()} == got


def test_long_conversations_span_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 3)
    _check(spark, some_rows(2, 4, 120) + [(7, t, "user", "ok.") for t in range(150)] + [(8, 1, "user", "again.")] * 60)


def test_nothing_left_and_nothing(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert _check(spark, [(gone, 0, "user", "a.")])[gone][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.structure_repair(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 100])
def test_checkpoints_keep_a_square_root_of_vectors(n):
    rng = random.Random(n)
    codes, counts = [rng.randrange(12) for _ in range(n)], [rng.randrange(1, 4) if rng.random() < 0.3 else 1 for _ in range(n)]
    counts = [c if code % 3 == repair.GONE else 1 for code, c in zip(codes, counts)]
    width, behind = repair.behind_checkpoints(codes, counts, list(repair.ENDS))
    assert width <= n**0.5 + 1 and len(behind) <= n**0.5 + 3
    whole = list(repair.ENDS)
    for code, count in zip(reversed(codes), reversed(counts)):
        whole = repair.before_row(whole, code, count)
    by_matrix = repair.matrix(codes, counts)
    assert whole == [min(by_matrix[4 * s + e] + repair.ENDS[e] for e in range(4)) for s in range(4)]
    for state in range(4):
        audit, _ = repair.walk(codes, counts, width, behind, state, True)
        cost, at, places = 0, 0, [c for c, k in zip(codes, counts) for _ in range(k)]
        for edit in audit:
            code = places[at] if edit != "I" else 0
            cost += {"D": 4, "I": 3, "K": 0, "R": 3}[edit] + 3 * (edit in "KR" and code % 3 == repair.CUT)
            at += edit != "I"
        assert at == len(places) and cost == whole[state]
