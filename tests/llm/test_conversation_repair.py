import hashlib
import heapq
import random
import re
import zlib

import pytest

from trajspark.llm.conversation_repair import Node, damaged, repair_conversations

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """All edits by rising (cost, audit); rows are (role, text, fault)."""
    heap, tick = [(0, "", 0, (), ())], 0
    while True:
        cost, audit, _, at, out = heapq.heappop(heap)
        at = len(at)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
            return cost, audit, out
        moves = []
        if at < len(rows):
            role, text, fault = rows[at]
            extra = fault == "truncated"
            moves.append((3, "D", 1, []))
            if fault not in ("blank", "duplicate"):
                moves.append((extra, "K", 1, [(role, text)]))
                moves += [(2 + extra, "R", 1, [(r, text)]) for r in ("user", "assistant")]
        moves += [(2, "I", 0, [(r, "")]) for r in ("user", "assistant")]
        for price, letter, step, more in moves:
            new = out + tuple(more)
            if re.fullmatch("(s?(ua)*u?)?", "".join(r[:1] or "-" for r, _ in new)):
                tick += 1
                heapq.heappush(heap, (cost + price, audit + letter, tick, (0,) * (at + step), new))


def expected(rows, damage):
    """rows of one conversation: (conv_id, turn, role, text)"""
    got = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        fate = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20 if damage else 99
        role, text = shown[2], shown[3]
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        got += [(turn, role, text)] * (2 if fate == 3 else 1)
    got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, judged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in got:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role, text, fault))
    turns = [t for t, _, _ in got if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1], b[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(got, got[1:], strict=False))
    cost, audit, out = cheapest(judged)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, *counts.values(), illegal, cost, audit, sha


def found(df, **options):
    out = {}
    for r in repair_conversations(df, **options).collect():
        assert r.conv_id not in out
        out[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
    return out


def conversations(n, seed):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No", "Maybe?\n", " \t", "", "Well!  ", "one two.", None, "a. ", "no.b", "é!"]
    for c in range(n):
        for t in range(rng.randint(1, 6)):
            turn = None if rng.random() < 0.05 else rng.choice([t, t, t, t + 3, t - 1])
            rows.append((c, turn, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "admin", "", None]), rng.choice(texts)))
    return rows + [(None, 1, "user", "x."), (None, None, "assistant", "y."), (900, 5, None, None), (901, None, "assistant", "z")]


@pytest.mark.parametrize("damage", [None, damaged])
def test_against_all_edits(spark, damage):
    rows = conversations(150, 4)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert found(df, damage=damage) == {c: expected(r, damage) for c, r in by.items()}


def test_odd_tables(spark):
    kind = "conv_id string, turn int, role string, text string, fault int, seen string, signature string"
    df = spark.createDataFrame([("a", 0, "user", "Hi.", 1, "s", "x"), ("a", 1, "assistant", "Yo.", 2, None, "y")], kind)
    assert found(df)["a"][5:7] == (0, "KK")
    assert found(df.filter("false")) == {}


def test_long_conversation(spark):
    rows = [("long", i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(30_000)]
    rows += [(f"c{i}", j, "user", f"t{j}") for i in range(50) for j in range(3)]
    got = found(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    want = hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows[:30_000]).encode()).hexdigest()
    assert got["long"] == (0, 0, 0, 0, 0, 0, "K" * 30_000, want)
    assert {v[5:7] for k, v in got.items() if k != "long"} == {expected([r for r in rows if r[0] == "c1"], None)[5:7]}


def test_a_node_is_made_once(monkeypatch):
    import pyarrow as pa

    from trajspark.llm import conversation_repair as cr

    made = []
    plain = Node.__init__
    monkeypatch.setattr(Node, "__init__", lambda self, letter="", behind=None: (made.append(letter), plain(self, letter, behind))[1])
    backwards = sorted(s[::-1] for s in ("uaua", "suaua", "xaua", "ua", "UA", "dua"))
    batches = iter([pa.record_batch([pa.array(backwards), pa.array(backwards)], ["backwards", "signature"])])
    list(cr._solved(batches))
    assert len(made) == 1 + len({b[:i] for b in backwards for i in range(1, len(b) + 1)})
