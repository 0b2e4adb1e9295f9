import hashlib
import random
import zlib
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import conversation_repair as C

BLANKS = " \t\n\x0b\x0c\r"


def fits(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (len(rest) >= 2 and rest == "ua" * (len(rest) // 2))


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        visible = text.strip(BLANKS)
        found.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def brute(rows):
    """(cost, audit, repaired) of the cheapest edits by search over all of them, with up to two insertions at a place."""
    faults = faults_of(rows)

    @lru_cache(None)
    def best(i, roles):
        # `roles` is s?, then u and a in turn: whatever is no start of a good conversation is cut off
        options = []
        for k in range(3):
            for inserted in product("ua", repeat=k):
                now = roles + "".join(inserted)
                if not fits(now) and not fits(now + "a") and not fits(now + "ua"):
                    continue
                now = now[:1] + now[1 + (len(now) - 1) // 2 * 2:] if len(now) > 3 and now[0] != "s" else now
                cost, edits = 3 * k, "I" * k
                new = tuple((("user" if r == "u" else "assistant"), "") for r in inserted)
                if i == len(rows):
                    if fits(now):
                        options.append((cost, edits, new))
                    continue
                role, text = rows[i]
                after = [(4, "D", now, ())]
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 if faults[i] else 0
                    after.append((more, "K", now + (role[:1] or "?"), ((role, text),)))
                    after += [(more + 3, "R", now + r[0], ((r, text),)) for r in ("user", "assistant")]
                for c, e, next_roles, out in after:
                    if fits(next_roles) or fits(next_roles + "a") or fits(next_roles + "ua"):
                        short = next_roles[0] + next_roles[-2:] if next_roles[:1] == "s" and len(next_roles) > 3 else next_roles[-2:] if len(next_roles) > 3 else next_roles
                        short = {"au": "u", "sua": "sua", "sau": "su"}.get(short, short)
                        rest = best(i + 1, short)
                        options.append((cost + c + rest[0], edits + e + rest[1], new + out + rest[2]))
        return min(options, key=lambda o: o[:2])

    return best(0, "")


def by_automaton(rows):
    codes = []
    for (role, _), fault in zip(rows, faults_of(rows)):
        code = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
        codes.append(8 if fault in ("blank", "duplicate") else code + 4 * (fault == "truncated"))
    signature = "".join(map(str, codes))
    batch = C.pa.RecordBatch.from_pydict({"b": [signature[::-1]], "n": [1]})
    row = next(C._audits(iter([batch]))).to_pylist()[0]
    repair, out = C._Repair(row), []
    for pair in [*rows, (None, None)]:
        out += [(r, t) for e, r, t in repair.turns(*pair) if e != "D"]
    return row["cost"], row["audit"], tuple(out)


TURN = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "sam", "ulf"]), st.sampled_from(["", " \n", "a.", "b!", "c", "d? ", "e . f", "g"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(TURN, max_size=9))
def test_audits_are_the_cheapest_and_ascii_least(rows):
    assert by_automaton(rows) == brute(rows)


def test_nodes_are_few_and_shared():
    rng = random.Random(1)
    automaton = C.Minimal()
    signatures = sorted("".join(rng.choice("0123456789"[:9]) for _ in range(rng.randint(0, 300))) for _ in range(400))
    batch = C.pa.RecordBatch.from_pydict({"b": signatures, "n": [1] * len(signatures)})
    assert sum(len(b) for b in C._audits(iter([batch]))) == 400
    for s in signatures:
        node = automaton.start
        for symbol in s:
            node = automaton.step(node, int(symbol))[0]
    assert len(automaton.nodes) < 200


def brute_table(rows):
    """The registered result from plain rows (conv_id, turn, role, text)."""
    kept, ids = {}, set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        kept.setdefault(conv, []).extend([(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    found = {}
    for conv in ids:
        ordered = sorted(kept.get(conv, []), key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = [t for known, t, _, _ in ordered if known]
        pairs = [(r, t) for _, _, r, t in ordered]
        faults, initials = faults_of(pairs), [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = brute(pairs)
        lines = "\n".join(f"{r}:{t}" for r, t in out)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return found


@pytest.mark.parametrize("source", ["table", "odd"])
def test_query_matches_brute_force(spark, source):
    if source == "table":
        frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    else:
        rng = random.Random(4)
        texts = ["", None, " ", "a.", "b", "c!", "Long " * 30_000 + "end.", "é?", "d.\n", "x" * 70 + "1", "x" * 70 + "2."]
        rows = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(texts), "k", 1, 2.0) for _ in range(260)]
        rows += [(500, None, "user", "a.", "k", 1, 2.0), (501, 7, None, None, "k", 1, 2.0)]
        frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, audit string, rank int, plan double")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    wanted = brute_table(rows)
    found = {r.conv_id: tuple(r) for r in C.repair_conversations(C.damage(frame)).collect()}
    assert set(found) == set(wanted)
    wrong = [(found[k], wanted[k]) for k in wanted if found[k] != wanted[k]]
    assert not wrong, wrong[:2]


def test_repaired_turns_are_good_conversations(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = C.damage(frame)
    plans = C.plan_repairs(rows).cache()
    turns = {}
    for r in C.repaired_turns(rows, plans).collect():
        turns.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    digests = {r.conv_id: r.repaired_sha256 for r in C.repair_digests(rows, plans).collect()}
    for conv, digest in digests.items():
        own = sorted(turns.get(conv, []))
        assert fits("".join(r[:1] for _, r, _ in own)) and [p for p, _, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in own).encode()).hexdigest() == digest


def test_long_conversation_and_empty_table(spark):
    long = spark.range(60_000).selectExpr("1L as conv_id", "id as turn", "if(id % 7 = 0, 'user', 'assistant') as role", "concat('t', id % 5000, if(id % 3 = 0, '', '.')) as text")
    row = C.repair_conversations(C.damage(long)).collect()
    assert len(row) == 1 and row[0].duplicate > 20_000 and len(row[0].audit) >= 55_000
    assert C.repair_conversations(C.damage(long.limit(0))).collect() == []
