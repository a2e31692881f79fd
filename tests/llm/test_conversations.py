import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import conversations, queries
from shelfwise.llm.common import bound_batches
from tests.conftest import SF_SMALL
from tests.llm.conftest import LONG, ordered, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def sorted_rows(rows):
    def key(r):
        digest = hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
        return (r[1] is not None, r[1] or 0, digest)
    return sorted(rows, key=key)


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit) over all edits by search in that order, and the repaired rows."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, shape, kept = heapq.heappop(queue)
        state = shape[-1:] if shape in ("", "s") else shape[-1]
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, audit, kept

        def go(price, letter, then, role="", text=None, at=at, cost=cost, audit=audit, shape=shape, kept=kept):
            grown = shape + role[:1]
            if re.fullmatch("(s?(ua)*u?)?", grown):
                heapq.heappush(queue, (cost + price, audit + letter, then, grown,
                                       kept if text is None else (*kept, (role, text))))
        for role in ("user", "assistant"):
            go(2, "I", at, role, "")
        if at < len(rows):
            _, _, role, text = rows[at]
            go(3, "D", at + 1)
            if faults[at] not in ("blank", "duplicate"):
                extra = faults[at] == "truncated"
                if role[:1] and role[:1] in "sua":
                    go(extra, "K", at + 1, role, text)
                for new in ("user", "assistant"):
                    go(2 + extra, "R", at + 1, new, text)


def brute(damaged_rows, ids):
    groups = {i: [] for i in ids}
    for r in damaged_rows:
        groups[r[0]].append(r)
    out = []
    for conv, rows in groups.items():
        rows = sorted_rows(rows)
        faults = faults_of(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        cost, audit, kept = cheapest(rows, faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
                    cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return out


def made(seed, convs=60, longest=30):
    rng = random.Random(seed)
    words = ["Yes.", "No", "so?", "", " \n", "Right.", "ok ", "fine!\n", "é.", "and then"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher"]
    rows = []
    for conv in [*range(convs), None]:
        fixed = rng.choice([None, None, "user", "assistant"])
        for turn in range(rng.randint(0, longest)):
            text = rng.choice(words) if rng.random() < 0.4 else f"part {turn} of {conv}" + rng.choice([".", "!", ""])
            role = fixed if fixed and rng.random() < 0.9 else rng.choice(roles) if rng.random() < 0.3 else roles[turn % 2]
            rows.append((conv, rng.choice([turn, turn, turn, turn // 3, None]), role, rng.choice([text, text, text, None])))
    return rows


@pytest.mark.parametrize("chunk, passes", [(128, 4), (3, 4), (2, 0), (1, 1)])
def test_audit_equals_a_full_search(spark, chunk, passes):
    bound_batches(spark)
    rows = made(chunk)
    table = spark.createDataFrame(rows, SCHEMA)
    hurt = conversations.damage(table)
    assert ordered(rows_of(hurt)) == ordered(damaged(rows))
    got = conversations.audit(hurt, table, chunk_rows=chunk, passes=passes)
    assert ordered(rows_of(got)) == ordered(brute(damaged(rows), dict.fromkeys(r[0] for r in rows)))


def test_query_equals_a_full_search(spark):
    rows = rows_of(spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    got = queries.op11_conversation_repair(spark, SF_SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    assert ordered(rows_of(got)) == ordered(brute(damaged(rows), dict.fromkeys(r[0] for r in rows)))


def test_edges(spark):
    bound_batches(spark)
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", LONG + "."), (2, None, None, None), (3, 5, "user", "Hi.")] + [
        (4, 7, "user", "Again.")] * 300 + [(5, t, "user", f"{t}.") for t in range(300)] + [
        (6, t, "tool", " ") for t in range(40)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                  SCHEMA + ", gid long, digest string, lid long")
    for chunk, passes in ((16, 1), (128, 4)):
        got = conversations.audit(table, chunk_rows=chunk, passes=passes)
        plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        assert ordered(rows_of(got)) == ordered(brute(plain, range(1, 7)))
    lost = spark.createDataFrame([(9, 1, "user", "x"), (9, 1, "user", "x")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(conversations.audit(lost.where("turn = 2"), lost)) == [(9, 0, 0, 0, 0, 0, 0, "", empty)]
    assert conversations.audit(lost.where("turn = 2")).count() == 0


def test_repaired_rows_are_the_audited_ones(spark):
    bound_batches(spark)
    rows = damaged(made(5))
    table = spark.createDataFrame(rows, SCHEMA)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in conversations.audit(table, chunk_rows=4).collect()}
    groups = {}
    for r in sorted(conversations.repair(table, chunk_rows=4).collect(), key=lambda r: (repr(r[0]), r["position"])):
        groups.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["edit"], r["turn"]))
    empty = hashlib.sha256(b"").hexdigest()
    for conv, digest in digests.items():
        found = groups.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, *_ in found))
        assert digest == (hashlib.sha256("\n".join(f"{r}:{t}" for r, t, *_ in found).encode()).hexdigest()
                          if found else empty)
        assert all((turn is None and not text) for _, text, edit, turn in found if edit == "I")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 15), min_size=1, max_size=40), st.integers(0, 40))
def test_vectors_meet_after_few_rows_or_by_matrices(codes, cut):
    """Fix-up from the neighbour's vector equals one run over the whole, and so do the matrices."""
    steps, cut = conversations.Steps(), min(cut, len(codes))
    left, right = bytes(codes[:cut]), bytes(codes[cut:])
    whole = conversations.backward(bytes(codes), conversations.END, steps)
    tail = conversations.backward(right, conversations.END, steps)
    guess = conversations.backward(left, conversations.END, steps)
    assert conversations.backward(left, tail[0], steps, guess) == whole[:cut + 1]
    matrix = conversations.transfer(left)
    costs = [min(matrix[4 * s + t] + tail[0][t] for t in range(4)) for s in range(4)]
    assert tuple(c - min(costs) for c in costs) == whole[0]
