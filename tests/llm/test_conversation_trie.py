"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pandas as pd
import pytest

from shopflow.llm import conversation_trie as ct
from shopflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, depth string, key long"


def sort_key(turn):
    return (turn[0] is not None, turn[0] or 0)


def brute(rows):
    """Rows (conv_id, turn, role, text) whose (conv_id, turn) are distinct -> set of result rows."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t, r or "", x or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v, key=sort_key)] for c, v in convs.items()}
    made = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(convs.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out, total = set(), {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        total[p] = (sum(total[k][0] for k in kids[p]) or 1, own + sum(total[k][1] for k in kids[p]))
        ends = ",".join(str(c) for c in members[p] if len(made[c]) == len(p))
        out.add((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), *total[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in ct.trie(df, **how).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def forest(seed, convs, longest, words, roles=2):
    rng = random.Random(seed)
    return [(c, t, ["user", "assistant", None][rng.randrange(roles)], f"w{rng.randrange(words)}" * rng.randrange(1, 4))
            for c in convs for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("width,turns", [(32, 1 << 18), (4, 20), (1, 5)])
def test_equals_a_dictionary_of_prefixes(spark, width, turns):
    check(spark, forest(1, range(60), 14, 2, 1), width=width, shard_turns=turns)


def test_hot_conversation_copies_and_common_first_turn(spark):
    rows = [(7, t, "user", f"long {t % 3}") for t in range(400)] + [(8, t, "user", f"long {t % 3}") for t in range(390)]
    rows += [(100 + c, t, "user", ["same", "copy", f"end {c % 2}"][t]) for c in range(150) for t in range(3)]
    rows += [(1000 + c, 0, "system", "same") for c in range(60)]
    check(spark, rows, width=16, shard_turns=100)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (-7, None, None, None), (-7, 3, "user", ""), (-5, 1, "user", "é" * 40), (0, 2, "a", "b"),
            (1, None, "ab", ""), (1, 0, "a", "b"), (11, 5, "user", "x" * 200000), (12, 0, "", "aab"), (13, 0, "a", "ab"),
            (10 ** 15 + 3, 1, "user", "far"), (2, 0, "a", "b")]
    check(spark, rows)
    check(spark, [])
    check(spark, [(None, 0, "user", "lost")])


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(c, 0, "user", f"t{k}") for c in (5, 6) for k in (3, 1, 2)] * 2
    a, b = ([tuple(r) for r in ct.trie(spark.createDataFrame([(*r, "x", 1) for r in order], SCHEMA).repartition(4)).collect()]
            for order in (rows, rows[::-1]))
    assert sorted(map(repr, a)) == sorted(map(repr, b))
    root = next(r for r in a if r[1] == 0)
    assert root[:4] == (5, 0, None, 2) and sum(r[1] == 6 for r in a) >= 1


def test_query(spark):
    d = pd.read_parquet(f"{SMALL}/conversations.parquet").astype(object)
    d = d.where(d.notna(), None)
    rows = [tuple(r) for r in d[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    assert {tuple(r) for r in QUERIES["op13_conversation_trie"](spark, SMALL).collect()} == brute(rows)
