import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from kiln.llm import prefixtrie
from kiln.llm.prefixtrie import SEGMENT, Walk, conversation_turns, keyed_segments, path_segments, prefix_trie, shared_openings

SCHEMA = "conv_id long, turn int, role string, text string"


def rebuilt(rows, every=20, spread=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn, digest), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    drop = {c: zlib.crc32(str(c).encode()) % spread for c in own}
    rem = lambda c: c % every if c >= 0 else -(-c % every)
    return {c: own.get(c - rem(c), [])[:drop[c]] + own[c][drop[c]:] for c in own}


def brute(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in paths.items():
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        saved[p] += (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted((len(p), min(m), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(p))
                  for p, m in members.items())


def trie(df):
    turns = conversation_turns(df)
    out = prefix_trie(keyed_segments(path_segments(shared_openings(turns))))
    return [tuple(r) for r in out.select("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def check(spark, rows, partitions=5):
    got = trie(spark.createDataFrame(rows, SCHEMA).repartition(partitions))
    assert key(got) == key(brute(rebuilt(rows)))


def conversations(r, ids, words, most):
    rows = []
    for c in ids:
        rows += [(c, t, r.choice(("user", "assistant", None)), r.choice(words)) for t in range(r.randint(1, most))]
    return rows


def test_equals_a_trie_in_memory(spark):
    r = random.Random(1)
    rows = conversations(r, range(-45, 400), ["a", "b c", None, "", " x\ty\x0bz "], 5)
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (None, 1, "user", "lost"), (3, 2, "user", "a"), (3, 2, "user", "a")]
    check(spark, rows)


def test_conversations_longer_than_segments(spark):
    r = random.Random(2)
    rows = []
    base = [("user", f"turn {t % 5}") for t in range(3 * SEGMENT)]
    for c in range(60):
        n = r.choice((SEGMENT - 1, SEGMENT, SEGMENT + 1, 2 * SEGMENT, 2 * SEGMENT + 3, 3 * SEGMENT, 2))
        turns = base[:n]
        if c % 4 == 0:
            turns = turns[:-1] + [("user", f"end {c % 8}")]
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    rows += conversations(r, range(60, 120), ["a", "b"], 3)
    check(spark, rows)
    check(spark, rows, 1)


def test_one_conversation_with_most_rows_spans_many_tasks(spark):
    rows = [(40, t, "user", f"w{t % 3}") for t in range(3000)] + [(c, 0, "user", "w0") for c in range(41, 60)] * 2
    check(spark, rows)


def test_equal_conversations_are_divided_among_shards(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SHARD_ROWS", 20)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 4000, 20) for t in range(3)]
    rows += [(c, t, "user", f"own {c} {t}") for c in range(1, 100, 7) for t in range(4)]
    check(spark, rows)


def test_ends_of_a_skeleton_node_come_in_blocks(monkeypatch):
    monkeypatch.setattr(prefixtrie, "ENDS_BLOCK", 20)
    top = bytes(prefixtrie.HEAD)
    walk = Walk({top})
    for c in range(100):
        walk.add(0, c, top, [])
    walk.finish()
    blocks = [x["ends"] for x in walk.out if x["kind"] == "ends"]
    assert len(blocks) > 5 and b",".join(blocks).decode() == ",".join(map(str, range(100)))


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "a")]])
def test_empty_tables(spark, rows):
    check(spark, rows, 1)


def test_extra_and_clashing_columns_and_long_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "x " * 300_000, 5, b"k", 1), (1, 1, "user", "y", 6, b"k", 2)],
                               SCHEMA + ", c int, key binary, depth int")
    got = trie(df)
    want = brute(rebuilt([(1, 0, "user", "x " * 300_000), (1, 1, "user", "y")]))
    assert key(got) == key(want)


def test_splitters_and_partitions_do_not_change_the_result(spark):
    r = random.Random(4)
    df = spark.createDataFrame(conversations(r, range(300), ["a", "b"], 4), SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    one = key(trie(df.repartition(1)))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        many = key(trie(df.repartition(9)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many
