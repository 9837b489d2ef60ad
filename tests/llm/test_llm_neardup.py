import random
import re
from itertools import combinations

import numpy as np

from kiln.llm import neardup
from kiln.llm.graph import components
from kiln.llm.neardup import near_duplicates, signature, sketch_limit
from kiln.llm.shingles import shingle_set


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return ({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}) if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    of = list(range(len(rows)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            of[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(rows))], [len(s) for s in sets]


def chain_corpus(seed):
    """Groups whose members drift apart word by word, so that many links do not meet the smallest member."""
    r = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows, n = [], 0
    for _ in range(6):
        base = [r.choice(words) for _ in range(60)]
        for _ in range(25):
            rows.append((n, " ".join(base)))
            n += 1
            base = list(base)
            base[r.randrange(60)] = r.choice(words)
    r.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    for k, percent in ((3, 85), (5, 80)):
        rows = chain_corpus(k) + [(1000, "Ab c"), (1001, "ab\tC"), (1002, "ab"), (1003, ""), (1004, None), (1005, " \n"),
                                  (1006, "long " * 20000), (1007, "LONG " * 20001)]
        got = {r["doc_id"]: r for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
        comp, n = brute(rows, k, percent)
        assert [got[d]["component_id"] for d, _ in rows] == comp
        assert [got[d]["n_shingles"] for d, _ in rows] == n
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_null_ids_repeated_rows_clashing_columns_and_empty_table(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(None, text, 1), (5, text, 2), (5, text, 3), (7, text.upper(), 4)],
                               "doc_id long, text string, component_id int")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in near_duplicates(df).collect())
    assert got == [(-1, -1, True), (5, 5, True), (5, 5, True), (7, 5, False)]
    assert near_duplicates(df.where("false")).count() == 0


def test_sketches_tell_high_similarities():
    r = random.Random(2)
    limit = sketch_limit(85, 24 * 5)
    for _ in range(200):
        words = ["x%d" % r.randrange(10**6) for _ in range(300)]
        other = list(words)
        for _ in range(6):
            other[r.randrange(300)] = "y%d" % r.randrange(10**6)
        a, b = shingle_set(" ".join(words), 3), shingle_set(" ".join(other), 3)
        similar = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        _, x, v = signature(a, 24)
        _, y, w = signature(b, 24)
        differ = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert similar < 0.85 or differ <= limit
        assert int(np.bitwise_count((v ^ w).view(np.uint64)).sum()) <= len(np.setxor1d(a, b))
    _, y, w = signature(shingle_set(" ".join("z%d" % i for i in range(300)), 3), 24)
    assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) > limit


def test_components_of_hubs_and_chains(spark):
    links = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 360)] + [(500, 500), (360, 900), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(200)) and all(got[i] == 300 for i in range(300, 361)) and got[900] == 300
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
