import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import brown
from kiln.llm.brown import CLASSES, SLOTS, best_classes, brown_scores, exchange_classes
from kiln.llm.decontaminate import RADIUS, ItemIndex, drop_leaking, find_leaks, words_of
from kiln.llm.langid import drop_undetermined, fit_prototypes, identify, trigrams
from kiln.llm.licenses import TEMPLATES, find_licences, train_classifier
from kiln.llm.toxicity import fit_toxicity, ftrl, op5_toxicity, score_toxicity
from kiln.sources.tables import table

SF01 = "/root/testdata/sf0.01"


# ---- language ----

def test_held_out_language_accuracy(spark):
    docs = table(spark, SF01, "documents")
    model = fit_prototypes(docs.where("doc_id % 4 <> 2"))
    out = identify(docs.where("doc_id % 4 = 2").select("doc_id", "lang", "text"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_edge_cases(spark):
    train = spark.createDataFrame([("the of and to in", "en"), ("der die und das", "de"), (None, "en"), ("", "xx"), ("abc", None)],
                                  "text string, lang string")
    model = fit_prototypes(train)
    assert model[0] == ["de", "en"]
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "12 !!", 9), (4, "the and of " * 5000, 9), (4, "und die der", 9)],
                               "doc_id long, text string, score int")
    out = identify(df, model).collect()
    assert [r["lang_pred"] for r in out] == ["und", "und", "und", "en", "de"] and out[0]["score"] == 0.0
    assert identify(df, model).columns == ["doc_id", "text", "lang_pred", "score"]
    nothing = identify(df, fit_prototypes(train.where("false"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert identify(df.where("false"), model).count() == 0


def test_texts_stay_if_no_language_was_learned(spark):
    df = spark.createDataFrame([(1, "some text"), (2, "12 !"), (3, None), (4, "é")], "doc_id long, text string")
    nothing = fit_prototypes(df.withColumn("lang", F.lit(None).cast("string")))
    assert sorted(r["doc_id"] for r in drop_undetermined(df, nothing).collect()) == [1, 4]


def test_trigrams_count_word_borders():
    doc, gram, count = trigrams(["ab  ab, c", "", "ab"])
    per = Counter(dict(zip(zip(doc.tolist(), gram.tolist()), count.tolist())))
    assert sum(v for (d, _), v in per.items() if d == 0) == 5  # _ab ab_ twice, _c_
    assert sum(v for (d, _), v in per.items() if d == 2) == 2


# ---- toxicity ----

def test_held_out_toxicity(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    held = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in op5_toxicity(spark, "/root/testdata/sf0.1").collect()
            if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    flagged = [y for _, y, p in held if p]
    assert auc > 0.9 and sum(flagged) / len(flagged) > 0.9 and sum(flagged) / len(pos) > 0.5


def test_toxicity_edge_cases(spark):
    rows = [(i, "good text here number%d" % i, 0) for i in range(80)] + [(100 + i, "bad insult here number%d" % i, 1) for i in range(40)]
    rows += [(500, None, 0), (501, "", 0), (502, "x", None), (503, "x", 7)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = fit_toxicity(train)
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "an insult " * 20000, 5), (4, "good", 5)], "doc_id long, text string, SCORE int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(df, model).collect()}
    assert got[1] == got[2] and got[3] > 0.7 > got[4]
    empty = fit_toxicity(train.where("false"))
    assert {r["score"] for r in score_toxicity(df, empty).collect()} == {0.5}
    assert score_toxicity(df.where("false"), model).count() == 0


def test_l1_keeps_chance_features_at_zero():
    r = np.random.default_rng(0)
    rows = [(np.unique(np.append(r.integers(10, 1000, 30), 1 if y else 2)).astype(np.int32), int(y)) for y in r.random(600) < 0.3]
    w, _ = ftrl(rows)
    assert w[1] > 0 and np.count_nonzero(w) < 60


# ---- class language model ----

def plain_counts(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, _, t in rows]
    c = Counter(w for (_, h, _), ws in zip(rows, tokens) if not h for w in ws)
    return tokens, c


def test_base_scores_and_counts_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_CHARS", 500)
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(60).collect()
    rows = [(r["doc_id"], zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2, r["text"]) for r in docs]
    rows += [(9001, False, None), (9002, True, ""), (9003, True, "never seenbefore"), (9003, True, "never seenbefore"),
             (None, False, "The the"), (9004, False, "very " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    tokens, c = plain_counts(rows)
    n, v = sum(c.values()), len(c)
    got = sorted(brown_scores(df).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    want = sorted(zip(rows, tokens), key=lambda x: (x[0][0] is None, x[0][0] or 0))
    for r, ((d, h, _), ws) in zip(got, want):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (d, h, len(ws), n)
        assert r["n_known"] == sum(c[w] > 0 for w in ws)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0
    none = brown_scores(df.where("held_out")).collect()
    assert {r["base_score"] for r in none} == {0.0} and {r["train_tokens"] for r in none} == {0}
    assert brown_scores(df.where("false")).count() == 0


def test_held_out_text_scores_better_than_base(spark):
    docs = table(spark, SF01, "documents").selectExpr("doc_id", "doc_id % 7 = 2 AS held_out", "text")
    held = [r for r in brown_scores(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_exchange_finds_alternating_classes():
    r = np.random.default_rng(4)
    c = np.zeros((21, 21), int)
    for _ in range(4000):  # words 0-9 are followed by 10-19 and the other way round
        a, b = r.integers(0, 10), r.integers(10, 20)
        c[a, b] += 1
        c[b, r.integers(0, 10)] += 1
    of = exchange_classes(c, 4)
    assert not set(of[:10]) & set(of[10:20]) and of[20] == 3


def test_exchange_moves_only_raise_the_likelihood():
    r = np.random.default_rng(5)
    c = r.poisson(2.0, (31, 31)) * (r.random((31, 31)) < 0.4)

    def likelihood(of):
        one = np.eye(6)[of]
        g = one.T @ c @ one
        h = lambda x: float((x * np.log(np.maximum(x, 1e-12))).sum())
        return h(g) - h(g.sum(0)) - h(g.sum(1))

    steps = [likelihood(exchange_classes(c, 6, n)) for n in range(6)]
    assert all(b >= a - 1e-6 for a, b in zip(steps, steps[1:])) and steps[-1] > steps[0]


def test_best_classes_have_the_highest_likelihood():
    r = np.random.default_rng(6)
    c = r.poisson(3.0, (40, 40)) * (r.random((40, 40)) < 0.5)
    of = np.append(r.integers(0, 5, 25), np.full(15, 5))  # words 25-39 are in the rest

    def likelihood(of):
        one = np.eye(6)[of]
        g = one.T @ c @ one
        h = lambda x: float((x * np.log(np.maximum(x, 1e-12))).sum())
        return h(g) - h(g.sum(0)) - h(g.sum(1))

    one = np.eye(6, dtype=int)[of]
    x = np.zeros((15, SLOTS), int)
    for i, w in enumerate(range(25, 40)):
        after, before = c[w].copy(), c[:, w].copy()
        after[w] = before[w] = 0
        x[i, :6], x[i, CLASSES:CLASSES + 6], x[i, -1] = after @ one, before @ one, c[w, w]
    word, slot = np.nonzero(x)
    got = best_classes(word, slot, x[word, slot], one.T @ c @ one, 5)
    want = [max(range(5), key=lambda k: likelihood(np.where(np.arange(40) == w, k, of))) for w in range(25, 40)]
    assert got.tolist() == want


def test_repeated_words_outside_the_frequent_ones_are_clustered(spark):
    # Words a.. and b.. take turns; 1,200 of them are frequent, and 800 rare ones are met six times each.
    r = random.Random(7)
    a = [f"a{i}" for i in range(600)] * 30 + [f"a{i}" for i in range(600, 1000)] * 6
    b = [w.replace("a", "b") for w in a]
    r.shuffle(a)
    r.shuffle(b)
    pairs = [f"{x} {y}" for x, y in zip(a, b)]
    rows = [(i, False, " ".join(pairs[i * 20:i * 20 + 20])) for i in range(len(pairs) // 20)]
    rare = [(f"a{i}", f"b{i + 1}") for i in range(600, 998, 2)]
    rows += [(9001, True, " ".join(f"{x} {y}" for x, y in rare)),
             (9002, True, " ".join([x for x, _ in rare] + [y for _, y in rare]))]
    df = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    got = {r["doc_id"]: r for r in brown_scores(df).where("held_out").collect()}
    assert math.isclose(got[9001]["base_score"], got[9002]["base_score"])
    assert got[9001]["score"] > got[9002]["score"] + 50


# ---- decontamination ----

def weighted(words):
    k = min(5, len(words))
    return {tuple(words[i:i + k]): sum(map(len, words[i:i + k])) for i in range(len(words) - k + 1)}


def best_window(text, item):
    w, x = words_of(text), words_of(item)
    n = min(len(x), len(w))
    a, best = weighted(x), 0.0
    for i in range(len(w) - n + 1 if n else 0):
        b = weighted(w[i:i + n])
        common = sum(v for g, v in b.items() if g in a)
        best = max(best, common / (sum(a.values()) + sum(b.values()) - common))
    return best


def test_leaks_equal_brute_force(spark):
    base = [" ".join(f"{a}{i}{b}" for i in range(n)) for a, b, n in (("w", "x", 40), ("v", "y", 18), ("u", "z", 4))]
    items = [(i, t) for i, t in enumerate(base)] + [(7, None), (8, ""), (0, base[0])]
    edited = base[0].split()
    edited[20] = "other"
    docs = [(1, "a b c " + base[0] + " d e"), (2, "q " + " ".join(edited) + " r"), (3, " ".join(base[0].split()[:30])),
            (4, base[1].upper() + ", " + base[2]), (5, None), (6, ""), (7, base[2]), (8, " ".join(base[1].split()[1:])),
            (9, "filler " * 20000 + base[1]), (9, "filler " * 20000 + base[1]), (None, base[0]),
            (10, " ".join(base[0].split()[:20] + ["gap"] * 3 + base[0].split()[20:]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["item_id"]), r["similarity"]) for r in find_leaks(df, bench).collect())
    want = sorted(((d or -1, i), s) for d, t in docs for i, x in enumerate(base) if (s := best_window(t or "", x)) >= 0.8)
    assert [k for k, _ in got] == [k for k, _ in want]
    assert all(math.isclose(a, b) for (_, a), (_, b) in zip(got, want))
    kept = {r["doc_id"] for r in drop_leaking(df.withColumn("similarity", df.doc_id), bench).collect()}
    assert kept == {d for d, _ in docs} - {k[0] for k, _ in want} - {None}
    assert find_leaks(df, bench.where("false")).count() == 0 and find_leaks(df.where("false"), bench).count() == 0


def test_index_proposes_everything_within_the_radius():
    r = np.random.default_rng(3)
    index = ItemIndex([(i, " ".join(f"t{i}x{j}" for j in range(30))) for i in range(50)])
    prints = []
    for k in range(400):
        p = int(index.prints[k % 50])
        for b in r.choice(64, int(r.integers(0, 22)), replace=False):
            p ^= 1 << int(b)
        prints.append(p)
    prints = np.array(prints, np.uint64)
    w, i, d = index.within_radius(prints)
    want = {(a, b) for a in range(400) for b in range(50) if np.bitwise_count(prints[a] ^ index.prints[b]) <= RADIUS}
    assert set(zip(w.tolist(), i.tolist())) == want


# ---- licences ----

@pytest.fixture(scope="module")
def classifier(spark):
    return train_classifier(spark)


def test_licences_of_known_and_unknown_notices(spark, classifier):
    cases = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "x\nReleased under the MIT License.\ny": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "licensed under the gnu general public license, version 2.": "GPL-2.0",
             "Licensed under the Apache License, Version 2.0. More text.": "Apache-2.0", "All rights reserved.": "Proprietary",
             "Licensed under the Foo License, Version 9.": None, "A driving licence is needed.": None,
             "The license was revoked.": None, "": None, "plain text": None, "license " * 30000: None}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").withColumn("family", df_lit())
    got = {r["doc_id"]: r["family"] for r in find_licences(df, *classifier).collect()}
    assert got == {i: f for i, f in enumerate(cases.values()) if f}


def df_lit():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_licences_nulls_repeats_and_empty_table(spark, classifier):
    df = spark.createDataFrame([(None, "Released under the MIT License."), (1, None), (2, "Released under the MIT License.\n" * 3),
                                (2, "Released under the MIT License.")], "doc_id long, text string")
    assert sorted(r["doc_id"] or -1 for r in find_licences(df, *classifier).collect()) == [-1, 2, 2, 2, 2]
    assert find_licences(df.where("false"), *classifier).count() == 0


def test_every_template_is_found_also_wrapped(spark, classifier):
    cases = [(f, t) for f, ts in TEMPLATES.items() for s in ts for t in (s, "Intro\n\n" + textwrap.fill(s, 72))]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {(r["doc_id"], r["family"]) for r in find_licences(df, *classifier).collect()}
    assert [c for i, c in enumerate(cases) if (i, c[0]) not in got] == []


# Customary wordings that are no template of the module.
OTHER_WORDINGS = {
    "Apache-2.0": "Apache-2.0", "Distributed under Apache 2.0": "Apache-2.0", "This library is licensed under Apache License 2.0": "Apache-2.0",
    "Licensed under MPL 2.0.": "MPL-2.0", "MPL 2.0": "MPL-2.0", "This file is available under the Mozilla Public License 2.0.": "MPL-2.0",
    "License: MIT": "MIT", "Code is available under the MIT licence.": "MIT", "All examples are MIT licensed.": None,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "MIT",
    "Licensed under the GPL v3": "GPL-3.0", "License: GPL-3.0": "GPL-3.0", "GNU GPL version 2 or later": "GPL-2.0",
    "You may copy it under the terms of the GPLv2.": "GPL-2.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "GPL",
    "Distributed under the terms of the GNU AGPL.": "AGPL-3.0", "Released under the LGPL-2.1 license": "LGPL",
    "License: BSD-3-Clause": "BSD", "The sources are distributed under the 3-clause BSD license.": "BSD",
    "The text is available under the CC BY-SA 4.0 license.": "CC-BY-SA", "License: CC-BY-NC-4.0": "CC-BY-NC",
    "Data released under CC0 1.0": "CC0-1.0", "Released under the ISC licence.": "ISC", "License: Unlicense": "Unlicense",
}


def test_recall_on_other_wordings(spark, classifier):
    df = spark.createDataFrame(list(enumerate(OTHER_WORDINGS)), "doc_id long, text string")
    got = {(r["doc_id"], r["family"]) for r in find_licences(df, *classifier).collect()}
    wanted = [(i, f) for i, f in enumerate(OTHER_WORDINGS.values()) if f]
    missed = [(list(OTHER_WORDINGS)[i], f) for i, f in wanted if (i, f) not in got]
    assert len(missed) <= 0.1 * len(wanted), missed


def test_no_false_hit_on_plain_sentences(spark, classifier):
    from kiln.llm.licenses import NO_LICENCE, mixed_words
    texts = [*NO_LICENCE, *mixed_words()[:300], "The Apache helicopter has two engines.", "MIT and Harvard are in Cambridge.",
             "The BSD of 1994 ran on a VAX.", "He has a CC of the letter."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(texts[r["doc_id"]], r["family"]) for r in find_licences(df, *classifier).collect()] == []


def test_the_pattern_leaves_out_nothing(spark, classifier):
    """With a pattern that lets everything through the notices are the same."""
    from dataclasses import replace
    model, threshold = classifier
    texts = [t for ts in TEMPLATES.values() for t in ts] + list(OTHER_WORDINGS)
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    found = lambda m: sorted(tuple(r) for r in find_licences(docs, m, threshold).select("doc_id", "paragraph", "family").collect())
    assert found(model) == found(replace(model, pattern=""))


def test_licences_with_clashing_columns(spark, classifier):
    df = spark.createDataFrame([(1, "License: MIT", "p", 0.5, 1, "f")], "doc_id long, text string, paragraph string, probability double, "
                                                                       "unit int, _grams string")
    assert [(r["doc_id"], r["family"]) for r in find_licences(df, *classifier).collect()] == [(1, "MIT")]
