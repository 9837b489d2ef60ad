import hashlib
import random

import numpy as np
import pytest

from kiln.llm.bpe import BpeCodec, TokenAutomaton, bpe_decode, bpe_digests, bpe_encode, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def codec():
    return BpeCodec(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def explicit_arcs(n_bytes, merges):
    """The automaton written out: one gadget after the other, all arcs of all states."""
    accepted = {None: set(range(n_bytes))} | {t: set(range(n_bytes)) for t in range(n_bytes)}
    for u, v, uv in merges:
        accepted[uv] = set(accepted[v])
        # u no longer goes on with v; the pair's token may stand wherever u may.
        allowed = {p for p in accepted if u in accepted[p]}
        if v in accepted[u]:
            accepted[u].discard(v)
        if u == v:
            accepted[uv] = accepted[uv] | {u}  # a third u follows the pair, which merged first
        for p in allowed - ({u} if u == v else set()):
            accepted[p].add(uv)
    return accepted


def plain_bpe(word, merges):
    out = list(word)
    for u, v, uv in merges:
        i, new = 0, []
        while i < len(out):
            if i + 1 < len(out) and out[i] == u and out[i + 1] == v:
                new.append(uv)
                i += 2
            else:
                new.append(out[i])
                i += 1
        out = new
    return out


def test_automaton_equals_merging_one_by_one():
    r = random.Random(3)
    for _ in range(60):
        labels, merges = [b"a", b"b", b"c"], []
        for _ in range(r.randint(1, 12)):
            u, v = r.randrange(len(labels)), r.randrange(len(labels))
            if labels[u] + labels[v] not in labels:
                merges.append((u, v, len(labels)))
                labels.append(labels[u] + labels[v])
        auto = TokenAutomaton(labels, merges)
        for _ in range(60):
            word = bytes(r.choice(b"abc") for _ in range(r.randint(1, 14)))
            assert auto.encode(word) == plain_bpe([b"abc".index(c) for c in word], merges)


def test_gadgets_remove_the_arcs_of_the_written_out_automaton():
    labels = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"ca"]
    merges = [(0, 1, 3), (1, 2, 4), (3, 2, 5), (2, 0, 6)]
    auto, arcs = TokenAutomaton(labels, merges), explicit_arcs(3, merges)
    for p in range(len(labels)):
        assert {t for t in range(len(labels)) if auto.accepts(p, t)} == arcs[p]


def test_repeated_merges_need_distinct_tokens():
    with pytest.raises(ValueError):
        TokenAutomaton([b"a", b"aa", b"aaa"], [(0, 0, 1), (1, 0, 2), (0, 1, 2)])


def test_same_ids_and_text_as_the_library(codec, library):
    r = random.Random(1)
    alphabet = list("aaabbb \n\t  '’stréßдж中文字😀1٣²Ⅷ_-#%́") + ["\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "'ll", "'S"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, " " * 300, "x<|endoftext|>y<|endoftext|><|endoftext|> z", "<|endoftext", "", "\n"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        got = codec.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want.ids
        assert codec.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_decode_replaces_broken_utf8(codec, library):
    ids = [i for i in range(100, 300)]
    assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_nulls_empty_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", None), (3, "Hello world", "y"), (3, "Hello world", "y")],
                               "doc_id long, text string, IDS string")
    out = bpe_decode(bpe_encode(df, tokenizer_path()), tokenizer_path()).orderBy("doc_id").collect()
    assert [bytes(r["ids"]) for r in out][:2] == [b"", b""] and [r["decoded"] for r in out] == ["", "", "Hello world", "Hello world"]
    assert bpe_encode(df, tokenizer_path()).columns == ["doc_id", "text", "ids"]
    got = bpe_digests(df.where("doc_id = 1"), tokenizer_path()).first()
    empty = hashlib.sha256(b"").hexdigest()
    assert (got["n_tokens"], got["ids_sha256"], got["decoded_sha256"]) == (0, empty, empty)
    assert bpe_digests(df.where("false"), tokenizer_path()).count() == 0
