from kiln.llm import common, shingles, toxicity
from kiln.llm.common import hold_memory
from kiln.llm.shingles import word_hashes
from kiln.llm.toxicity import features


def test_one_worker_memory_at_a_time():
    word_hashes([b"one", b"two"])
    assert len(shingles._hashes) >= 2
    features(["some words here"])
    assert not shingles._hashes and len(toxicity._hashes) == 3
    word_hashes([b"one"])
    assert not toxicity._hashes and len(shingles._hashes) == 1
    hold_memory("shingles")
    assert len(shingles._hashes) == 1 and common._owner == ["shingles"]


def test_forgotten_words_are_hashed_alike():
    doc, feat = features(["a b c a"])
    word_hashes([b"x"])
    again = features(["a b c a"])
    assert (doc == again[0]).all() and (feat == again[1]).all()
