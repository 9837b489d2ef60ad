"""BPE encoding and decoding with a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens that accepts
exactly the proper tokenizations. It starts as one state that accepts every byte
again and again; each merge (u, v) -> uv then adds one gadget: the state entered by
arc u is copied without its arc v, every state with an arc u gets an arc uv, and uv
enters the state that v entered. So the state after a token depends on that token
alone, and a text has exactly one accepted path: its BPE tokenization.

Written out, 50,000 merges would give up to |V|^2 arcs. The gadgets are therefore kept
as they are (one table entry per merge), and an arc (state p, token t) is resolved from
them when it is first needed and then stored in the transition table: arc t is missing
from state p exactly if some gadget (u, v) removed it, where u ends p and was still
whole, and v begins t and was still whole, when the gadget was added.

Pre-split words are encoded by running the automaton over their bytes: a byte trie
proposes the tokens that start at a position, the transition table accepts at most one
token per end position, and the accepted path is read backwards. Decoding emits the
arc labels (byte strings) of the ids.

Ids are carried as one binary value per row: little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import hold_memory, ready, remembers, replace_columns, schema_plus, texts_of

# Words and transitions a worker remembers; beyond it the memory is emptied and filled anew.
MEMO_WORDS = 600_000
MEMO_WORD_CHARS = 64
MEMO_ARCS = 2_000_000

# Fixed values of the byte-level pre-splitting: contractions, and white space by property.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _category_ranges(initial: str) -> str:
    """Character-class body of all code points whose category starts with ``initial``."""
    out, start = [], None
    for cp in range(sys.maxunicode + 2):
        inside = cp <= sys.maxunicode and unicodedata.category(chr(cp))[0] == initial
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return "".join(out)


def presplit_pattern() -> re.Pattern:
    """Words: contraction, or optional blank with letters, digits or other signs, or white space."""
    letters, digits = _category_ranges("L"), _category_ranges("N")
    return re.compile(
        "|".join(re.escape(c) for c in CONTRACTIONS)
        + f"| ?[{letters}]+| ?[{digits}]+| ?[^{SPACES}{letters}{digits}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


def plain_pattern() -> tuple[re.Pattern, frozenset[str]]:
    """The same words by the built-in classes, which are faster, and what a text must not hold for that:
    numbers other than decimal digits, and controls that only the built-in class takes as white space."""
    words = re.compile("|".join(re.escape(c) for c in CONTRACTIONS)
                       + r"| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    odd = [chr(cp) for cp in range(sys.maxunicode + 1) if unicodedata.category(chr(cp)) in ("Nl", "No")]
    return words, frozenset([*odd, "\x1c", "\x1d", "\x1e", "\x1f"])


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in vocabulary files -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenAutomaton:
    """Deterministic automaton of a merge list.

    labels: the bytes of each token id; merges: (left id, right id, merged id) by priority.
    Merges must make distinct tokens.
    """

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        self.gadgets: dict[tuple[int, int], int] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.made: dict[int, int] = {}
        self.table: dict[tuple[int, int], bool] = {}
        self._ends: dict[int, list] = {}
        self._starts: dict[int, list] = {}
        for k, (u, v, uv) in enumerate(merges):
            if uv in self.made:
                raise ValueError("merges must make distinct tokens")
            # A pair that earlier gadgets keep apart never meets: no arc is added, and uv never occurs.
            if not (self._occurs(u) and self._occurs(v) and self._free(u, v)):
                continue
            self.gadgets[u, v] = k
            self.left[uv], self.right[uv], self.made[uv] = u, v, k
        self.longest = max(map(len, labels))
        self.trie: dict[int, tuple[int, dict]] = {}
        for t, label in enumerate(labels):
            if self._occurs(t):
                node = self.trie
                for b in label[:-1]:
                    node = node.setdefault(b, (-1, {}))[1]
                node[label[-1]] = (t, node[label[-1]][1] if label[-1] in node else {})

    def _occurs(self, t: int) -> bool:
        return len(self.labels[t]) == 1 or t in self.made

    def _spine(self, t: int, side: dict[int, int], known: dict[int, list]) -> list[tuple[int, float]]:
        """Tokens at one border of t with the step at which each was merged into the next."""
        got = known.get(t)
        if got is None:
            got, x, until = [], t, float("inf")
            while True:
                got.append((x, until))
                if x not in self.made:
                    break
                until = self.made[x]
                x = side[x]
            known[t] = got
        return got

    def accepts(self, p: int, t: int) -> bool:
        """Whether the state entered by token p has an arc t."""
        ok = self.table.get((p, t))
        if ok is None:
            ok = self.table[p, t] = self._free(p, t)
        return ok

    def _free(self, p: int, t: int) -> bool:
        """Whether no gadget so far took arc t from the state of p."""
        for u, until_u in self._spine(p, self.right, self._ends):
            for v, until_v in self._spine(t, self.left, self._starts):
                k = self.gadgets.get((u, v))
                # Equal steps: runs of one token merge from the left, so the left one is gone already.
                if k is not None and k < until_u and k <= until_v:
                    return False
        return True

    def encode(self, word: bytes) -> list[int]:
        """Labels of the one accepted path over the bytes of a pre-split word.

        Depth first, longer arcs first. A position that no arc continues is dead: only one
        token can be accepted up to a position, so it need not be tried again.
        """
        n, table, labels = len(word), self.table, self.labels
        dead, out, i = bytearray(n + 1), [], 0
        offers: list[list[int]] = []
        while i < n:
            if len(offers) == len(out):
                arcs, node = [], self.trie
                for b in word[i:i + self.longest]:
                    hit = node.get(b)
                    if hit is None:
                        break
                    t, node = hit
                    if t >= 0:
                        arcs.append(t)
                offers.append(arcs)
            arcs = offers[-1]
            while arcs:
                t = arcs.pop()
                j = i + len(labels[t])
                if dead[j]:
                    continue
                if out:
                    ok = table.get((out[-1], t))
                    if not (self.accepts(out[-1], t) if ok is None else ok):
                        continue
                out.append(t)
                i = j
                break
            else:
                dead[i] = 1
                offers.pop()
                i -= len(labels[out.pop()])
        return out


class BpeCodec:
    """Automaton, pre-splitting and special tokens of one tokenizer file (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ids = model["vocab"]
        labels = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            labels[i] = bytes(alphabet[c] for c in token)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.automaton = TokenAutomaton(labels, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        for token, i in self.special.items():
            labels[i] = token.encode("utf-8")
        self.words = presplit_pattern()
        self.plain, self.odd = plain_pattern()
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.memo: dict[str, bytes] = {}

    def _part(self, text: str) -> bytes:
        """Packed ids of a text without special tokens, word by word."""
        memo, out = self.memo, []
        for word in (self.plain if self.odd.isdisjoint(text) else self.words).findall(text):
            got = memo.get(word)
            if got is None:
                got = np.array(self.automaton.encode(word.encode("utf-8")), "<u4").tobytes()
                if len(word) <= MEMO_WORD_CHARS:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    if len(self.automaton.table) >= MEMO_ARCS:
                        self.automaton.table.clear()
                    memo[word] = got
            out.append(got)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        if not self.special:
            return self._part(text)
        parts = self.cut.split(text)
        if len(parts) == 1:
            return self._part(text)
        return b"".join(np.array([self.special[part]], "<u4").tobytes() if k % 2 else self._part(part)
                        for k, part in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """Text of packed ids: the arc labels one after the other, invalid UTF-8 replaced."""
        labels = self.automaton.labels
        return b"".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_codecs: dict[str, BpeCodec] = {}
remembers("bpe", _codecs.clear)


def codec(path: str) -> BpeCodec:
    """The codec of a file, built once per process."""
    hold_memory("bpe")
    if path not in _codecs:
        _codecs[path] = BpeCodec(path)
    return _codecs[path]


def bpe_encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add column ``out``: the packed ids of column ``text`` (null counts as empty; empty text has no ids).

    path: a tokenizer file that every executor can open. One narrow pass; words recur within a task and
    are encoded once as long as they are remembered. Very long texts and words take linear time.
    """
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = pa.array([c.encode(t) for t in texts_of(b, text)], pa.binary())
            yield replace_columns(b, drop, **{out: ids})

    return df.mapInArrow(run, schema_plus(df, drop, **{out: T.BinaryType()}))


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add column ``out``: the text of packed ids (null counts as no ids)."""
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = pa.array([c.decode(x or b"") for x in b.column(ids).to_pylist()], pa.string())
            yield replace_columns(b, drop, **{out: texts})

    return df.mapInArrow(run, schema_plus(df, drop, **{out: T.StringType()}))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding every text and decoding its ids again."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)  # one worker encodes and decodes: two would hold a codec each
        for b in batches:
            ids = [c.encode(t) for t in texts_of(b, "text")]
            yield replace_columns(
                b, ("text",), n_tokens=pa.array([len(x) // 4 for x in ids], pa.int64()),
                ids_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                decoded_sha256=pa.array([hashlib.sha256(c.decode(x).encode("utf-8")).hexdigest() for x in ids], pa.string()))

    return rows.mapInArrow(run, schema_plus(rows, ("text",), n_tokens=T.LongType(), ids_sha256=T.StringType(),
                                            decoded_sha256=T.StringType()))


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    from kiln.sources.tables import table

    ready(spark)
    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())
