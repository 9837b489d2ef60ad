"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path: the 128-bit digests of its turns. Paths are sorted and cut into shards at splitters, and
the members of a node (the conversations that start with it) are neighbours in that order. A node whose members
are cut apart has a splitter inside its range, so it is a prefix of that splitter. These prefixes form the
skeleton: a trie of at most ``MAX_SHARDS`` x (``SEGMENT`` + 1) nodes, which is broadcast. Every other node lies in
one shard, and a single pass over the sorted shard finishes it with a stack; what a shard knows of a skeleton node
is a partial aggregate, and these are reduced to one row per skeleton node. Splitters carry the conversation id, so
equal conversations are divided among shards too.

Long conversations. A path is cut into segments of ``SEGMENT`` turns, so no row, sort key or splitter grows with a
conversation. Segment k of a conversation lies in the trie of all segments that follow the same k * SEGMENT turns
(told apart by the segment number and a sum of digests of the earlier segments), a sub-trie that hangs below the
node at that depth. Sums over a subtree are carried up across segments by conversations: everything below a node
belongs to exactly one member, the smallest of the node that adds it, so a conversation's later segments are summed
once and added to the nodes of its earlier segments.

Turn numbers within a conversation come from a range sort whose partitions hand on one small carry each, so a
conversation may be spread over many tasks. The concatenated ids of a skeleton node's finished conversations are
written as text blocks, and only these pass through the one task that hashes them in order.

Defined results: rows with a null id take no part; turns are ordered by ``turn``, null first, rows that share it by
the digest of role and text; null role or text is empty; repeated rows are turns of their own; a conversation
without turns after rebuilding is a member of the root only; ``%`` keeps the sign of its left side. Very long texts
are hashed whole. An empty table gives no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import WORD_PATTERN, ready
from kiln.operators.positions import running_sum
from kiln.session import materialize, staged

# Turns per segment; bounds rows, sort keys and the depth of the skeleton.
SEGMENT = 32
SHARD_ROWS = 20_000
MAX_SHARDS = 4096
SAMPLES_PER_SHARD = 16
# Text of one block of concatenated ids.
ENDS_BLOCK = 1 << 16
# Rows of an Arrow batch that a task hands out.
OUT_ROWS = 4096
DIGEST = 16
# Segment number and sum of earlier digests, before the digests of a key.
HEAD = 24
SUM_BITS = 90
NONE_SHA = hashlib.sha256(b"").hexdigest()

NODE_FIELDS = ("conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, "
               "n_leaves long, saved_tokens long, ends_sha256 string, node_key binary, below_key binary")
WALK_SCHEMA = ("kind string, shard int, seq long, key binary, c long, n long, children long, leaves long, saved long, "
               f"words long, ends binary, {NODE_FIELDS}")


def conversation_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """(c, turn, d, words): one narrow row per turn, with the digest of role and text and the words of the text."""
    who, what = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    mark = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    return (df.select(F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("turn"),
                      F.substring(F.unhex(F.sha2(mark.cast("binary"), 256)), 1, DIGEST).alias("d"),
                      F.regexp_count(what, F.lit(WORD_PATTERN)).cast("long").alias("words"))
            .where("c is not null"))


def shared_openings(turns: DataFrame, every: int = 20, spread: int = 4) -> DataFrame:
    """Rebuilding rows (c, src, r, turn, d, words): the first h turns of conversation c - c % every (src 0), then c's
    own turns (src 1), of which :func:`path_segments` drops the first h; h = crc32(decimal c) % spread."""
    first = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "d")
    # The limit on the row number is applied within each task first, so a long conversation sends few rows.
    heads = (turns.where(F.col("c") % every == 0).withColumn("r", F.row_number().over(first))
             .where(F.col("r") < spread).select(F.col("c").alias("base"), "r", "d", "words"))
    convs = turns.select("c").distinct().withColumn("base", F.col("c") - F.col("c") % every)
    opening = convs.join(heads, "base").where(F.col("r") <= F.crc32(F.col("c").cast("string").cast("binary")) % spread)
    own = turns.select("c", F.lit(1).alias("src"), F.lit(None).cast("int").alias("r"), "turn", "d", "words")
    kind = dict(turns.dtypes)["turn"]
    return own.unionByName(opening.select("c", F.lit(0).alias("src"), "r", F.lit(None).cast(kind).alias("turn"), "d", "words"))


def _dropped(c: int, spread: int) -> int:
    return zlib.crc32(str(c).encode()) % spread if spread else 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, int]]:
    for b in batches:
        yield from zip(*(b.column(x).to_pylist() for x in ("c", "src", "d", "words")))


def path_segments(rows: DataFrame, spread: int = 4) -> DataFrame:
    """(c, k, path, words): the segments of every conversation, from :func:`shared_openings` rows."""
    spark = rows.sparkSession
    order = [F.col("c"), F.col("src"), F.col("r"), F.col("turn").asc_nulls_first(), F.col("d")]
    ordered = materialize(rows.orderBy(*order).select("c", "src", "d", "words"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """First and last conversation of the partition with their (src 0, src 1) rows."""
        first = last = None
        for c, src, _, _ in _runs(batches):
            if last is None or last[0] != c:
                last = [c, 0, 0]
                first = first or last
            last[1 + src] += 1
        if first:
            names = ["part", *(f"{x}{i}" for x in ("first", "last") for i in range(3))]
            values = [TaskContext.get().partitionId(), *first, *last]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names)

    schema = "part long, " + ", ".join(f"{x}{i} long" for x in ("first", "last") for i in range(3))
    tallies = sorted(ordered.mapInArrow(tally, schema).collect())  # one row per partition
    carry, held = {}, (None, 0, 0)
    for i, t in enumerate(tallies):
        follows = tallies[i + 1][1] if i + 1 < len(tallies) else None
        before = held if held[0] == t[1] else (None, 0, 0)
        carry[t[0]] = (before[1], before[2], follows)
        held = (t[4], t[5], t[6])
        if t[1] == t[4]:  # one conversation only
            held = (t[4], before[1] + t[5], before[2] + t[6])
    sent = spark.sparkContext.broadcast(carry)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, own, follows = sent.value.get(TaskContext.get().partitionId(), (0, 0, None))
        out: list[tuple] = []
        now, pos, start, path, words = None, 0, 0, [], []

        def close(whole: bool) -> None:
            nonlocal start
            if path or whole and not pos:
                k, at = divmod(start, SEGMENT)
                out.append((now, k, at, whole and at == 0, b"".join(path), words.copy()))
            start = pos
            path.clear()
            words.clear()

        for c, src, d, n in _runs(batches):
            if c != now:
                if now is not None:
                    close(True)
                    base = own = 0
                now, h = c, _dropped(c, spread)
                pos = start = base + max(0, own - h)
            if src:
                own += 1
                if own <= h:
                    continue
            path.append(d)
            words.append(n)
            pos += 1
            if pos % SEGMENT == 0:
                close(True)
            if len(out) >= OUT_ROWS:
                yield _batch(out, SEGMENT_TYPES)
                out.clear()
        if now is not None:
            close(now != follows)
        if out:
            yield _batch(out, SEGMENT_TYPES)

    pieces = staged(ordered.mapInArrow(cut, "c long, k long, at int, whole boolean, path binary, words array<long>"), "pieces")
    # Segments that range partitions cut: SEGMENT turns at most each.
    joined = (pieces.where("not whole").groupBy("c", "k")
              .agg(F.sort_array(F.collect_list(F.struct("at", "path", "words"))).alias("p"))
              .select("c", "k", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["path"])).alias("path"),
                      F.flatten(F.transform("p", lambda x: x["words"])).alias("words")))
    return pieces.where("whole").select("c", "k", "path", "words").unionByName(joined)


SEGMENT_TYPES = {"c": pa.int64(), "k": pa.int64(), "at": pa.int32(), "whole": pa.bool_(), "path": pa.binary(),
                 "words": pa.list_(pa.int64())}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types.values())], list(types))


def segment_head(k: int, total: int) -> bytes:
    """First bytes of the keys of all segments k that follow the same turns."""
    return k.to_bytes(8, "big") + (total % (1 << SUM_BITS)).to_bytes(HEAD - 8, "big")


def segment_sum(k: int, path: bytes) -> int:
    """Digest of a full segment and its number; sums of these tell what precedes a segment."""
    return int.from_bytes(hashlib.sha256(b"%d:" % k + path).digest()[:12], "big") % (1 << SUM_BITS)


def keyed_segments(segments: DataFrame) -> DataFrame:
    """(c, k, key, words): the sort key is segment number, sum of the earlier segments' digests, own digests.

    A conversation whose turns fill its last segment gets an empty one after it.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = [Decimal(segment_sum(k, p)) for k, p in zip(b.column("k").to_pylist(), b.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("c"), b.column("k"), pa.array(g, pa.decimal128(38, 0))], ["c", "k", "g"])

    full = segments.where(F.length("path") == SEGMENT * DIGEST).select("c", "k", "path")
    sums = running_sum(full.mapInArrow(digests, "c long, k long, g decimal(38,0)"), ["k"], "g", ["c"], "total")
    later = (segments.where("k > 0").select("c", "k", "path", "words")
             .join(sums.select("c", (F.col("k") + 1).alias("k"), F.col("total").cast("decimal(38,0)")), ["c", "k"], "right"))
    both = (segments.where("k = 0").select("c", "k", "path", "words", F.lit(0).cast("decimal(38,0)").alias("total"))
            .unionByName(later.select("c", "k", F.coalesce("path", F.lit(b"")).alias("path"),
                                      F.coalesce("words", F.array().cast("array<long>")).alias("words"), "total")))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(x).to_pylist() for x in ("k", "total", "path")))
            made = pa.array([segment_head(k, int(t)) + p for k, t, p in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("c"), b.column("k"), made, b.column("words")], ["c", "k", "key", "words"])

    return staged(both.mapInArrow(keys, "c long, k long, key binary, words array<long>"), "segments")


def splitters(segments: DataFrame) -> list[tuple[bytes, int]]:
    """(key, conversation) at which the sorted segments are cut, from a sample chosen by a hash."""
    total = segments.count()
    wanted = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = min(MAX_SHARDS, max(wanted, -(-total // SHARD_ROWS)))
    sample = segments.select("key", "c")
    if total > shards * SAMPLES_PER_SHARD:
        share = int((1 << 30) * shards * SAMPLES_PER_SHARD / total)
        sample = sample.where(F.pmod(F.xxhash64("c", "key"), F.lit(1 << 30)) < share)
    found = sorted((bytes(r["key"]), r["c"]) for r in sample.collect())  # about SAMPLES_PER_SHARD a shard
    return sorted({found[i * len(found) // shards] for i in range(1, shards)}) if found else []


def skeleton_of(cuts: list[tuple[bytes, int]]) -> set[bytes]:
    """All prefixes of the splitters' paths."""
    return {key[:n] for key, _ in cuts for n in range(HEAD, len(key) + 1, DIGEST)}


class _Node:
    """A node while its members pass by."""

    __slots__ = ("key", "words", "n", "c", "children", "leaves", "saved", "skeleton", "deep", "sha", "ends", "size", "seq", "waiting")

    def __init__(self, key: bytes, words: int, skeleton: bool):
        self.key, self.words, self.skeleton = key, words, skeleton
        self.n = self.children = self.leaves = self.saved = self.size = self.seq = 0
        self.c = self.sha = None
        self.deep = False
        self.ends: list[str] = []
        self.waiting: list[dict] = []


def node_row(key: bytes, c: int, n: int, children: int, leaves: int, saved: int, ends: str, deep: bool) -> dict:
    """A finished node; nodes that fill their segment go on in the segment named by ``below_key``."""
    k, depth = int.from_bytes(key[:8], "big"), (len(key) - HEAD) // DIGEST
    below = None
    if depth == SEGMENT:
        below = segment_head(k + 1, int.from_bytes(key[8:HEAD], "big") + segment_sum(k, key[HEAD:]))
    return {"kind": "node", "conv_id": c, "depth": k * SEGMENT + depth, "n_convs": n, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": ends, "node_key": key if deep else None, "below_key": below}


def own_share(key: bytes, n: int, words: int, children: int) -> tuple[int, int]:
    """(tokens saved, leaves) that a node itself adds: one that fills its segment is a leaf of none, the top of a
    later segment was counted where it ends the segment before."""
    top = len(key) == HEAD
    return 0 if top else (n - 1) * words, int(not children and len(key) < HEAD + SEGMENT * DIGEST)


class Walk:
    """Finishes the nodes of sorted shards with a stack; skeleton nodes give partial aggregates."""

    def __init__(self, skeleton: set[bytes]):
        self.skeleton, self.out, self.shard = skeleton, [], None
        self.stack = [_Node(b"", 0, True)]

    def add(self, shard: int, c: int, key: bytes, words: list[int]) -> None:
        if shard != self.shard:
            self.finish()
            self.shard = shard
        while not key.startswith(self.stack[-1].key):
            self._pop()
        for depth in range(len(self.stack) - 1, (len(key) - HEAD) // DIGEST + 1):
            part = key[:HEAD + depth * DIGEST]
            self.stack.append(_Node(part, words[depth - 1] if depth else 0, part in self.skeleton))
        top = self.stack[-1]
        top.n += 1
        top.c = c if top.c is None else min(top.c, c)
        if len(words) == SEGMENT:
            top.deep = True
        elif not top.skeleton:
            if top.sha is None:
                top.sha = hashlib.sha256(b"%d" % c)
            else:
                top.sha.update(b",%d" % c)
        else:
            top.ends.append(str(c))
            top.size += len(top.ends[-1]) + 1
            if top.size >= ENDS_BLOCK:
                self._ends(top)

    def finish(self) -> None:
        while len(self.stack) > 1:
            self._pop()

    def _ends(self, node: _Node) -> None:
        if node.ends:
            self.out.append({"kind": "ends", "shard": self.shard, "seq": node.seq, "key": node.key,
                             "ends": ",".join(node.ends).encode()})
            node.seq, node.size, node.ends = node.seq + 1, 0, []

    def _pop(self) -> None:
        x, up = self.stack.pop(), self.stack[-1]
        up.n += x.n
        up.c = x.c if up.c is None else min(up.c, x.c)
        up.deep |= x.deep and len(x.key) > HEAD
        if x.skeleton:
            self._ends(x)
            self.out.append({"kind": "skeleton", "key": x.key, "c": x.c, "n": x.n, "children": x.children,
                             "leaves": x.leaves, "saved": x.saved, "words": x.words})
            return
        saved, leaf = own_share(x.key, x.n, x.words, x.children)
        x.saved, x.leaves = x.saved + saved, x.leaves + leaf
        up.children, up.leaves, up.saved = up.children + 1, up.leaves + x.leaves, up.saved + x.saved
        for row in x.waiting:
            row["parent_conv_id"] = x.c
        self.out += x.waiting
        later = x.key[:8] > bytes(8)
        if later and (saved or leaf):
            self.out.append({"kind": "share", "c": x.c, "n": int.from_bytes(x.key[:8], "big"), "saved": saved, "leaves": leaf})
        ends = x.sha.hexdigest() if x.sha else NONE_SHA
        if later and len(x.key) == HEAD:
            self.out.append({"kind": "top", "key": x.key, "children": x.children, "ends_sha256": ends})
            return
        row = node_row(x.key, x.c, x.n, x.children, x.leaves, x.saved, ends, x.deep)
        if up.skeleton:
            row["parent_key"] = up.key or None
            self.out.append(row)
        else:
            up.waiting.append(row)


WALK_TYPES = {"kind": pa.string(), "shard": pa.int32(), "seq": pa.int64(), "key": pa.binary(), "c": pa.int64(),
              "n": pa.int64(), "children": pa.int64(), "leaves": pa.int64(), "saved": pa.int64(), "words": pa.int64(),
              "ends": pa.binary(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(),
              "parent_key": pa.binary(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
              "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "node_key": pa.binary(), "below_key": pa.binary()}


def walk_shards(segments: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """Rows of :class:`Walk` over all shards."""
    sent = segments.sparkSession.sparkContext.broadcast((cuts, skeleton_of(cuts)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = sent.value[0]
        for b in batches:
            shard = [bisect_right(at, x) for x in zip(b.column("key").to_pylist(), b.column("c").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column("c"), b.column("key"), b.column("words")],
                                             ["shard", "c", "key", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(sent.value[1])
        for b in batches:
            for row in zip(*(b.column(x).to_pylist() for x in ("shard", "c", "key", "words"))):
                walk.add(*row)
                if len(walk.out) >= OUT_ROWS:
                    yield _columns(walk.out)
                    walk.out = []
        walk.finish()
        if walk.out:
            yield _columns(walk.out)

    dealt = segments.mapInArrow(deal, "shard int, c long, key binary, words array<long>")
    ordered = dealt.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "key", "c")
    return staged(ordered.mapInArrow(run, WALK_SCHEMA), "walk")


def _columns(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(x) for r in rows], t) for x, t in WALK_TYPES.items()], list(WALK_TYPES))


def ends_of_skeleton(walked: DataFrame) -> dict[bytes, str]:
    """SHA-256 of each skeleton node's concatenated ids: blocks of text in order, read as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for b in batches:
            for key, text in zip(b.column("key").to_pylist(), b.column("ends").to_pylist()):
                if key == now:
                    sha.update(b"," + text)
                    continue
                if sha:
                    yield pa.RecordBatch.from_pydict({"key": [now], "sha": [sha.hexdigest()]})
                now, sha = key, hashlib.sha256(text)
        if sha:
            yield pa.RecordBatch.from_pydict({"key": [now], "sha": [sha.hexdigest()]})

    blocks = (walked.where("kind = 'ends'").select("key", "shard", "seq", "ends")
              .repartition("key").sortWithinPartitions("key", "shard", "seq"))
    return {bytes(r["key"]): r["sha"] for r in blocks.mapInArrow(run, "key binary, sha string").collect()}


def finish_skeleton(walked: DataFrame) -> list[dict]:
    """Rows like those of :class:`Walk` for the skeleton nodes, from their reduced partial aggregates."""
    parts = (walked.where("kind = 'skeleton'").groupBy("key")
             .agg(F.min("c").alias("c"), F.max("words").alias("words"),
                  *(F.sum(x).alias(x) for x in ("n", "children", "leaves", "saved"))))
    nodes = {bytes(r["key"]): r.asDict() for r in parts.collect()}  # the skeleton's size at most
    ends, out = ends_of_skeleton(walked), []
    for key in sorted(nodes, key=len, reverse=True):
        x = nodes[key]
        saved, leaf = own_share(key, x["n"], x["words"], x["children"])
        x["saved"], x["leaves"] = x["saved"] + saved, x["leaves"] + leaf
        up = nodes.get(key[:-DIGEST]) if len(key) > HEAD else None
        if up:
            for f, v in (("children", 1), ("leaves", x["leaves"]), ("saved", x["saved"])):
                up[f] += v
        k = int.from_bytes(key[:8], "big")
        if k and (saved or leaf):
            out.append({"kind": "share", "c": x["c"], "n": k, "saved": saved, "leaves": leaf})
        sha = ends.get(key, NONE_SHA)
        if k and len(key) == HEAD:
            out.append({"kind": "top", "key": key, "children": x["children"], "ends_sha256": sha})
        else:
            out.append(node_row(key, x["c"], x["n"], x["children"], x["leaves"], x["saved"], sha, True)
                       | {"parent_conv_id": up and up["c"]})
        out.append({"kind": "parent", "key": key, "c": x["c"]})
    return out


def prefix_trie(segments: DataFrame) -> DataFrame:
    """One row per node, from :func:`keyed_segments`."""
    spark = segments.sparkSession
    walked = walk_shards(segments, splitters(segments))
    names = walked.columns
    skeleton = spark.createDataFrame([tuple(r.get(x) for x in names) for r in finish_skeleton(walked)], walked.schema)
    rows = walked.where("kind not in ('skeleton', 'ends')").unionByName(skeleton)
    # As many parents as skeleton nodes.
    parents = skeleton.where("kind = 'parent'").select(F.col("key").alias("parent_key"), F.col("c").alias("parent_c"))
    nodes = (rows.where("kind = 'node'").join(F.broadcast(parents), "parent_key", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent_c")))
    plain = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return (nodes.where("node_key is null").select(plain)
            .unionByName(_with_later_segments(nodes.where("node_key is not null"), rows, segments).select(plain)))


def _with_later_segments(nodes: DataFrame, rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds what lies below the end of the segment to nodes on the way to it."""
    shares = (rows.where("kind = 'share'").groupBy("c", F.col("n").alias("k"))
              .agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
    later = segments.where("k > 0").select("c", "k").join(shares, ["c", "k"], "left").fillna(0, ["saved", "leaves"])
    for x in ("saved", "leaves"):
        later = running_sum(later, [F.col("k").desc()], x, ["c"], f"{x}_on")
    on = later.select("c", (F.col("k") - 1).alias("k"), "saved_on", "leaves_on")
    steps = F.sequence(F.when(F.col("k") == 0, 0).otherwise(1), F.lit(SEGMENT))
    below = (segments.where(F.length("key") == HEAD + SEGMENT * DIGEST).select("c", "k", "key").join(on, ["c", "k"])
             .select("saved_on", "leaves_on", F.explode(F.transform(
                 steps, lambda d: F.substring(F.col("key"), F.lit(1), F.lit(HEAD) + d * DIGEST))).alias("node_key"))
             .groupBy("node_key").agg(F.sum("saved_on").alias("saved_on"), F.sum("leaves_on").alias("leaves_on")))
    tops = (rows.where("kind = 'top'")
            .select(F.col("key").alias("below_key"), F.col("children").alias("top_children"), F.col("ends_sha256").alias("top_ends")))
    return (nodes.join(below, "node_key", "left").join(tops, "below_key", "left")
            .withColumns({"n_children": F.coalesce("top_children", "n_children"),
                          "ends_sha256": F.coalesce("top_ends", "ends_sha256"),
                          "n_leaves": F.col("n_leaves") + F.coalesce("leaves_on", F.lit(0)),
                          "saved_tokens": F.col("saved_tokens") + F.coalesce("saved_on", F.lit(0))}))


def op11_prefixtrie(spark, sf_dir: str) -> DataFrame:
    """Prefix trie of all ``conversations`` after giving them shared openings."""
    from kiln.sources.tables import table

    ready(spark)
    turns = staged(conversation_turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(keyed_segments(path_segments(shared_openings(turns))))


# The oracle counts subtrees by conversations: what lies below a node belongs to the smallest member that adds it.
# CRC-32 (fixed polynomial) is folded over the bytes of the id, eight shifts each.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, list_reduce(
      list_concat([4294967295], flatten(list_transform(
        string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS crc
  FROM (SELECT DISTINCT c FROM t)),
h AS (SELECT c, xor(crc, 4294967295) % 4 AS h FROM convs),
rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY src, r) AS pos, role, text FROM (
    SELECT h.c, 0 AS src, t.r, t.role, t.text FROM h JOIN t ON t.c = h.c - h.c % 20 AND t.r <= h.h
    UNION ALL
    SELECT t.c, 1, t.r, t.role, t.text FROM t JOIN h ON h.c = t.c AND t.r > h.h)),
steps AS (
  SELECT c, pos, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         md5(string_agg(sha256(len(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY pos)) AS node
  FROM rebuilt),
paths AS (
  SELECT c, pos, words, node, lag(node, 1, '') OVER (PARTITION BY c ORDER BY pos) AS up,
         pos = max(pos) OVER (PARTITION BY c) AS last FROM steps
  UNION ALL
  SELECT h.c, 0, 0, '', NULL, NOT EXISTS (SELECT 1 FROM steps s WHERE s.c = h.c) FROM h),
nodes AS (
  SELECT node, any_value(pos) AS depth, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends
  FROM paths GROUP BY node),
kids AS (SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT p.node,
         sum(CASE WHEN n.c = p.c THEN (n.n - 1) * p.words ELSE 0 END) OVER w AS saved,
         sum(CASE WHEN n.c = p.c AND k.n IS NULL THEN 1 ELSE 0 END) OVER w AS leaves
  FROM paths p JOIN nodes n ON n.node = p.node LEFT JOIN kids k ON k.node = p.node
  WINDOW w AS (PARTITION BY p.c ORDER BY p.pos DESC)),
sums AS (SELECT node, sum(saved) AS saved, sum(leaves) AS leaves FROM below GROUP BY node)
SELECT n.c AS conv_id, CAST(n.depth AS BIGINT) AS depth, u.c AS parent_conv_id, n.n AS n_convs,
       coalesce(k.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes u ON u.node = n.up
"""
