"""Conversation prefixes as a z-fast trie.

A prefix is known by its depth and a signature: the sum of 128-bit hashes of its
turns with their places. Tasks read whole conversations and keep a compacted
trie of them: a node has an extent (the prefix where it ends) and an entry in a
table under its handle, the prefix whose length is the two-fattest number on the
node's edge. A conversation finds its exit node by fat binary search, which
asks for a handle per step and so takes as many steps as the length has bits;
there the edge is split or a leaf added. Conversations come in batches, equal
ones of a batch are inserted once.

Each task's trie is expanded along its edges, one row per prefix with counts, and
tries of all tasks are summed by prefix; so a prefix that very many
conversations share costs a row per task. Each node belongs to its smallest member,
and a conversation owns the end of its path from some depth on. Sums over
subtrees are sums over paths: every owner adds what it owns to the nodes of
its own path, so no walk through the levels of the tree is needed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import kept, per_batch

#: Turns of one local trie, or more if one conversation has more.
TRIE_TURNS = 200_000
#: Conversations that ask for the same parent at a time.
SALT_WIDTH = 4096
#: The first turns a rebuilt conversation can take from another one.
MOST_HEAD = 3

_random = np.random.default_rng(20240311)
_KEYS = _random.integers(1, 2**62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def head_turns(conv_id: int) -> int:
    """Turns that a conversation takes over from the first one of its twenty."""
    return zlib.crc32(str(conv_id).encode()) % (MOST_HEAD + 1)


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that a power of two divides most often."""
    return high & -(1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """A compacted trie over sequences given by the signatures of their prefixes.

    ``signatures(example)`` gives the list of signatures, by length, of a sequence
    inserted before; nodes keep the number of a sequence that passes through them.
    """

    def __init__(self, signatures: Callable[[int], list]) -> None:
        self.signatures = signatures
        self.extent = [0]
        self.start = [-1]  # the extent of the node above
        self.parent = [-1]
        self.example = [-1]
        self.handles: dict[tuple, int] = {}
        self.first: dict[tuple, int] = {}  # the node whose edge begins with this prefix

    def _handle(self, node: int) -> tuple:
        length = two_fattest(self.start[node], self.extent[node])
        return length, self.signatures(self.example[node])[length]

    def _add(self, start: int, extent: int, parent: int, example: int) -> int:
        node = len(self.extent)
        self.extent.append(extent)
        self.start.append(start)
        self.parent.append(parent)
        self.example.append(example)
        self.handles[self._handle(node)] = node
        self.first[start + 1, self.signatures(example)[start + 1]] = node
        return node

    def exit_node(self, own: list) -> tuple[int, int]:
        """The deepest node whose edge agrees with a sequence, and the length that agrees."""
        node, low, high = 0, 0, len(own) - 1
        while low < high:
            length = two_fattest(low, high)
            found = self.handles.get((length, own[length]))
            if found is None:
                high = length - 1
                continue
            extent = self.extent[found]
            if extent <= len(own) - 1 and self.signatures(self.example[found])[extent] == own[extent]:
                node, low = found, extent
                high = max(high, low)
            else:
                # The sequence leaves within this edge, behind its handle.
                return found, self._agreeing(found, own, length)
        below = self.first.get((low + 1, own[low + 1])) if low + 1 < len(own) else None
        if below is None:
            return node, low
        return below, self._agreeing(below, own, low + 1)

    def _agreeing(self, node: int, own: list, low: int) -> int:
        other = self.signatures(self.example[node])
        high = min(self.extent[node], len(own) - 1)
        while low < high:
            middle = (low + high + 1) // 2
            if other[middle] == own[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def insert(self, example: int) -> int:
        """The node where the sequence ends, made if need be."""
        own = self.signatures(example)
        node, agreed = self.exit_node(own)
        if agreed < self.extent[node]:
            node = self._split(node, agreed)
        if agreed == len(own) - 1:
            return node
        return self._add(agreed, len(own) - 1, node, example)

    def _split(self, lower: int, extent: int) -> int:
        del self.handles[self._handle(lower)]
        upper = self._add(self.start[lower], extent, self.parent[lower], self.example[lower])
        self.start[lower], self.parent[lower] = extent, upper
        self.handles[self._handle(lower)] = lower
        self.first[extent + 1, self.signatures(self.example[lower])[extent + 1]] = lower
        return upper


def turn_digests(conversations: DataFrame) -> DataFrame:
    """Per turn with a conv_id: ``conv, block, turn, digest`` (of role and text) and ``words``."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    return conversations.select(
        conv.alias("conv"),
        (conv - conv % 20).alias("block"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).filter("conv IS NOT NULL")


def _mixed(digests: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 128-bit hash per turn and place, as two columns."""
    with np.errstate(over="ignore"):
        out = np.empty((len(places), 2), np.uint64)
        for i in range(2):
            value = (digests[:, i] ^ (places * _KEYS[i])) * _KEYS[2 + i]
            value ^= value >> np.uint64(32)
            value = (value + digests[:, 1 - i]) * _KEYS[3 - i]
            value ^= value >> np.uint64(29)
            value *= _KEYS[i]
            out[:, i] = value ^ (value >> np.uint64(32))
        return out


PATHS = "conv long, depth int, s1 long, s2 long, words long, before long, total long, last boolean"


def rebuilt_paths(turns: DataFrame, head: Callable[[int], int] = head_turns) -> DataFrame:
    """A row per conversation and depth of its rebuilt turns, the root (depth 0) too, each conversation's rows in order.

    ``s1, s2`` sign the prefix; ``words`` are those of its last turn, ``before``
    those of the turns before it, ``total`` those of the conversation.

    The twenty conversations of a block go to one task, sorted; rows stream
    through it, and it holds the digests of one conversation at a time.
    """
    dealt = turns.repartition("block").sortWithinPartitions("block", "conv", "turn", "digest", "words")
    names = [part.split(" ")[0] for part in PATHS.split(", ")]

    def paths(conv: int, digests: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
        n = len(words)
        depth = np.arange(n + 1)
        signed = np.zeros((n + 1, 2), np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_mixed(digests, depth[1:].astype(np.uint64)), axis=0, out=signed[1:])
        upto = np.concatenate(([0], np.cumsum(words)))
        own = np.concatenate(([0], words))
        return [
            np.full(n + 1, conv), depth, signed[:, 0].view(np.int64), signed[:, 1].view(np.int64),
            own, upto - own, np.full(n + 1, upto[-1]), depth == n,
        ]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        out: list[list[np.ndarray]] = []
        block, first_digests, first_words = None, np.empty((0, 2), np.uint64), np.empty(0, np.int64)
        current: tuple[int, int] | None = None

        def close() -> None:
            nonlocal block, first_digests, first_words
            digests = np.concatenate([d for d, _ in held])
            words = np.concatenate([w for _, w in held])
            held.clear()
            if current[0] != block:
                # Without the conversation that heads the block there is nothing to take over.
                block = current[0]
                has_first = current[1] == block
                first_digests = digests[:MOST_HEAD] if has_first else digests[:0]
                first_words = words[:MOST_HEAD] if has_first else words[:0]
            h = head(current[1])
            out.append(
                paths(
                    current[1],
                    np.concatenate([first_digests[:h], digests[h:]]),
                    np.concatenate([first_words[:h], words[h:]]),
                )
            )

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(parts) for parts in zip(*out, strict=True)]
            out.clear()
            columns[1] = columns[1].astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            conv, of_block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            digests = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(-1, 2)
            words = batch.column(3).to_numpy()
            edges = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                key = int(of_block[a]), int(conv[a])
                if current is not None and key != current:
                    close()
                current = key
                held.append((digests[a:b], words[a:b]))
            if sum(len(parts[0]) for parts in out) > 50_000:
                yield flush()
        if current is not None:
            close()
        if out:
            yield flush()

    return per_batch(dealt.select("conv", "block", "digest", "words"), build, PATHS)


NODES = (
    "depth int, s1 long, s2 long, p1 long, p2 long, words long, before long, conv long, n_convs long, n_ends long, totals long"
)


def local_tries(paths: DataFrame) -> DataFrame:
    """Prefixes of each task's conversations from its z-fast tries, with counts and the smallest member.

    ``p1, p2`` sign the prefix one turn shorter; ``n_ends`` members have no more
    turns; ``totals`` are the words of all members.
    """
    names = [part.split(" ")[0] for part in NODES.split(", ")]

    def expand(columns: list[np.ndarray]) -> pa.RecordBatch:
        conv, depth, s1, s2, words, before, total, last = columns
        begin = np.flatnonzero(depth == 0)
        end = np.flatnonzero(last)
        pairs = list(zip(s1.tolist(), s2.tolist(), strict=True))
        memo: dict[int, list] = {}

        def signatures(example: int) -> list:
            found = memo.get(example)
            if found is None:
                found = memo[example] = pairs[begin[example] : end[example] + 1]
            return found

        trie = ZFastTrie(signatures)
        # Equal conversations of the batch are one sequence.
        same: dict[tuple, int] = {}
        node_of = np.empty(len(begin), np.int64)
        for example, at in enumerate(end.tolist()):
            key = (int(depth[at]), pairs[at])
            node = same.get(key)
            if node is None:
                node = same[key] = trie.insert(example) if key[0] else 0
            node_of[example] = node
        n = len(trie.extent)
        extent, start, parent = (np.array(x) for x in (trie.extent, trie.start, trie.parent))
        ends = np.bincount(node_of, minlength=n)
        members, totals = ends.copy(), np.zeros(n, np.int64)
        np.add.at(totals, node_of, total[end])
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, node_of, conv[begin])
        for node in np.argsort(-extent, kind="stable").tolist():
            above = parent[node]
            if above >= 0:
                members[above] += members[node]
                totals[above] += totals[node]
                least[above] = min(least[above], least[node])
        # Edges: a row for each depth behind the extent above.
        size = extent - start
        node = np.repeat(np.arange(n), size)
        behind = np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size) + 1
        example = np.array(trie.example)
        at = np.where(example >= 0, begin[np.maximum(example, 0)], 0)[node] + start[node] + behind
        at[node == 0] = begin[0]
        above = np.where(node == 0, at, at - 1)
        values = [
            depth[at].astype(np.int32), s1[at], s2[at], s1[above], s2[above], words[at], before[at], least[node],
            members[node], np.where(depth[at] == extent[node], ends[node], 0), totals[node],
        ]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= TRIE_TURNS:
                table = pa.Table.from_batches(held)
                # The last conversation may go on in the next batch.
                whole = int(np.flatnonzero(table.column(7).to_numpy())[-1]) + 1 if pa.compute.any(table.column(7)).as_py() else 0
                if whole:
                    yield expand([c.to_numpy() for c in table.slice(0, whole).columns])
                    held = [b for b in table.slice(whole).to_batches() if b.num_rows]
                    size = table.num_rows - whole
        if held:
            yield expand([c.to_numpy() for c in pa.Table.from_batches(held).columns])

    return per_batch(paths, build, NODES)


def ends_digests(paths: DataFrame) -> DataFrame:
    """Per node where conversations end: SHA-256 of their ids, ascending and joined by commas.

    A digest needs its ids one after the other; they stream through a task,
    sorted, and none is held.
    """
    ends = paths.filter("last").select("depth", "s1", "s2", "conv")
    dealt = ends.repartition("depth", "s1", "s2").sortWithinPartitions("depth", "s1", "s2", "conv")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple] = []
            for depth, s1, s2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, s1, s2) == current:
                    running.update(b",%d" % conv)
                    continue
                if current is not None:
                    done.append((*current, running.hexdigest()))
                current, running = (depth, s1, s2), hashlib.sha256(b"%d" % conv)
            if done:
                yield batch_of(done)
        if current is not None:
            yield batch_of([(*current, running.hexdigest())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["depth", "s1", "s2", "ends_sha256"],
        )

    return per_batch(dealt, digest, "depth int, s1 long, s2 long, ends_sha256 string")


KEY = ["depth", "s1", "s2"]


def prefix_nodes(conversations: DataFrame, head: Callable[[int], int] = head_turns) -> DataFrame:
    """Per distinct prefix ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are in order of ``turn`` (null first), equal ones by the MD5 of role
    and text; repeated rows are turns of their own. A null role or text is an
    empty one; rows without conv_id belong to no conversation. A conversation c
    begins with the first ``head(c)`` turns of conversation c - c % 20 (% as in
    SQL), followed by its own without as many. One without turns is a member of
    the root. Other columns are not read; no rows in, none out.
    """
    paths = kept(rebuilt_paths(turn_digests(conversations), head))
    nodes = (
        local_tries(paths)
        .groupBy(*KEY)
        .agg(
            F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words"), F.min("before").alias("before"),
            F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"), F.sum("totals").alias("totals"),
        )
    )
    nodes = kept(nodes)
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = kept(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    # A conversation owns the nodes whose smallest member it is: the end of its path.
    owners = kept(
        nodes.groupBy("conv").agg(
            F.min("depth").alias("top"),
            F.min_by(F.struct("p1", "p2"), "depth").alias("above"),
            F.min("before").alias("top_before"),
            F.max(F.col("before") + F.col("words")).alias("total"),
            (F.min("n_children") == 0).cast("long").alias("leaf"),
        )
    )
    owned = paths.join(owners.select("conv", "top_before", F.col("total").alias("own_total"), "leaf"), "conv")
    subtrees = owned.groupBy(*KEY).agg(
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("own_total") - F.greatest("before", "top_before")).alias("distinct_words"),
    )
    # Many tops may hang on one node: ids of a range ask for it once, and then tell each other.
    asking = owners.filter("top > 0").select(
        "conv", (F.col("top") - 1).alias("depth"), F.col("above.p1").alias("s1"), F.col("above.p2").alias("s2"),
        F.floor(F.col("conv") / SALT_WIDTH).alias("salt"),
    )
    answers = (
        asking.select(*KEY, "salt")
        .distinct()
        .join(nodes.select(*KEY, F.col("conv").alias("parent")), KEY)
        .select(*KEY, "salt", "parent")
    )
    parents = asking.join(answers, [*KEY, "salt"]).select("conv", (F.col("depth") + 1).alias("top"), "parent")
    whole = (
        nodes.join(subtrees, KEY)
        .join(ends_digests(paths), KEY, "left")
        .join(parents.withColumnRenamed("top", "depth"), ["conv", "depth"], "left")
    )
    nobody = hashlib.sha256(b"").hexdigest()
    return whole.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        # Words of all members from this turn on, less those that a trie still has to hold.
        (F.col("totals") - F.col("n_convs") * F.col("before") - F.col("distinct_words")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
