"""Exact dedup with Patricia-trie owners.

Map side, every task inserts its texts into a compressed radix trie and passes
on one row per distinct text, so a text that fills a third of the corpus costs
one row per task.  These rows are dealt by (length, content hash); each
partition inserts the full byte strings into its own trie, whose terminal
nodes hold the owner and the number of rows.  A trie that outgrows
``memory_bytes`` writes its largest subtree to a file of the task and carries
on; spilled subtrees are rebuilt one at a time afterwards, each without the
prefix they share.  The decisions go back to the rows by digest and length.

Defined cases: null text counts as empty; null ids are smaller than any id;
rows that repeat both id and text are one listed document, of which one row
stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAP_MEMORY = 32 << 20
TRIE_MEMORY = 96 << 20
BATCH_BYTES = 8 << 20
NODE_BYTES = 400  # of Python objects, per node


def prefix_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, children: dict | None = None, value: tuple | None = None):
        self.label, self.children, self.value = label, children if children is not None else {}, value


class RadixTrie:
    """Byte strings to (owner, rows); edges hold whole byte runs.

    ``keep`` picks the owner ("max" or "min"; None is the smallest id).
    With ``spill`` the subtree under the root that holds most bytes goes to a
    temporary file of this process as soon as ``memory`` is exceeded.
    """

    def __init__(self, keep: str = "max", memory: int = TRIE_MEMORY, spill: bool = True):
        self.keep, self.memory, self.spill = keep, memory, spill
        self.clear()

    def clear(self) -> None:
        self.root, self.held, self.by_child, self.files = Node(b""), 0, {}, {}

    def merge(self, a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        rank = lambda v: (v is not None, v or 0)
        return (max if self.keep == "max" else min)(a[0], b[0], key=rank), a[1] + b[1]

    def insert(self, key: bytes, owner, rows: int) -> None:
        head = key[:1]
        if head in self.files:
            pickle.dump((key, owner, rows), self.files[head])
            return
        node, at, grown = self.root, 0, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = child = Node(key[at:])
                grown += len(child.label) + NODE_BYTES
                at = len(key)
            elif key.startswith(child.label, at):
                at += len(child.label)
            else:
                n = prefix_length(child.label, key[at:at + len(child.label)])
                upper = Node(child.label[:n], {child.label[n]: child})
                child.label = child.label[n:]
                node.children[key[at]] = child = upper
                grown += NODE_BYTES
                at += n
            node = child
        node.value = self.merge(node.value, (owner, rows))
        self.held += grown
        self.by_child[head] = self.by_child.get(head, 0) + grown
        if self.spill and self.held > self.memory and len(key):
            self._spill_largest()

    def _spill_largest(self) -> None:
        head = max(self.by_child, key=self.by_child.get)
        child = self.root.children.pop(head[0], None) if head else None
        if child is None:
            return
        f = self.files[head] = tempfile.TemporaryFile()
        for key, value in walk(child):
            pickle.dump((key, *value), f)
        self.held -= self.by_child.pop(head)

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """All (bytes, (owner, rows)); spilled subtrees are rebuilt in turn."""
        yield from walk(self.root)
        self.root = Node(b"")
        for f in self.files.values():
            f.seek(0)
            entries = read_entries(f)
            shared = next(entries)[0]
            for key, _, _ in entries:
                shared = shared[:prefix_length(shared, key)]
            f.seek(0)
            sub = RadixTrie(self.keep, self.memory)
            for key, owner, rows in read_entries(f):
                sub.insert(key[len(shared):], owner, rows)
            f.close()
            for key, value in sub.items():
                yield shared + key, value
        self.files = {}


def read_entries(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def walk(node: Node) -> Iterator[tuple[bytes, tuple]]:
    stack = [(node, node.label)]
    while stack:
        node, key = stack.pop()
        if node.value is not None:
            yield key, node.value
        stack.extend((c, key + c.label) for c in node.children.values())


def _combine(batches: Iterator[pa.RecordBatch], keep: str) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a task's share (more when the trie is emptied midway)."""
    trie = RadixTrie(keep, MAP_MEMORY, spill=False)
    for b in batches:
        for text, owner in zip(b.column("text"), b.column("id").to_pylist()):
            trie.insert(text.as_py(), owner, 1)
            if trie.held > trie.memory:
                yield from _partials(trie)
                trie.clear()
    yield from _partials(trie)


def _partials(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for key, (owner, n) in trie.items():
        rows.append((key, owner, n))
        held += len(key)
        if held > BATCH_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, owner, n = zip(*rows)
    return pa.record_batch({"text": pa.array(text, pa.binary()), "owner": pa.array(owner, pa.int64()),
                            "n": pa.array(n, pa.int64())})


def _own(batches: Iterator[pa.RecordBatch], keep: str, memory: int) -> Iterator[pa.RecordBatch]:
    """Owner and size of every distinct text of a (length, content hash) partition."""
    trie = RadixTrie(keep, memory)
    for b in batches:
        for text, owner, n in zip(b.column("text"), b.column("owner").to_pylist(), b.column("n").to_pylist()):
            trie.insert(text.as_py(), owner, n)
    rows = []
    for key, (owner, n) in trie.items():
        if n > 1:
            rows.append((hashlib.sha256(key).digest(), len(key), owner, n))
        if len(rows) == 10_000:
            yield _groups(rows)
            rows = []
    if rows:
        yield _groups(rows)


def _groups(rows: list[tuple]) -> pa.RecordBatch:
    sha, size, owner, n = zip(*rows)
    return pa.record_batch({"g_sha": pa.array(sha, pa.binary()), "g_bytes": pa.array(size, pa.int64()),
                            "owner": pa.array(owner, pa.int64()), "n": pa.array(n, pa.int64())})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                memory_bytes: int = TRIE_MEMORY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    base = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    partial = base.mapInArrow(lambda it: _combine(it, keep), "text binary, owner long, n long")
    dealt = partial.repartition(F.octet_length("text"), F.xxhash64("text"))
    groups = dealt.mapInArrow(lambda it: _own(it, keep, memory_bytes),
                              "g_sha binary, g_bytes long, owner long, n long")
    rows = base.select("id", F.octet_length("text").cast("long").alias("n_bytes"),
                       F.unhex(F.sha2("text", 256)).alias("sha"))
    # numbered before the join, on a key that copies do not share, so that the join can split a hot text
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("id", "sha").orderBy("n_bytes")))
    out = rows.join(groups, (rows.sha == groups.g_sha) & (rows.n_bytes == groups.g_bytes), "left")
    single = F.col("n").isNull()
    return out.select(
        F.col("id").alias("doc_id"),
        F.when(single, F.col("id")).otherwise(F.col("owner")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("id").eqNullSafe(F.col("owner")) & (F.col("copy") == 1))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
