"""Edit-aware token counts.

A document keeps a segment tree over its pre-tokens: leaves are runs of pre-tokens with the length
in characters and the token count of each, inner nodes hold the sums of both. An edit finds its
place by descending the length sums, walks back by the boundary context (how far beyond its end a
pre-token's extent can depend on the text), splits pre-tokens again from there until a boundary
falls on an old one behind the edit, and encodes only the pre-tokens of that stretch. Only sums on
the paths of the leaves it touched are updated; the total is the root's. Leaves lie in the slots of
an implicit binary tree with room between them: new leaves are spread over the least window around
them that has room, so an edit moves few leaves, and the tree grows only when it is nearly full.
The stored tree holds its sums, so nothing is summed again when it is loaded.

A byte-level BPE never merges across pre-tokens, so the counts are those of the whole text. How far
a pre-token's extent can depend on what follows it is known for the patterns in ``CONTEXTS``; any
other pattern is refused unless the caller gives its ``context``.

:func:`build` makes the tree column of a table, :func:`apply_edits` takes it on. Edits of a
document are an array of (start, end, text) in characters, applied in order, each to the result of
the one before; ends are clipped to the text. Defined cases: null text counts as empty; null or no
edits change nothing; repeated rows are counted alike; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .workers import tidied

#: Pre-tokens in a leaf when it is made; it is split at twice this.
LEAF = 64
#: Patterns, and the characters behind its end that a pre-token's extent can depend on: none of their parts looks further ahead.
CONTEXTS = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": 3}
REMEMBERED = 100_000


class Counter:
    """Splits text into pre-tokens and counts the tokens of each."""

    def __init__(self, ranks_path: str, pattern: str, context: int | None = None):
        import tiktoken

        self.context = CONTEXTS.get(pattern) if context is None else context
        if self.context is None:
            raise ValueError("how far this pattern looks ahead isn't known: give its context in characters")

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, pre_tokens: list[str]) -> list[int]:
        known = self.known
        new = set(pre_tokens).difference(known)
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(pre_tokens)
            one = self.encoding._core_bpe.encode_ordinary
            known.update((p, len(one(p))) for p in new)
        return list(map(known.__getitem__, pre_tokens))

    def whole(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


@lru_cache(maxsize=2)
def counter(ranks_path: str, pattern: str, context: int | None = None) -> Counter:
    return Counter(ranks_path, pattern, context)


class Tree:
    """Leaves of (lengths, counts) in the slots of an implicit binary tree; ``sums`` has characters, tokens and leaves below each node."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self._lay([(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(lengths), LEAF)])

    def _lay(self, leaves: list) -> None:
        n = self.size = 2 << max(0, len(leaves) - 1).bit_length()
        self.slots: list = [None] * n
        self.sums = [[0] * (2 * n) for _ in range(3)]
        self._spread(1, leaves)

    @property
    def total(self) -> int:
        return self.sums[1][1]

    @property
    def chars(self) -> int:
        return self.sums[0][1]

    def leaf(self, slot: int) -> tuple[list[int], list[int]]:
        """The lists of a leaf; one that lies in the stored bytes is unpacked when it is first asked for."""
        found = self.slots[slot]
        if found is None:
            return [], []
        if not isinstance(found[0], list):
            found = self.slots[slot] = (found[0].tolist(), found[1].tolist())
        return found

    def _window(self, node: int) -> tuple[int, int]:
        """First slot and number of slots below a node."""
        width = self.size >> (node.bit_length() - 1)
        return node * width - self.size, width

    def _spread(self, node: int, leaves: list) -> None:
        """Deal leaves evenly over the slots below ``node`` and sum there; sums above are not touched."""
        first, width = self._window(node)
        self.slots[first : first + width] = [None] * width
        for i, leaf in enumerate(leaves):
            self.slots[first + i * width // len(leaves)] = leaf
        chars, tokens, used = self.sums
        for slot in range(first, first + width):
            x, at = self.slots[slot], self.size + slot
            chars[at], tokens[at], used[at] = (0, 0, 0) if x is None else (int(sum(x[0])), int(sum(x[1])), 1)
        lo, n = (self.size + first) // 2, width // 2
        while n:
            for at in range(lo, lo + n):
                for row in self.sums:
                    row[at] = row[2 * at] + row[2 * at + 1]
            lo, n = lo // 2, n // 2

    def _climb(self, nodes: set[int]) -> None:
        """Sum again on the paths from nodes to the root."""
        while nodes := {n // 2 for n in nodes if n > 1}:
            for at in nodes:
                for row in self.sums:
                    row[at] = row[2 * at] + row[2 * at + 1]

    def find(self, at: int) -> tuple[int, int, int]:
        """(slot, pre-token in its leaf, start) of the pre-token that holds character ``at``; at the end, one behind the last."""
        chars = self.sums[0]
        if at >= chars[1]:
            slot = self.last()
            return slot, len(self.leaf(slot)[0]), chars[1]
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at >= start + chars[node]:
                start += chars[node]
                node += 1
        slot = node - self.size
        for k, n in enumerate(self.leaf(slot)[0]):
            if at < start + n:
                return slot, k, start
            start += n
        raise AssertionError("sums and leaves differ")

    def last(self) -> int:
        """The slot of the last leaf; the first if there is none."""
        node, used = 1, self.sums[2]
        while node < self.size:
            node = 2 * node + (used[2 * node + 1] > 0)
        return node - self.size if used[1] else 0

    def splice(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in place of those from ``first`` up to, without, ``last``, each (slot, pre-token)."""
        (a, i), (b, j) = first, last
        lengths = self.leaf(a)[0][:i] + lengths + self.leaf(b)[0][j:]
        counts = self.leaf(a)[1][:i] + counts + self.leaf(b)[1][j:]
        step = 2 * LEAF if len(lengths) <= 2 * LEAF else LEAF
        new = [(lengths[k : k + step], counts[k : k + step]) for k in range(0, len(lengths), step)]
        free = [s for s in range(a, b + 1)]
        if len(new) <= len(free):
            # those that are left over stay empty
            for slot, leaf in zip(free, [*new, *[None] * (len(free) - len(new))], strict=True):
                self.slots[slot] = leaf
                at = self.size + slot
                for row, value in zip(self.sums, (0, 0, 0) if leaf is None else (sum(leaf[0]), sum(leaf[1]), 1), strict=True):
                    row[at] = value
            self._climb({self.size + s for s in free})
            return
        node = self.size + a
        while True:
            lo, width = self._window(node)
            if lo + width > b:
                leaves = [x for s, x in enumerate(self.slots[lo:a], lo) if x is not None] + new + [x for x in self.slots[b + 1 : lo + width] if x is not None]
                if len(leaves) <= (width if width < 8 else width * 3 // 4):
                    break
            if node == 1:
                self._lay(leaves)
                return
            node //= 2
        # leaves below the window's edges that the edit took out are gone with it, as it reaches over all of them
        self._spread(node, leaves)
        self._climb({node})

    def dump(self) -> bytes:
        """Header, sums, leaf sizes, then lengths and counts of all pre-tokens."""
        leaves = [x for x in self.slots if x is not None]
        sizes = np.array([0 if x is None else len(x[0]) for x in self.slots], "<u4")
        flat = [np.concatenate([np.zeros(0, "<u4"), *(np.asarray(x[k], "<u4") for x in leaves)]) for k in (0, 1)]
        return np.concatenate([np.array([self.size, len(flat[0])], "<u4"), *(np.array(row, "<u4") for row in self.sums), sizes, *flat]).tobytes()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        flat = np.frombuffer(data, "<u4")
        tree = cls.__new__(cls)
        n, pre_tokens = tree.size, _ = flat[:2].tolist()
        tree.sums = [flat[2 + k * 2 * n : 2 + (k + 1) * 2 * n].tolist() for k in range(3)]
        sizes = flat[2 + 6 * n : 2 + 7 * n]
        lengths, counts = flat[2 + 7 * n : 2 + 7 * n + pre_tokens], flat[2 + 7 * n + pre_tokens :]
        ends = np.cumsum(sizes).tolist()
        tree.slots = [(lengths[e - s : e], counts[e - s : e]) if s else None for s, e in zip(sizes.tolist(), ends, strict=True)]
        return tree

    @staticmethod
    def pre_tokens(data: bytes) -> int:
        """The number of pre-tokens of a stored tree."""
        return int(np.frombuffer(data, "<u4", 1, 4)[0])


def plant(text: str, counter: Counter) -> Tree:
    """The tree of a text that has none yet. What no pattern matches goes to the next pre-token and counts nothing."""
    found = counter.pattern.findall(text)
    if sum(map(len, found)) == len(text):
        return Tree(list(map(len, found)), counter.count(found))
    lengths, found, at = [], [], 0
    for m in counter.pattern.finditer(text):
        lengths.append(m.end() - at)
        found.append(m[0])
        at = m.end()
    counts = counter.count(found)
    return Tree([*lengths, len(text) - at], [*counts, 0]) if at < len(text) else Tree(lengths, counts)


def edit(tree: Tree, text: str, start: int, end: int, new: str, counter: Counter) -> tuple[str, int]:
    """Change ``text[start:end]`` to ``new`` in text and tree: the new text, and how many pre-tokens were encoded."""
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    after = text[:start] + new + text[end:]
    grown, behind = len(new) - (end - start), start + len(new)
    leaf, k, at = tree.find(max(0, start - counter.context))
    if k == len(tree.leaf(leaf)[0]) and k:  # beyond the end: the last pre-token may go on
        k -= 1
        at -= tree.leaf(leaf)[0][k]
    first, old_at, old = (leaf, k), at, (leaf, k)
    lengths, found = [], []
    done = False
    for m in counter.pattern.finditer(after, at):
        lengths.append(m.end() - at)
        found.append(m[0])
        at = m.end()
        if at < behind:
            continue
        # the old boundary that could lie here
        while old_at < at - grown:
            a, b = old
            while b == len(tree.leaf(a)[0]):
                a, b = a + 1, 0
            old_at += tree.leaf(a)[0][b]
            old = (a, b + 1)
        if old_at == at - grown and old_at >= end:
            done = True
            break
    counts = counter.count(found)
    if not done:
        last = max(tree.last(), first[0])
        old = (last, len(tree.leaf(last)[0]))
        if at < len(after):
            lengths, counts = [*lengths, len(after) - at], [*counts, 0]
    tree.splice(first, old, lengths, counts)
    return after, len(found)


def build(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), context: int | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, text, tree, n_tokens, n_pretokens."""
    ship(docs.sparkSession)
    names = ["doc_id", *keep, "text", "tree", "n_tokens", "n_pretokens"]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(ranks_path, pattern, context)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                trees = [plant(t or "", own) for t in part.column(part.num_columns - 1).to_pylist()]
                dumps = [t.dump() for t in trees]
                made = [pa.array(dumps, pa.binary()), pa.array([t.total for t in trees], pa.int64()), pa.array(list(map(Tree.pre_tokens, dumps)), pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, tree binary, n_tokens long, n_pretokens long")


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, edits_col: str = "edits", context: int | None = None) -> DataFrame:
    """From doc_id, text, tree and an array of edits: doc_id, text and tree after them, n_tokens, n_edits, n_encoded."""
    ship(trees.sparkSession)
    names = ["doc_id", "text", "tree", "n_tokens", "n_edits", "n_encoded"]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(ranks_path, pattern, context)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for text, dump, edits in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    tree, text, encoded = Tree.load(dump), text or "", 0
                    for e in edits or ():
                        text, n = edit(tree, text, e["start"], e["end"], e["text"] or "", own)
                        encoded += n
                    rows.append((text, tree.dump(), tree.total, len(edits or ()), encoded))
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names)

    rows = trees.select("doc_id", "text", "tree", edits_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, tree binary, n_tokens long, n_edits long, n_encoded long")
