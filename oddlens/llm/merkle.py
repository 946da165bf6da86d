"""Merkle manifest of a table, with proofs of all rows by octopus multiproofs.

A row is a leaf: the hash of its fields, each with its length. The leaves of a source, in
ascending doc_id, make a tree whose nodes hash runs of ``ARITY`` consecutive nodes (the last
run may be shorter, even a single node); the roots of the sources, in order (null first,
then by UTF-8 bytes), make the top tree.

1. Leaves are hashed by Spark and numbered inside their source by prefix sums over range
   slices, so a source of any size is spread over tasks.
2. ``forest`` builds all trees at once, ``PAGE_LEVELS`` levels in a round: a task gets whole
   pages of at most ``ARITY ** PAGE_LEVELS`` consecutive nodes and returns every node above
   them. Rounds grow with the logarithm of the largest source.
3. Leaf partitions are runs of ``PARTITION`` consecutive leaves. Each one computes the
   minimal union of the node coordinates that the proofs of all its leaves need and that
   do not follow from its own leaves (an octopus multiproof), ``missing``.
4. These coordinates are fetched by one join with the nodes; each partition then derives
   the interiors that its proofs share, once, and expands the proof of each leaf.

Defined results: null fields count as ``-``; a null doc_id comes first in its source and
has the decimal text ''; rows with equal doc_ids are ordered by their leaf; equal rows are
leaves of their own; an empty table gives an empty result; columns other than the five
hashed ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.functions.ranking import global_row_number, prefix_sums
from oddlens.llm.common import remainder, written

ARITY = 3
#: Levels that a task builds from one page of nodes.
PAGE_LEVELS = 7
#: Leaves of a leaf partition.
PARTITION = 8192
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree above the sources' roots.
TOP = -1


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """The leaf of a row: sha256 over its fields, in lowercase hex."""
    return F.sha2(F.concat(*(_field(columns[c]) for c in FIELDS)).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, and ``changed``: the leaf after tampering, null where that changes nothing."""
    own = {c: F.col(c) for c in FIELDS}
    text = F.col("text").cast("string")
    tampered = (remainder("doc_id", 2) == 0) & (F.instr(text, "\n") > 0)
    changed = F.when(tampered, leaf_hash(own | {"text": F.replace(text, F.lit("\n"), F.lit(""))}))
    return docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(own).alias("leaf"), changed.alias("changed"))


def numbered(rows: DataFrame, size: int = PARTITION) -> tuple[DataFrame, int]:
    """The written leaves with their tree (number of the source), place ``at`` in it, the
    tree's number of leaves ``n``, and the leaf partition ``part``; and the number of trees."""
    placed = global_row_number(written(rows, "merkle-leaves"), ["doc_id", "leaf"], ["source"], "at")
    sizes = placed.groupBy("source").agg(F.max("tot_n").alias("leaves"), F.lit(1).cast("long").alias("one"))
    ordered = prefix_sums(sizes, [], ["source"], ["one", "leaves"])
    trees = written(ordered.select(F.col("source").alias("of"), (F.col("cum_one") - 1).alias("tree"), (F.col("cum_leaves") - F.col("leaves")).alias("before")), "merkle-trees")
    joined = placed.join(trees, F.col("source").eqNullSafe(F.col("of")))
    at = F.col("at") - 1
    part = F.floor((F.col("before") + at) / size).cast("long").alias("part")
    return written(joined.select("tree", at.alias("at"), F.col("tot_n").alias("n"), part, "doc_id", "leaf", "changed"), "merkle-numbered"), trees.count()


def joined(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


_NODES = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])


def _page(table: pa.Table, page_levels: int) -> pa.Table:
    """All nodes of up to ``page_levels`` levels above one page of a level."""
    by = np.argsort(table.column("at").to_numpy())
    tree, level, first, n = (table.column(c)[int(by[0])].as_py() for c in ("tree", "level", "at", "n"))
    digests = table.column("digest").take(pa.array(by)).to_pylist()
    count = -(-n // ARITY**level)
    levels, places, found = [], [], []
    for _ in range(page_levels):
        if count == 1:
            break
        digests = [joined(digests[k : k + ARITY]) for k in range(0, len(digests), ARITY)]
        level, first, count = level + 1, first // ARITY, -(-count // ARITY)
        levels += [level] * len(digests)
        places += range(first, first + len(digests))
        found += digests
    return pa.table([pa.array([tree] * len(found), pa.int64()), pa.array(levels, pa.int32()), pa.array(places, pa.int64()), pa.array([n] * len(found), pa.int64()), pa.array(found, pa.string())], schema=_NODES)


def forest(nodes: DataFrame, page_levels: int = PAGE_LEVELS) -> DataFrame:
    """Every node (tree, level, at, n, digest) of the trees whose leaves are ``nodes`` (level 0; n: leaves of the tree)."""
    every, level = nodes, 0
    most = nodes.agg(F.max("n")).first()[0] or 0
    while ARITY**level < most:
        open_ = nodes.where((F.col("level") == level) & (F.col("n") > ARITY**level))
        pages = open_.withColumn("page", F.floor(F.col("at") / ARITY**page_levels)).groupBy("tree", "page")
        nodes = written(pages.applyInArrow(lambda t: _page(t, page_levels), "tree long, level int, at long, n long, digest string"), "merkle-nodes")
        every = every.unionByName(nodes)
        level += page_levels
    return every


def missing(own: Iterable[int], n: int) -> list[tuple[int, int]]:
    """(level, place) of the fewest nodes that the proofs of the leaves ``own`` of a tree of ``n`` leaves need beside them."""
    nodes, level, found = np.unique(np.fromiter(own, np.int64)), 0, []
    while n > 1:
        parents = np.unique(nodes // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        lacking = np.setdiff1d(children[children < n], nodes, assume_unique=True)
        found += [(level, at) for at in lacking.tolist()]
        nodes, n, level = parents, -(-n // ARITY), level + 1
    return found


def _lacking(table: pa.Table, trees: int) -> pa.Table:
    """The coordinates that one leaf partition has to fetch."""
    part, tree, at, n = (table.column(c).to_numpy() for c in ("part", "tree", "at", "n"))
    rows = []
    for t in np.unique(tree):
        mine = tree == t
        rows += [(int(t), *m) for m in missing(at[mine], int(n[mine][0]))]
    rows += [(TOP, *m) for m in missing(np.unique(tree), trees)]
    columns = list(zip(*rows, strict=True)) or [()] * 3
    kinds = (pa.int64(), pa.int32(), pa.int64())
    arrays = [pa.array([int(part[0])] * len(rows), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
    return pa.table(arrays, names=["part", "tree", "level", "at"])


class Branch:
    """The part of a tree that own leaves and fetched nodes span: every node on the way up, and its neighbours."""

    def __init__(self, own: dict[int, str], n: int, fetched: dict[tuple[int, int], str]):
        self.before: list[dict[int, str]] = []  # on each level, of each own node: digests left of it in its run
        self.behind: list[dict[int, str]] = []
        level = 0
        while n > 1:
            before, behind, above = {}, {}, {}
            for parent in {at // ARITY for at in own}:
                places = range(parent * ARITY, min((parent + 1) * ARITY, n))
                run = [own[at] if at in own else fetched[level, at] for at in places]
                for k, at in enumerate(places):
                    if at in own:
                        before[at], behind[at] = "".join(run[:k]), "".join(run[k + 1 :])
                above[parent] = joined(run)
            self.before.append(before)
            self.behind.append(behind)
            own, n, level = above, -(-n // ARITY), level + 1
        (self.root,) = own.values()
        # The neighbours from each level's node upwards: shared by all leaves below it.
        self.up: list[dict[int, str]] = [{0: ""}]
        for before, behind in zip(reversed(self.before), reversed(self.behind), strict=True):
            self.up.append({at: before[at] + behind[at] + self.up[-1][at // ARITY] for at in before})
        self.up.reverse()

    def siblings(self, at: int) -> str:
        """Digests of all neighbours on the way from leaf ``at`` to the root, level by level."""
        return self.up[0][at]

    def fold(self, at: int, leaf: str) -> str:
        """The root that follows from a leaf and the neighbours of its place."""
        for before, behind in zip(self.before, self.behind, strict=True):
            leaf = hashlib.sha256((before[at] + leaf + behind[at]).encode()).hexdigest()
            at //= ARITY
        return leaf


PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof array<string>"


def _expanded(table: pa.Table, nodes: pa.Table, trees: int, full: bool) -> pa.Table:
    """The proofs of one leaf partition, expanded."""
    fetched: dict[int, dict[tuple[int, int], str]] = {}
    for tree, level, at, digest in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "at", "digest")), strict=True):
        fetched.setdefault(tree, {})[level, at] = digest
    rows = list(zip(*(table.column(c).to_pylist() for c in ("tree", "at", "n", "doc_id", "leaf", "changed")), strict=True))
    own: dict[int, dict[int, str]] = {}
    sizes = {}
    for tree, at, n, _, leaf, _ in rows:
        own.setdefault(tree, {})[at] = leaf
        sizes[tree] = n
    branches = {t: Branch(digests, sizes[t], fetched.get(t, {})) for t, digests in own.items()}
    top = Branch({t: b.root for t, b in branches.items()}, trees, fetched.get(TOP, {}))
    found = []
    for tree, at, _, doc_id, leaf, changed in rows:
        branch = branches[tree]
        siblings = branch.siblings(at) + top.siblings(tree)
        folded = top.fold(tree, branch.fold(at, changed or leaf))
        proof = [siblings[k : k + 64] for k in range(0, len(siblings), 64)] if full else None
        found.append((doc_id, leaf, branch.root, top.root, joined([siblings]), folded, folded == top.root, proof))
    kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string()))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)


def partition_proofs(rows: DataFrame, trees: int, nodes: DataFrame, full: bool = False) -> DataFrame:
    """Proofs of the numbered leaves ``rows`` of ``trees`` sources from all ``nodes``; ``full`` adds the digests themselves as ``proof``."""
    lacking = rows.groupBy("part").applyInArrow(lambda t: _lacking(t, trees), "part long, tree long, level int, at long")
    wanted = written(lacking, "merkle-missing")
    fetched = wanted.join(nodes.drop("n"), ["tree", "level", "at"]).select("part", "tree", "level", "at", "digest")

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        return _expanded(left, right, trees, full)

    return rows.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(expand, PROVED)


def manifest(docs: DataFrame, size: int = PARTITION, page_levels: int = PAGE_LEVELS) -> tuple[DataFrame, int, DataFrame]:
    """The numbered leaves, the number of sources, and every node of all trees (tree ``TOP``: above the sources)."""
    rows, trees = numbered(leaves(docs), size)
    nodes = forest(rows.select("tree", F.lit(0).alias("level"), "at", "n", F.col("leaf").alias("digest")), page_levels)
    roots = nodes.where(F.expr(f"at = 0 and (level = 0 and n = 1 or level > 0 and n <= power({ARITY}, level) and n > power({ARITY}, level - 1))"))
    top = roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), F.lit(trees).cast("long").alias("n"), "digest")
    return rows, trees, nodes.unionByName(forest(written(top, "merkle-subroots"), page_levels))


def merkle_proofs(docs: DataFrame, size: int = PARTITION, full: bool = False, page_levels: int = PAGE_LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (and proof)."""
    proved = partition_proofs(*manifest(docs, size, page_levels), full=full)
    return proved if full else proved.drop("proof")
