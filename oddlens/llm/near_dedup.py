"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles of ``words`` words (4 by default); two documents are linked when
their sets have a Jaccard similarity of 0.8 or more. Plain banding into L tables of k
values needs L * k minhashes. Here two collections of ``HALVES`` half keys (of ``WIDTH``
minhashes each) are formed, and every pair of a left and a right half key is the key of
one table: HALVES ** 2 tables from 2 * HALVES * WIDTH minhashes.

1. One pass writes, for each document, the size and digest of its set and its half keys.
   Equal sets become one class, so copies never meet as pairs.
2. Half keys that only one class has are dropped before any table key is formed.
3. Candidates share a table key. They are compared on their full sets, in rounds that
   never list all pairs of a bucket whose members are already connected:
   a. Each bucket's most typical class (whose half keys most classes have: in a group of
      edited copies the text that the others were made from) meets its members. Pairs
      at ``LEAST`` are links; pairs at ``KIN`` join classes to families.
   b. Inside a family that the links leave in several components, every class outside the
      largest one meets all others in blocks of ``BLOCK`` classes: a block holds its sets
      once, and gives one link for each component that a class touches, not its pairs.
   c. Buckets that hold several families: their classes meet in blocks like those of b. Equal
      buckets are one, and a large component meets the classes that share any bucket with
      it once, so no table of pairs is made.
   So no candidate pair that could join two components is left out.
4. Components of the links, and the smallest doc_id of each.

A pair at similarity 0.8 shares a table with probability (1 - (1 - 0.8 ** 2) ** 10) ** 2,
that is 0.99993, and 0.9999999 at 0.9.

Defined results: null, empty or blank texts have an empty set and are linked with
nothing; repeated rows are copies; rows that share a doc_id stay or go by their own
texts; a null doc_id counts as larger than any other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import LOWER, slices, text_bytes, written
from oddlens.llm.components import components

HALVES, WIDTH, WORDS = 10, 2, 4
#: Most words of a shingle.
MOST_WORDS = 16
#: Least intersection / union, in hundredths.
LEAST = 80
#: The same for pairs that only show classes to be of one family.
KIN = 30
#: Classes, and shingles of all of them, in one side of a block.
BLOCK, BLOCK_SHINGLES = 256, 200_000
#: Classes of a component beyond which it meets the classes outside it once, not in each bucket.
LARGE = 64
#: Words whose hashes one task remembers at most.
REMEMBERED = 500_000

_rng = np.random.default_rng(7)
_MULTIPLY = _rng.integers(1, 1 << 63, 2 * HALVES * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _rng.integers(1, 1 << 63, 2 * HALVES, dtype=np.uint64)
_PLACES = np.append(_PLACES, _rng.integers(1, 1 << 63, MOST_WORDS - WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that lets every bit reach every other (uint64, wraps around)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, hashes: dict, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words; all words if there are fewer."""
    words = text_bytes(text).translate(LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    if n < size:
        return _mix((each * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
    total = each[: n - size + 1] * _PLACES[0]
    for k in range(1, size):
        total += each[k : n - size + 1 + k] * _PLACES[k]
    return np.unique(_mix(total))


def half_keys(found: np.ndarray) -> np.ndarray:
    """The 2 * HALVES half keys of a set, as int64; no two places share a value by design."""
    least = np.full(len(_MULTIPLY), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), 2048):
        np.minimum(least, (found[a : a + 2048, None] * _MULTIPLY).min(axis=0), out=least)
    keys = _SALTS.copy()
    for k in range(WIDTH):
        keys = _mix(keys ^ least[k :: WIDTH])
    return keys.view(np.int64)


def _signed(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for doc_ids, texts, text_hashes in (part for batch in batches for part in slices(batch)):
        sizes, digests, keys = [], [], []
        for text in texts:
            found = shingles(text, hashes, words)
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()))
            keys.append(half_keys(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(text_hashes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "n_shingles", "digest", "keys"],
        )


def _sets(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Full sets of the documents whose text has the digest of their class."""
    hashes = _WordHashes()
    for cids, expected, texts in (part for batch in batches for part in slices(batch, 64)):
        rows = []
        for cid, digest, text in zip(cids, expected, texts, strict=True):
            found = shingles(text, hashes, words).tobytes()
            if xxhash.xxh3_128_digest(found) == digest:
                rows.append((cid, found))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["cid", "members"])


def _compare(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Pairs at ``least`` hundredths or more, and whether they are links."""
    for a, b, left, right in (part for batch in batches for part in slices(batch, 64)):
        rows = []
        for k, (x, y) in enumerate(zip(left, right, strict=True)):
            n, m = len(x) // 8, len(y) // 8
            if 100 * min(n, m) >= least * max(n, m):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                if 100 * both >= least * (n + m - both):
                    rows.append((a[k], b[k], 100 * both >= LEAST * (n + m - both)))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "linked"])


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, and whether they are links."""
    left = sets.select(F.col("cid").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("cid").alias("b"), F.col("members").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return written(joined.mapInArrow(lambda rows: _compare(rows, least), "a long, b long, linked boolean"), "near-links")


def _block_links(table: pa.Table) -> pa.Table:
    """Links between the two sides of a block; side 0 holds classes outside the largest component.

    In a block of a chunk with itself all rows are on side 0.
    """
    cids, comps, sides = (table.column(c).to_numpy() for c in ("cid", "comp", "side"))
    sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
    mine = np.flatnonzero(sides == 0)
    others = np.flatnonzero(sides == 1) if (sides == 1).any() else mine
    sizes = np.array([len(sets[k]) for k in others])
    owner = np.repeat(np.arange(len(others)), sizes)
    all_members = np.concatenate([sets[k] for k in others]) if len(others) else np.empty(0, np.uint64)
    found = []
    for x in mine:
        at = np.minimum(np.searchsorted(sets[x], all_members), len(sets[x]) - 1)
        both = np.bincount(owner[sets[x][at] == all_members], minlength=len(others))
        linked = (100 * both >= LEAST * (len(sets[x]) + sizes - both)) & (comps[others] != comps[x])
        if linked.any():
            _, first = np.unique(comps[others][linked], return_index=True)
            found += [(int(cids[x]), int(cids[k])) for k in others[linked][first]]
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def _family_links(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links inside families of several components, found in blocks; ``classes``: cid, comp, family."""
    sized = classes.join(sets.select("cid", (F.octet_length("members") / 8).alias("n")), "cid")
    per = sized.groupBy("family", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    main = per.groupBy("family").agg(
        F.max(F.struct("k", (-F.col("comp")).alias("c"))).alias("top"), F.count("*").alias("parts"), F.sum("k").alias("k"), F.sum("n").alias("n")
    )
    main = main.where("parts > 1").select("family", (-F.col("top.c")).alias("main"), "k", "n", F.col("top.k").alias("k1"))
    chunks = lambda k, n: F.greatest(F.ceil(k / BLOCK), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    main = main.withColumn("inner", chunks(F.col("k1"), F.col("n"))).withColumn("outer", chunks(F.col("k") - F.col("k1"), F.col("n")))
    rows = classes.join(main.select("family", "main", "inner", "outer"), "family")
    outside = F.col("comp") != F.col("main")
    spread = F.pmod(F.xxhash64("cid"), F.when(outside, F.col("outer")).otherwise(F.col("inner"))).cast("int")
    rows = rows.withColumn("chunk", F.when(outside, spread).otherwise(F.col("outer") + spread))
    # An outside chunk meets itself and every chunk after it; the largest component's meet outside ones.
    upto = F.sequence(F.lit(0), F.least(F.col("chunk"), F.col("outer") - 1))
    later = F.when(outside & (F.col("chunk") + 1 < F.col("outer") + F.col("inner")), F.sequence(F.col("chunk") + 1, F.col("outer") + F.col("inner") - 1))
    first = F.transform(upto, lambda c: F.struct(c.alias("c1"), F.col("chunk").alias("c2"), F.when(c == F.col("chunk"), 0).otherwise(1).alias("side")))
    second = F.transform(later, lambda c: F.struct(F.col("chunk").alias("c1"), c.alias("c2"), F.lit(0).alias("side")))
    met = rows.select("family", "cid", "comp", F.explode(F.concat(first, F.coalesce(second, F.array().cast(_BLOCKS)))).alias("x"))
    blocks = met.select("family", "x.c1", "x.c2", "x.side", "cid", "comp").join(sets, "cid")
    return written(blocks.groupBy("family", "c1", "c2").applyInArrow(_block_links, "a long, b long"), "near-links")


_BLOCKS = "array<struct<c1:int,c2:int,side:int>>"


def _bucket_groups(buckets: DataFrame, placed: DataFrame) -> DataFrame:
    """Groups (cid, comp, family) of classes that share a bucket and lie in different families.

    Classes of components of up to ``LARGE`` classes meet in their bucket; buckets with the same such
    classes are one group. A larger component is one group with all classes outside it that share
    a bucket with any of its own, however many buckets these are.
    """
    rows = buckets.select("tk", "cid").join(placed, "cid")
    apart = rows.groupBy("tk").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x != y").select("tk")
    large = placed.groupBy("comp").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("comp", F.lit(True).alias("large"))
    rows = written(rows.join(apart, "tk", "left_semi").join(large, "comp", "left").select("tk", "cid", "comp", F.coalesce("large", F.lit(False)).alias("large")), "near-apart")

    small = rows.where("not large")
    marks = [F.sum(F.xxhash64("cid", F.lit(k)).cast("decimal(38,0)")).alias(f"m{k}") for k in (0, 1)]
    sets = small.groupBy("tk").agg(F.count("*").alias("n"), F.min("comp").alias("x"), F.max("comp").alias("y"), *marks)
    chosen = sets.where("x != y").groupBy("n", "m0", "m1").agg(F.min("tk").alias("tk")).select("tk")
    met = small.join(chosen, "tk").select("cid", "comp", F.col("tk").alias("family"))

    hosts = rows.where("large").select("tk", F.col("comp").alias("host")).distinct()
    other = (F.col("comp") != F.col("host")) & (~F.col("large") | (F.col("comp") > F.col("host")))
    guests = rows.join(hosts, "tk").where(other).select("cid", "comp", "host").distinct()
    guests = written(guests, "near-guests")
    own = placed.select("cid", "comp").join(guests.select(F.col("host").alias("comp")).distinct(), "comp").select("cid", "comp", F.col("comp").alias("host"))
    hosted = guests.unionByName(own).select("cid", "comp", F.xxhash64(F.lit(1), "host").alias("family"))
    return written(met.unionByName(hosted), "near-met")


def _two_components(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of two link tables in one run: their nodes are told apart by the last bit."""
    links = [t.select((F.col("a") * 2 + k).alias("a"), (F.col("b") * 2 + k).alias("b")) for k, t in enumerate((first, second))]
    found = components(links[0].unionByName(links[1]))
    halves = [found.where(F.pmod("node", F.lit(2)) == k) for k in (0, 1)]
    return tuple(h.select(F.shiftright("node", 1).alias("node"), F.shiftright("root", 1).alias("root")) for h in halves)


def _with_root(rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """Adds each class's root among ``roots``; classes without one are their own."""
    return rows.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn(name, F.coalesce("root", "cid")).drop("root")


def near_groups(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """With shingles of ``words`` words (at most MOST_WORDS), one row per document of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the
    smallest doc_id of its group), kept, and text_hash (xxhash64 of the text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = written(hashed.mapInArrow(partial(_signed, words=words), "doc_id long, text_hash long, n_shingles long, digest binary, keys array<long>"), "near-signed")

    grouped = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n_docs"), F.any_value("keys").alias("keys"))
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()), "near-classes")

    halves = classes.select("cid", F.posexplode("keys").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1")
    own = F.struct("place", "half")
    sides = (
        halves.join(shared, "half")
        .groupBy("cid")
        .agg(
            F.collect_list(F.when(F.col("place") < HALVES, own)).alias("left"),
            F.collect_list(F.when(F.col("place") >= HALVES, own)).alias("right"),
            F.sum("n").alias("typical"),
        )
    )
    pairs = sides.select("cid", "typical", F.explode("left").alias("l"), "right").select("cid", "typical", "l", F.explode("right").alias("r"))
    tables = written(pairs.select("cid", "typical", F.col("l.place").alias("i"), F.col("r.place").alias("j"), F.xxhash64("l.half", "r.half").alias("tk")), "near-tables")
    rank = F.struct("typical", (-F.col("cid")).alias("c"))
    centres = tables.groupBy("tk").agg(F.max(rank).alias("top"), F.count("*").alias("n")).where("n > 1").select("tk", (-F.col("top.c")).alias("b"))
    buckets = written(tables.join(centres, "tk"), "near-buckets")

    needed = buckets.select("cid").distinct().join(classes.select("cid", "digest", "least_id"), "cid")
    texts = rows.join(needed.withColumnRenamed("least_id", "own_id"), F.col("doc_id").eqNullSafe(F.col("own_id")))
    sets = written(texts.select("cid", "digest", "text").mapInArrow(partial(_sets, words=words), "cid long, members binary").dropDuplicates(["cid"]), "near-sets")

    found = buckets.where("cid != b").select(F.col("cid").alias("a"), "b").distinct()
    kin = _verified(found, sets, KIN)
    families, roots = _two_components(kin, kin.where("linked"))
    placed = written(_with_root(_with_root(needed.select("cid"), roots, "comp"), families, "family"), "near-placed")
    inside = _family_links(placed, sets)

    across = _family_links(_bucket_groups(buckets, placed), sets)
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(stars.unionByName(inside).unionByName(across))

    # Only classes of several documents or with a link can have another document's id.
    named = classes.select("cid", "digest", "least_id", "n_docs").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("comp", F.coalesce("root", "cid"))
    least = named.groupBy("comp").agg(F.min("least_id").alias("component"), F.sum("n_docs").alias("size")).where("size > 1").select("comp", "component")
    by_digest = written(named.join(least, "comp").select("digest", "component"), "near-named")
    found = signed.select("doc_id", "n_shingles", "text_hash", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), "text_hash").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
