"""Exact deduplication by recursive hash partitioning (Grace hash).

Two texts are equal when they are identical without the characters ``[\x20\x09-\x0D]``.

Level 0. Every task reads its documents once and folds equal contents in an
open-addressing table that compares the complete bytes, so a content that a third of
all rows share leaves a task as one row. The folded rows ("locals") are written with
their documents' ids beside them.

Level k. The contents are dealt out by a hash that is seeded with the level. Each task
fills a table up to ``table_mb`` of content. A content that is not in a full table goes
to the spill files of the next level; one that is in the table is always folded into
it, so each content is settled on exactly one level. Levels go on until nothing spills.
All files lie in the shared checkpoint folder, so a lost executor costs its tasks only.

Defined results: null text counts as empty; empty texts are one group; a null doc_id
loses against any other on equal lengths; repeated rows are documents of their own and
share the group; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import SPACES, slices, text_bytes, written

#: Content bytes a task holds at most before it spills (levels) or flushes (level 0).
TABLE_MB = 96
#: Documents that one level-0 table may stand for before it is flushed.
FOLD_ROWS = 100_000
_FREE = -1


class ContentTable:
    """Open addressing with linear probing; a hit needs equal hash and equal bytes."""

    def __init__(self, slots: int = 1024):
        self.slot = np.full(slots, _FREE, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, hashed: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot where the search ended)."""
        mask = len(self.slot) - 1
        at = hashed & mask
        while (entry := int(self.slot[at])) != _FREE:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return _FREE, at

    def add(self, hashed: int, content: bytes, at: int) -> int:
        entry = len(self.contents)
        self.slot[at] = entry
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + 120
        if 2 * len(self.contents) > len(self.slot):
            self._grow()
        return entry

    def _grow(self) -> None:
        mask = 2 * len(self.slot) - 1
        self.slot = np.full(mask + 1, _FREE, dtype=np.int64)
        for entry, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slot[at] != _FREE:
                at = (at + 1) & mask
            self.slot[at] = entry


FOLDED = pa.schema(
    [("local", pa.int64()), ("hashed", pa.int64()), ("content", pa.binary()), ("sha256", pa.string()), ("n_points", pa.int64()),
     ("best", pa.int64()), ("best_at", pa.int32()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("text_hashes", pa.list_(pa.int64()))]
)
LEVEL = pa.schema(
    [("local", pa.int64()), ("hashed", pa.int64()), ("content", pa.binary()), ("n_points", pa.int64()), ("best", pa.int64()),
     ("n", pa.int64()), ("keep_local", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("spilled", pa.bool_())]
)


def _better(a: tuple, b: tuple) -> bool:
    """More code points, then the smaller id; a null id comes last; then the smaller place."""
    return (-a[0], a[1] is None, a[1] or 0, a[2]) < (-b[0], b[1] is None, b[1] or 0, b[2])


def _batch(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: A content of one task: its best row (length, id, place in doc_ids) and all its documents.
LOCALS = "local long, hashed long, content binary, sha256 string, n_points long, best long, best_at int, n long, doc_ids array<long>, text_hashes array<long>"
#: A spilled content as it came, or the verdict for a settled one.
SETTLED = "local long, hashed long, content binary, n_points long, best long, n long, keep_local long, keep_id long, group_size long, spilled boolean"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _fold(batches: Iterable[pa.RecordBatch], table_mb: float) -> Iterator[pa.RecordBatch]:
    """Fold the equal contents of one task; see LOCALS."""
    first, flushed = TaskContext.get().partitionId() << 40, 0
    table, best, ids, text_hashes, seen = ContentTable(), [], [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal flushed
        for a in range(0, len(best), 256):
            part = range(a, min(a + 256, len(best)))
            yield _batch(
                (
                    [first + flushed + i for i in part],
                    [_signed(table.hashes[i]) for i in part],
                    [table.contents[i] for i in part],
                    [hashlib.sha256(table.contents[i]).hexdigest() for i in part],
                    *zip(*(best[i] for i in part), strict=True),
                    [len(ids[i]) for i in part],
                    [ids[i] for i in part],
                    [text_hashes[i] for i in part],
                ),
                FOLDED,
            )
        flushed += len(best)

    for part in (part for batch in batches for part in slices(batch)):
        for doc_id, text, text_hash in zip(*part, strict=True):
            content = text_bytes(text).translate(None, SPACES)
            hashed = xxhash.xxh3_64_intdigest(content)
            entry, at = table.find(hashed, content)
            if entry == _FREE:
                table.add(hashed, content, at)
                best.append((len(text or ""), doc_id, 0))
                ids.append([doc_id])
                text_hashes.append([text_hash])
            else:
                found = (len(text or ""), doc_id, len(ids[entry]))
                ids[entry].append(doc_id)
                text_hashes[entry].append(text_hash)
                if _better(found, best[entry]):
                    best[entry] = found
            seen += 1
            if table.bytes > table_mb * 2**20 or seen >= FOLD_ROWS:
                yield from flush()
                table, best, ids, text_hashes, seen = ContentTable(), [], [], [], 0
    yield from flush()


def _settle(batches: Iterable[pa.RecordBatch], table_mb: float) -> Iterator[pa.RecordBatch]:
    """Fold the contents of one partition of a level; what does not fit is spilled."""
    table, best, sizes = ContentTable(), [], []
    locals_, entries = array("q"), array("q")
    full = False
    for part in (part for batch in batches for part in slices(batch)):
        spill = []
        for local, signed, content, n_points, doc_id, n in zip(*part, strict=True):
            hashed = signed & (1 << 64) - 1
            entry, at = table.find(hashed, content)
            if entry == _FREE:
                full = full or (bool(best) and table.bytes + len(content) > table_mb * 2**20)
                if full:
                    spill.append((local, signed, content, n_points, doc_id, n, None, None, None, True))
                    continue
                entry = table.add(hashed, content, at)
                best.append((n_points, doc_id, local))
                sizes.append(n)
            else:
                sizes[entry] += n
                if _better((n_points, doc_id, local), best[entry]):
                    best[entry] = (n_points, doc_id, local)
            locals_.append(local)
            entries.append(entry)
        if spill:
            yield _batch(zip(*spill, strict=True), LEVEL)
    for a in range(0, len(locals_), 8192):
        part = entries[a : a + 8192]
        none = [None] * len(part)
        columns = [locals_[a : a + 8192], none, none, none, none, none, [best[e][2] for e in part], [best[e][1] for e in part], [sizes[e] for e in part], [False] * len(part)]
        yield _batch(columns, LEVEL)


def exact_groups(docs: DataFrame, table_mb: float = TABLE_MB) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text), dropped ones too: doc_id, keep_id,
    group_size, kept, text_sha256 (of the text without white space), text_hash (xxhash64 of
    the text as it is).

    ``table_mb`` bounds the content that one task holds; more levels follow if needed.
    """
    folded = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string"))).mapInArrow(lambda b: _fold(b, table_mb), LOCALS)
    locals_ = written(folded, "exact-locals")
    todo, settled, level = locals_, None, 0
    while True:
        dealt = todo.select("local", "hashed", "content", "n_points", "best", "n").repartition(F.xxhash64("hashed", F.lit(level)))
        done = written(dealt.mapInArrow(lambda b: _settle(b, table_mb), SETTLED), f"exact-level{level}")
        verdicts = done.where("not spilled").select("local", "keep_local", "keep_id", "group_size")
        settled = verdicts if settled is None else settled.unionByName(verdicts)
        todo = done.where("spilled")
        if todo.isEmpty():
            break
        level += 1
    members = locals_.select("local", "sha256", "best_at", "text_hashes", F.posexplode("doc_ids").alias("at", "doc_id"))
    stays = (F.col("local") == F.col("keep_local")) & (F.col("at") == F.col("best_at"))
    return members.join(settled, "local").select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.col("sha256").alias("text_sha256"), F.get("text_hashes", "at").alias("text_hash"))
