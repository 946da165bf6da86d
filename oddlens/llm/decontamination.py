"""Benchmark decontamination with an FM-index for each training shard.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
lower case. A window is ``WINDOW`` consecutive words of a benchmark item, or all words of a
shorter one. A document's word inside any occurrence of a window is hit.

1. ``build_index`` reads the documents once. Each task cuts its documents into shards of
   about ``SHARD_WORDS`` words (a longer document is a shard of its own) and writes one
   row for each: the shard's words, the FM-index, and the documents' ids. The index does
   not depend on any benchmark, so it is built once for all of them.
2. ``benchmark_blocks`` deals the distinct windows of the items into blocks of about
   ``BLOCK`` windows; one block at a time is sent to the tasks, so what is sent has a
   bound whatever the size of the benchmark.
3. ``find_hits`` searches a block in every shard: backward search of all windows at
   once, then the located occurrences are merged to removal spans of words.
4. ``contaminated`` merges the blocks' spans of each document that is hit and joins
   them to all documents by (shard, place in the shard), so no key is frequent.

Shards lie inside tasks' own rows: nothing of a document is shuffled, and a source,
a common passage or a group of copies of any size is spread as the input is. A window that
occurs very often is located in parts of ``LOCATED`` rows into one field of the shard.

Defined results: null texts and texts without words have no words and no hits; items
without words have no window; an item_id that is null names no item, but its windows hit;
equal item_ids are one item; rows that share a doc_id are judged by their own texts; an
empty table gives an empty result, an empty benchmark no hits; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import shared_path, slices, text_bytes, written
from oddlens.llm.fm_index import FmIndex, build, ranges

#: Words of a window.
WINDOW = 10
#: Words of a shard, end marks included; a shard holds one document at least.
SHARD_WORDS = 1_000_000
#: Expected windows of a block.
BLOCK = 100_000
#: Occurrences that are located at once.
LOCATED = 500_000

#: A-Z to a-z, other ASCII but letters and digits to blanks; bytes of other characters stay.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_WORDS).split()


class _Numbers(dict):
    """Numbers words from 1 on, in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self) + 1
        return found


_PARTS = ("counts", "levels", "marks", "samples", "starts")
_INDEX = "shard long, doc_ids array<long>, text_hashes array<long>, sizes array<long>, words binary, " + ", ".join(f"{p} binary" for p in _PARTS)
_ARROW = pa.schema(
    [("shard", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "text_hashes", "sizes")), ("words", pa.binary()), *((p, pa.binary()) for p in _PARTS)]
)


def _shards(batches: Iterable[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    made, size = 0, 0
    docs: list[tuple[int | None, int, int]] = []
    sequence: list[np.ndarray] = []
    numbers = _Numbers()

    def flush() -> pa.RecordBatch:
        parts = build(np.concatenate(sequence), len(numbers) + 1)
        columns = [base + made, *([d[k] for d in docs] for k in range(3)), b" ".join(numbers), *(parts[p] for p in _PARTS)]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    for doc_ids, hashes, texts in (part for batch in batches for part in slices(batch, 64)):
        for doc_id, text_hash, text in zip(doc_ids, hashes, texts, strict=True):
            found = words(text)
            if docs and size + len(found) >= shard_words:
                yield flush()
                made, size, docs, sequence, numbers = made + 1, 0, [], [], _Numbers()
            docs.append((doc_id, text_hash, len(found)))
            own = np.zeros(len(found) + 1, np.int32)
            own[:-1] = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
            sequence.append(own)
            size += len(own)
    if docs:
        yield flush()


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The written index of all documents (doc_id, text): one row for each shard."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    index = hashed.mapInArrow(lambda batches: _shards(batches, shard_words), _INDEX)
    path = shared_path(docs.sparkSession, "fm-index")
    index.write.option("compression", "zstd").option("maxRecordsPerFile", 8).parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def _windows(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for items, texts in (part for batch in batches for part in slices(batch, 64)):
        found = []
        for item, text in zip(items, texts, strict=True):
            own = words(text)
            found += [(item, b" ".join(own[k : k + window])) for k in range(max(1, len(own) - window + 1)) if own]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())], names=["item_id", "words"])


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Distinct (item_id, words) of all windows of ``benchmark`` (item_id, text), dealt to
    blocks, and the number of blocks."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = written(rows.mapInArrow(lambda batches: _windows(batches, window), "item_id string, words binary").distinct(), "benchmark-windows")
    blocks = max(1, -(-found.count() // block))
    return found.withColumn("block", F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks))), blocks


class _Phrases:
    """One block: its distinct words, the windows as numbers of these words, and each window's items."""

    def __init__(self, rows: list[tuple[str | None, bytes]]):
        by_window: dict[bytes, list[str]] = {}
        for item, window in rows:
            by_window.setdefault(window, []).extend([] if item is None else [item])
        split = [w.split(b" ") for w in by_window]
        self.items = list(by_window.values())
        self.words = list({word for s in split for word in s})
        number = {word: k for k, word in enumerate(self.words)}
        self.lengths = np.array([len(s) for s in split], np.int64)
        self.windows = np.zeros((len(split), int(self.lengths.max(initial=0))), np.int64)
        for k, s in enumerate(split):
            self.windows[k, : len(s)] = [number[word] for word in s]


_HITS = "shard long, place int, spans array<long>, items array<string>"


def _hits(row: dict, phrases: _Phrases) -> Iterator[tuple[int, list[int], list[str]]]:
    """(place, removal spans as starts and stops of words, items) of the shard's documents that are hit."""
    vocabulary = {word: k + 1 for k, word in enumerate(row["words"].split(b" "))} if row["words"] else {}
    symbols = np.array([vocabulary.get(word, 0) for word in phrases.words], np.int64)
    own = symbols[phrases.windows] if len(symbols) else phrases.windows
    inside = np.arange(own.shape[1]) < phrases.lengths[:, None]
    known = np.flatnonzero((own.astype(bool) | ~inside).all(axis=1))
    if not len(known):
        return
    index = FmIndex(*(row[p] for p in _PARTS))
    lengths = phrases.lengths[known]
    low, high = index.search(own[known], lengths)
    change = np.zeros(index.n + 1, np.int32)
    met = np.empty(0, np.int64)
    for owner, rows in ranges(low, high, LOCATED):
        at = index.locate(rows)
        change += np.bincount(at, minlength=index.n + 1).astype(np.int32)
        change -= np.bincount(at + lengths[owner], minlength=index.n + 1).astype(np.int32)
        doc = np.searchsorted(index.starts, at, "right") - 1
        met = np.union1d(met, doc * len(known) + owner)
    if not len(met):
        return
    edges = np.diff(np.concatenate([[0], (np.cumsum(change) > 0).view(np.int8), [0]]))
    starts, stops = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    docs = np.searchsorted(index.starts, starts, "right") - 1
    owner_doc, window = np.divmod(met, len(known))
    for doc in np.unique(docs):
        mine = docs == doc
        spans = np.column_stack([starts[mine], stops[mine]]) - index.starts[doc]
        windows = known[window[slice(*np.searchsorted(owner_doc, [doc, doc + 1]))]]
        yield int(doc), spans.ravel().tolist(), list({item for w in windows.tolist() for item in phrases.items[w]})


def find_hits(index: DataFrame, windows: DataFrame, blocks: int) -> DataFrame:
    """(shard, place, spans, items) of every document that a window of a block hits."""
    found = None
    for k in range(blocks):
        table = windows.where(F.col("block") == k).select("item_id", "words").toArrow()  # one block: BLOCK rows are expected
        rows = list(zip(*(table.column(c).to_pylist() for c in ("item_id", "words")), strict=True))
        shared = index.sparkSession.sparkContext.broadcast(_Phrases(rows))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    row = batch.slice(n, 1).to_pylist()[0]
                    hits = [(row["shard"], *hit) for hit in _hits(row, shared.value)]
                    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()))
                    columns = list(zip(*hits, strict=True)) or [()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "place", "spans", "items"])

        hits = written(index.select("shard", "words", *_PARTS).mapInArrow(search, _HITS), "benchmark-hits")
        shared.unpersist()
        found = hits if found is None else found.unionByName(hits)
    return found


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One document's spans and items from all blocks, each once and in order."""
    for shards, places, spans, items in (part for batch in batches for part in slices(batch)):
        merged, hits = [], []
        for flat in spans:
            joined: list[list[int]] = []
            for start, stop in sorted(zip(flat[::2], flat[1::2], strict=True)):
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], stop)
                else:
                    joined.append([start, stop])
            merged.append([{"start": a, "stop": b} for a, b in joined])
            hits.append(sum(b - a for a, b in joined))
        named = [sorted(set(i)) for i in items]
        shas = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in named]
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        kinds = (pa.int64(), pa.int32(), span, pa.int64(), pa.int64(), pa.string())
        columns = (shards, places, merged, hits, [len(i) for i in named], shas)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "place", "spans", "n_hit", "n_items", "items_sha256"])


_MERGED = "shard long, place int, spans array<struct<start:long,stop:long>>, n_hit long, n_items long, items_sha256 string"


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64 of the text), n_words, spans (of hit
    words, as start and stop), n_hit, n_items, items_sha256, contaminated."""
    index = build_index(docs, shard_words)
    hits = find_hits(index, *benchmark_blocks(benchmark, window, block))
    each = hits.groupBy("shard", "place").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    merged = each.mapInArrow(_merged, _MERGED)
    rows = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "text_hashes", "sizes")).alias("place", "d"))
    rows = rows.select("shard", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.text_hashes").alias("text_hash"), F.col("d.sizes").alias("n_words"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return rows.join(merged, ["shard", "place"], "left").select(
        "doc_id", "text_hash", "n_words", "spans",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_hit", "n_items")),
        F.coalesce("items_sha256", none).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _cut(text: str | None, spans) -> str | None:
    """The text without its spans of words; white space around a span stays."""
    if text is None or spans is None or not len(spans):
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["start"]][0]])
        at = places[span["stop"] - 1][1]
    return "".join([*kept, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """``docs`` with the hit spans cut out of the texts: from a span's first word to its last one."""
    found = contaminated(docs, benchmark, **options).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    found = written(found.dropDuplicates(["__id", "__hash"]), "benchmark-spans")  # equal (doc_id, text) rows have equal spans
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__hash"))
    without = F.pandas_udf(lambda texts, spans: pd.Series([_cut(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object), "string")
    joined = docs.join(found, same, "left")
    return joined.select(*(without(F.col("text").cast("string"), F.col("__spans")).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))
