"""Alignment of two tokenizers by products of token-byte incidence matrices.

A: byte-level BPE of " " + text; B: SentencePiece BPE of the text. Both give the same bytes,
so with one row per token and one column per byte, A·Bᵀ holds for each token of A the tokens
of B that it overlaps, and in how many bytes. Offsets where tokens of both end cut
the bytes into groups; the product of the token-group matrices holds the pairs that share a
group. All matrices are compressed sparse rows, multiplied by rows (``csr.Csr.times``).

Texts are cut before each blank between a character other than white space and any other. Neither
tokenizer has a token across such a cut, nor does it look behind it (checked against the
vocabulary), so both align each different segment by itself, once in a while remembered, and
a document's tokens, groups and links are the sums over its segments. Chunks of documents
(``CHUNK_BYTES``) keep a table of their own pairs of ids; a product of the document-segment
and segment-pair matrices gives each document's links by pair.

Counts of the whole corpus: pairs of chunks are added up by Spark, and joined back once per
chunk and pair (not per link), so a frequent pair costs one row for each chunk, and nothing that
grows with the corpus is held by a task or the driver.

Defined results: null and empty texts, and texts whose tokens do not give " " + text byte
by byte in both vocabularies, have no tokens: zeros and ''. Rows are documents of their own,
equal doc_ids too; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import shared_path, slices
from oddlens.llm.csr import Csr

#: UTF-8 bytes and documents of a chunk; one document at least.
CHUNK_BYTES, CHUNK_DOCS = 8_000_000, 4096
#: Segments that a task remembers at most from one chunk to the next.
REMEMBERED = 300_000
#: New segments that are encoded and multiplied at once.
NEW = 20_000

_CUT = re.compile(r"(?<=\S) (?!\Z)")
_UNUSUAL = re.compile(r"\s ")


def segments(text: str) -> list[str]:
    """The segments of a text (not empty), each without the blank before it; none is empty."""
    if text[0] == " " or text[-1] == " " or _UNUSUAL.search(text):
        return _CUT.split(text)
    return text.split(" ")


def _byte_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both vocabularies: encoding of segments, and the bytes of each id."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer  # reads the variable when it is loaded

        self.left = Tokenizer.from_str(definition)
        self.left.encode_special_tokens = True
        table = _byte_table()
        self.left_bytes = {i: bytes(table[c] for c in token) for token, i in self.left.get_vocab(with_added_tokens=False).items() if all(c in table for c in token)}
        self.right = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.right_bytes = []
        for i in range(self.right.get_piece_size()):
            piece = self.right.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece of B holds a blank after another character, so texts cannot be cut at blanks")
            self.right_bytes.append(bytes([int(piece[3:5], 16)]) if self.right.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        left = self.left.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)
        return [e.ids for e in left], self.right.encode(parts, num_threads=1)


@dataclass(frozen=True)
class Aligned:
    """Tokens of several texts, put one after the other on one axis of bytes."""

    links: Csr  # token of A, token of B: bytes that they share
    shared: Csr  # the same for groups that they share
    left_group: np.ndarray
    right_group: np.ndarray


def align(left_sizes: np.ndarray, right_sizes: np.ndarray) -> Aligned:
    """Links of tokens with these numbers of bytes; both cover the same bytes."""
    total = int(left_sizes.sum())
    a = Csr.of_sizes(left_sizes, np.arange(total), total)
    b = Csr.of_sizes(right_sizes, np.arange(total), total)
    cuts = np.intersect1d(a.rows[1:], b.rows[1:], assume_unique=True)
    left_group, right_group = (np.searchsorted(cuts, m.rows[:-1], "right") for m in (a, b))
    groups = [Csr.of_sizes(np.ones(len(g), np.int64), g, len(cuts)) for g in (left_group, right_group)]
    return Aligned(a.times(b.transposed()), groups[0].times(groups[1].transposed()), left_group, right_group)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


class Segments:
    """Aligned segments of a task: numbers, counts, groups as text, and pairs of ids with their links."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts = np.empty((0, len(_COUNTS)), np.int64)
        self.right = np.empty(0, bool)  # both tokenizers give the segment's bytes
        self.pairs = Csr.of_sizes(np.empty(0, np.int64), np.empty(0, np.int64), 1 << 62)

    def learn(self, parts: Iterable[str]) -> None:
        new = [p for p in set(parts) if p not in self.known]
        made = [self._learned(new[k : k + NEW]) for k in range(0, len(new), NEW)]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        if made:
            self.counts = np.concatenate([self.counts, *(m[0] for m in made)])
            self.right = np.concatenate([self.right, *(m[1] for m in made)])
            old, pairs = self.pairs, [m[2] for m in made]
            sizes = np.concatenate([np.diff(old.rows), *(np.diff(p.rows) for p in pairs)])
            self.pairs = Csr.of_sizes(sizes, np.concatenate([old.columns, *(p.columns for p in pairs)]), old.width, np.concatenate([old.data, *(p.data for p in pairs)]))

    def _learned(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, Csr]:
        left, right = self.pair.encode(parts)
        whole = [(" " + p).encode("utf-8", "surrogatepass") for p in parts]
        left_bytes, right_bytes = self.pair.left_bytes, self.pair.right_bytes
        good = np.array([b"".join(left_bytes[i] for i in a) == w == b"".join(right_bytes[i] for i in b) for a, b, w in zip(left, right, whole, strict=True)], bool)
        left = [ids if g else [] for ids, g in zip(left, good, strict=True)]
        right = [ids if g else [] for ids, g in zip(right, good, strict=True)]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (left, right))
        a, b = (np.fromiter((i for ids in side for i in ids), np.int64) for side in (left, right))
        found = align(np.array([len(left_bytes[i]) for i in a.tolist()], np.int64), np.array([len(right_bytes[i]) for i in b.tolist()], np.int64))
        owner = np.repeat(np.arange(len(parts)), n_a)
        link_owner = owner[found.links.row_numbers()]
        n_links = np.bincount(link_owner, minlength=len(parts))
        n_shared = np.bincount(owner[found.shared.row_numbers()], minlength=len(parts))
        last = np.append(found.left_group[1:] != found.left_group[:-1], True) if len(a) else np.empty(0, bool)
        n_groups = np.bincount(owner[last], minlength=len(parts))
        self.texts += self._shown(a, b, found, n_groups)
        # Segment by pair of ids: the product of the segment-link and link-pair matrices.
        ids = (a[found.links.row_numbers()] << 31) | b[found.links.columns]
        names, column = np.unique(ids, return_inverse=True)
        by_link = Csr.of_sizes(np.ones(len(ids), np.int64), column, len(names))
        per = Csr.of_sizes(n_links, np.arange(len(ids)), len(ids)).times(by_link)
        return np.column_stack([n_a, n_b, n_groups, n_links, n_shared]), good, Csr(per.rows, names[per.columns], per.data, 1 << 62)

    @staticmethod
    def _shown(a: np.ndarray, b: np.ndarray, found: Aligned, n_groups: np.ndarray) -> list[str]:
        """Each segment's groups as text."""
        sides = []
        for ids, group in ((a, found.left_group), (b, found.right_group)):
            names = list(map(str, ids.tolist()))
            edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist() if len(ids) else []
            sides.append([names[x] if y == x + 1 else ",".join(names[x:y]) for x, y in zip(edges, [*edges[1:], len(ids)], strict=True)])
        groups = [f"{x}|{y}" for x, y in zip(*sides, strict=True)]
        ends = np.cumsum(n_groups).tolist()
        return [";".join(groups[x:y]) for x, y in zip([0, *ends[:-1]], ends, strict=True)]


_LISTS = ("doc_ids", *_COUNTS, "sizes", "at", "times", "pairs", "totals")
_CHUNKS = pa.schema([("chunk", pa.int64()), *((c, pa.list_(pa.int64() if c in ("doc_ids", "pairs", "totals") else pa.int32())) for c in _LISTS), ("shas", pa.list_(pa.string()))])
_CHUNKS_DDL = "chunk long, " + ", ".join(f"{c} array<{'long' if c in ('doc_ids', 'pairs', 'totals') else 'int'}>" for c in _LISTS) + ", shas array<string>"


def _chunk(number: int, docs: list[tuple[int | None, str | None]], known: Segments) -> pa.RecordBatch:
    """One chunk's row: the documents' counts, and which of the chunk's pairs each holds how often."""
    split = [segments(text) if text else [] for _, text in docs]
    known.learn(p for parts in split for p in parts)
    numbers = [np.fromiter(map(known.known.__getitem__, parts), np.int64, len(parts)) for parts in split]
    numbers = [n if known.right[n].all() else n[:0] for n in numbers]
    counts = np.array([known.counts[n].sum(axis=0) for n in numbers], np.int64)
    shas = [hashlib.sha256(";".join([known.texts[k] for k in n.tolist()]).encode()).hexdigest() if len(n) else "" for n in numbers]
    # Documents by segment times segments by pair.
    each = [np.unique(n, return_counts=True) for n in numbers]
    used, column = np.unique(np.concatenate([e[0] for e in each]), return_inverse=True)
    mine = known.pairs.chosen(used)
    names, pair = np.unique(mine.columns, return_inverse=True)
    by_doc = Csr.of_sizes(np.array([len(e[0]) for e in each]), column, len(used), np.concatenate([e[1] for e in each]))
    links = by_doc.times(Csr(mine.rows, pair, mine.data, len(names)))
    totals = np.bincount(links.columns, weights=links.data, minlength=len(names)).astype(np.int64)
    lists = [[d for d, _ in docs], *counts.T, np.diff(links.rows), links.columns, links.data, names, totals]
    arrays = [pa.array([number], pa.int64()), *(pa.array([x], f.type) for x, f in zip([*lists, shas], list(_CHUNKS)[1:], strict=True))]
    return pa.RecordBatch.from_arrays(arrays, schema=_CHUNKS)


_pairs: dict[tuple[bytes, bytes], Pair] = {}


def _chunks(batches: Iterable[pa.RecordBatch], files: tuple[str, bytes], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    key = tuple(hashlib.sha256(f if isinstance(f, bytes) else f.encode()).digest() for f in files)
    if key not in _pairs:
        _pairs[key] = Pair(*files)
    known = Segments(_pairs[key])
    number = TaskContext.get().partitionId() << 32
    docs: list[tuple[int | None, str | None]] = []
    size = 0
    for doc_ids, texts in (part for batch in batches for part in slices(batch, 64)):
        for doc_id, text in zip(doc_ids, texts, strict=True):
            own = len((text or "").encode("utf-8", "surrogatepass"))
            if docs and (size + own > chunk_bytes or len(docs) == CHUNK_DOCS):
                yield _chunk(number, docs, known)
                number, docs, size = number + 1, [], 0
                if len(known.known) > REMEMBERED:
                    known.clear()
            docs.append((doc_id, text))
            size += own
    if docs:
        yield _chunk(number, docs, known)


_RESULT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
_RESULT_DDL = "doc_id long, " + ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"


def _finished(chunk: pa.Table, marks: pa.Table) -> pa.Table:
    """The documents of one chunk, with the corpus's counts of its pairs."""
    if not chunk.num_rows:
        return _RESULT.empty_table()
    row = {c: chunk.column(c).combine_chunks().values for c in (*_LISTS, "shas")}
    count, best = np.zeros(len(row["pairs"]), np.int64), np.zeros(len(row["pairs"]), np.int64)
    place = marks.column("place").to_numpy()
    count[place], best[place] = marks.column("count").to_numpy(), marks.column("best").to_numpy()
    at, times = row["at"].to_numpy(), row["times"].to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(row["sizes"].to_numpy(), dtype=np.int64)])
    sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[at])])[ends]) for x in (best, count)]
    arrays = [row["doc_ids"], *(row[c] for c in _COUNTS), *sums, row["shas"]]
    return pa.table([pa.array(x).cast(f.type) for x, f in zip(arrays, _RESULT, strict=True)], schema=_RESULT)


def aligned_chunks(docs: DataFrame, left: str, right: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The written chunks of aligned documents (doc_id, text); ``left`` and ``right``: the tokenizers' files."""
    with open(left) as a, open(right, "rb") as b:  # on the driver; files of fixed size
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(lambda batches: _chunks(batches, files.value, chunk_bytes), _CHUNKS_DDL)
    path = shared_path(docs.sparkSession, "alignment")
    made.write.option("compression", "zstd").option("maxRecordsPerFile", 4).parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair (id of A << 31 | id of B), its links in the corpus, and ``best``: 1 if no pair of its B id has more."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.totals").alias("n"))
    sums = each.groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 31) - 1)).alias("b")
    most = sums.groupBy(b).agg(F.max("count").alias("most"))
    return sums.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def aligned(docs: DataFrame, left: str, right: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_shared (pairs of tokens in a
    common group), n_best, count_sum, groups_sha256."""
    chunks = aligned_chunks(docs, left, right, chunk_bytes)
    own = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    marks = own.join(pair_counts(chunks), "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    return chunks.groupBy("chunk").cogroup(marks.groupBy("of")).applyInArrow(_finished, _RESULT_DDL)
