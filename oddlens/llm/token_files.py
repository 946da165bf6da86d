"""Token ids in flat binary files.

A shard is three files in the shared folder: ``tokens`` (unsigned 16- or 32-bit little
endian ids, the smallest that holds the vocabulary), ``offsets`` (64-bit: where each
document starts inside the shard, and the end) and ``docs`` (64-bit document ids). The
shards hold ascending ranges of doc_id; the place of a shard in the whole corpus is the
prefix sum of the token counts before it, kept in the manifest table. Readers map the
files into memory.

A task writes under a name of its own and renames the finished files, so a repeated or
speculative task leaves whole files only.

Defined results: null text counts as empty and becomes the end id alone; a null doc_id
comes first and is stored as the smallest 64-bit number; repeated rows are documents of
their own, next to each other; an added token's text inside a text becomes that token, as in
the library; an empty table gives no shard and no row.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddlens.llm.common import chunks, shared_path, written

#: Words that one worker remembers in each of two generations; UTF-8 bytes of texts (one text at least) encoded at once.
KNOWN, CHUNK_BYTES = 300_000, 4_000_000
NO_ID = -(1 << 63)


#: A letter that no normalisation changes into anything but a letter, then a few closing marks.
_CLOSED = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e][.,;:!?|]{1,3}$"
MARKS = ".,;:!?|"


def _strung(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``codes`` of ``flat``, which holds runs of the given sizes, one after another; their sizes."""
    n = sizes[codes]
    stops = np.cumsum(n)
    starts = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts[codes] - stops + n, n) + np.arange(n.sum())], n


class WordEncoder:
    """Encodes texts part by part with the tokenizers library, remembering words.

    The vocabulary's normaliser folds white space and its pattern drops it, so no token
    and no normalisation reaches over a blank or a line end. Nor does one reach from a
    letter to a closing punctuation mark, so a word is encoded once for all its endings
    and, if it is of ASCII letters only, for all its cases (the library looks for added tokens
    before it folds cases). A chunk's texts are split, and its different parts and words found,
    by Arrow; only different words are Python objects. New words go to the library many at a
    time; the tokens that end a word tell them apart. Lower-case ASCII letters pass the
    normaliser and the pattern unchanged, so such words go to the model without them.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer  # reads the variable when it is loaded

        self.tokenizer = Tokenizer.from_str(definition)
        plain = json.loads(definition) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        lower, letters, others = [], [], []
        for w in words:
            (others if not w.isalpha() else lower if w.isascii() and w.islower() else letters).append(w)
        runs = [(k, some[a : a + 500]) for k, some in ((self.plain, lower), (self.tokenizer, letters)) for a in range(0, len(some), 500)]
        for tokenizer, some in runs:
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            if len(stops) != len(some):  # every word has an end at least, so each has one if there are no more
                others += some
                continue
            data, start = ids.tobytes(), 0
            for word, stop in zip(some, stops.tolist(), strict=True):
                self.words[word] = data[start:stop]
                start = stop
        for word, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.words[word] = np.array(e.ids, dtype=self.dtype).tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        found = list(map(self.words.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        new = []
        for k in missing:
            ids = self.old_words.get(words[k])
            if ids is None:
                new.append(words[k])
            else:
                self.words[words[k]] = ids
        self._learn(new)
        for k in missing:
            found[k] = self.words[words[k]]
        if len(self.words) >= KNOWN:
            self.old_words, self.words = self.words, {}
        return found

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one after another, and how many each has."""
        if not len(texts):
            return np.empty(0, self.dtype), np.empty(0, np.int64)
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        all_parts = split.flatten().dictionary_encode()
        parts = all_parts.dictionary
        # Different parts: a word and the marks that close it.
        short = pc.utf8_rtrim(parts, MARKS)
        closed = pc.match_substring_regex(parts, _CLOSED)
        words = pc.if_else(closed, short, parts)
        words = pc.if_else(pc.ascii_is_alpha(words), pc.ascii_lower(words), words)
        n_marks = pc.subtract(pc.binary_length(parts), pc.binary_length(short)).to_numpy()
        n_marks = np.where(closed.to_numpy(zero_copy_only=False), n_marks, 0)
        marked = [np.flatnonzero(n_marks == k) for k in (1, 2, 3)]
        marks = [pc.utf8_slice_codeunits(parts.take(pa.array(at)), -k) for k, at in enumerate(marked, 1)]
        known = pa.concat_arrays([words, *marks, pa.array([""], words.type)]).dictionary_encode()
        ids = self._ids(known.dictionary.to_pylist())
        codes = known.indices.to_numpy()
        pairs = np.full((len(parts), 2), codes[-1])
        pairs[:, 0] = codes[: len(parts)]
        pairs[np.concatenate(marked), 1] = codes[len(parts) : -1]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        flat, n = _strung(np.frombuffer(b"".join(ids), self.dtype), sizes, pairs.ravel())
        flat, n = _strung(flat, n.reshape(-1, 2).sum(axis=1), all_parts.indices.to_numpy())
        starts = split.offsets.to_numpy()[:-1]  # no text is without a part
        return flat, np.add.reduceat(n, starts - starts[0])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``."""
        flat, n = self.encode_column(pa.array(texts, pa.string()))
        stops = np.cumsum(n)
        return [flat[b - k : b].tobytes() for b, k in zip(stops.tolist(), n.tolist(), strict=True)]


_encoders: dict[bytes, WordEncoder] = {}  # one definition at a time


def encoder_of(definition: str) -> WordEncoder:
    """This worker's encoder, with the words that its tasks before have met. (A function inside another is
    sent to tasks with copies of the dictionaries that it names, so it must not name ``_encoders`` itself.)"""
    key = hashlib.sha256(definition.encode()).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(definition)
    return _encoders[key]


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, path: str, end_id: int, folder: str, shards: int | None = None) -> DataFrame:
    """Write the ids of all texts to ``folder``; the manifest: shard, n_docs, n_tokens, base.

    ``path`` is a definition of the tokenizers library, read on the driver (a file of
    fixed size). ``shards`` is the number of doc_id ranges, by default Spark's number of
    shuffle partitions.
    """
    with open(path) as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition.value)
        context = TaskContext.get()
        system, root = _file_system(folder)
        system.create_dir(root)
        shard, own = context.partitionId(), f"{root}/.{context.taskAttemptId()}"
        ids, offsets, total = [], [np.zeros(1, np.int64)], 0
        with system.open_output_stream(f"{own}.tokens") as out:
            for part in (part for batch in batches for part in chunks(batch, 1, CHUNK_BYTES)):
                tokens, n = encoder.encode_column(part.column(1))
                stops = np.cumsum(n)
                out.write(np.insert(tokens, stops, end_id).tobytes())
                offsets.append(total + stops + np.arange(1, len(stops) + 1))
                total = int(offsets[-1][-1])
                ids.append(pc.fill_null(part.column(0), NO_ID).to_numpy())
        if ids:
            for kind, values in (("offsets", offsets), ("docs", ids)):
                with system.open_output_stream(f"{own}.{kind}") as out:
                    out.write(np.concatenate(values).astype("<i8").tobytes())
            for kind in ("tokens", "offsets", "docs"):
                system.move(f"{own}.{kind}", f"{root}/{shard:07d}.{kind}")
            row = [[shard], [sum(map(len, ids))], [total], [encoder.dtype.str]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["shard", "n_docs", "n_tokens", "dtype"])
        else:
            system.delete_file(f"{own}.tokens")

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ranged = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    sizes = written(ranged.sortWithinPartitions("doc_id").mapInArrow(write, "shard long, n_docs long, n_tokens long, dtype string"), "token-manifest")
    # One row per shard: the window is over the manifest only.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(system: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=dtype)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``ids_crc32`` is the unsigned crc32 of the ids as little-endian 32-bit numbers.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        for shard, dtype, base in (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            tokens = _mapped(system, f"{root}/{shard:07d}.tokens", dtype)
            offsets = _mapped(system, f"{root}/{shard:07d}.offsets", "<i8")
            docs = _mapped(system, f"{root}/{shard:07d}.docs", "<i8")
            for a in range(0, len(docs), 4096):
                part = slice(a, min(a + 4096, len(docs)))
                starts, stops = offsets[part], offsets[part.start + 1 : part.stop + 1]
                sums = [zlib.crc32(tokens[x:y].astype("<u4").tobytes()) for x, y in zip(starts, stops, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[part], pa.int64(), mask=docs[part] == NO_ID), pa.array(starts + base), pa.array(stops - starts), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A fixed number of tasks: the manifest's rows are small, what they stand for is not.
    one_each = manifest.select("shard", "dtype", "base").repartition(max(1, manifest.count()), "shard")
    return one_each.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_rows(docs: DataFrame, path: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    folder = shared_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, path, end_id, folder, shards), folder)
