"""Exact SentencePiece BPE encoding by backtracking, and decoding.

The library merges the best-scored neighbours again and again. This encoder finds the
same pieces from left to right: an Aho-Corasick automaton gives the longest piece at
each position; a piece may follow another only if merging the text of the two anew
gives just these two; if none fits, the last piece is taken back, and a bit field
remembers positions from which no encoding exists. An encoding whose neighbours all
agree is the library's own.

Two neighbouring characters that stand together in no piece are a cut: no piece spans
it, so both sides are encoded on their own. If no piece holds a blank after another
character (checked when the vocabulary is read), words are such parts; they are cut
further where the vocabulary allows it, encoded once and remembered. Characters without
a piece become their UTF-8 bytes.

Defined results: null text counts as empty and has no ids; texts of any length are
encoded whole; rows are independent, so ties, repeated rows and an empty table need no
rule; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import slices

BLANK = "▁"
#: Parts that one Python worker remembers at most, in each of two generations.
REMEMBERED = 250_000

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceCodec:
    """Encoder and decoder of one BPE model with byte fallback, given as the model file's bytes."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.surface: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(vocabulary.get_piece_size()):
            piece = vocabulary.id_to_piece(i)
            self.scores.append(vocabulary.get_score(i))
            if vocabulary.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif vocabulary.is_control(i):
                self.surface.append(b"")
            elif vocabulary.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.surface.append(piece.replace(BLANK, " ").encode())
        self.pieces = {i: piece for piece, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.lengths = [len(self.pieces.get(i, "")) for i in range(len(self.surface))]
        letters = {c for piece in self.ids for c in piece}
        if not letters <= self.ids.keys():
            raise ValueError("a character of the pieces is not a piece itself")
        self.joined = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        inner = any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        stops = "" if "\n" in letters else "\n"
        self.words = re.compile("(?s:.+)" if inner else f"{BLANK}*[^{BLANK}{stops}]+|{BLANK}+" + "|\n" * bool(stops))
        self.shorter: dict[int, int] = {}
        self.agreed: dict[tuple[int, int], bool] = {}
        self.young: dict[str, tuple[tuple[int, ...], str]] = {}
        self.old: dict[str, tuple[tuple[int, ...], str]] = {}

    def merged(self, text: str) -> list[int]:
        """The library's rule itself, for the few characters of two pieces."""
        parts = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                return [self.ids[p] for p in parts]
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def agree(self, a: int, b: int) -> bool:
        found = self.agreed.get((a, b))
        if found is None:
            found = self.agreed[a, b] = self.merged(self.pieces[a] + self.pieces[b]) == [a, b]
        return found

    def next_prefix(self, i: int) -> int:
        """The longest piece that is a proper prefix of piece ``i``; -1 if there is none."""
        found = self.shorter.get(i)
        if found is None:
            piece = self.pieces[i]
            found = self.shorter[i] = next((self.ids[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), -1)
        return found

    def backtrack(self, longest: list[int]) -> list[int]:
        """Pieces of a part; ``longest``: the longest piece that starts at each character."""
        lengths, agreed, end = self.lengths, self.agreed, len(longest)
        failed = bytearray(end + 1)
        chosen: list[int] = []
        last, at, piece = -1, 0, longest[0]
        while True:
            stop = at + lengths[piece]
            if not failed[stop]:
                fits = last < 0 or agreed.get((last, piece))
                if fits is None:
                    fits = self.agree(last, piece)
                if fits:
                    chosen.append(piece)
                    if stop == end:
                        return chosen
                    last, at, piece = piece, stop, longest[stop]
                    continue
            piece = self.next_prefix(piece)
            while piece < 0:
                failed[at] = 1
                piece = chosen.pop()
                at -= lengths[piece]
                last = chosen[-1] if chosen else -1
                piece = self.next_prefix(piece)

    def part(self, text: str) -> tuple[int, ...]:
        """Ids of a text without a cut."""
        if len(text) == 1:
            i = self.ids.get(text)
            return (i,) if i is not None else tuple(self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass"))
        longest = [0] * len(text)
        for stop, (length, i) in self.automaton.iter(text):
            longest[stop - length + 1] = i  # matches come by their end, so the longest of a place is the last
        return tuple(self.backtrack(longest))

    def word(self, text: str) -> tuple[tuple[int, ...], str]:
        """(ids, ids as text) of a word, made from its parts and remembered."""
        found = self.old.get(text)
        if found is None:
            joined, start, ids = self.joined, 0, ()
            for k in range(1, len(text)):
                if text[k - 1 : k + 1] not in joined:
                    ids += self.word(text[start:k])[0] if k - start > 1 else self.part(text[start:k])
                    start = k
            ids += self.word(text[start:])[0] if 0 < start < len(text) - 1 else self.part(text[start:])
            found = (ids, ",".join(map(str, ids)))
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[text] = found
        return found

    def encoded_words(self, text: str | None) -> list[tuple[tuple[int, ...], str]]:
        """(ids, ids as text) of each word of the text, in order."""
        if not text:
            return []
        words = self.words.findall(BLANK + text.replace(" ", BLANK))
        return [self.young.get(w) or self.word(w) for w in words]

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(ids for ids, _ in self.encoded_words(text)))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; bytes that form no character become U+FFFD each."""
        ids = list(ids)
        found = b"".join(map(self.surface.__getitem__, ids))
        shown = next((i for i in ids if self.surface[i]), None)
        if self.pieces.get(shown, "").startswith(BLANK):
            found = found[1:]  # of the blank that stands before every text
        return found.decode("utf-8", "each-byte")


_codecs: dict[bytes, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    """One codec for each model and Python worker."""
    key = hashlib.sha256(model).digest()
    if key not in _codecs:
        _codecs[key] = PieceCodec(model)
    return _codecs[key]


def _model(docs: DataFrame, path: str):
    with open(path, "rb") as file:  # on the driver; a model file is of fixed size
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text."""
    model = _model(docs, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        for doc_ids, texts in (part for batch in batches for part in slices(batch, 64)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([own.encode(t) for t in texts], pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(encoded_docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` of every row of ids."""
    model = _model(encoded_docs, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        for doc_ids, ids in (part for batch in batches for part in slices(batch, 64)):
            texts = [own.decode(i or ()) for i in ids]
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded_docs.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; doc_id, n_tokens, ids_sha256, decoded_sha256.

    Both directions run in one task, so no ids are moved between processes.
    """
    model = _model(docs, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value)
        for doc_ids, texts in (part for batch in batches for part in slices(batch, 64)):
            rows = []
            for text in texts:
                parts = own.encoded_words(text)
                ids = list(chain.from_iterable(i for i, _ in parts))
                back = own.decode(ids).encode("utf-8", "surrogatepass")
                rows.append((len(ids), hashlib.sha256(",".join([t for _, t in parts]).encode()).hexdigest(), hashlib.sha256(back).hexdigest()))
            columns = zip(*rows, strict=True)
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(digest, schema)
