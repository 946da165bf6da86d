"""Toxicity by weak supervision.

1. Voters. A bounded sample of labelled documents shows which words and word starts occur
   in marked documents only; they are dealt by hash into ``LISTS`` lexicon voters, beside
   voters of a written lexicon and of patterns (insults spelled with digits or split into
   letters, shouting, an insult aimed at "you"). A voter votes 1 or abstains (0).
2. Label model. One pass over all training documents gives the votes' means and joint
   rates. For voters that are independent given the label, the covariance of two is
   z_j * z_k; z is fitted to the off-diagonal cells. Pairs that fit badly are taken as
   correlated, left out of the fit, and later weigh less together. With the share of
   marked documents this gives each voter's rate among toxic and among clean documents,
   and from them a posterior for every combination of votes.
3. A linear classifier on words and word starts is trained on the posteriors of all
   training documents, which need no label. One pass sums, for each hashed slot, the slope of
   the loss before any weight; the next one looks into the slots that are steep enough for the
   L1 term and sums the slopes of the terms themselves, so no term shares a weight
   with another. The terms that may move are fitted in further passes, each of which sums
   slopes of all rows at one common state: the result does not depend on partitions. No
   table of features is written but the rows of these terms. It scores every whole text.

Labels are read only for documents whose crc32(doc_id) modulo 4 is not 2, and only in
step 1 (which terms, and the share of marked documents). Labels, lang, source and doc_id
are not inputs of a score.

Defined results: null text counts as empty and gets the score of a text without a word;
repeated rows are scored alike; several labels of a document count as toxic if one is;
without any marked or any clean label, or on an empty table, the written lexicon alone
decides the lists; other columns are not read.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import remainder, slices, written
from oddlens.llm.hashed_words import IS_WORD, Scan, Terms, lowered, scan_slots, scans, sifted, summed, term_hashes, text_rows
from oddlens.llm.linear import BITS, PREFIXES, fit_in_tasks, hash_sample, logit, sigmoid, tokens

#: Bound of the labelled sample (expected rows) that the lists are found in.
LABELLED = 20_000
#: L1 term of the classifier, in standard deviations of the slope of a word in all documents, and its passes.
L1, PASSES = 0.05, 15
#: Standard deviations from chance that a term's slope must have to enter the classifier, half of it for a slot.
SURE = 3.0
#: Terms of the classifier at most: those with the steepest slopes.
MOST = 1 << 17
#: Lexicon voters that the found terms are dealt to, and the most terms of all of them.
LISTS, TERMS = 12, 600
#: A term must be in so many marked documents, and that many times likelier than in clean ones.
LEAST_DOCS, LEAST_RATIO = 4, 15.0
#: Residual correlation from which two voters count as dependent.
DEPENDENT = 0.1
THRESHOLD = 0.3

#: Common insults of four languages.
INSULTS = (
    "asshole bastard bitch clown crap cretin damn disgusting dumb fool freak garbage idiot imbecile jerk loser moron "
    "pathetic pig scum scumbag shit stupid trash ugly useless vermin whore worthless "
    "abschaum arschloch blöd depp dreck dumm hure idiot schlampe schwein trottel versager "
    "abruti connard conne crétin imbécile ordure pute raté salaud salope "
    "basura cabrón estúpido gilipollas imbécil inútil mierda pendejo puta"
).split()
_DIGITS = str.maketrans("013457@$!", "oieastasi")
_SPELLED = re.compile(r"(?<!\w)(?:\w[ .*_-]){3,}\w(?!\w)")
_AIMED = re.compile(r"\b(?:you|du|tu|vous|usted|ustedes)\b((?:\W+\w+){1,5})", re.I)
_SHOUT = re.compile(r"[!?]{3,}")


@dataclass(frozen=True)
class Voters:
    """Which lists a term belongs to, and the names of all voters."""

    lists: dict[str, int]

    names = (*(f"list {k}" for k in range(LISTS)), "written", "digits", "letters", "aimed", "shouting")

    def votes(self, text: str | None, known: dict[str, int]) -> int:
        """Bit field of the voters that vote 1."""
        found = 0
        for word in words(text):
            mask = known.get(word)
            if mask is None:
                if len(known) > 300_000:
                    known.clear()
                mask = known[word] = self._mask(word)
            found |= mask
        if text:
            if any((plain := word.translate(_DIGITS)) != word and plain in _WRITTEN for word in (t.strip(string.punctuation) for t in tokens(text))):
                found |= 1 << LISTS + 1
            if any("".join(re.findall(r"\w", m)).lower() in _WRITTEN for m in _SPELLED.findall(text)):
                found |= 1 << LISTS + 2
            if found & (1 << LISTS) and any(w in _WRITTEN for m in _AIMED.findall(text) for w in re.findall(r"\w+", m.lower())):
                found |= 1 << LISTS + 3
            if len(_SHOUT.findall(text)) > 2:
                found |= 1 << LISTS + 4
        return found

    def _mask(self, word: str) -> int:
        mask = 1 << LISTS if word in _WRITTEN else 0
        for term in terms(word):
            if term in self.lists:
                mask |= 1 << self.lists[term]
        return mask

    def by_hash(self) -> tuple[Terms, np.ndarray]:
        """All terms that list voters know, and the bits of the voters that know each."""
        bits: dict[int, int] = {}
        named = [(t, 1 << k) for t, k in self.lists.items()] + [(t, 1 << LISTS) for t in _WRITTEN]
        for h, (_, bit) in zip(term_hashes([t for t, _ in named]).tolist(), named, strict=True):
            bits[h] = bits.get(h, 0) | bit
        hashes = sorted(bits)
        return Terms(np.array(hashes, np.uint64)), np.array([bits[h] for h in hashes], np.int64)


def words(text: str | None) -> set[str]:
    """Distinct words of a text, in lower case, as ``hashed_words`` finds them."""
    return {w.decode("utf-8", "surrogatepass") for w in lowered(text).translate(_BLANKED).split()}


_BLANKED = bytes(b if IS_WORD[b] else 32 for b in range(256))


def terms(word: str) -> list[str]:
    """A word, and its starts; a start carries its length, so it differs from a word."""
    return [word, *(f"{k} {word[:k]}" for k in PREFIXES if len(word) > k)]


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of ``a`` with ``b`` at the next one."""
    return np.flatnonzero(a[:-1] & b[1:])


_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_DIGIT, _SIGN, _LOUD = (np.isin(np.arange(256), list(x)) for x in (b"013457", b"@$!", b"!?"))


def suspects(scan: Scan) -> np.ndarray:
    """Places of a buffer where a pattern voter may vote: a digit or sign inside a word, single
    letters in a row, or a run of marks. A superset; the voters themselves decide."""
    letter, digit, sign, loud = (kind[scan.data] for kind in (_LETTER, _DIGIT, _SIGN, _LOUD))
    one = scan.single()
    row = one[:-1] & one[1:] & (scan.starts[1:] - scan.ends[:-1] == 1)
    letters = scan.starts[:-3][row[:-2] & row[1:-1] & row[2:]]
    return np.concatenate([_near(letter, digit), _near(digit | sign, letter), letters, _near(loud[:-1] & loud[1:], loud[1:])])


_WRITTEN = frozenset(INSULTS)


def _term_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, clean documents, toxic documents) of one task, in parts; plus the totals under ''."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[0][t] for t in names], pa.int64()), pa.array([seen[1][t] for t in names], pa.int64())], names=["term", "clean", "toxic"]
        )

    for texts, marks in (part for batch in batches for part in slices(batch)):
        for text, mark in zip(texts, marks, strict=True):
            seen[mark].update({t for word in words(text) for t in terms(word)} | {""})
        if len(seen[0]) + len(seen[1]) > 400_000:
            yield flush()
            for c in seen:
                c.clear()
    yield flush()


def training_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1) of the labelled rows that may be learned from."""
    own = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return own.where(remainder("doc_id", 4) != 2)


def find_voters(docs: DataFrame, labels: DataFrame) -> tuple[Voters, float]:
    """The voters, and the share of marked documents among the labelled ones."""
    chosen = hash_sample(training_labels(docs, labels), "doc_id", LABELLED)
    # Of bounded size: see LABELLED.
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    once = marked.groupBy(F.xxhash64("text").alias("h")).agg(F.any_value("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = once.select("text", "toxic").mapInArrow(_term_rows, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = rows.where("term = ''").first()
    clean, toxic = (total.clean, total.toxic) if total else (0, 0)
    if not clean or not toxic:
        return Voters({}), 0.1
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    found = rows.where((F.col("term") != "") & (F.col("toxic") >= LEAST_DOCS) & (ratio >= LEAST_RATIO))
    best = found.orderBy((F.col("toxic") - F.lit(toxic / clean) * F.col("clean")).desc(), "term").limit(TERMS).collect()
    lists = {r.term: xxhash.xxh32_intdigest(r.term) % LISTS for r in best}
    return Voters(lists), toxic / (clean + toxic)


@dataclass(frozen=True)
class LabelModel:
    """Rates of each voter among toxic and clean documents, and the weight of its vote."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    weight: np.ndarray
    correlated: tuple[tuple[int, int], ...]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = self.weight * (np.log(self.toxic) - np.log(self.clean))
        no = self.weight * (np.log1p(-self.toxic) - np.log1p(-self.clean))
        bits = (votes[:, None] >> np.arange(len(self.weight))) & 1
        # Row by row, so that a row's sum does not depend on its batch.
        return sigmoid(logit(self.prior) + np.where(bits, yes, no).sum(axis=1))


def fit_label_model(n: int, joint: np.ndarray, prior: float) -> LabelModel:
    """``joint[j, k]``: in how many of ``n`` documents voters j and k both vote."""
    m = len(joint)
    mean = joint.diagonal() / max(n, 1)
    cov = joint / max(n, 1) - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.outer(cov.diagonal(), cov.diagonal()), 1e-18))
    use = ~np.eye(m, dtype=bool)
    use &= np.outer(mean > 0, mean > 0)
    z = np.zeros(m)
    for _ in range(6):
        z = np.sqrt(np.maximum(np.where(use, cov, 0).max(axis=1, initial=0), 0))
        for _ in range(200):  # alternating least squares on the cells in use
            for j in range(m):
                other = z * use[j]
                z[j] = max(0.0, (cov[j] @ other) / max(other @ other, 1e-18))
        residual = np.where(np.eye(m, dtype=bool), 0, (cov - np.outer(z, z)) / scale)
        keep = use & (np.abs(residual) <= DEPENDENT)
        # A voter stays with its best-fitting partners, else its z has no evidence.
        for j in np.flatnonzero(keep.sum(axis=1) < 3):
            best = [k for k in np.argsort(np.abs(residual[j])) if use[j, k]][:3]
            keep[j, best] = keep[best, j] = True
        if (keep == use).all():
            break
        use = keep
    rho = np.where(np.abs(residual) > DEPENDENT, np.abs(residual), 0)
    gap = z / np.sqrt(prior * (1 - prior))
    low, high = 1e-5, 1 - 1e-3
    toxic, clean = np.clip(mean + (1 - prior) * gap, low, high), np.clip(mean - prior * gap, low, high)
    silent = z == 0
    toxic[silent] = clean[silent] = np.clip(mean[silent], low, high)
    pairs = tuple((j, k) for j in range(m) for k in range(j) if rho[j, k] > 0)
    return LabelModel(prior, toxic, clean, 1 / (1 + rho.sum(axis=1)), pairs)


def _marks(texts: list[str | None], scanned: list, voters: Voters, terms: Terms, bits: np.ndarray, known: dict[str, int]) -> np.ndarray:
    """Votes of each text: those of lists by looked-up hashes, the others' only where they may vote."""
    sizes, found = terms.rows(scanned, len(texts))
    votes = np.zeros(len(texts), np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        votes[filled] = np.bitwise_or.reduceat(bits[found], (np.cumsum(sizes) - sizes)[filled])
    marked = votes & (1 << LISTS) != 0
    for scan, ends, numbers in scanned:
        marked[numbers[np.searchsorted(ends, suspects(scan), "right")]] = True
    for k in np.flatnonzero(marked).tolist():
        votes[k] = voters.votes(texts[k], known)
    return votes


#: Grain of summed slopes: whole numbers add up alike in any order.
_GRAIN = float(1 << 24)


class _Rows:
    """What tasks read from training texts, with the voters and the label model."""

    def __init__(self, voters: Voters, labels: LabelModel | None = None):
        self.voters, self.labels = voters, labels

    def scanned(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
        """Scans of some texts at a time, and the texts' votes."""
        known, (terms, bits) = {}, self.voters.by_hash()
        for (texts,) in (part for batch in batches for part in slices(batch)):
            found = list(scans(texts))
            yield found, _marks(texts, found, self.voters, terms, bits, known)

    def _slopes(self, marks: np.ndarray) -> np.ndarray:
        """Slope of the loss by each text's score before any weight."""
        return np.rint(_GRAIN * (self.labels.prior - self.labels.posterior(marks)))

    def votes(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, marks in self.scanned(batches):
            seen.update(marks.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["mark", "n"])

    def slot_slopes(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(1 << BITS), np.zeros(1 << BITS, np.int64)
        for scanned, marks in self.scanned(batches):
            sizes, found = text_rows([scan_slots(*s) for s in scanned], len(marks))
            total += np.bincount(found, weights=np.repeat(self._slopes(marks), sizes), minlength=1 << BITS)
            docs += np.bincount(found, minlength=1 << BITS)
        at = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64)), pa.array(docs[at])], names=["slot", "total", "n"])

    def term_slopes(self, batches: Iterable[pa.RecordBatch], sieve: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Slopes of the terms themselves whose slot is in the sieve, in parts."""
        for scanned, marks in self.scanned(batches):
            slopes, keys, places = self._slopes(marks), [], []
            for scan, ends, numbers in scanned:
                for owner, found in sifted(scan, sieve):
                    keys.append(found)
                    places.append(numbers[np.searchsorted(ends, scan.starts[owner], "right")])
            keys, places = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.int64), *places])
            by = np.lexsort((places, keys))
            keys, places = keys[by], places[by]
            once = np.append(True, (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])) if len(keys) else []
            keys, places = keys[once], places[once]
            heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
            totals = np.add.reduceat(slopes[places], heads) if len(heads) else np.empty(0)
            docs = np.diff(np.append(heads, len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[heads].view(np.int64)), pa.array(totals.astype(np.int64)), pa.array(docs)], names=["term", "total", "n"])

    def rows(self, batches: Iterable[pa.RecordBatch], terms: Terms) -> Iterator[pa.RecordBatch]:
        for scanned, marks in self.scanned(batches):
            sizes, found = terms.rows(scanned, len(marks))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(found))
            yield pa.RecordBatch.from_arrays([lists, pa.array(marks)], names=["slots", "mark"])


@dataclass(frozen=True)
class ToxicityModel:
    """A linear model over terms, known by their 64-bit hashes in ascending order."""

    hashes: np.ndarray
    weights: np.ndarray
    offset: float
    labels: LabelModel


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Voters, label model and classifier, from all documents whose remainder is not 2."""
    voters, prior = find_voters(docs, labels)
    context = docs.sparkSession.sparkContext
    own = docs.where(remainder("doc_id", 4) != 2).select(F.col("text").cast("string").alias("text"))
    shared = context.broadcast(_Rows(voters))  # TERMS terms at most
    m = len(Voters.names)
    joint, n = np.zeros((m, m)), 0
    votes = own.mapInArrow(lambda b, shared=shared: shared.value.votes(b), "mark long, n long").groupBy("mark").agg(F.sum("n").alias("n"))
    for r in votes.collect():  # combinations of votes: few of the 2 ** m occur
        bits = (r.mark >> np.arange(m)) & 1
        joint += r.n * np.outer(bits, bits)
        n += r.n
    model = fit_label_model(n, joint, prior)
    l1 = L1 * float(np.sqrt(max(n, 1) * prior * (1 - prior)))
    # Slopes of the slots show where terms may lie that the L1 term lets move; then those terms themselves.
    shared = context.broadcast(_Rows(voters, model))
    both = [F.sum(c).alias(c) for c in ("total", "n")]
    slots = own.mapInArrow(lambda b: shared.value.slot_slopes(b), "slot long, total long, n long").groupBy("slot").agg(*both).toArrow()
    slot, total, n_docs = (slots.column(c).to_numpy() for c in ("slot", "total", "n"))
    chance = float(np.sqrt(prior * (1 - prior)))  # standard deviation of one document's slope
    sieve = np.zeros(1 << BITS, bool)
    sieve[slot[np.abs(total) / _GRAIN > np.maximum(l1 / 2, SURE / 2 * chance * np.sqrt(n_docs))]] = True
    sums = own.mapInArrow(lambda b: shared.value.term_slopes(b, sieve), "term long, total long, n long").groupBy("term").agg(*both)
    steep = F.abs("total") / F.lit(_GRAIN) > F.greatest(F.lit(l1), F.lit(SURE * chance) * F.sqrt("n"))
    chosen = sums.where(steep).orderBy(F.abs("total").desc(), "term").limit(MOST).select("term").toArrow()
    terms = Terms(np.sort(chosen.column("term").to_numpy().view(np.uint64)))
    rows = written(own.mapInArrow(lambda b: shared.value.rows(b, terms), "slots array<int>, mark long"), "toxicity-rows")
    weights, offset = fit_in_tasks(rows, model.posterior, prior, l1, PASSES)
    at = np.flatnonzero(weights)
    return ToxicityModel(terms.hashes[at], weights[at], offset, model)


def with_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """``docs`` with the score of each text; row by row, so rows of any shape stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST terms at most

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        terms = Terms(own.hashes)
        for texts in batches:
            parts = (texts.iloc[a : a + 256].tolist() for a in range(0, len(texts), 256))
            raw = [summed(own.weights, *terms.rows(scans(part), len(part))) for part in parts]
            yield pd.Series(sigmoid(np.concatenate([np.empty(0), *raw]) + own.offset), dtype="float64")

    return docs.withColumn(column, score(F.col("text").cast("string")))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit_toxicity(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = with_toxicity(rows, model)
    held: Column = remainder("doc_id", 4) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
