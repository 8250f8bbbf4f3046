"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel compares two words by their common subsequences of three letters, each weighted by
DECAY for every letter it spans (at most SPAN), so gaps and inserted characters lower a match
instead of losing it. Words are runs between blanks in small letters, without other signs; three or
more single letters in a row also count as one word; a long word counts by overlapping pieces.

Landmarks are all words that tell the labels apart, common words of clean texts and those
nearest to the former. Their
kernel matrix gives the Nyström features, on which a linear support vector machine (squared hinge)
is trained. Labels are known for whole texts, so the parts of their sentences that carry them are
found in turns: first words that tell the texts apart, then the likeliest word of each. A text's
score comes from its largest margin, the number of words on the toxic side and the number of all
words by a logistic model that is fitted on texts the machine has not seen.

The machine is fitted on a bounded sample of labelled rows: about FIT_TOXIC and FIT_CLEAN texts.
An upper bound of the similarity to the toxic landmarks spares most words the full kernel; workers
keep the margins of words in a cache; when it is full, only those of the texts at hand stay.

Defined results: null or empty texts and texts without letters score like a text of unknown words;
without labels of both kinds every score is the share of toxic labels (0 without labels); null
labels are left out; of conflicting labels of one document the larger holds; repeated rows give
repeated rows; an empty table gives an empty result; further columns are ignored by ``score`` and
kept by ``remove_toxic``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek.llm.boosting import sigmoid
from kartotek.llm.memory import tidy

#: Labelled texts of the sample, about, and landmarks among clean words near to telling ones (as many
#: as telling ones, if these are more); the sample bounds the telling ones, which are all landmarks.
FIT_TOXIC, FIT_CLEAN, LANDMARKS = 1000, 2000, 120
#: Least evidence (log likelihood ratio) of a telling word, clean words that the machine is trained on,
#: and the weight of its errors against the size of its weights.
EVIDENCE, CLEAN_WORDS, SUPPORT_COST = 12.0, 4000, 2000.0
#: Plain words that may pass as telling by chance, whatever the number of words that are tried; words
#: of a text's sketch, and how many of them two near copies share.
MISTAKE, SKETCH, SHARED = 3.0, 24, 12
#: Fall of the kernel with distance, and similarity to a toxic landmark below which a word is
#: like any other.
SHARPNESS, LIKE = 6.0, 0.5
#: Margin that a like word must reach without one letter to count, and what that costs it.
SURE, INSERTED = 0.8, 0.2
#: Groups of toxic landmarks that share a bound, and groups that share one before.
GROUPS, TOGETHER = 24, 5
#: Share of a bound that rounding may take.
ROUNDED = 1e-4
#: Letters that a subsequence may span, and the weight of each.
SPAN, DECAY = 6, 0.6
#: Letters of a piece of a long word, and words in a worker's cache.
PIECE, CACHE_SIZE = 24, 100_000
#: Words whose subsequences are held at once.
CHUNK = 6000
THRESHOLD = 0.3

_SPACED = re.compile(r"(?<!\S)\w(?:\s\w(?!\S)){2,}")
_SHAPES = [(a, b) for a, b in combinations(range(1, SPAN), 2)]
_CODES = 64


def words_of(text: str) -> set[str]:
    """Raw words of a text in small letters; spaced letters also as one word."""
    low = text.lower()
    found = set(low.split())
    for m in _SPACED.finditer(low):
        found.add("".join(m[0].split()))
    return found


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def _pieces(forms: Iterable[str]) -> tuple[np.ndarray, list[str]]:
    """Each form (letters of a word) between marks of its ends; long ones in overlapping pieces."""
    owner, pieces = [], []
    for k, w in enumerate(forms):
        w = f"^{w}$"
        starts = range(0, len(w) - PIECE // 2, PIECE // 2) if len(w) > PIECE else (0,)
        for s in starts:
            owner.append(k)
            pieces.append(w[s:s + PIECE])
    return np.array(owner, np.int64), pieces


def _letter_codes(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(size, begin) of each piece; (code, letters from here to the piece's end) of each letter."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    plain = (points >= 97) & (points < 123)
    flat = np.where(plain, points - 96, 29 + points % 35)
    flat[points == 94], flat[points == 36] = 27, 28
    ends = np.cumsum(sizes)
    return sizes, ends - sizes, flat, np.repeat(ends, sizes) - np.arange(len(flat))


def _subsequences(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, subsequence, weight) of every occurrence of three letters within SPAN."""
    sizes, _, flat, left = _letter_codes(pieces)
    who = np.repeat(np.arange(len(pieces)), sizes)
    owners, codes, weights = [], [], []
    for a, b in _SHAPES:
        at = np.flatnonzero(left > b)
        owners.append(who[at])
        codes.append((flat[at] * _CODES + flat[at + a]) * _CODES + flat[at + b])
        weights.append(np.full(len(at), DECAY ** (b - 2)))
    return np.concatenate(owners), np.concatenate(codes), np.concatenate(weights)


def _summed(owner, code, weight):
    """Equal subsequences of a piece as one, with the sum of their weights."""
    key = owner * _CODES ** 3 + code
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    total = np.add.reduceat(weight[order], np.flatnonzero(fresh)) if len(key) else weight
    return key[fresh] // _CODES ** 3, key[fresh] % _CODES ** 3, total


class Landmarks:
    """Normalised subsequence weights of a bounded list of words, and their largest values."""

    def __init__(self, words: list[str], n_toxic: int):
        owner, code, weight = _summed(*_subsequences([f"^{letters(w)}$"[:PIECE] for w in words]))
        norm = np.sqrt(np.bincount(owner, weight ** 2, len(words)))
        weight = weight / np.maximum(norm[owner], 1e-12)
        self.n = len(words)
        self.known = np.unique(code)
        self.place = np.full(_CODES ** 3, -1, np.int32)
        self.place[self.known] = np.arange(len(self.known))
        self.dense = np.zeros((len(self.known), len(words)), np.float32)
        self.dense[self.place[code], owner] = weight
        # largest values within groups of like toxic words, for upper bounds
        toxic = self.dense[:, :n_toxic]
        alike = toxic.T @ toxic
        leaders: list[int] = []
        members: list[list[int]] = []
        for k in range(n_toxic):
            best = max(range(len(leaders)), key=lambda g: alike[k, leaders[g]], default=-1)
            if best >= 0 and (alike[k, leaders[best]] >= 0.4 or len(leaders) == GROUPS):
                members[best].append(k)
            else:
                leaders.append(k)
                members.append([k])
        most = np.array([toxic[:, m].max(1) for m in members], np.float32).reshape(len(members), len(self.known))
        # the same of all groups, and of some together: what fails these fails each of their groups
        self.top = np.zeros(_CODES ** 3, np.float32)
        self.top[self.known] = most.max(0, initial=0)
        self.sieves = [[most[g:g + TOGETHER].max(0) for g in range(0, len(most), TOGETHER)], most]

    def promising(self, pieces: list[str]) -> np.ndarray:
        """Places of the pieces whose subsequences could make them LIKE a toxic word if all of these were one."""
        sizes, begin, flat, left = _letter_codes(pieces)
        if not len(flat):
            return begin
        bound = np.zeros(len(flat), np.float32)  # of the subsequences that begin at each letter
        squares = np.zeros(len(pieces))
        for a, b in _SHAPES:
            n = max(0, len(flat) - b)
            code = (flat[:n] * _CODES + flat[a:a + n]) * _CODES + flat[b:]
            bound[:n] += self.top[code] * (left[:n] > b) * np.float32(DECAY ** (b - 2))
            squares += np.maximum(sizes - b, 0) * DECAY ** (2 * (b - 2))
        return np.flatnonzero(np.add.reduceat(bound, begin) >= LIKE * (1 - ROUNDED) * np.maximum(np.sqrt(squares), 1e-12))

    def similarities(self, owner, code, weight, n: int) -> np.ndarray:
        """Normalised kernel of ``n`` pieces (summed subsequences, sorted by piece) and all words."""
        norm = np.sqrt(np.bincount(owner, weight ** 2, n))
        weight = (weight / np.maximum(norm[owner], 1e-12)).astype(np.float32)
        out = np.zeros((n, self.n), np.float32)
        at = self.place[code]
        hit = at >= 0
        owner, at, weight = owner[hit], at[hit], weight[hit]
        cuts = np.searchsorted(owner, np.arange(0, n + 256, 256))
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                who, first = np.unique(owner[lo:hi], return_index=True)
                out[who] = np.add.reduceat(self.dense[at[lo:hi]] * weight[lo:hi, None], first, axis=0)
        return out

    def of_words(self, words: list[str]) -> np.ndarray:
        return self.similarities(*_summed(*_subsequences([f"^{letters(w)}$"[:PIECE] for w in words])), len(words))


def gaussian(similarity: np.ndarray) -> np.ndarray:
    """Gaussian kernel in the space of the subsequence kernel."""
    return np.exp(-SHARPNESS * (1 - similarity))


@dataclass
class Machine:
    """``weights`` of the landmarks. A word that is less than LIKE to every toxic landmark has the
    margin ``bias``. ``evidence``: weights of a text's facts and, last, the constant."""

    landmarks: Landmarks | None
    weights: np.ndarray
    bias: float
    evidence: np.ndarray
    n_toxic: int = 0

    def margins(self, words: list[str]) -> np.ndarray:
        if self.landmarks is None or not words:
            return np.full(len(words), self.bias)
        forms: dict[str, int] = {}  # words with the same letters have the same margin
        at = [forms.setdefault(letters(w), len(forms)) for w in words]
        rest = iter(forms)
        return np.concatenate([self._of_forms(list(islice(rest, CHUNK))) for _ in range(0, len(forms), CHUNK)])[at]

    def _of_forms(self, forms: list[str]) -> np.ndarray:
        out = np.full(len(forms), self.bias)
        owner, pieces = _pieces(forms)
        like, margin = self._of_pieces(pieces)
        # a like word that is not toxic as it stands may be so without an inserted letter
        short, whose = [], []
        for k in np.flatnonzero(like & (margin <= 0)).tolist():
            p = pieces[k]
            if len(p) > 6:
                short += [p[:i] + p[i + 1:] for i in range(1, len(p) - 1) if p[i] != p[i - 1]]
                whose += [k] * (len(short) - len(whose))
        for lo in range(0, len(short), CHUNK):
            _, without = self._of_pieces(short[lo:lo + CHUNK])
            sure = without >= SURE
            np.maximum.at(margin, np.array(whose[lo:lo + CHUNK])[sure], without[sure] - INSERTED)
        np.maximum.at(out, owner, margin)
        return out

    def _of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each piece is LIKE a toxic landmark, and its margin."""
        margin, like = np.full(len(pieces), self.bias), np.zeros(len(pieces), bool)
        # no piece that is LIKE a toxic landmark fails a bound
        able = self.landmarks.promising(pieces)
        who, code, weight = _subsequences([pieces[k] for k in able])
        least = LIKE * (1 - ROUNDED) * np.maximum(np.sqrt(np.bincount(who, weight ** 2, len(able))), 1e-12)
        at = self.landmarks.place[code]
        mine = at >= 0
        for sieve in self.landmarks.sieves:
            who, at, weight = who[mine], at[mine], weight[mine]
            stays = np.zeros(len(able), bool)
            for most in sieve:
                stays |= np.bincount(who, weight * most[at], len(able)) >= least
            mine = stays[who]
            who = np.cumsum(stays)[who] - 1
            able, least = able[stays], least[stays]
        if len(able):
            near = self.landmarks.similarities(*_summed(*_subsequences([pieces[k] for k in able])), len(able))
            like[able] = near[:, :self.n_toxic].max(1) >= LIKE
            margin[able] = np.where(like[able], gaussian(near) @ self.weights + self.bias, self.bias)
        return like, margin

    def facts(self, margins: list[float]) -> tuple[float, ...]:
        """The largest margin of a text's words, how far it is beyond doubt, the number of words
        on the toxic side and of all words (log)."""
        top = max(margins, default=self.bias)
        beyond = sum(m > 0 for m in margins) if top > 0 else 0
        return top, max(top - 0.5, 0.0), math.log1p(beyond), math.log1p(len(margins))

    def probability(self, facts: np.ndarray) -> np.ndarray:
        return sigmoid(facts @ self.evidence[:-1] + self.evidence[-1])


def _support_vectors(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0, turns: int = 30) -> np.ndarray:
    """Squared-hinge machine in the primal (Newton); the last weight is the bias."""
    z1 = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z1.shape[1])
    damp = np.eye(len(w)) * ridge
    damp[-1, -1] = 1e-6
    before = None
    for _ in range(turns):
        active = y * (z1 @ w) < 1
        if before is not None and (active == before).all():
            break
        a = z1[active]
        c = cost[active]
        w = np.linalg.solve(damp + a.T @ (a * c[:, None]), a.T @ (c * y[active]))
        before = active
    return w


def _telling(seen: tuple[Counter, Counter], docs: list[int]) -> dict[str, float]:
    """Words of toxic texts with the evidence (log likelihood ratio) that they tell them apart. The more
    words are tried, the more evidence each must have."""
    out = {}
    share = docs[1] / sum(docs)
    least = max(EVIDENCE, 2 * math.log(max(1, sum(n > 1 for n in seen[1].values())) / MISTAKE))
    for w, n in seen[1].items():
        m = seen[0][w]
        if n > 1 and n * docs[0] > 4 * m * docs[1]:
            g = 2 * (n * math.log(n / ((n + m) * share)) + (m * math.log(m / ((n + m) * (1 - share))) if m else 0.0))
            if g > least:
                out[w] = g
    return out


def _one_of_copies(texts: list[tuple[list[str], int]]) -> list[tuple[list[str], int]]:
    """The texts without those that are near copies of an earlier one: copies of one toxic text would
    make each of its plain words tell. Sketches are the words with the smallest hashes."""
    seen: dict[int, list[int]] = {}
    out = []
    for found, y in texts:
        sketch = sorted({zlib.crc32(letters(w).encode("utf-8", "surrogatepass")) for w in found})[:SKETCH]
        met = Counter(k for h in sketch for k in seen.get(h, ()))
        if met and max(met.values()) >= max(SHARED * len(sketch) / SKETCH, 2):
            continue
        for h in sketch:
            seen.setdefault(h, []).append(len(out))
        out.append((found, y))
    return out


def train(texts: list[tuple[list[str], int]], share: float | None = None) -> Machine:
    """A machine from (distinct words, label) of a bounded list of texts. ``share``: that of toxic
    labels where the list was drawn, if the list has another one."""
    ones = sum(y for _, y in texts)
    drawn = ones / len(texts) if texts else 0.0
    share = drawn if share is None else share
    flat = Machine(None, np.zeros(0), 0.0, np.array([0.0] * 4 + [math.log((share + 1e-6) / (1 - share + 1e-6))]))
    if not 0 < ones < len(texts):
        return flat
    train_on, held = [t for k, t in enumerate(texts) if k % 3], texts[::3]
    if not 0 < sum(y for _, y in held) < len(held) or not any(y for _, y in train_on):
        train_on = held = texts
    seen = (Counter(), Counter())
    docs = [0, 0]
    for found, y in _one_of_copies(train_on):
        docs[y] += 1
        seen[y].update({w for w in map(letters, found) if len(w) > 2})
    telling = _telling(seen, docs)
    if not telling:
        return flat
    ranked = sorted(telling, key=lambda w: (-telling[w], w))
    common = [w for w, _ in sorted(seen[0].items(), key=lambda x: (-x[1], x[0])) if w not in telling]
    # clean words as near to the telling ones as they come, and common ones
    heads = {w[:n] for w in ranked for n in range(2, len(w) + 1)}
    near = sorted(common[:40 * CLEAN_WORDS], key=lambda w: -_shared(w, heads))[:CLEAN_WORDS // 2]
    chosen = list(dict.fromkeys(ranked + near[:max(LANDMARKS, len(ranked))] + common[:LANDMARKS // 4]))
    landmarks = Landmarks(chosen, len(ranked))
    k = gaussian(landmarks.of_words(chosen)).astype(float)
    values, vectors = np.linalg.eigh(k + 1e-8 * np.eye(len(k)))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    spread = common[CLEAN_WORDS // 4:: max(1, 4 * len(common) // CLEAN_WORDS)]
    clean = list(dict.fromkeys(common[:CLEAN_WORDS // 4] + spread + near))
    features = dict(zip(clean, gaussian(landmarks.of_words(clean)) @ root, strict=True))
    right = {w: float(seen[1][w]) for w in ranked}
    machine = flat
    for turn in range(2):
        new = [w for w in right if w not in features]
        if new:
            features.update(zip(new, gaussian(landmarks.of_words(new)) @ root, strict=True))
        negatives = [w for w in clean if w not in right]
        z = np.array([features[w] for w in [*right, *negatives]])
        y = np.array([1.0] * len(right) + [-1.0] * len(negatives))
        cost = np.concatenate([np.array([*right.values()]) / sum(right.values()),
                               np.full(len(negatives), 1 / max(1, len(negatives)))]) * SUPPORT_COST
        w = _support_vectors(z, y, cost)
        machine = Machine(landmarks, root @ w[:-1], float(w[-1]), flat.evidence, len(ranked))
        # the likeliest word of each toxic text bears its label, unless clean texts have it too; where no
        # word is like a landmark, none is likelier than the others
        if not turn:
            for found, label in train_on:
                if label and found:
                    names = sorted(found)
                    best = letters(names[int(machine.margins(names).argmax())])
                    if len(best) > 2 and seen[0][best] <= 0.001 * docs[0]:
                        right[best] = right.get(best, 0.0) + 1.0
    facts = np.array([machine.facts(machine.margins(f).tolist()) for f, _ in held])
    machine.evidence = _logistic(facts, np.array([float(y) for _, y in held]))
    if 0 < share < 1:
        machine.evidence[-1] += math.log(share / (1 - share)) - math.log(drawn / (1 - drawn))
    return machine


def _shared(word: str, heads: set[str]) -> float:
    """Share of a word that is the longest beginning known in ``heads``."""
    n = 1
    while n < len(word) and word[:n + 1] in heads:
        n += 1
    return n / len(word) if n > 2 else 0.0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, turns: int = 40) -> np.ndarray:
    """Weights and constant of a logistic model (Newton steps, halved while they do not help)."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])

    def loss(v):
        m = x1 @ v
        return (np.logaddexp(0, m) - y * m).sum() + ridge * (v @ v) / 2

    for _ in range(turns):
        p = sigmoid(x1 @ w)
        step = np.linalg.solve((x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + ridge * np.eye(len(w)), x1.T @ (p - y) + ridge * w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine from a sample of the labelled rows that are not held out."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    )
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, F.pmod(F.xxhash64("doc_id"), F.lit(totals.get(1, 1))) < FIT_TOXIC).otherwise(
        F.pmod(F.xxhash64("doc_id"), F.lit(totals.get(0, 1))) < FIT_CLEAN)

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(words_of(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.string())), batch.column(2)], ["doc_id", "words", "label"])

    most = 2 * (FIT_TOXIC + FIT_CLEAN)  # the bound of the sample, and so of the broadcast ids
    chosen = F.broadcast(known.where(share).limit(most))
    table = (
        docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "label")
        .mapInArrow(tidy(distinct_words), "doc_id long, words array<string>, label int")
        .limit(most).toArrow()
    )
    one: dict[str, str] = {}  # equal words of the sample as one object
    rows = []
    for batch in table.to_batches(max_chunksize=64):
        for r in batch.to_pylist():
            r["words"] = [one.setdefault(w, w) for w in r["words"]]
            rows.append(r)
    del table
    rows.sort(key=lambda r: (hash_of(r["doc_id"]), r["words"]))
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    return train([(r["words"], r["label"]) for r in rows], toxic / max(1, toxic + clean))


def hash_of(n: int) -> int:
    return (n * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 61)


#: Margins of words in this Python worker, for the machine they belong to.
_CACHE: dict[int, dict[str, float]] = {}


def probabilities(texts: list[str], machine: Machine, name: int = 0) -> np.ndarray:
    """The probability of each text."""
    if name not in _CACHE:
        _CACHE.clear()
        _CACHE[name] = {}
    cache = _CACHE[name]
    facts = np.empty((len(texts), 4))
    for lo in range(0, len(texts), 256):
        found = [words_of(t) for t in texts[lo:lo + 256]]
        met = set().union(*found)
        if len(cache) > CACHE_SIZE:  # only what is at hand stays
            kept = {w: cache[w] for w in met & cache.keys()}
            cache.clear()
            cache.update(kept)
        new = list(met - cache.keys())
        cache.update(zip(new, machine.margins(new).tolist(), strict=True))
        for k, f in enumerate(found):
            facts[lo + k] = machine.facts(list(map(cache.__getitem__, f)))
    return machine.probability(facts)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    name = abs(hash((id(shared), machine.bias, *machine.evidence.tolist())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probabilities(batch.column(1).to_pylist(), shared.value, name)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        tidy(run), "doc_id long, score double, predicted int")


def remove_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` without the rows that score THRESHOLD or more, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    name = abs(hash((id(shared), machine.bias, *machine.evidence.tolist())))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            p = probabilities(texts, shared.value, name)
            yield batch.filter(pa.array(p < THRESHOLD))

    return docs.mapInArrow(tidy(run), docs.schema)
