"""Personal data in whole texts: generators, boosted trees, calibrated thresholds.

Base spans (email, ip, card, phone) follow fixed patterns and tests and always count. Beyond them
high-recall generators propose overlapping spans: addresses written with "at" and "dot" in
brackets or words, numbers with other prefixes or separators, and quads with other signs. Boosted
trees rate each proposal by format and context; a kind's proposals count from the calibrated
probability that reached PRECISION on held-out candidates. Of overlapping proposals the likelier
stays (ties: leftmost, longest), and none may touch a base span.

The trees learn from the candidates of all whole texts, which are counted by kind, label, fold and
features where they lie. Trees grow level by level from sums over these counts, and thresholds come from
counts of margins, so only sums reach the driver; up to FIT_ROWS counts it adds up itself, with the same
result. ``fit`` takes a list of texts, and of it a bounded hash sample of candidates. Base
spans, and rewritten forms of them put in the same place, are right; rewritten forms that break
the tests (a wrong check digit, a part over 255, too few digits) and all other proposals are
wrong. No labels are needed.

Defined results: null text is empty: no spans; texts without base spans give trees that
accept nothing, so only base spans count; repeated rows give repeated rows and are learned from as often; an empty table gives
an empty result; further columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek.llm import boosting
from kartotek.llm.memory import tidy
from kartotek.llm.store import written

#: Candidates that ``fit`` keeps of its list at most, and different ones whose sums the driver adds up itself.
FIT_CANDIDATES, FIT_ROWS = 40_000, 50_000
#: Candidates as which each kind and label weighs in the trees at most.
EVEN = 1600
#: Different candidates that a task counts before it passes them on.
COUNTED = 20_000
#: Folds (for trees, calibration, thresholds) by passages of so many characters, and slices of the hashes.
FOLDS, PASSAGE, SLICES = 3, 4096, 32
PRECISION = 0.99
CONTEXT = 24

KINDS = ("email", "ip", "card", "phone")

# The base patterns. That of an email is cut at its @ and that of an ip starts at a run of
# digits, so that a long run is read once and not again from each of its characters.
_NAME_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
BASE = {
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_AT = r"(?:@|\x20?[\[(]\x20?(?:at|@)\x20?[\])]\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20?[\[(]\x20?(?:dot|\.)\x20?[\])]\x20?|\x20dot\x20)"
PROPOSED = {
    "email": re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,4}(?:\x20?[.:_-]\x20?[0-9]{1,4}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){11,19}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00|\()?\x20?[0-9](?:[\x20().0-9/-]){5,24}[0-9](?![0-9])"),
}
_OBFUSCATED = re.compile(r"[\[(]\x20?(?:at|@)\x20?[\])]|\x20at\x20\S+\x20dot\x20|[\[(]\x20?dot\x20?[\])]")
_DIGIT = re.compile("[0-9]")

# Words that announce personal data, in the languages of common corpora.
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "kontakt", "correo", "courriel", "write", "adresse"),
    "ip": ("ip", "host", "server", "address", "login", "client"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "pay"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "telefon", "téléphone", "teléfono", "number"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def passes(kind: str, span: str) -> bool:
    """The test of a base match."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in span.split("."))
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each base match of an email. What stands before an @ reaches back to the last @ or
    match at most, so all of it is read once."""
    low = 0
    at = text.find("@")
    while at >= 0:
        name = text[low:at]
        length = len(name) - len(name.rstrip(_NAME_SIGNS))
        host = _HOST.match(text, at + 1) if length else None
        if host:
            yield at - length, host.end()
        low = host.end() if host else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = []
    found += [("email", s, e) for s, e in emails(text)]
    for kind in KINDS[1:] if _DIGIT.search(text) else ():
        if kind == "phone" and "+" not in text:
            continue
        found += [(kind, m.start(), m.end()) for m in BASE[kind].finditer(text) if passes(kind, m[0])]
    return found


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Overlapping candidates of all kinds."""
    found = []
    if "@" in text or _OBFUSCATED.search(text):
        found += [("email", m.start(), m.end()) for m in PROPOSED["email"].finditer(text)]
    if _DIGIT.search(text):
        for kind in KINDS[1:]:
            found += [(kind, m.start(), m.end()) for m in PROPOSED[kind].finditer(text)]
    return found


def _coarse(v: int) -> float:
    """The 8 highest bits, so that a feature has a bounded number of values."""
    low = v.bit_length() - 8
    return float(v >> low << low)


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    span = text[start:end]
    digits = "".join(c for c in span if c in "0123456789")
    groups = [g for g in re.split(r"[^0-9]+", span) if g]
    before, after = text[max(0, start - CONTEXT):start].lower(), text[end:end + CONTEXT].lower()
    octets = len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups)
    signs = [c for c in span if not c.isalnum()]
    found = [
        float(KINDS.index(kind)), len(span), len(digits), sum(c.isalpha() for c in span), len(signs),
        len(set(signs)), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(span.startswith("+")), float(span.startswith("00")), float("(" in span), float("@" in span),
        float(bool(_OBFUSCATED.search(span))), float(luhn(digits)) if len(digits) > 11 else -1.0, float(octets),
        len(set(digits)), float(any(c in before for c in CUES[kind])),
        float(any(c in before + after for k in KINDS if k != kind for c in CUES[k])),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float("." in signs), float(" " in signs),
        float("-" in signs), float("/" in signs), float(":" in signs),
        len(re.split(r"\.|dot", span)[-1].strip(" )]")) if kind == "email" else -1.0,
    ]
    return [v if v < 256 else _coarse(int(v)) for v in found]


def _rewritten(kind: str, span: str, rng: random.Random) -> list[tuple[str, bool]]:
    """Other ways to write a base span, and broken ones."""
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "email":
        name, _, host = span.partition("@")
        at, dot = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), ("[at]", "[dot]")])
        return [(name + at + host.replace(".", dot), True), (f"{name} at {host.split('.')[0]}", False)]
    if kind == "ip":
        parts = digits and span.split(".")
        return [(rng.choice([" . ", ". "]).join(parts), True), (".".join([str(int(parts[0]) + 256), *parts[1:]]), False),
                (":".join(parts), False), ("-".join(parts), False)]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
        cut = lambda d, s: s.join(d[k:k + 4] for k in range(0, len(d), 4))
        sign = rng.choice([".", "_", "/", "  "])
        return [(cut(digits, sign), True), (cut(wrong, sign), False), (wrong, False), (cut(wrong, " "), False)]
    tail = span.lstrip("+")
    return [("00" + tail, True), ("00 " + tail, True), (digits[:6], False), (digits, False),
            (f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", False), (f"{digits[:4]}/{digits[4:8]}", False)]


@dataclass
class Model:
    trees: boosting.Trees
    cuts: dict[str, float]


#: Candidates kept of each kind, label, fold and slice.
KEPT = FIT_CANDIDATES // (len(KINDS) * 2 * FOLDS * SLICES)

class Kept:
    """Of each slice and group the KEPT candidates with the smallest hashes; equal ones count once."""

    def __init__(self):
        self.heaps: dict[tuple[int, int], list[tuple[int, list[float]]]] = {}
        self.names: set[tuple[int, int]] = set()

    def wants(self, group: int, name: int) -> bool:
        heap = self.heaps.get((name % SLICES, group), ())
        return (len(heap) < KEPT or name < -heap[0][0]) and (group, name) not in self.names

    def add(self, group: int, name: int, x: list[float]) -> None:
        heap = self.heaps.setdefault((name % SLICES, group), [])
        self.names.add((group, name))
        heapq.heappush(heap, (-name, x))
        if len(heap) > KEPT:
            self.names.discard((group, -heapq.heappop(heap)[0]))

    def rows(self) -> list[tuple[int, int, int, list[float]]]:
        """(slice, group, name, features) by slice, group and name."""
        return sorted((s, g, -n, x) for (s, g), heap in self.heaps.items() for n, x in heap)


def _outside(spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Those of ``spans`` that touch no base span."""
    starts, ends = [], []
    for s, e in sorted((s, e) for _, s, e in base):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = []
    for span in spans:
        at = bisect_left(starts, span[2]) - 1
        if at < 0 or ends[at] <= span[1]:
            out.append(span)
    return out


def offer(kept: Kept, text: str) -> None:
    """All candidates of a text to ``kept``."""
    digest = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()
    rng = random.Random(digest)
    number = 0

    def add(kind, around, start, end, right, fold):
        nonlocal number
        number += 1
        name = int.from_bytes(hashlib.blake2b(digest + number.to_bytes(8, "big"), digest_size=8).digest(), "big") >> 1
        group = (KINDS.index(kind) * 2 + right) * FOLDS + fold
        if kept.wants(group, name):
            kept.add(group, name, features(kind, around, start, end))

    def fold_of(start):
        return hashlib.md5(digest + (start // PASSAGE).to_bytes(8, "big")).digest()[0] % FOLDS

    base = base_spans(text)
    for kind, start, end in base:
        fold = fold_of(start)
        add(kind, text, start, end, 1, fold)
        for span, right in _rewritten(kind, text[start:end], rng):
            changed = text[max(0, start - 60):start] + span + text[end:end + 60]
            at = min(60, start)
            for k, s, e in proposals(changed):
                if s < at + len(span) and at < e:
                    add(k, changed, s, e, int(right and k == kind and (s, e) == (at, at + len(span))), fold)
    for kind, start, end in _outside(proposals(text), base):
        add(kind, text, start, end, 0, fold_of(start))


def fit(texts: list[str]) -> Model:
    """Trees and thresholds from a bounded list of texts."""
    kept = Kept()
    for text in texts:
        offer(kept, text)
    return trained(kept.rows())


def trained(rows: list[tuple[int, int, int, list[float]]]) -> Model:
    """Trees and thresholds from the kept candidates."""
    cuts = dict.fromkeys(KINDS, 2.0)
    if not rows:
        return Model(boosting.Trees(0), cuts)
    sizes: dict[tuple[int, int], int] = {}
    most: dict[tuple[int, int], int] = {}
    for s, g, name, _ in rows:
        sizes[s, g] = sizes.get((s, g), 0) + 1
        most[s, g] = max(most.get((s, g), 0), name)
    # a full slice of a group stands for as many as its largest hash tells
    stands = {k: max(1.0, (n - 1) / n * 2.0 ** 63 / (most[k] + 1)) if n == KEPT else 1.0 for k, n in sizes.items()}
    weight = np.array([stands[s, g] for s, g, _, _ in rows])
    group = np.array([g for _, g, _, _ in rows])
    x = np.array([f for _, _, _, f in rows], float)
    y, fold = group // FOLDS % 2, group % FOLDS
    trees = boosting.fit(x[fold == 0], y[fold == 0])
    if any(y[fold == 0]):
        boosting.calibrate(trees, x[fold == 1], y[fold == 1], weight=weight[fold == 1])
        for k, kind in enumerate(KINDS):
            held = (fold == 2) & (x[:, 0] == k)
            cuts[kind] = max(0.5, boosting.threshold(
                trees.probability(x[held]), y[held], PRECISION, weight[held])) if held.any() else 2.0
    return Model(trees, cuts)


def added_spans(text: str, base: list[tuple[str, int, int]], model: Model) -> list[tuple[str, int, int]]:
    free = _outside(proposals(text), base)
    if not free:
        return []
    p = model.trees.probability(np.array([features(k, text, s, e) for k, s, e in free], float))
    good = [(-q, s, -e, k) for q, (k, s, e) in zip(p.tolist(), free, strict=True) if q >= model.cuts[k]]
    kept: list[tuple[int, int, str]] = []  # by place, none touching another
    for _, s, e, k in sorted(good):
        at = bisect_left(kept, (-e,))
        if not at or kept[at - 1][1] <= s:
            kept.insert(at, (s, -e, k))
    return [(k, s, e) for s, e, k in kept]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


class Counts:
    """Candidates of texts, counted by group, which is (kind, label, fold) as one number, and features."""

    def __init__(self):
        self.found: dict[tuple[int, bytes], int] = {}

    def wants(self, group: int, name: int) -> bool:
        return True

    def add(self, group: int, name: int, x: list[float]) -> None:
        key = group, np.array(x, np.int32).tobytes()
        self.found[key] = self.found.get(key, 0) + 1

    def taken(self) -> pa.RecordBatch:
        columns = [[g for g, _ in self.found], [x for _, x in self.found], list(self.found.values())]
        self.found = {}
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.int64()), strict=True)], ["grp", "x", "n"])


def counted(docs: DataFrame) -> DataFrame:
    """grp, x (features as 32-bit integers), n of the candidates of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                offer(counts, text)
                if len(counts.found) > COUNTED:
                    yield counts.taken()
        yield counts.taken()

    text = F.col("text")
    able = docs.where(text.rlike("[0-9@]") | text.rlike(_OBFUSCATED.pattern))  # no other text has candidates
    return able.select("text").mapInArrow(tidy(count), "grp int, x binary, n long").groupBy("grp", "x").agg(F.sum("n").alias("n"))


#: From groups, features and numbers of some candidates: keys, and two sums for each.
_Sums = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _arrays(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.int32).reshape(max(1, rows.num_rows), -1)[:rows.num_rows]
    return rows.column("grp").to_numpy().astype(np.int64), x.astype(float), rows.column("n").to_numpy()


def summed(candidates: DataFrame, most: int) -> Callable[[_Sums], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What adds up a function of ``candidates`` by key over all of them: on Spark, if they are more than ``most``."""

    def here(rows: pa.Table):
        block = _arrays(rows)

        def add_up(f: _Sums):
            return f(*block)

        return add_up

    def on_spark(f: _Sums):
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in f(*_arrays(batch))], ["k", "a", "b"])

        rows = (
            candidates.mapInArrow(tidy(part), "k long, a long, b long")
            .groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow().sort_by("k")
        )
        return tuple(rows.column(c).to_numpy() for c in ("k", "a", "b"))

    return here(candidates.toArrow()) if candidates.count() <= most else on_spark


def _by_key(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, a, len(found)).astype(np.int64), np.bincount(at, b, len(found)).astype(np.int64)


def learn(docs: DataFrame) -> Model:
    """The model from the candidates of all texts."""
    total = summed(written(counted(docs), "candidates"), FIT_ROWS)

    groups, sizes, _ = total(lambda group, x, n: _by_key(group, n, 0 * n))
    here = groups % FOLDS == 0
    if not here.any():
        return Model(boosting.Trees(0), dict.fromkeys(KINDS, 2.0))
    # kinds and labels with many candidates do not drown the others
    weight = np.zeros(2 * len(KINDS))
    weight[groups[here] // FOLDS] = np.minimum(1, EVEN / sizes[here])
    ones, zeros = (float((sizes * weight[groups // FOLDS])[here & (groups // FOLDS % 2 == y)].sum()) for y in (1, 0))

    def values(group, x, n):
        mine = group % FOLDS == 0
        x, n = x[mine], np.rint(weight[group[mine] // FOLDS] * boosting.UNIT) * n[mine]
        key = (np.arange(x.shape[1]) << 40) + x.astype(np.int64) + 1  # the least value is -1
        n = np.repeat(n, x.shape[1])
        return _by_key(key.ravel(), n, 0 * n)

    keys, reached, _ = total(values)
    column, value = keys >> 40, (keys & ((1 << 40) - 1)) - 1
    width = int(column[-1]) + 1
    edges = [boosting.quantiles(value[column == j], reached[column == j]) for j in range(width)]
    bins = max(map(len, edges)) + 1

    def grown(model, feature, cut, level):
        def cells(group, x, n):
            mine = group % FOLDS == 0
            group = group[mine] // FOLDS
            g, h = boosting.cells(model, feature, cut, level, edges, x[mine], group % 2, n[mine], weight[group])
            used = np.flatnonzero((g != 0) | (h != 0))
            return used, g.ravel()[used], h.ravel()[used]

        at, g, h = total(cells)
        out = np.zeros((2, 2 ** level * width * bins), np.int64)
        out[:, at] = g, h
        return out.reshape(2, 2 ** level, width, bins)

    trees = boosting.grow(grown, edges, ones, zeros)

    def margins(group, x, n):
        mine = group % FOLDS > 0
        group, n = group[mine], n[mine]
        step = np.rint(trees.margin(x[mine]) * boosting.LEAF).astype(np.int64)  # exact: leaves are such parts
        y = group // FOLDS % 2
        return _by_key(((group % FOLDS * len(KINDS) + group // FOLDS // 2) << 40) + step + (1 << 39), n * y, n * (1 - y))

    keys, ones, zeros = total(margins)
    margin = ((keys & ((1 << 40) - 1)) - (1 << 39)) / boosting.LEAF
    fold, kind = keys >> 40 >> 2, (keys >> 40) & (len(KINDS) - 1)
    return _judged(trees, np.tile(fold, 2), np.tile(kind, 2), np.tile(margin, 2),
                   np.repeat([1, 0], len(keys)), np.concatenate([ones, zeros]))


def _judged(trees: boosting.Trees, fold, kind, margin, y, n) -> Model:
    """The trees calibrated on fold 1, with thresholds from fold 2, of margins that stand for ``n`` candidates each."""
    cuts = dict.fromkeys(KINDS, 2.0)
    fold, kind, margin, y, n = (c[n > 0] for c in (fold, kind, margin, y, n))
    if trees.features or trees.start > 0:  # some are right
        one = fold == 1
        boosting.platt(trees, margin[one], y[one], weight=n[one].astype(float))
        for k, name in enumerate(KINDS):
            held = (fold == 2) & (kind == k)
            if held.any():
                p = boosting.sigmoid(trees.slope * margin[held] + trees.offset)
                cuts[name] = max(0.5, boosting.threshold(p, y[held], PRECISION, n[held].astype(float)))
    return Model(trees, cuts)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end), n_base of each row: base spans first."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            all_spans, counts = [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                more = added_spans(text, base, model.value)
                counts.append(len(base))
                all_spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in base + more])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(all_spans, pa.list_(kind)), pa.array(counts, pa.int32())],
                ["doc_id", "spans", "n_base"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        tidy(run), "doc_id long, spans array<struct<kind:string,start:int,end:int>>, n_base int")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span (or union of touching ones) as its first kind in brackets."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans of the column text replaced, in all its rows and columns."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                if text:
                    base = base_spans(text)
                    text = redacted(text, base + added_spans(text, base, model.value))
                texts.append(text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(tidy(run), docs.schema)
