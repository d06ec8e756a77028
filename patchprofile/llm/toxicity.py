"""Toxicity: a support vector machine over a gap-weighted subsequence string kernel, on Nyström landmarks.

The kernel counts common subsequences of three characters, each weighted by ``decay`` to the
length it spans in both words, so an insult with gaps or inserted characters stays close to
the plain one. Landmark words span the feature space; a sentence's margin is that of its worst
word, a document's that of its worst sentence, turned into a probability by a logistic fit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchprofile.llm.common import held_out

LONGEST = 16
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
#: Marks that part words beside white space.
_PARTS = ",;:()\"/|"
_SPACED = re.compile(r"(?<!\S)(?:\S ){3,}\S(?!\S)")
#: Digits and marks that stand for letters inside words.
_LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_PLAIN = re.compile(r"[^a-z]+")


@dataclass(frozen=True)
class Config:
    """``toxic_rows`` / ``clean_rows``: the bounds of the labelled sample the model is fitted on (documents of each
    label, in hash order), of at most ``text_bytes`` each; ``clean_words`` bounds their rare words. ``landmarks``: Nyström landmark words, most of them spread over
    the ``telling`` words that set toxic documents apart. ``least_odds``: log odds from which a word that
    ``least_texts`` toxic texts hold may be what makes a sentence toxic; a toxic document without such a word teaches nothing."""

    toxic_rows: int = 800
    clean_rows: int = 1600
    text_bytes: int = 32_000
    landmarks: int = 64
    telling: int = 400
    clean_words: int = 8_000
    decay: float = 0.7
    least_odds: float = 2.0
    least_texts: int = 4


def normal(word: str) -> str:
    """A word as the kernel sees it: lower case, look-alike digits as letters, letters only."""
    low = word.lower()
    if low.isalpha():
        return low
    low = "".join(low.split()).strip(".,;:!?'\"()[]")
    if low.isalpha():
        return low
    if any(c.isdigit() or c in "@$" for c in low) and any(c.isalpha() for c in low):
        low = low.translate(_LETTERS)
    return _PLAIN.sub("", low) if low.isascii() else "".join(c for c in low if c.isalpha())


def pieces(word: str) -> list[str]:
    """The word itself, or overlapping windows of a very long one."""
    return [word] if len(word) <= LONGEST else [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def words_of(text: str) -> list[str]:
    """Words between white space and parting marks; letters set apart by single spaces count as one word as well."""
    low = text.lower()
    for c in _PARTS:
        if c in low:
            low = low.replace(c, " ")
    return low.split() + ([m[0].replace(" ", "") for m in _SPACED.finditer(low)] if _may_be_spaced(low) else [])


def _may_be_spaced(text: str) -> bool:
    """Whether three spaces stand two characters apart somewhere, as they do among letters set apart by single spaces."""
    space = np.frombuffer(text.encode("latin-1", "replace"), np.uint8) == 32  # one byte a character
    return bool((space[:-4] & space[2:-2] & space[4:]).any())


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence."""
    return [w for s in _SENTENCE.split(text) if (w := words_of(s))]


#: Letters a-z, and five classes of other letters.
_SYMBOLS = 32


def _codes(words: list[str], n: int) -> np.ndarray:
    c = np.frombuffer("".join(words).encode("utf-32-le"), np.int32).reshape(len(words), n)
    return np.where((c >= 97) & (c <= 122), c - 97, 26 + c % 5)


@cache
def _triples(n: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """The places of every subsequence of three of a word of ``n`` characters, and decay ** its span."""
    at = np.array(list(combinations(range(n), 3)), np.int64).T
    return at, decay ** (at[2] - at[0] + 1).astype(np.float64)


class Landmarks:
    """Kernel values against fixed words: their weighted triples as a table by triple."""

    def __init__(self, marks: list[str], decay: float):
        self.marks, self.decay = marks, decay
        self.table = np.zeros((_SYMBOLS**3, len(marks)), np.float32)
        for k, w in enumerate(marks):
            at, weight = _triples(len(w), decay)
            np.add.at(self.table[:, k], self._ids([w], at)[0], weight)
        self.table /= np.sqrt(np.einsum("ij,ij->j", self.table, self.table, dtype=np.float64))
        self.has = self.table.any(axis=1)

    @staticmethod
    def _ids(words: list[str], at: np.ndarray) -> np.ndarray:
        c = _codes(words, len(words[0]))
        return (c[:, at[0]] * _SYMBOLS + c[:, at[1]]) * _SYMBOLS + c[:, at[2]]

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalized gap-weighted kernel, words x landmarks; 0 for a word of under three characters."""
        out = np.zeros((len(words), len(self.marks)))
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) >= 3:
                by.setdefault(len(w), []).append(i)
        for n, all_at in by.items():
            at, weight = _triples(n, self.decay)
            weight = weight.astype(np.float32)
            # triples at a time, fewer with many landmarks: each that is met takes a row of the table (some 15 MB in all)
            step = max(1, 60_000 * 64 // max(64, len(self.marks)) // len(weight))
            for k in range(0, len(all_at), step):
                part = all_at[k : k + step]
                ids = self._ids([words[i] for i in part], at)
                row, col = np.nonzero(self.has[ids])
                if not len(row):
                    continue
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                met = self.table.take(ids[row, col], axis=0)
                met *= weight.take(col)[:, None]
                top = np.add.reduceat(met, first, axis=0)
                hit = row[first]
                ids = ids[hit].astype(np.int64)
                order = np.argsort(ids, axis=1)
                key = (np.take_along_axis(ids, order, 1) + np.arange(len(hit))[:, None] * _SYMBOLS**3).ravel()
                cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                same = np.add.reduceat(weight[order].ravel(), cut)
                own = np.bincount(key[cut] // _SYMBOLS**3, same * same, len(hit))
                out[np.array(part)[hit]] = top / np.sqrt(own)[:, None]
        return out


@dataclass
class Model:
    """Scores words; those met are kept, within twice ``limit``, in two generations: what is met again moves to the young one."""

    marks: Landmarks | None
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    known: dict[str, float] = field(default_factory=dict)
    old: dict[str, float] = field(default_factory=dict)
    limit: int = 100_000

    def learn(self, words: set[str]) -> None:
        if len(self.known) > self.limit:
            self.known, self.old = {}, self.known
        new = []
        for w in words.difference(self.known):
            if (m := self.old.get(w)) is not None:
                self.known[w] = m
            else:
                new.append(w)
        for at in range(0, len(new), 20_000):
            # words of one form (marks around them, look-alike digits) have one margin
            forms = {w: normal(w) for w in new[at : at + 20_000]}
            fresh = set(forms.values()).difference(self.known)
            spelt = {f: pieces(f) for f in fresh if len(f) > LONGEST}
            flat = sorted({f for f in fresh if 3 <= len(f) <= LONGEST}.union(*spelt.values()))
            margin = dict(zip(flat, (self.marks.kernel(flat) @ self.weights + self.bias).tolist()))
            self.known.update(margin)
            self.known.update({f: max(map(margin.__getitem__, spelt[f])) if f in spelt else self.bias for f in fresh.difference(margin)})
            get = self.known.__getitem__
            self.known.update({w: get(f) for w, f in forms.items()})

    def margins(self, texts: list[str]) -> list[float]:
        """A sentence's margin is its worst word's and a text's its worst sentence's: the worst word's of the text."""
        out = []
        for at in range(0, len(texts), 256):
            split = [set(words_of(t)) for t in texts[at : at + 256]]
            self.learn(set().union(*split))
            get = self.known.__getitem__
            out += [max(map(get, s), default=self.bias) for s in split]
        return out

    def forget(self) -> None:
        self.known, self.old = {}, {}

    def scores(self, texts: list[str]) -> list[float]:
        if self.marks is None:
            return [0.0] * len(texts)
        return [1 / (1 + float(np.exp(-np.clip(self.slope * m + self.offset, -30, 30)))) for m in self.margins(texts)]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by accelerated gradient steps."""
    z = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    ridge = np.r_[np.full(x.shape[1], 1e-4), 0.0]
    lip = 2 * np.linalg.norm((z * weight[:, None]).T @ z, 2) + 1e-3
    w = prev = np.zeros(z.shape[1])
    for t in range(steps):
        v = w + t / (t + 3) * (w - prev)
        slack = np.maximum(0, 1 - y * (z @ v))
        prev, w = w, v - (ridge * v - 2 * z.T @ (weight * y * slack)) / lip
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(n * (p - y) * x).sum() + 1e-2 * a, (n * (p - y)).sum()])
        s = n * p * (1 - p) + 1e-6
        h = np.array([[(s * x * x).sum() + 1e-2, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
    return a, b


def fit_texts(toxic: list[str], clean: list[str], c: Config = Config()) -> Model:
    """Fit on labelled texts. With one label missing, every score is 0."""
    if not toxic or not clean:
        return Model(None, np.zeros(0), 0.0)
    toxic, clean = sorted(set(toxic)), sorted(set(clean))  # copies count once
    bad = [[[p for w in s for p in pieces(normal(w))] for s in sentences(t)] for t in toxic]
    in_bad = Counter(p for d in bad for p in {p for s in d for p in s} if len(p) >= 3)
    # text by text: the words of all clean ones are never held at once
    in_good = Counter(p for t in clean for p in {p for s in sentences(t) for w in s for p in pieces(normal(w))} if len(p) >= 3)
    nb, ng = len(bad), len(clean)
    odds = {p: np.log((n + 0.5) / (nb + 1)) - np.log((in_good[p] + 0.5) / (ng + 1)) for p, n in in_bad.items()}
    tell = [p for p in odds if in_bad[p] >= c.least_texts and odds[p] >= c.least_odds]
    tell = sorted(tell, key=lambda p: (-in_bad[p] * odds[p], p))[: c.telling]
    if not tell:
        return Model(None, np.zeros(0), 0.0)
    usual = [p for p, _ in sorted(in_good.items(), key=lambda x: (-x[1], x[0])) if p not in set(tell)]
    gain = np.array([in_bad[p] * odds[p] for p in tell])
    marks = _spread(tell, gain, c.landmarks * 3 // 4, c.decay)
    marks += usual[: c.landmarks - len(marks)]
    mark = Landmarks(marks, c.decay)
    own = mark.kernel(marks)
    val, vec = np.linalg.eigh((own + own.T) / 2)
    root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-2))) @ vec.T  # Nyström: K ** -1/2
    # clean words: the usual ones, and the rest in hash order up to the bound
    rest = sorted((p for p, n in in_good.items() if n < 3), key=lambda p: (xxhash.xxh64_intdigest(p), p))[: c.clean_words]
    neg = sorted((set(rest) | {p for p, n in in_good.items() if n >= 3}) - set(tell))
    # the worst word of each toxic sentence, and what one inserted character makes of it
    worst = Counter(w for d in bad for w in _worst(d, odds, set(tell)))
    pos = sorted(worst)
    spelt = [(w[:i] + x + w[i:], worst[w]) for w in pos for i in range(1, len(w)) for x in (w[i], _INSERT[(len(w) + i) % len(_INSERT)])]
    x = mark.kernel(pos + [v for v, _ in spelt] + neg) @ root
    y = np.r_[np.ones(len(pos) + len(spelt)), -np.ones(len(neg))]
    seen = np.array([1 + np.log1p(in_good[p]) for p in neg])
    w1, w2 = np.array([worst[p] for p in pos], float), np.array([n for _, n in spelt], float)
    weight = np.r_[w1 / w1.sum(), w2 / w2.sum(), 2 * seen / seen.sum()]
    weights, bias = _svm(x, y, weight)
    model = Model(mark, root @ weights, bias)
    # the variants stand for toxic texts too, with little weight: clean texts come first
    m = np.array(model.margins(toxic + clean + [v for v, _ in spelt]))
    model.slope, model.offset = _logistic(m, np.r_[np.ones(nb), np.zeros(ng), np.ones(len(spelt))], np.r_[np.ones(nb + ng), np.full(len(spelt), nb / 50 / max(1, len(spelt)))])
    model.forget()
    return model


def _spread(words: list[str], gain: np.ndarray, n: int, decay: float) -> list[str]:
    """Words of high gain that differ from each other."""
    # some words at a time: the table of all of them would be the largest thing the driver holds
    near = np.hstack([Landmarks(words[k : k + 64], decay).kernel(words) for k in range(0, len(words), 64)])
    left, out = gain.copy(), []
    for _ in range(min(n, len(words))):
        i = int(np.argmax(left))
        out.append(words[i])
        left = left * np.clip(1 - near[:, i] ** 2, 0, 1)
        left[i] = -1
    return out


#: Letters put between those of an insult when its variants are made.
_INSERT = "xeazqon"


def _worst(doc: list[list[str]], odds: dict[str, float], tell: set[str]) -> list[str]:
    """The telling word of each toxic sentence of a document."""
    return [max(t, key=lambda p: (odds[p], p)) for s in doc if (t := [p for p in s if p in tell])]


def sample(docs: DataFrame, labels: DataFrame, c: Config) -> tuple[list[str], list[str]]:
    """Texts of at most ``toxic_rows`` + ``clean_rows`` labelled documents outside the held-out fold: one text an id, none over ``text_bytes``.

    An id that is labelled both ways counts as toxic; of rows that share an id the least text stands.
    """
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic")))
    h = F.xxhash64(F.lit(7), "_id")
    ids = None
    for label, most in ((1, c.toxic_rows), (0, c.clean_rows)):
        some = rows.where(F.col("toxic") == label).orderBy(h, "_id").limit(most)
        ids = some if ids is None else ids.unionByName(some)
    # at most toxic_rows + clean_rows ids: the stated bound of the broadcast; of the collect, that many times text_bytes
    short = docs.select(F.col("doc_id").alias("_doc"), F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= c.text_bytes)
    found = short.join(F.broadcast(ids), F.col("_doc") == F.col("_id"))
    got = sorted((r.toxic, r._id, r.text) for r in found.groupBy("_id", "toxic").agg(F.min("text").alias("text")).collect())
    return [t for y, _, t in got if y == 1], [t for y, _, t in got if y == 0]


_MODELS: dict[int, Model] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row a row.

    The whole text counts. Null or empty text gets the score of a text without any word. Repeated rows and
    other columns don't matter. Map-only.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = hash((model.weights.tobytes(), model.slope, model.offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = sent.value
        m = _MODELS[key]
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                p = m.scores([x or "" for x in b.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32())],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, c: Config = Config()) -> DataFrame:
    return score(docs, fit_texts(*sample(docs, labels, c), c))


def reject(docs: DataFrame, labels: DataFrame, c: Config = Config()) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns (rows are judged one by one)."""
    model = fit_texts(*sample(docs, labels, c), c)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                p = m.scores([x or "" for x in b.column("text").to_pylist()])
                yield b.filter(pa.array([x < 0.5 for x in p]))
        m.forget()  # the worker lives on and serves other stages

    return docs.mapInArrow(run, docs.schema)
