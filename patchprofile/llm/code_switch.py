"""Language of words in code-switched text by a linear-chain conditional random field.

Word features: prefixes, suffixes, character n-grams and lexicon membership; transitions between
languages are learned with them. Words are labelled by forward-backward; a document's language is
the one with the largest expected share of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from patchprofile.llm.common import held_out

_WORD = re.compile(r"[^\W\d_]+")
UND = "und"


@dataclass(frozen=True)
class Config:
    """``docs``: documents per language in the labelled sample (hash order), of at most ``text_bytes`` each; ``words``: at most so many
    words of the sample per language enter the fit, ``lexicon``: most usual words per language. ``span``: words that are walked
    one by one; the spans of a longer text are walked side by side, joined by their transfer matrices (the result is the whole chain's)."""

    docs: int = 300
    text_bytes: int = 32_000
    words: int = 20_000
    lexicon: int = 500
    span: int = 512
    steps: int = 40
    rate: float = 0.5


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str, lexicons: dict[str, int]) -> list[str]:
    out = ["*"]
    for k in (1, 2, 3, 4):
        if len(word) >= k:
            out += (f"p{word[:k]}", f"s{word[-k:]}")
    out += [f"g{word[i : i + 2]}" for i in range(len(word) - 1)]
    out += [f"g{word[i : i + 3]}" for i in range(len(word) - 2)]
    if word in lexicons:
        out += [f"l{i}" for i in range(lexicons[word].bit_length()) if lexicons[word] >> i & 1]
        out.append(f"w{word}")
    return out


@dataclass
class Model:
    langs: list[str]
    index: dict[str, int]
    weights: np.ndarray  # features x langs
    moves: np.ndarray  # log transition scores
    lexicons: dict[str, int]
    span: int
    known: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)
    limit: int = 200_000

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp of the words' scores, scaled to a largest of 1."""
        if len(self.rows) > self.limit:
            self.known.clear()
            self.rows.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            at = [[i for x in features(w, self.lexicons) if (i := self.index.get(x)) is not None] for w in new]
            cut = np.cumsum([0, *map(len, at)])
            got = np.add.reduceat(self.weights[[i for a in at for i in a]], cut[:-1], axis=0)
            got = np.exp(got - got.max(axis=1, keepdims=True))
            for w, r in zip(new, got):
                self.known[w] = len(self.rows)
                self.rows.append(r)
            self._table = None
        if getattr(self, "_table", None) is None:
            self._table = np.array(self.rows)
        return self._table[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def posteriors(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Per document: words x langs, the probability of each label."""
        n = [len(d) for d in docs]
        if not sum(n):
            return [np.zeros((0, len(self.langs))) for _ in docs]
        e = self.emissions([w for d in docs for w in d])
        begin = np.cumsum([0, *n])
        spans = [(b + i, min(self.span, m - i), i == 0) for b, m in zip(begin[:-1].tolist(), n) for i in range(0, m, self.span)]
        starts, sizes, first = (np.array(x) for x in zip(*spans))
        order = np.argsort(-sizes, kind="stable")
        moves = np.exp(self.moves - self.moves.max())
        enter, leave = _joints(e, starts, sizes, first.astype(bool), moves)
        forward, backward = forward_backward(e, starts[order], sizes[order], moves, enter[order], leave[order])
        out = forward * backward
        out /= out.sum(axis=1, keepdims=True)
        return [out[a:b] for a, b in zip(begin[:-1], begin[1:])]


def _joints(e: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What enters each span of a chain from the words before it (ones where a chain begins), and what its last word takes from the words behind it."""
    m = e.shape[1]
    enter, leave = np.ones((len(starts), m)), np.ones((len(starts), m))
    more = np.flatnonzero(~first)
    if not len(more):
        return enter, leave
    # spans of chains that have several: the matrix that carries a state over all of a span's words
    many = np.unique(np.r_[more, more - 1])
    many = many[np.argsort(-sizes[many], kind="stable")]
    live = np.searchsorted(-sizes[many], -np.arange(1, int(sizes[many[0]]) + 1), side="right")
    over = np.where(first[many][:, None, None], np.eye(m), moves) * e[starts[many]][:, None, :]
    for t in range(1, len(live)):
        k = live[t]
        x = (over[:k] @ moves) * e[starts[many[:k]] + t][:, None, :]
        over[:k] = x / x.max(axis=(1, 2), keepdims=True)
    carry = dict(zip(many.tolist(), over))
    for i in more.tolist():
        v = (np.ones(m) if first[i - 1] else enter_raw) @ carry[i - 1]
        enter_raw = v / v.sum()
        enter[i] = enter_raw @ moves
    for i in more[::-1].tolist():
        z = carry[i] @ leave[i]
        leave[i - 1] = z / z.sum()
    return enter, leave


def forward_backward(e: np.ndarray, starts: np.ndarray, sizes: np.ndarray, moves: np.ndarray,
                     enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward values of chains [start, start + size) of ``e``; ``sizes`` falls. ``enter`` weighs the labels of each
    chain's first word, ``leave`` those of its last (ones: a chain that stands alone)."""
    f, b = np.empty_like(e), np.empty_like(e)
    longest = int(sizes[0])
    live = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # chains with at least t words
    a = None
    for t in range(longest):
        at = starts[: live[t]] + t
        a = (e[at] if enter is None else enter * e[at]) if a is None else (a[: live[t]] @ moves) * e[at]
        a = a / a.sum(axis=1, keepdims=True)
        f[at] = a
    z = None
    for t in range(longest - 1, -1, -1):
        at = starts[: live[t]] + t
        last = np.ones((live[t], e.shape[1])) if leave is None else leave[: live[t]].copy()
        if z is not None:
            last[: len(z)] = z
        b[at] = last
        z = (last * e[at]) @ moves.T
        z = z / z.sum(axis=1, keepdims=True)
    return f, b


def fit_texts(texts: dict[str, list[str]], c: Config = Config()) -> Model:
    """Fit on texts by language. Training chains join runs of words of different languages, so moves between languages
    are learned; the chance of a move is that of such runs."""
    langs = sorted(texts)
    rng = np.random.default_rng(5)
    by = {}
    for lang in langs:
        docs = [words_of(t) for t in sorted(set(texts[lang]))]
        by[lang] = [d for d in docs if d]
    langs = [x for x in langs if by[x]]
    if not langs:
        return Model([], {}, np.zeros((0, 0)), np.zeros((0, 0)), {}, c.span)
    lexicons: dict[str, int] = {}
    for k, lang in enumerate(langs):
        for w, _ in Counter(w for d in by[lang] for w in d).most_common(c.lexicon):
            lexicons[w] = lexicons.get(w, 0) | 1 << k
    runs: list[tuple[int, list[str]]] = []
    for k, lang in enumerate(langs):
        flat = [w for d in by[lang] for w in d]
        cuts, at = [], 0
        while at < len(flat):
            size = int(rng.integers(4, 24))
            cuts.append(flat[at : at + size])
            at += size
        order = rng.permutation(len(cuts))
        got = 0
        for i in order:
            if got >= c.words:
                break
            runs.append((k, cuts[i]))
            got += len(cuts[i])
    chains, current = [], []
    for i in rng.permutation(len(runs)):
        current.append(runs[i])
        if sum(len(r[1]) for r in current) >= 40:
            chains.append(current)
            current = []
    if current:
        chains.append(current)
    chains.sort(key=lambda x: -sum(len(r[1]) for r in x))
    words = [w for ch in chains for _, r in ch for w in r]
    gold = np.array([k for ch in chains for k, r in ch for _ in r])
    sizes = np.array([sum(len(r[1]) for r in ch) for ch in chains])
    starts = np.cumsum(sizes) - sizes
    every = list(dict.fromkeys(words))
    place = {w: i for i, w in enumerate(every)}
    word = np.array([place[w] for w in words])
    feats = [features(w, lexicons) for w in every]
    seen = Counter(x for f in feats for x in set(f))
    index = {x: i for i, x in enumerate(sorted(x for x, n in seen.items() if n > 1))}
    at = [[index[x] for x in f if x in index] or [index["*"]] for f in feats] if "*" in index else [[0] for _ in feats]
    if "*" not in index:
        index = {"*": 0}
    flat = np.array([i for a in at for i in a])
    cut = np.cumsum([0, *map(len, at)])[:-1]
    owner = np.repeat(np.arange(len(at)), [len(a) for a in at])
    m = len(langs)
    w, moves = np.zeros((len(index), m)), np.zeros((m, m))
    gw, gm = np.full(w.shape, 1e-6), np.full(moves.shape, 1e-6)
    inner = np.ones(len(words), bool)
    inner[starts] = False
    second = np.flatnonzero(inner)
    truth = np.zeros((len(words), m))
    truth[np.arange(len(words)), gold] = 1
    moved = np.zeros((m, m))
    np.add.at(moved, (gold[second - 1], gold[second]), 1)
    for _ in range(c.steps):
        s = np.add.reduceat(w[flat], cut, axis=0)
        e = np.exp(s - s.max(axis=1, keepdims=True))[word]
        t = np.exp(moves - moves.max())
        f, b = forward_backward(e, starts, sizes, t)
        p = f * b
        p /= p.sum(axis=1, keepdims=True)
        pair = f[second - 1][:, :, None] * t[None] * (e[second] * b[second])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        d = np.zeros((len(every), m))
        np.add.at(d, word, truth - p)
        g = np.zeros_like(w)
        np.add.at(g, flat, d[owner])
        g = g / len(words) - 1e-6 * w
        h = (moved - pair.sum(axis=0)) / len(words) - 1e-5 * moves
        gw += g * g
        gm += h * h
        w += c.rate * g / np.sqrt(gw)
        moves += c.rate * h / np.sqrt(gm)
    return Model(langs, index, w, moves, lexicons, c.span)


def fit(docs: DataFrame, c: Config = Config()) -> Model:
    """Fit on at most ``c.docs`` documents per language, one text an id, none over ``c.text_bytes``, from the held-out fold or without ``lang``."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    w = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id")
    # the top rows of each language are cut down in every task before they meet
    top = rows.select("doc_id", "lang").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= c.docs)
    ids = top.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    short = docs.select("doc_id", "lang", "text").where(F.octet_length("text") <= c.text_bytes)
    found = short.join(F.broadcast(ids), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    got = found.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()  # at most c.docs a language, c.text_bytes each
    texts: dict[str, list[str]] = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.text or "")):
        texts.setdefault(r.lang, []).append(r.text or "")
    return fit_texts(texts, c)


_MODELS: dict[int, Model] = {}


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: the language with the largest expected share of the words, and that share.

    ``und`` with score 0 for null texts, texts without a letter, or a model without languages. Every
    word of the whole text counts; repeated rows and other columns don't matter. Ties go to the
    first language in code-point order. Map-only.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = hash((tuple(model.langs), model.weights.tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = sent.value
        m = _MODELS[key]
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                lang, score = [], []
                words = [words_of(x or "") if m.langs else [] for x in b.column("text").to_pylist()]
                for p in m.posteriors(words):
                    share = p.mean(axis=0) if len(p) else None
                    k = None if share is None else int(np.argmax(share))
                    lang.append(UND if k is None else m.langs[k])
                    score.append(0.0 if k is None else min(1.0, float(share[k])))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def label(text: str | None, model: Model) -> list[tuple[str, str, float]]:
    """(word, language, probability) for every word of a text."""
    words = words_of(text or "")
    if not words or not model.langs:
        return []
    p = model.posteriors([words])[0]
    return [(w, model.langs[int(k)], float(r[k])) for w, r, k in zip(words, p, p.argmax(axis=1))]
