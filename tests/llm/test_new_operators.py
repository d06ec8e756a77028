"""Source divergence, fill-in-middle and linked BPE against brute force, and their defined results for odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from patchprofile.llm import bpe, divergence, middle, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
LONG = "lorem ipsum dolor " * 30_000
ODD = [(1, "a b c d e f", "s"), (2, None, None), (3, "", "s"), (3, "", "s"), (None, "a b c d e f", "s"), (4, "  \n ", None), (5, "A B c d e f", "t"), (6, LONG, "t")]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


def odd(spark):
    """Nulls, empties, repeated rows and ids, a very long text, and columns that clash with the operators' own names."""
    rows = [(i, t, "xx", s, 0, 1, 2, "y", 9) for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, ids int, p int, term string, rank int")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


# ---- 11

def audit(rows, c):
    """Every group against every kept term, in plain Python integers."""
    rows = [(t or "", la or "", so or "") for t, la, so in rows]
    seen, own = defaultdict(Counter), defaultdict(Counter)
    for t, la, so in rows:
        words = TERM.findall(lower(t))
        own[la, so].update(words)
        seen[la].update(set(words))
    out = set()
    for la in seen:
        kept = [w for w, n in seen[la].items() if n >= c.least_docs]
        groups = sorted(s for x, s in own if x == la)
        share = lambda cnt: (lambda n: {w: 1 + c.scale * (cnt[w] + c.smooth) // (n + c.smooth * len(kept)) for w in kept})(sum(cnt[w] for w in kept))
        p = {s: share(own[la, s]) for s in groups}
        q = share(sum((own[la, s] for s in groups), Counter()))
        for s in groups:
            pair = [(sum(abs(p[s][w] - p[u][w]) for w in kept), u) for u in groups if u != s]
            term = [(p[s][w] - q[w], w) for w in kept if own[la, s][w] and p[s][w] > q[w]]
            for part, found, top in (("pair", pair, None), ("term", term, c.top)):
                for r, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:top], 1):
                    out.add((la, s, part, item, v, r))
    return out


def test_divergence_brute_force(spark):
    rng = random.Random(4)
    words = ["be", "Be", "eightlet", "eightlette", "eightletters", "é", "Éa", "straße", "x" * 40, "x" * 41, "x" * 48, "漢字", "K", "ab_cd", "p2q", "z"]
    rows = [(i, " ,\x01"[rng.randrange(3)].join(rng.choices(words, range(1, 17), k=rng.randrange(0, 30))), rng.choice(["aa", "bb", "bb", None]), rng.choice(["s1", "s2", "S3", "ß", None]))
            for i in range(400)] + [(900, "", "aa", "silent"), (901, None, "dd", "only"), (902, "be", "ee", "one"), (903, "be", "ee", "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    for c in (divergence.Config(least_docs=20, top=3), divergence.Config(least_docs=2, top=5, shard=300, cells=7), divergence.Config(least_docs=10_000)):
        got = [tuple(r) for r in divergence.divergence(df, c).collect()]
        assert len(got) == len(set(got))
        assert set(got) == audit([r[1:] for r in rows], c)


def test_divergence_odd_rows(spark):
    c = divergence.Config(least_docs=1)
    got = divergence.divergence(odd(spark), c)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == audit([(t, "xx", s) for _, t, s in ODD], c)
    assert divergence.divergence(odd(spark).limit(0), c).count() == 0


def test_sorted_words():
    rng = random.Random(1)
    words = ["".join(rng.choices("ab", k=rng.randrange(1, 30))) for _ in range(3_000)] + ["a" * 5_000, "a" * 5_000, "a" * 4_999]
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    at, size = divergence.word_starts(buf, np.zeros(1, np.int64))
    order, fresh = divergence.sort_words(np.concatenate([buf, np.zeros(8, np.uint8)]), at, size)
    got = [words[i] for i in order]
    assert got == sorted(words)
    assert fresh.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


def test_words_end_where_a_text_does():
    buf = np.frombuffer("abcdéf g".encode(), np.uint8)
    at, size = divergence.word_starts(buf, np.array([0, 2, 2, 4], np.int64))
    assert [bytes(buf[a : a + s]).decode() for a, s in zip(at, size)] == ["ab", "cd", "éf", "g"]


# ---- 12

def fim(text, doc_id):
    """The contract, on a list of units."""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    return (n, "spm", len(a), len(b), f"<S>{s}<P>{a}<M>{b}") if h4 % 100 < 20 else (n, "psm", len(a), len(b), f"<P>{a}<S>{s}<M>{b}")


def test_middle_brute_force(spark):
    rng = random.Random(2)
    alphabet = ["a", "Bc", "wörd", "é", "漢", "🙂", " ", "\n", "\r\n", "<", "<P", ">", "M>", "<M", "0", "\x00", "́"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randrange(0, 60)))) for i in range(600)] + [(i, "x<P>y") for i in (7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (1, 7, 1024):
        got = middle.restore(middle.fill_in_middle(df, middle.Config(block=block))).collect()
        assert sorted(got, key=str) == sorted(got, key=str) and len(got) == len(rows)
        assert Counter(tuple(r) for r in got) == Counter((i, *fim(t, i), t) for i, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_middle_odd_rows(spark):
    got = middle.restore(middle.fill_in_middle(odd(spark)))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "text"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, *fim(t or "", i), t or "") for i, t, _ in ODD)
    assert middle.fill_in_middle(odd(spark).limit(0)).count() == 0


def test_fenwick_descent():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 8, 9, 100):
        counts = rng.integers(0, 4, n)
        tree = middle.Fenwick(counts)
        assert [tree.before(k) for k in range(n + 1)] == [0, *np.cumsum(counts)]
        for rank in range(int(counts.sum())):
            blocks, before = tree.descend(rank)
            assert before == counts[:blocks].sum() and before <= rank < before + counts[blocks]


# ---- 13

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))


def expected(tokenizer, doc_id, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return doc_id, ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_query_equals_the_library(spark, tokenizer):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {tuple(r) for r in queries.op13_linked_bpe(spark, SF).collect()}
    want = set()
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        i, ids, text = expected(tokenizer, d.doc_id, d.text)
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(text)))
    assert got == want


def test_bpe_fuzz(tokenizer):
    rng = random.Random(5)
    parts = ["a", "th", "ing", "'s", "'LL", "é", "É", "İ", "ſ", "ß", "ẞ", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", "​", "́", "ͅ", "漢", "🙂", "1", "²", "Ⅷ",
             "<|endoftext|>", "<|startoftext|>", "<|", "|>", "...", "!?", "\x00", "﻿", "Σ", "ς", "क़", "ﬁ", "K", "Å", "　", "_", "-"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 15))) for _ in range(8_000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FFF), rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(rng.randrange(12))) for _ in range(4_000)]
    texts += ["".join(rng.choices("abcdefghij", k=50_000)), "x" * 20_000, "ab " * 30_000]
    c = bpe.Codec(queries.tokenizer_path("word_bpe_49k.json"), limit=500)  # so small that the kept words are dropped many times
    for at in range(0, len(texts), 97):
        some = texts[at : at + 97]
        for text, got in zip(some, c.encode(pa.array(some)).to_pylist(), strict=True):
            _, ids, back = expected(tokenizer, 0, text)
            assert got == ids
            assert c.decode(pa.array([ids], pa.list_(pa.int32()))).to_pylist() == [back]


def test_merge_queue_against_rescanning():
    """The heap gives what joining the best pair, found anew each time, gives; ties go to the left."""
    rng = random.Random(6)
    for _ in range(30):
        vocab = {s: i for i, s in enumerate(["a", "b", "c", "a</w>", "b</w>", "c</w>"])}
        merges = []
        while len(merges) < 12:
            left, right = rng.choice([s for s in vocab if not s.endswith("</w>")]), rng.choice(list(vocab))
            if [left, right] not in merges:
                merges.append([left, right])
                vocab.setdefault(left + right, len(vocab))
        m = bpe.Merges({"type": "BPE", "vocab": vocab, "merges": merges, "end_of_word_suffix": "</w>"})
        for _ in range(40):
            word = "".join(rng.choices("abcd", k=rng.randrange(0, 14)))
            sym = [s for s in [*word[:-1], *([word[-1] + "</w>"] if word else [])] if s in vocab]
            while found := [(merges.index([x, y]), i) for i, (x, y) in enumerate(zip(sym, sym[1:])) if [x, y] in merges]:
                i = min(found)[1]
                sym[i : i + 2] = [sym[i] + sym[i + 1]]
            assert m.encode(word) == [vocab[s] for s in sym]


def test_bpe_odd_rows(spark, tokenizer):
    path = queries.tokenizer_path("word_bpe_49k.json")
    got = bpe.decode(bpe.encode(odd(spark), path), path)
    assert got.columns == ["doc_id", "ids", "text"]
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in got.collect()) == Counter((i, tuple(ids), s) for i, ids, s in (expected(tokenizer, i, t) for i, t, _ in ODD))
    assert bpe.encode(odd(spark).limit(0), path).count() == 0


def test_unsupported_tokenizers_raise():
    with pytest.raises(ValueError):
        bpe.Merges({"type": "BPE", "vocab": {}, "merges": [], "byte_fallback": True})
    with pytest.raises(ValueError):
        bpe.Codec(queries.tokenizer_path())  # it names a decoder


# ---- 1: the encoder that cuts texts in Arrow

def test_cut_texts_encode_like_whole_ones():
    from patchprofile.llm import token_output

    rng = random.Random(9)
    parts = ["a", "b", "th", "ing", "'s", "don't", "é", "É", "İ", " ", " ", " ", "\n", "  ", "\t", "\r", "\x1c", "\x85", "\xa0", "​", "́", "漢", "🙂", "1", "²", "<|endoftext|>", "...", "!?", "\x00", "\x01", "_", "1,234"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 15))) for _ in range(6_000)]
    texts += ["".join(rng.choices(["ab", " ", "\n", ".", ",", "é", " cd"], k=rng.randrange(0, 20))) for _ in range(3_000)]
    e = token_output.Encoder(queries.tokenizer_path(), limit=100)
    for at in range(0, len(texts), 211):
        some = texts[at : at + 211]
        assert e.many(pa.array(some)).to_pylist() == [e.tok.encode(t, add_special_tokens=False).ids for t in some]
