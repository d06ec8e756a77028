"""What a task holds and hands on at once stays bounded."""

import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from patchprofile.llm import divergence, queries, token_output, toxicity

ROOT = Path(__file__).parents[2]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


# ---- 11

def test_a_shard_of_text_is_sorted_in_little_memory():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 12))) for _ in range(60_000)]
    size = divergence.Config().shard
    texts = [" ".join(rng.choices(words, k=300)).encode() for _ in range(size // 2_300)]
    pair = pa.StructArray.from_arrays([pa.array(["en"] * len(texts)), pa.array([f"s{i % 3}" for i in range(len(texts))])], ["lang", "source"])
    tracemalloc.start()
    found = list(divergence._shard(pa.array(texts, pa.binary()), pair, size))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sum(b["n"].to_pylist()) for b in found) == 300 * len(texts)
    assert peak < 60 << 20


def test_terms_handed_on_in_slices_are_all_there(spark):
    text = " ".join(f"w{'abcdefghij'[i % 10] * (i // 10 % 40 + 1)}{chr(97 + i // 400)}" for i in range(2_000))
    docs = spark.createDataFrame([(i, text, "en", "web") for i in range(30)], "doc_id long, text string, lang string, source string").coalesce(1)
    c = divergence.Config(rows=64)
    assert divergence.shards(docs, c).count() == 2_000
    kept = divergence.term_counts(docs, c).collect()
    assert len(kept) == 2_000 and all((r.n, r.total, r.first) == (30, 30, True) for r in kept)


# ---- 7

def test_only_texts_that_may_hold_spaced_letters_are_searched_for_them(monkeypatch):
    plain = toxicity._SPACED
    searched = []

    class Counted:
        def finditer(self, text):
            searched.append(text)
            return plain.finditer(text)

    monkeypatch.setattr(toxicity, "_SPACED", Counted())
    rng = random.Random(7)
    odd = ["", " ", "a b c d", "a b c", "i d i o t", "é ü ß 字", "\U0001f600 x y z", "a  b c d e", "x\ty z w v", "İ a b c d"]
    odd += ["".join(rng.choices("ab  é字.,\n\U0001f600", k=rng.randint(0, 30))) for _ in range(3_000)]
    for t in odd:
        low = re.sub(r"[,;:()\"/|]", " ", t.lower())
        assert toxicity.words_of(t) == low.split() + [m[0].replace(" ", "") for m in plain.finditer(low)]
    searched.clear()
    assert toxicity.words_of("an ordinary text, as most are: no letter of it stands alone") and not searched


def test_short_words_are_not_cut_and_all_spellings_keep_their_margins(monkeypatch):
    model = toxicity.Model(toxicity.Landmarks(["idiot", "fool", "garden"], 0.7), np.array([1.0, 0.5, -0.25]), -0.1)
    words = ["idiot", "Idiot!", "1d10t", "i.d.i.o.t", "fool", "ab", "", "...", "été", "x²y", "gardener", "idiot" * 9, "字" * 40, "[fool]", "f-o-o-l"]
    want = {}
    for w in words:
        parts = [p for p in toxicity.pieces(toxicity.normal(w)) if len(p) >= 3]
        want[w] = max((float(model.marks.kernel([p])[0] @ model.weights + model.bias) for p in parts), default=model.bias)
    cut = []
    whole = toxicity.pieces
    monkeypatch.setattr(toxicity, "pieces", lambda w: cut.append(w) or whole(w))
    model.learn(set(words))
    assert {w: pytest.approx(model.known[w]) for w in words} == want
    assert sorted(cut) == sorted(["idiot" * 9, "字" * 40])
    model.limit = 1
    for _ in range(3):
        model.learn(set(words))  # a word met again comes from the older generation
        assert {w: pytest.approx(model.known[w]) for w in words} == want


def test_the_form_of_a_word_is_as_it_was():
    for w, form in {"Fool": "fool", "fool!": "fool", "[ÉTÉ]": "été", "1d10t": "idiot", "x²y": "xy", "字.": "字", "a1": "ai", "12": "", "don't": "dont", "İx": "i̇x".replace("\u0307", "")}.items():
        assert toxicity.normal(w) == form


# ---- 1

def test_marks_behind_letters_cost_no_encoding_of_the_letters_again(monkeypatch):
    e = token_output.Encoder(queries.tokenizer_path())
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeéßдא字ª²½ǅʰ", k=rng.randint(1, 9))) for _ in range(300)]
    marks = ["", ".", ",", "***", "&&&", "%%%%", "%%%%%", "'s", "!'s", "-x", "_", "__", "'", "<|endoftext|>", "9", "²", "…"]
    texts = [" ".join(rng.choice(words) + rng.choice(marks) for _ in range(40)).replace(" a", "\na") for _ in range(120)]
    texts += ["", ".", "a", "a.", "x²", "x² y½.", "<|endoftext|>", "a <|endoftext|>.", "\x00a b\x00", "don't, I'll. we've"]
    want = [np.frombuffer(e.whole(t), np.uint32).tolist() for t in texts]
    assert e.many(pa.array(texts)).to_pylist() == want
    e.limit = 50
    for _ in range(2):
        assert [x for t in texts for x in e.many(pa.array([t])).to_pylist()] == want
    # one unit of letters, however it is marked
    e = token_output.Encoder(queries.tokenizer_path())
    seen = []
    unit = e.unit
    monkeypatch.setattr(e, "unit", lambda p: seen.append(p) or unit(p))
    e.many(pa.array([" ".join("x letters" + m for m in ("", ".", ",", "!!", "&&&", "***", "%%", ":"))]))
    assert [p for p in seen if "letters" in p] == [" letters"]


# ---- 1, pipeline: what a worker keeps after its task

KEEPS = """
import random, sys
import pyarrow as pa
from patchprofile.llm import common, token_output

def mb():
    return sum(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith("Pss_Anon")) / 1024

rng = random.Random(5)
words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(5_000)]
texts = [" ".join(rng.choices(words, k=4_000)) for _ in range(60)]

def batches():
    for k in range(8):
        yield pa.RecordBatch.from_pydict({"doc_id": list(range(240)), "text": texts * 4, "part": [0] * 240})

enc = token_output.Encoder(sys.argv[1])
enc.many(pa.array(texts[:5]))
common.word_hashes([b"word"])
start = mb()
n = sum(b.num_rows for b in token_output._encoded(batches(), enc, ["doc_id", "tokens", "n_tokens", "n_tokens_before", "part"], 2))
print(n, len(common._HASHES), round(mb() - start))
"""


def test_a_worker_gives_back_the_memory_of_its_batches():
    # 48 MB of text, 6 MB a batch, whose every word is known: nothing of it has to stay
    got = subprocess.run([sys.executable, "-c", KEEPS, queries.tokenizer_path()], cwd=ROOT, capture_output=True, text=True, check=True, timeout=120)
    n, hashes, kept = map(int, got.stdout.split())
    assert (n, hashes) == (1_920, 0)
    assert kept < 25


def test_a_batch_is_dropped_before_the_next_is_read():
    held = []

    def batches():
        for k in range(4):
            held.append(pa.total_allocated_bytes())
            yield pa.RecordBatch.from_pydict({"doc_id": [k], "start": [0], "n_tokens": [500_000], "tokens": pa.array([[k] * 500_000], pa.list_(pa.int32()))})

    assert [b.column("ids_crc32").to_pylist() for b in token_output._checked(batches())] == [[zlib.crc32(np.full(500_000, k, "<u4"))] for k in range(4)]
    assert max(held) - held[0] < 100_000
