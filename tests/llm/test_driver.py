"""What the driver holds and plans stays small."""

import random
import tracemalloc

import numpy as np
import pytest

from patchprofile.llm import components, queries, toxicity


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


def _groups(links):
    """The least node reachable of every node."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in list(root)}


def _paths(n):
    """Paths through shuffled nodes, a star, copies of links and a self link."""
    rng = random.Random(n)
    nodes = rng.sample(range(10 * n), n)
    links = [(a, b) for k, (a, b) in enumerate(zip(nodes, nodes[1:])) if k % 97] + [(-1, -2 - i) for i in range(40)] + [(-500, -500)]
    links += rng.choices(links, k=n // 3)
    rng.shuffle(links)
    return links


def test_links_of_one_task_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialize", lambda df, name, f=components.materialize: written.append(name) or f(df, name))
    links = _paths(2_000)
    got = components.components(spark.createDataFrame(links, "a long, b long").coalesce(1), "test-one")
    assert {r.node: r.component for r in got.collect()} == _groups(links)
    assert len(written) == 1


def test_links_of_several_tasks_and_slices_keep_their_components(spark):
    links = _paths(900)
    name = lambda x: (x + 1_000).to_bytes(4, "big")
    df = spark.createDataFrame([(name(a), name(b)) for a, b in links], "a binary, b binary").repartition(7)
    got = components.components(df, "test-bytes").collect()
    assert len(got) == len({bytes(r.node) for r in got})
    assert {bytes(r.node): bytes(r.component) for r in got} == {name(k): name(v) for k, v in _groups(links).items()}
    ordered = spark.createDataFrame([(str(max(x)), str(min(x))) for x in links if x[0] != x[1] and min(x) > 0], "u string, v string").selectExpr("greatest(u, v) u", "least(u, v) v")
    for most in (1, 13, 10_000):
        drawn = [(r.u, r.v) for r in components._drawn(ordered.coalesce(2), most).collect()]
        assert all(u > v for u, v in drawn)
        assert _groups(drawn) == _groups([(r.u, r.v) for r in ordered.collect()])


def test_landmarks_are_spread_in_little_memory():
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("abcdefghijklm", k=rng.randint(3, 16))) for _ in range(400)})
    gain = np.array([rng.random() for _ in words])
    near = toxicity.Landmarks(words, 0.7).kernel(words)
    left, want = gain.copy(), []
    for _ in range(48):
        i = int(np.argmax(left))
        want.append(words[i])
        left = left * np.clip(1 - near[:, i] ** 2, 0, 1)
        left[i] = -1
    tracemalloc.start()
    got = toxicity._spread(words, gain, 48, 0.7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want
    assert peak < 45e6  # 79 MB with one table of all words


def test_words_of_clean_texts_are_not_held_at_once():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(500)]
    clean = [" ".join(rng.choices(words, k=900)) + f" {i}." for i in range(400)]
    tracemalloc.start()
    toxicity.fit_texts(["you moron"] * 3, clean, toxicity.Config(least_texts=99))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6  # 20 MB with all words held
