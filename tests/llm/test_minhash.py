"""MinHash groups against brute force over full sets, and the parts of the method."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import minhash

DOCS = "doc_id long, text string, n long, value string"


def shingles(text, size):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, size, percent):
    sets = [shingles(r[1], size) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[find(k)] = min(row[0], least.get(find(k), row[0]))
    out = []
    for k, row in enumerate(rows):
        component = least.get(find(k))
        out.append((row[0], len(sets[k]), component, row[0] == component))
    return sorted(out, key=str)


def corpus():
    draw = random.Random(4)
    vocabulary = [f"{a}{n}" for a in ("Alpha", "beta", "gÉma", "Δ") for n in range(60)]
    rows = []
    for group in range(6):  # copies from hardly to much changed, so that similarities lie on both sides of the bound
        base = [draw.choice(vocabulary) for _ in range(draw.choice((12, 40, 150)))]
        for _ in range(25):
            text = list(base)
            for _ in range(draw.randrange(1 + len(base) // 12)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(text), group, "x"))
    rows += [(900 + k, " ".join(draw.choice(vocabulary) for _ in range(60)), 0, None) for k in range(20)]
    rows += [(None, None, 1, "a"), (800, "", 1, "a"), (801, " \t\n", 1, "a"), (802, "one", 1, "a"), (803, "ONE", 1, "a"),
             (804, "one two", 1, "a"), (None, rows[0][1], 1, "a"), (None, "null ids only here", 1, "a"), (805, "É", 1, None)]
    return rows + rows[:3]  # repeated rows


@pytest.mark.parametrize("size, percent", [(4, 80), (2, 60)])
def test_groups_equal_brute_force(spark, size, percent, monkeypatch):
    monkeypatch.setattr(minhash, "LIST_BLOCK", 8)  # long lists are cut
    if percent == 60:
        monkeypatch.setattr(minhash, "COLLISIONS", 12)
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).withColumn("component_id", F.lit("clash"))
    got = minhash.minhash_groups(docs, shingle=size, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, size, percent)


def test_empty_table_and_texts(spark):
    none = spark.createDataFrame([], DOCS)
    assert minhash.minhash_groups(none).collect() == []
    empty = spark.createDataFrame([(1, None, 0, ""), (2, "", 0, "")], DOCS)
    assert sorted(map(tuple, minhash.minhash_groups(empty).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_very_long_texts_link(spark):
    long = " ".join(f"w{k % 7919}x{k % 104729}" for k in range(200_000))
    rows = [(1, long, 0, ""), (2, long + " more", 0, ""), (3, long[: len(long) // 2], 0, "")]
    got = minhash.minhash_groups(spark.createDataFrame(rows, DOCS), shingle=4).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == [1, 1, 3]
    assert [r.n_shingles for r in got] == [len(shingles(r[1], 4)) for r in rows]


def test_bound_and_collisions_never_rule_out_a_link():
    draw = random.Random(9)
    texts = [r[1] for r in corpus() if r[1]]
    sets = [s for s in minhash._sets(pa.array(texts, pa.large_string()), 4) if len(s)]
    features = minhash._features(sets, minhash._signatures(sets))
    n = np.array([len(s) for s in sets])
    every = np.ones(len(n), bool)
    x, y = minhash._pairs(n, features, np.arange(len(n)), every, np.zeros(len(n), int), False, 80)
    found = set(zip(x.tolist(), y.tolist(), strict=True))
    for _ in range(4000):
        a, b = sorted(draw.sample(range(len(sets)), 2))
        common = len(np.intersect1d(sets[a], sets[b]))
        if 100 * common >= 80 * (n[a] + n[b] - common):
            assert (a, b) in found


def test_groups_of_sorted_batches_stay_whole():
    keys = [1, 1, 1, 1, 2, 3, 3, 3, 4, 5, 5]
    batches = [pa.RecordBatch.from_pydict({"k": keys[a:b], "v": list(range(a, b))}) for a, b in ((0, 2), (2, 3), (3, 3), (3, 6), (6, 8), (8, 11))]
    tables = [t.to_pydict() for t in minhash.whole_groups(iter(batches), 1)]
    assert sum((t["v"] for t in tables), []) == list(range(11))
    seen = [set(t["k"]) for t in tables]
    assert sum(map(len, seen)) == len(set(keys))
