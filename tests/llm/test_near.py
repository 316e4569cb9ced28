"""SimHash groups, components and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlens.llm import simhash, substring_dedup
from fleetlens.llm.components import components

DOCS = "doc_id long, text string, n_chars long"


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_groups(spark):
    draw = random.Random(3)
    base = [draw.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(draw.randrange(50)) for _ in range(400)]
    rows = [(None, "null id", 0), (100, None, 0), (101, "", 0), (102, " \t\n ", None), (103, "one", 0), (104, "Two WORDS", 0),
            (105, "two words", 0), (106, "É é", 0)]
    for k in range(40):
        text = list(base)
        for _ in range(draw.randrange(3)):
            text[draw.randrange(400)] = "changed"
        rows.append((k, " ".join(text), k))
    rows += rows[:3]
    got = simhash.simhash_groups(spark.createDataFrame(rows, DOCS).withColumn("print", F.lit("x"))).collect()
    prints = {r[1]: fingerprint(r[1]) for r in rows}
    root = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[root[prints[text]]] = min(doc_id, least.get(root[prints[text]], doc_id))
    want = [(i, format(prints[t], "016x"), least.get(root[prints[t]])) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len(set(least.values())) < len({r[0] for r in rows})


def test_links_connect_all_near_prints(spark):
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    prints = {centre, 0, (1 << 64) - 1}
    while len(prints) < 700:  # a crowd around one print, so that meetings are large
        x = centre
        for _ in range(draw.randrange(1, 6)):
            x ^= 1 << draw.randrange(64)
        prints.add(x)
    prints |= {draw.getrandbits(64) for _ in range(50)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = [(a, b) for a, b in simhash.links(spark.createDataFrame(signed, "print long")).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links)
    near = classes(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    unsigned = {(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in links}
    assert classes(sorted(prints), lambda a, b: (a, b) in unsigned or (b, a) in unsigned) == near


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_at_smaller_distances(spark, distance):
    draw = random.Random(6)
    centre = draw.getrandbits(64)
    prints = {0, 1, (1 << 64) - 1}
    while len(prints) < 600:  # crowds whose members are one to six bits apart, with and without their centre
        x = centre ^ (draw.getrandbits(3) << 40)
        for bit in draw.sample(range(64), draw.randrange(1, 4)):
            x ^= 1 << bit
        prints.add(x)
    numbers = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(numbers, "print long"), distance).collect()
    linked = {tuple(sorted(x & (1 << 64) - 1 for x in pair)) for pair in links}
    assert all((a ^ b).bit_count() <= distance for a, b in linked)
    near = classes(sorted(prints), lambda a, b: (a ^ b).bit_count() <= distance)
    assert classes(sorted(prints), lambda a, b: (a, b) in linked) == near


def test_simhash_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.simhash_groups(docs).count() == 0
    assert simhash.keep_one(docs).columns == docs.columns


def test_simhash_keeps_one(spark):
    text = " ".join(f"word{i}" for i in range(300))
    docs = spark.createDataFrame([(5, text, 1), (3, text.upper(), 2), (9, "other words here now", 3), (3, text.upper(), 2),
                                  (None, "x y z", 4)], DOCS).withColumn("component_id", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "9", "None"]


def test_simhash_keeps_one_where_ids_repeat_or_lack(spark):
    base = [" ".join(f"{name}{i}" for i in range(300)) for name in "abcd"]
    rows = [(1, base[0], 1), (1, base[1], 2), (2, base[1].upper(), 3), (1, base[0], 4), (None, base[2], 5), (None, base[2].upper(), 6),
            (None, base[3], 7), (3, base[3].upper(), 8), (None, None, 9), (None, "", 10)]
    kept = [r["text"] for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted((t or "").lower() for t in kept) == sorted(["", *base])
    assert base[1] in kept and base[3].upper() in kept


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(rows, window):
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            low = -1 << 70 if doc_id is None else doc_id
            first[key] = min(first.get(key, low), low)
    out = []
    for doc_id, text in rows:
        w, gone = words(text), set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (-1 << 70 if doc_id is None else doc_id):
                gone |= set(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def passages(seed):
    draw = random.Random(seed)
    store = [[f"p{k}w{i}" for i in range(draw.randrange(20, 90))] for k in range(12)]
    rows = []
    for doc_id in range(60):
        text = []
        for _ in range(draw.randrange(1, 6)):
            part = draw.choice(store)
            a = draw.randrange(0, 10)
            text += part[a:draw.randrange(len(part) - 8, len(part) + 1)] + [f"own{draw.randrange(10**6)}"] * draw.randrange(3)
        rows.append((doc_id, draw.choice([" ", "\n", "  "]).join(text)))
    return rows + [(100, None), (101, ""), (102, " "), (103, "a\x1cb\x85c a"), (None, rows[0][1]), (7, rows[3][1]), rows[4], rows[4]]


def test_repeated_passages(spark):
    rows = passages(11)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit(1), "shared": F.lit("x")})
    for window in (50, 20, 5):
        got = substring_dedup.remove_repeats(docs, window=window, with_text=True).drop("factors").collect()
        assert sorted(map(tuple, got), key=str) == removed(rows, window)


def test_factors_name_a_reference_that_holds_them(spark):
    rows = passages(13)
    text = {i: words(t) for i, t in rows[:60]}
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows[:60], "doc_id long, text string"), window=20).collect()
    seen = 0
    for r in out:
        for f in r["factors"]:
            span, other = text[r["doc_id"]][f["start"]:f["start"] + f["length"]], text[f["reference"]]
            assert f["reference"] < r["doc_id"] and f["length"] >= 20
            for s in range(len(span) - 19):
                assert any(other[k:k + 20] == span[s:s + 20] for k in range(len(other) - 19))
            seen += 1
    assert seen


def test_repeated_passages_of_nothing(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rolling_hashes_are_equal_where_words_are():
    values = np.array([3, 5, 7, 9, 3, 5, 7, 9, 3], np.uint64)
    got = substring_dedup._rolling(values, 4, substring_dedup.BASES[0])
    assert got[0] == got[4] and got[1] == got[5] and len(set(got.tolist())) == 4
