"""Divergence of sources and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import divergence, spelling

TEXTS = "doc_id long, text string, lang string, source string, term string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_audit(rows, least, top):
    counts, docs, groups = defaultdict(Counter), Counter(), set()
    for _, text, lang, source, _ in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(terms)
        docs.update((lang or "", t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for l, t in docs if l == lang and docs[l, t] >= least)
        sources = sorted(s for l, s in groups if l == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        of = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(of[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and of[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def sources():
    draw = random.Random(2)
    words = [draw.choice(("Wort", "été", "mot", "ß", "日本", "x")) + "abcdefghij"[k % 10] * (k % 4) + draw.choice("äöüé") for k in range(90)]
    rows = []
    for k in range(220):
        lang, source = draw.choice(("de", "fr", None)), draw.choice(("s1", "s2", "s3", "s4", None, ""))
        favourite = words[: 30 if source == "s1" else 90]
        rows.append((k, "; ".join(draw.choice(favourite) for _ in range(draw.randrange(40))), lang, source, "clash"))
    rows += [(900, None, "de", "silent", "x"), (901, "", "xx", "only", "x"), (902, "rare words", "xx", "other", "x"),
             (None, "wort1 2 3", "de", "s1", None), (903, "  ", None, None, None)]
    return rows + rows[:5]


@pytest.mark.parametrize("per_block", [4096, 8])
def test_audit_equals_brute_force(spark, per_block, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS_PER_BLOCK", per_block)  # small blocks: ids run over several tasks
    rows = sources()
    got = divergence.audit(spark.createDataFrame(rows, TEXTS).withColumn("n", F.lit(1)), least_docs=4, top=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 4, 7)


def test_audit_without_rows_or_terms(spark):
    assert divergence.audit(spark.createDataFrame([], TEXTS)).collect() == []
    rows = [(1, "a", "en", "s", ""), (2, None, "en", "t", "")]
    got = divergence.audit(spark.createDataFrame(rows, TEXTS))
    assert sorted(map(tuple, got.collect())) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_audit_of_a_very_long_text(spark):
    text = "Word " * 300_000 + "other " * 5
    rows = [(1, text, "en", "s", ""), (2, "word", "en", "t", "")]
    got = divergence.audit(spark.createDataFrame(rows, TEXTS), least_docs=1)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 1, 50)


def test_equal_subtrees_are_one_node():
    counts = np.zeros((3, 64), np.int64)
    counts[1, 5] = counts[1, 37] = counts[2, 5] = 9
    leaves, levels, roots = divergence._trees(counts)
    assert leaves.tolist() == [0, 9] and [len(x) for x in levels][:5] == [2, 2, 2, 2, 2] and len(set(roots)) == 3
    draw = np.random.default_rng(1)
    counts = draw.integers(0, 3, (5, 128))
    x, y = np.triu_indices(5, 1)
    got = divergence._distances(counts, counts.sum(axis=1).tolist(), 128, x, y)
    shares = np.array([[1 + 10**9 * (int(c) + 5) // (int(row.sum()) + 5 * 128) for c in row] for row in counts])
    assert got.tolist() == [int(abs(shares[a] - shares[b]).sum()) for a, b in zip(x, y)]


def test_shares_are_exact_for_large_counts():
    for total in (10, 10**9, 10**15, 10**17):
        counts = [0, 1, total // 3, total]
        want = [1 + 10**9 * (c + 5) // (total + 5 * 7) for c in counts]
        assert divergence._shares(np.array(counts), total, 7).tolist() == want


def brute_words(rows, misprints, least_length=5, least_times=3):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            if misprints and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % misprints == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_times}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(rows, misprints):
    words = brute_words(rows, misprints)
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def letters():
    draw = random.Random(8)
    stems = ["straße", "ÉLÈVE", "garden", "gardens", "gar×den", "÷division", "aaaaaa", "aaaaa", "window", "winndow", "wintow", "Œuvre", "ñandú"]
    stems += ["".join(draw.choice("abcàéß") for _ in range(draw.randrange(4, 9))) for _ in range(150)]
    weights = [1 + 40 // (1 + k % 30) for k in range(len(stems))]
    rows = [(k, draw.choice((" ", "-1", "€")).join(draw.choices(stems, weights, k=60)), "", "", "") for k in range(60)]
    rows += [(None, "window window windo", "", "", ""), (900, None, "", "", ""), (901, "", "", "", ""), (-5, "garden garden gardn", "", "", "")]
    rows += [(902, "pattern " * 40 + "patern " * 15 + "patrn " * 5, "", "", "")]  # a chain of forms
    return rows + rows[:4]


@pytest.mark.parametrize("misprints", [None, 97, 3])
def test_variants_equal_brute_force(spark, misprints):
    rows = letters()
    docs = spark.createDataFrame(rows, TEXTS).withColumns({"word": F.lit("clash"), "n": F.lit(0)})
    got = spelling.variants(docs, misprints=misprints)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows, misprints)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert ("patrn", "patern", "pattern") in {r[:3] for r in want}


def test_variants_of_nothing_and_of_long_words(spark):
    assert spelling.variants(spark.createDataFrame([], TEXTS), misprints=97).collect() == []
    long = "ab" * 30_000
    rows = [(k, f"{long} {long}x {'z' * 500_000}", "", "", "") for k in range(3)] + [(7, f"{long} " * 4, "", "", "")]
    got = spelling.variants(spark.createDataFrame(rows, TEXTS)).collect()
    assert sorted((len(r.word), r.form and len(r.form), r.n, r.n_near) for r in got) == [
        (60000, None, 7, 1), (60001, 60000, 3, 1), (500000, None, 3, 0)]


def test_neighbourhoods_are_whole_and_distinct():
    rows = np.array([[1, 1, 2, 4, 4], [3, 2, 3, 2, 3]], np.uint64)
    for k, row in enumerate(rows.tolist()):
        forms = {tuple(row)}
        for i in range(len(row) + 1):
            forms |= {tuple(row[:i] + [c] + row[i:]) for c in range(1, spelling.SYMBOLS + 1)}
            if i < len(row):
                forms |= {tuple(row[:i] + [c] + row[i + 1:]) for c in range(1, spelling.SYMBOLS + 1)} | {tuple(row[:i] + row[i + 1:])}
        want = sorted(int(spelling._hashes(np.array([f], np.uint64))[0]) for f in forms)
        got = sorted(int(h) for r, found in spelling._neighbours(rows) for a, h in zip(r, found) if a == k)
        assert got == want
