"""Language model, classifiers and SentencePiece: exact figures, round trips, held-out accuracy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece as library
from pyspark.sql import functions as F

from fleetlens.llm import lm_scoring, quality, sentencepiece, toxicity
from fleetlens.llm.queries import PIECES

DOCS = "doc_id long, text string"


def tokens(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def corpus(n=300):
    draw = random.Random(1)
    phrase = "the quick brown fox jumps over the lazy dog".split()
    rows = []
    for k in range(n):
        words = []
        while len(words) < 60:
            words += phrase if draw.random() < 0.3 else [f"w{int(draw.paretovariate(0.7))}"]
        rows.append((k, " ".join(words).title() if k % 7 == 0 else "\n".join(words)))
    return rows + [(1000, None), (1001, ""), (1002, " \t "), (None, "the quick w1"), (4, rows[4][1])]


def test_language_model(spark):
    rows = corpus()
    held = {k for k in range(300) if k % 5 == 1}
    learn = ~F.coalesce(F.col("doc_id").isin(*held), F.lit(False))
    docs = spark.createDataFrame(rows, DOCS).withColumns({"learn": F.lit(1), "codes": F.lit("x")})
    got = lm_scoring.score_documents(docs, learn).collect()
    count = Counter(t for k, text in rows if k not in held for t in tokens(text))
    total, distinct = sum(count.values()), len(count)

    def base(text):
        return sum(math.log10((count[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens(text))

    want = sorted((str(k), k not in held, len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), total, round(base(t), 6))
                  for k, t in rows)
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in got) == want
    model = interpolated([t for k, t in rows if k not in held])
    for r in got:  # quantised shares are low by half a percent at most
        text = next(t for k, t in rows if k == r["doc_id"])
        score = sum(math.log10(model(a, b)) for a, b in zip([None, *tokens(text)], tokens(text)))
        assert score - 0.0021 * r["n_tokens"] <= r["score"] <= score + 1e-6
    out = [r for r in got if not r["learn"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def interpolated(texts):
    """P(word | word before), by the definition."""
    count = Counter(t for text in texts for t in tokens(text))
    pairs = Counter(x for text in texts for x in zip([None, *tokens(text)], tokens(text)))
    total, once, twice = sum(count.values()), sum(c == 1 for c in count.values()), sum(c == 2 for c in count.values())
    discount = once / (once + 2 * twice) if once and twice else 0.5
    classes, singular = Counter(), Counter()
    for (a, _), n in pairs.items():
        classes[int(math.log2(count[a]))] += n
        singular[int(math.log2(count[a]))] += n == 1

    def probability(before, word):
        single = (count[word] - discount) / total if count[word] else discount * len(count) / total
        if not count[before]:
            return single
        kind = int(math.log2(count[before]))
        weight = min((singular[kind] + 1) / (classes[kind] + 1), lm_scoring.MOST_BACKOFF)
        return (1 - weight) * pairs[before, word] / count[before] + weight * single

    for before in [None, *list(count)[:5]]:  # all words seen, and the one class of those not seen
        assert sum(probability(before, w) for w in [*count, "never seen"]) == pytest.approx(1)
    return probability


def test_language_model_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    assert [r["score"] for r in lm_scoring.score_documents(docs, F.lit(False)).collect()] == [0.0, 0.0]
    assert lm_scoring.score_documents(docs.limit(0), F.lit(True)).count() == 0


def test_elias_fano_and_trie():
    draw = np.random.default_rng(2)
    for values in ([], [0], [0, 0, 5], np.sort(draw.integers(0, 1 << 40, 1000)), np.arange(50)):
        values = np.array(values, np.uint64)
        data = np.frombuffer(b"x" + lm_scoring.elias_fano(values), np.uint8)
        got, end = lm_scoring.elias_fano_decode(data, 1)
        assert got.tolist() == values.tolist() and end == len(data)
    grams = sorted({(int(a), int(b)) for a, b in draw.integers(0, 60, (500, 2))})
    context, word = (np.array(x, np.uint64) for x in zip(*grams))
    codes = draw.integers(1, 60000, len(grams)).astype(np.uint16)
    trie = lm_scoring.Trie(np.frombuffer(lm_scoring.build_trie(context, word, codes), np.uint8))
    known = dict(zip(grams, codes.tolist()))
    a, b = np.meshgrid(np.arange(70, dtype=np.uint64), np.arange(70, dtype=np.uint64))
    assert trie.look_up(a.ravel(), b.ravel()).tolist() == [known.get((int(x), int(y)), 0) for x, y in zip(a.ravel(), b.ravel())]
    share = np.array([1.0, 0.5, 1e-7])
    back = lm_scoring.probabilities(lm_scoring.quantised(share).astype(int))
    assert (back <= share * (1 + 1e-9)).all() and (back > share * 0.99).all()


def labelled(spark, n=400):
    draw = random.Random(4)
    docs, marks = [], []
    for k in range(n):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(80)]
        toxic = k % 4 == 0
        if toxic:
            for at in draw.sample(range(80), 5):
                words[at] = draw.choice(["villain", "Rotten"])
        docs.append((k, " ".join(words)))
        marks.append((k, int(toxic)))
    docs += [(n, None), (n + 1, ""), (None, "villain rotten"), (0, docs[0][1])]
    marks += [(n, None), (None, 1), (0, 1), (7, 5)]
    return (spark.createDataFrame(docs, DOCS).withColumns({"label": F.lit(9), "score": F.lit(9)}),
            spark.createDataFrame(marks, "doc_id long, toxic int"))


def test_toxicity_on_held_out_documents(spark):
    docs, marks = labelled(spark)
    model = toxicity.train(docs, marks.filter("doc_id < 300"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    right = [got[k]["predicted"] == int(k % 4 == 0) for k in range(300, 400)]
    assert np.mean(right) > 0.95 and toxicity.score(docs, model).count() == docs.count()
    assert got[400]["score"] == got[401]["score"] and 0 < got[400]["score"] < 1 and got[None]["predicted"] == 1


def plain_buckets(text):
    """Buckets of a text's character n-grams, by the definition."""
    line = " " + re.sub("[A-Z]", lambda m: m[0].lower(), text) + " " if text else ""
    found = set()
    for order in toxicity.ORDERS:
        for at in range(len(line) - order + 1):
            value = 0
            for c in line[at:at + order]:
                value = (value * 0x01000193 + ord(c) + 1) % 2**32
            value = (value ^ value >> 15 ^ order * 0x1ED270B % 2**32) * 0x9E3779B1 % 2**32
            found.add(value >> 32 - toxicity.BITS)
    return found


def test_toxicity_features_and_scores_equal_the_definition(spark):
    docs, marks = labelled(spark, 100)
    model = toxicity.train(docs, marks)
    rows = [(r["doc_id"], plain_buckets(r["text"])) for r in docs.collect()]
    of = {r["doc_id"]: r["m"] for r in marks.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("m")).collect()}
    known = [(of[k], b) for k, b in rows if k is not None and k in of]
    counts = [Counter(x for label, b in known if label == c for x in b) for c in (0, 1)]
    n = [sum(label == c for label, _ in known) for c in (0, 1)]
    ratio = {x: math.log((t + 1) / (n[1] + 2)) - math.log((counts[0][x] + 1) / (n[0] + 2))
             for x, t in counts[1].items() if t >= toxicity.LEAST}
    chosen = {x for x, r in ratio.items() if r > toxicity.RATIO}
    assert set(np.flatnonzero(model.chosen).tolist()) == chosen and set(np.flatnonzero(model.weight).tolist()) <= chosen

    def score(buckets):
        mine = buckets & chosen
        margin = model.bias + sum(model.weight[x] for x in mine) / math.sqrt(max(len(mine), 1))
        return round(1 / (1 + math.exp(-margin)), 4)

    got = sorted((str(r["doc_id"]), round(r["score"], 4)) for r in toxicity.score(docs, model).collect())
    want = sorted((str(k), score(b)) for k, b in rows)
    assert [x for x, _ in got] == [x for x, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], atol=2e-4)


def test_toxicity_of_a_very_long_text(spark):
    docs, marks = labelled(spark, 100)
    model = toxicity.train(docs, marks)
    filler = "abc defgh fed cab " * 60_000  # 1 MB
    long = spark.createDataFrame([(1, filler + "villain rotten villain"), (2, filler)], DOCS)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(long, model).collect()}
    assert got[1] > 0.5 > got[2]


def test_toxicity_without_labels(spark):
    docs, marks = labelled(spark, 8)
    model = toxicity.train(docs, marks.limit(0))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_labellers_are_weighed_by_agreement():
    draw = np.random.default_rng(3)
    truth = draw.random(4000) < 0.7
    accuracy = [0.95, 0.9, 0.85, 0.55, 0.5]
    said = np.stack([np.where(draw.random(4000) < a, truth, ~truth).astype(int) for a in accuracy], axis=1)
    said[draw.random(said.shape) < 0.2] = quality.NONE
    patterns = Counter("".join(map(str, row)) for row in said.tolist())
    posterior, table = quality.weigh(dict(patterns))
    guess = np.array([posterior["".join(map(str, row))] >= 0.5 for row in said.tolist()])
    assert (guess == truth).mean() > 0.95
    found = [(table[k, 1, 1] / table[k, 1, :2].sum() + table[k, 0, 0] / table[k, 0, :2].sum()) / 2 for k in range(5)]
    assert np.allclose(found, accuracy, atol=0.06)
    assert quality.weigh({}) [0] == {}


def test_quality_keeps_prose_and_drops_junk(spark):
    draw = random.Random(6)

    def prose():
        return " ".join(draw.choice(["the", "of", "and", "a", "to", "in"]) if draw.random() < 0.4 else
                        "".join(draw.choice("aeiorstln") for _ in range(draw.randrange(3, 9))) + draw.choice(["", "", "", ".", ","])
                        for _ in range(120))

    def junk(k):
        return [" | ".join(prose().upper().split()[:60]), "BUY!! NOW!! " * 60, "spam " * 200][k % 3]

    rows = [(k, junk(k) if k % 5 == 0 else prose()) for k in range(300)] + [(300, None), (301, ""), (None, prose()), (1, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"pattern": F.lit(1), "good": F.lit(2)})
    model = quality.train(docs)
    kept = {r["doc_id"]: r["keep"] for r in quality.score(docs, model).filter("doc_id < 300").collect()}
    assert np.mean([kept[k] == (k % 5 != 0) for k in range(2, 300)]) > 0.95
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.keep_good(docs, model).count() == quality.score(docs, model).filter("keep").count()


def test_quality_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    model = quality.train(docs)
    assert quality.score(docs, model).count() == 0 and quality.keep_good(docs, model).count() == 0


TEXTS = ["", " ", "a", "The quick brown fox, of course.", "  two  spaces ", "é naïve café", "日本語 🙂🙂 x", "tab\tline\nend\n\n",
         "a" * 300, "<s> [INST] <0x41>", "x\x00y", "Wörter und Übung " * 50, "," * 40, "the end"]


def best_path(model, text):
    """Viterbi over all pieces, one byte after the other."""
    pieces = {p: n for n, p in enumerate(model.pieces) if model.kinds[n] in (sentencepiece.NORMAL, sentencepiece.USER_DEFINED)}
    raw = model.normalise(text).encode()
    best = [(0.0, [])] + [(-math.inf, [])] * len(raw)
    for at in range(len(raw)):
        if best[at][0] == -math.inf or raw[at] & 0xC0 == 0x80:
            continue
        width = next(n for n in range(1, 5) if at + n == len(raw) or raw[at + n] & 0xC0 != 0x80)
        for to in range(at + 1, min(len(raw), at + 48) + 1):
            n = pieces.get(raw[at:to])
            if n is not None and best[at][0] + model.scores[n] > best[to][0]:
                best[to] = best[at][0] + model.scores[n], best[at][1] + [n]
        if raw[at:at + width] not in pieces and best[at][0] + model.unknown_score > best[at + width][0]:
            best[at + width] = best[at][0] + model.unknown_score, best[at][1] + [model.byte_ids[b] for b in raw[at:at + width]]
    return best[-1]


def test_encoding_is_the_best_path():
    model = sentencepiece.load(PIECES)
    for text, ids in zip(TEXTS, model.encode(TEXTS), strict=True):
        score, path = best_path(model, text)
        assert model.decode(ids) == text
        known = [n for n in ids.tolist() if model.kinds[n] != sentencepiece.BYTE]
        assert sum(model.scores[known]) == pytest.approx(sum(model.scores[[n for n in path if model.kinds[n] != sentencepiece.BYTE]]))
        assert sum(model.kinds[ids] == sentencepiece.BYTE) == sum(model.kinds[n] == sentencepiece.BYTE for n in path)


def test_decoding_equals_the_library():
    model, other = sentencepiece.load(PIECES), library.SentencePieceProcessor(model_file=PIECES)
    for text in TEXTS:
        assert model.decode(np.array(other.encode(text), np.int64)) == other.decode(other.encode(text)) == text


def test_double_array_holds_the_pieces():
    pieces = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, "é".encode(): 4, "ébc".encode(): 5, bytes([255, 1]): 6}
    base, check, end = sentencepiece.double_array(pieces)

    def find(key):
        state = 0
        for byte in key:
            to = base[state] + byte
            if base[state] < 0 or to >= len(check) or check[to] != state:
                return -1
            state = to
        return end[state]

    assert all(find(p) == n for p, n in pieces.items())
    assert [find(x) for x in (b"c", b"abcd", b"", "é".encode()[:1])] == [-1, -1, -1, -1]


def test_encode_and_decode_tables(spark):
    rows = list(enumerate(TEXTS)) + [(100, None), (None, "x"), (3, TEXTS[3])]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"ids": F.lit("x"), "n_tokens": F.lit(0)})
    got = sentencepiece.encode(docs, PIECES, with_text=True)
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in got.collect()) == sorted((str(k), t or "") for k, t in rows)
    assert got.filter("round_trip AND n_tokens = size(ids)").count() == len(rows)
    back = sentencepiece.decode(got, PIECES).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(k), t or "") for k, t in rows)
    assert sentencepiece.encode(docs.limit(0), PIECES).count() == 0
