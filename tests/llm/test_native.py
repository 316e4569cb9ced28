"""Exact deduplication and decontamination against plain rules, with the odd cases."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from check_oracle import normal
from fleetlens.llm import decontaminate, exact_dedup, queries

DOCS = "doc_id long, text string, lang string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


LONG = "Some words, and more. " * 4000
TEXTS = [(1, "Hello World", "en"), (2, "hello world", None), (3, None, "en"), (4, "", "en"), (5, "É", "fr"), (6, "é", "fr"),
         (7, LONG, "en"), (8, LONG.upper(), "en"), (9, LONG + "x", "en"), (10, LONG[:-1], "en"), (11, "hello  world", "en"),
         (12, "no boundary" * 3000, "en")]


def groups_of(rows):
    by_text = defaultdict(list)
    for doc_id, text, *_ in set(rows):
        by_text[lower(text)].append(doc_id)
    out = []
    for text, ids in by_text.items():
        ids = sorted(set(ids), key=lambda i: (i is not None, i or 0))
        out += [(i, ids[-1], len(ids), i == ids[-1], hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("identifier", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))], ids=["hash", "clashing"])
def test_exact_groups(spark, identifier):
    rows = TEXTS + TEXTS[:3] + [(None, "hello world", "en"), (None, "alone", "en"), (None, "alone", "en")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, DOCS), identifier=identifier).collect()
    assert sorted(map(tuple, got), key=str) == groups_of(rows)


@pytest.mark.parametrize("identifier", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))], ids=["hash", "clashing"])
def test_exact_groups_of_every_row(spark, identifier):
    rows = TEXTS + TEXTS[:3] + [TEXTS[6]] * 40
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, DOCS), identifier=identifier, every_row=True).collect()
    size = Counter(lower(text) for _, text, _ in rows)
    of = {i: (keep, kept, sha) for i, keep, _, kept, sha in groups_of(rows)}
    assert sorted(map(tuple, got)) == sorted((i, of[i][0], size[lower(text)], *of[i][1:]) for i, text, _ in rows)


def test_repeated_rows_through_the_query(spark, tmp_path):
    spark.createDataFrame(TEXTS + TEXTS[:3], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = normal(queries.op1_exact_dedup(spark, str(tmp_path)).toPandas())
    assert len(got) == len(TEXTS) + 3 and got.equals(normal(con.execute(queries.OP1_SQL).df()))


def test_exact_groups_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.keep_one(docs).columns == ["doc_id", "text", "lang"]


def test_chunks_join_to_the_text_and_resume_after_an_edit(spark):
    cut = spark.createDataFrame([(LONG,), ("X" + LONG,)], "text string").select(exact_dedup.chunks(F.col("text"))).collect()
    first, edited = cut[0][0], cut[1][0]
    assert "".join(first) == LONG and max(map(len, first)) <= exact_dedup.LONGEST
    assert len(set(first) & set(edited)) >= 1 and set(edited[2:-1]) <= set(first)


def test_keep_one_keeps_columns_and_one_of_repeated_rows(spark):
    docs = spark.createDataFrame(TEXTS + TEXTS, DOCS).withColumns({"recipe": F.lit(1), "chunks": F.lit("x"), "keep_id": F.lit(0)})
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6, 8, 9, 10, 11, 12]


BENCH = "item_id long, text string, note string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contaminated(docs, items):
    windows = defaultdict(set)
    for item, text, *_ in items:
        w = words(text)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s:s + n])].add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def numbered(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


ITEMS = [(1, numbered(0, 40), None), (2, numbered(100, 113), "x"), (10, "Two words", "x"), (3, "", None), (4, None, None),
         (5, numbered(5, 25), None), (6, "one", None), (None, "the null item has six words", None)]
PAGES = [(1, f"a b {numbered(3, 20)} c d", "en"), (2, numbered(0, 12), "en"), (3, f"{'x ' * 400}{numbered(100, 113)}", "en"),
         (4, f"{numbered(90, 112)}", "en"), (5, "TWO-words; two words", "en"), (6, None, "en"), (7, "", None), (8, "é ü", "fr"),
         (9, "just one here", "en"), (None, numbered(0, 30), "en"), (None, "other text", "en"), (9, "same id", "en"),
         (11, f"{numbered(0, 13)} {numbered(7, 30)} {numbered(0, 40)}", "en"), (12, "the null item has six words", "en")]


def test_contamination(spark):
    docs = spark.createDataFrame(PAGES + PAGES[:2], DOCS).withColumn("window", F.lit("x"))
    got = decontaminate.contamination(docs, spark.createDataFrame(ITEMS, BENCH)).drop("text_key").collect()
    assert sorted(map(tuple, got), key=str) == contaminated(PAGES + PAGES[:2], ITEMS)


def test_contamination_by_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    got = decontaminate.contamination(spark.createDataFrame(PAGES, DOCS), spark.createDataFrame(ITEMS, BENCH))
    assert sorted(map(tuple, got.drop("text_key").collect()), key=str) == contaminated(PAGES, ITEMS)


def test_contamination_of_nothing(spark):
    docs, items = spark.createDataFrame(PAGES, DOCS), spark.createDataFrame(ITEMS, BENCH)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count() == 0


def test_keep_clean(spark):
    docs = spark.createDataFrame(PAGES, DOCS).withColumns({"shared": F.lit(1), "prints": F.lit(2)})
    kept = decontaminate.keep_clean(docs, spark.createDataFrame(ITEMS, BENCH))
    dirty = {(r[0], r[1]) for r in contaminated(PAGES, ITEMS) if r[-1]}
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], len(words(r["text"]))) for r in kept.collect() if r["doc_id"] is not None) == sorted(
        (p[0], len(words(p[1]))) for p in PAGES if p[0] is not None and (p[0], len(words(p[1]))) not in dirty)
