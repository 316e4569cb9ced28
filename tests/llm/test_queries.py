"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import pathlib
import re
import zlib

import duckdb
import pytest
from test_native import contaminated, lower
from test_near import classes, fingerprint
from test_terms import brute_variants

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import TABLES, normal
from fleetlens.llm import queries, sentencepiece

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if re.match(r"op\d+_", n)]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = normal(entry.queries()[name](spark, SF).toPandas())
    assert got.equals(normal(con.execute(entry.oracle_sql()[name]).df()))


def test_spelling_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op13_spelling_variants(spark, SF).collect()), key=str)
    assert got == brute_variants(docs, 97)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in entry.oracle_sql() and "spelling" not in n])
def test_query_has_a_row_per_document(spark, name):
    got = entry.queries()[name](spark, SF)
    ids = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(ids)


@pytest.mark.parametrize("name, divisor, held", [("op2_lm_score", 5, 1), ("op3_toxicity", 5, 0)])
def test_held_out_rows(spark, name, divisor, held):
    for r in entry.queries()[name](spark, SF).select("doc_id", "held_out").collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == held)


def test_toxicity_of_held_out_documents_in_every_language(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op3_toxicity(spark, folder).filter("held_out") \
        .join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("toxic IS NOT NULL") \
        .join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    for lang in ("en", "fr", "de", "es"):
        mine = scored[scored["lang"] == lang]
        toxic, clean = mine[mine["toxic"] == 1], mine[mine["toxic"] == 0]
        over = sum((s > clean["score"]).sum() + (s == clean["score"]).sum() / 2 for s in toxic["score"])
        hit, wrong = (toxic["score"] >= 0.5).sum(), (clean["score"] >= 0.5).sum()
        assert over / (len(toxic) * len(clean)) >= 0.9, lang
        assert hit >= 0.8 * len(toxic) and hit >= 0.9 * (hit + wrong), (lang, hit, len(toxic), wrong)


def test_simhash_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: fingerprint(t) for i, t in docs.items()}
    root = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    want = {i: min(j for j in docs if root[prints[j]] == root[p]) for i, p in prints.items()}
    got = entry.queries()["op10_simhash"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        i: (format(p, "016x"), want[i]) for i, p in prints.items()}


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        kept[name] = ({r["doc_id"]: r["text"] for r in docs.collect()}, out)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        docs = out
    ids = {name: sorted(r["doc_id"] for r in out.select("doc_id").collect()) for name, (_, out) in kept.items()}

    before, _ = kept["quality_classifier"]
    good = {r["doc_id"] for r in queries.op5_quality(spark, SF).filter("keep").collect()}
    assert ids["quality_classifier"] == sorted(good)

    before, _ = kept["exact_deduplication"]
    last = {lower(t): max(i for i, other in before.items() if lower(other) == lower(t)) for t in before.values()}
    assert ids["exact_deduplication"] == sorted(last.values())

    before, _ = kept["simhash_near_dedup"]
    prints = {i: fingerprint(t) for i, t in before.items()}
    root = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    assert ids["simhash_near_dedup"] == sorted({min(j for j in before if root[prints[j]] == root[p]) for p in prints.values()})

    before, _ = kept["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in contaminated(list(before.items()), items) if r[-1]}
    assert ids["benchmark_decontamination"] == sorted(set(before) - dirty) and dirty

    before, out = kept["sentencepiece_encoding"]
    model = sentencepiece.load(queries.PIECES)
    assert {r["doc_id"]: model.decode(out_ids(r)) for r in out.collect()} == before
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == ids["sentencepiece_encoding"]


def out_ids(row):
    import numpy as np

    return np.array(row["ids"], np.int64)


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_nothing_else_imports_the_package():
    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in root.glob("fleetlens/**/*.py"):
        if "llm" not in path.parts:
            assert "fleetlens.llm" not in path.read_text()
