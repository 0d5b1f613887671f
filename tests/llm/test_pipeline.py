"""The pipeline and the registered queries on the smallest data."""

import math
import os

import brute
import pytest

import corpus_pipeline
from duebook.llm import quality, toxicity
from duebook.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    gains = brute.toxic_gains([(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.toxic) for r in labels.collect()])
    scores = {i: 1 / (1 + math.exp(-(math.log1p(100 * g) * model.slope + model.offset))) for i, g in gains.items()}
    found = {r.doc_id: r.score for r in model.scored(docs).select("row.doc_id", "score").collect()}
    assert found == pytest.approx(scores, abs=1e-9)
    mild = [i for i, score in scores.items() if score < toxicity.REJECT]
    good = quality.quality_filter(docs.where(docs.doc_id.isin(mild))).select("doc_id", "text").collect()
    lines = brute.line_dedup([(r.doc_id, r.text) for r in good])
    left = {i: t for i, (t, n) in lines.items() if t or not n}
    _, component = brute.simhash_groups(left.items())
    kept = {i: left[i] for i in left if component[i] == i}
    places = corpus_pipeline.run(spark, SF_DIR).collect()
    words = {}
    for r in places:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.n_words
    assert words == {i: len(brute.words(t)) for i, t in kept.items() if brute.words(t)}
    assert 0 < len(kept) < docs.count()
    mine = sorted(places, key=lambda r: (-r.n_words, r.cluster, r.doc_id, r.piece))
    assert {r.shard for r in mine} == {0}
    assert [r.bin for r in mine] == brute.best_fit([(r.n_words, r.source, r.cluster) for r in mine], 4096)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    wide = docs.selectExpr("*", "1 as score", "'x' as features", "2 as lines_removed_", "'y' as row", "3L as hash")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF_DIR)
        assert out.schema == wide.schema or out.dtypes == wide.dtypes, name
        assert stage(spark, wide.limit(0), SF_DIR).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "line dedup", "near duplicates", "best-fit packing"]


def test_contracts(spark):
    """Columns that the queries owe, and the whole table in each result."""
    owed = {
        "op2": ("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "documents"),
        "op4": ("doc_id held_out score predicted", "documents"),
        "op6": ("vec_id n_links component_id kept", "embeddings"),
        "op8": ("page_id url text n_chars", "pages"),
        "op9": ("doc_id fingerprint component_id", "documents"),
        "op10": ("page_id host path rule verdict", "pages"),
        "op11": ("doc_id held_out lang_pred score", "documents"),
        "op13": ("doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256", "documents"),
    }
    by_number = {name.split("_")[0]: name for name in QUERIES}
    assert sorted(by_number) == sorted(f"op{n}" for n in range(1, 14))
    for number, (columns, table) in owed.items():
        out = QUERIES[by_number[number]](spark, SF_DIR)
        assert set(columns.split()) <= set(out.columns)
        assert out.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark):
    from checks.compare import connect, rows_of_duckdb, rows_of_spark

    con = connect(SF_DIR)
    for table in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"create or replace view {table} as select * from '{SF_DIR}/{table}.parquet'")
    assert rows_of_spark(QUERIES[name](spark, SF_DIR)) == rows_of_duckdb(con, SQL[name])
