import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.common import staged, table
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_the_columns_and_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    for name, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, SF).columns == docs.columns
        assert f(spark, docs.limit(0), SF).collect() == []
    spoken = stage("language_id")(spark, docs, SF)
    gone = {(r["doc_id"], r["text"]) for r in docs.collect()} - {(r["doc_id"], r["text"]) for r in spoken.collect()}
    assert gone == {(i, t) for i, t in odd_rows if not any(c.isalpha() for c in t or "")}


def test_lines_that_go_take_effect(spark, docs_of):
    line = "this line of ten words stands in all three documents"
    docs = docs_of([(1, f"{line}\none"), (2, f"two\n{line}"), (3, line), (4, None), (5, "")])
    got = {r["doc_id"]: r["text"] for r in stage("line_dedup")(spark, docs, SF).collect()}
    assert got == {1: f"{line}\none", 2: "two", 4: None, 5: ""}


def test_short_lines_that_recur_go(spark, docs_of):
    texts = ["Home | About\nown words of one\n\n12", "Home | About\nother words of two\n\n13", "MIT License\n\n12", "start\n MIT  License\nend"]
    got = {r["doc_id"]: r["text"] for r in stage("line_dedup")(spark, docs_of(list(enumerate(texts))), SF).collect()}
    assert got == {0: texts[0], 1: "other words of two\n\n13", 2: "MIT License\n", 3: "start\nend"}


def test_leaf_with_several_templates(spark, docs_of):
    families = ["there was a login by {} from the office today", "there was a crash in {} during our nightly run", "there was a parcel left {} beside that old door"]
    texts = [f.format(w) for w in ("ann", "bob", "eve") for f in families] + ["there was a line that nothing else here resembled"]
    got = {r["doc_id"]: r["text"] for r in stage("line_dedup")(spark, docs_of([(i, t + f"\nkept{chr(97 + i)}") for i, t in enumerate(texts)]), SF).collect()}
    assert got == {i: f"{t}\nkept{chr(97 + i)}" if i in (0, 1, 2, 9) else f"kept{chr(97 + i)}" for i, t in enumerate(texts)}


def test_variable_words_tell_nothing(spark, docs_of):
    """Rows of numbers, and lines that agree in the variable words and in three of five constant ones."""
    texts = ["1 2 3 4 5 6 7 8 9\nthere was a 10 11 12 13 14 cat here", "9 8 7 6 5 4 3 2 1\nthere was a 15 16 17 18 19 dog outside", "x\n1  2 3 4 5 6 7 8 9"]
    got = {r["doc_id"]: r["text"] for r in stage("line_dedup")(spark, docs_of(list(enumerate(texts))), SF).collect()}
    assert got == {0: texts[0], 1: texts[1], 2: "x"}


def test_run_is_the_stages_one_after_the_other(spark):
    docs = table(spark, SF, "documents")
    kept = []
    for name, f in corpus_pipeline.STAGES:
        docs = staged(f(spark, docs, SF), name)
        kept.append(docs.count())
    ran = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, ran.select(columns).collect())) == sorted(map(tuple, docs.select(columns).collect()))
    by_sequence = ran.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert by_sequence.where("n > 1024").count() == 0 and kept[0] >= kept[1] >= kept[2] > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF).select(columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
