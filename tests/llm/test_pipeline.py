from __future__ import annotations

import corpus_pipeline
from billweave.llm import near_dedup
from billweave.llm.common import documents

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = documents(spark, SF_DIR)
    columns, before = docs.columns, docs.count()
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).selectExpr("-1L doc_id", "'12 !' text", "lang", "source", "n_chars"))
    for (name, stage), rejects in zip(corpus_pipeline.STAGES[:-1], (True, True, True, False), strict=True):
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == columns, name
        assert (kept.count() < docs.count()) == rejects, name
        docs = kept
    assert docs.count() < before
    assert near_dedup.near_duplicates(docs).filter("not kept").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_near_duplicate_stage_keeps_rows_without_an_id_and_texts_of_one_id(spark):
    def words(seed, n=60):
        return " ".join(f"w{seed * 1000 + k}" for k in range(n))

    rows = [(None, words(k), k) for k in range(20)]  # unique, without ids
    rows += [(None, words(50), 0), (None, words(50), 1), (None, words(50, 59), 2)]  # a group without ids
    rows += [(7, words(60), 0), (7, words(61), 0), (7, words(61), 0), (7, None, 0), (None, None, 0)]  # one id, several texts
    rows += [(9, words(70), 0), (8, words(70), 0), (None, words(70), 0)]  # the smallest id stays
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert {r for r in got if r[1] in {words(k) for k in range(20)}} == set(rows[:20])
    assert sum(r[1] in (words(50), words(50, 59)) for r in got) == 1
    assert sorted(r for r in got if r[0] == 7 and r[1]) == [(7, words(60), 0), (7, words(61), 0)]
    assert [r[0] for r in got if r[1] == words(70)] == [8] and sum(r[1] is None for r in got) == 2
    assert len(got) == 20 + 1 + 2 + 1 + 2


def test_near_duplicate_stage_links_from_80_percent(spark):
    base = [f"w{k}" for k in range(200)]
    copy = [f"x{k}" if k in (20, 90, 150, 180) else w for k, w in enumerate(base)]  # 176 of 216 shingles
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(copy))], "doc_id long, text string")
    assert [r[0] for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR).collect()] == [1]
