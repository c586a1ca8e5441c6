"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns: every operator and every stage."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import arc_warc, brown_lm, compression_rules, decontam, langid, near_dup, packing, shards, site_lines, toxicity
from ledgerline.llm.queries import token_file

LONG = "the long text goes on and on. " * 20000
ROWS = [(1, "Some words here.\nAnd more words there.", "en", "s", 1), (1, "Some words here.\nAnd more words there.", "en", "s", 1), (2, None, None, None, None),
        (3, "", "en", "s", 0), (None, "a text without a number", "de", "s", 3), (4, LONG, "en", "s", 5), (4, "another text of the same number", "fr", "t", 6),
        (5, "12 345 !!", "en", "t", 7), (None, None, None, None, None)]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = "score shard size word node a b k1 held_out n_words value ids bucket component _nth _site _row _k1 _text n_dropped_lines _n_dropped_lines".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    return df.withColumns({c: F.lit("x") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "a text without a number"), (1, "a text without a number"), (2, None), (3, ""), (None, "words here")],
                                 "item_id bigint, text string")


LABELS = "doc_id bigint, quality int, toxic int"


def operators(items, labels):
    return {
        "langid": langid.predict_languages, "brown": brown_lm.score_texts, "decontam": lambda d: decontam.contamination(d, items),
        "shards": shards.assign_shards, "toxicity": lambda d: toxicity.predict_toxicity(d, labels), "lines": lambda d: site_lines.drop_site_lines(d, F.col("source")),
        "quality": compression_rules.judge, "near": near_dup.find_components}


def test_every_row_has_a_result(spark, docs, nothing, items):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, None, None), (9, 1, 1)], LABELS)
    for name, f in operators(items, labels).items():
        rows = f(docs).collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS), name
        assert f(nothing).count() == 0, name


def test_defined_results(spark, docs, items):
    none = spark.createDataFrame([], LABELS)
    lang = {(r.doc_id, r.bits > 0): r.lang_pred for r in langid.predict_languages(docs).collect()}
    assert lang[2, False] == lang[3, False] == lang[5, False] == "und" and lang[1, True] == "en"
    assert {r.score for r in toxicity.predict_toxicity(docs, none).collect()} == {0.0}
    near = [(r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in near_dup.find_components(docs).collect()]
    assert near.count((1, True, 1, True)) == 2 and (None, True, None, True) in near and (3, False, 3, True) in near
    hits = {(r.doc_id, r.n_words): (r.n_hit, r.n_items) for r in decontam.contamination(docs, items).collect()}
    assert hits[None, 5] == (5, 1) and hits[1, 7] == (2, 0) and hits[2, 0] == (0, 0)
    placed = shards.assign_shards(docs, 4).collect()
    assert sum(r["size"] for r in placed if r.doc_id in (2, 3)) == 2
    for s in {r.shard for r in placed}:
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(sum(r.shard == s for r in placed)))
    scored = {(r.doc_id, r.n_tokens) for r in brown_lm.score_texts(docs).collect()}
    assert {(2, 1), (3, 1), (None, 6)} <= scored
    packed = packing.pack(docs, token_file(), 256).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed}[2] == 1


def test_pages_of_every_kind(spark):
    same = "x" * 200
    rows = [(1, "http://a/ b", same), (2, None, same), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (None, "u", same), (6, "é\n", "ü\r\n\r\nWARC/1.1\r\n" * 20),
            (7, "z", same), (7, "z", same)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in arc_warc.archive_pages(pages).collect()), key=str)
    assert got == sorted([(1, 200, "response", None), (2, 200, "revisit", 1), (3, 5, "response", None), (4, 5, "response", None), (5, 0, "response", None),
                          (None, 200, "revisit", 1), (6, 20 * 16, "response", None), (7, 200, "revisit", 1), (7, 200, "revisit", 1)], key=str)
    assert arc_warc.archive_pages(pages.limit(0)).count() == 0


def test_site_lines_by_host(spark):
    rows = [(i, f"https://user@Site.example:80/{i}", f"own line {i}\nmenu of the site\n\n") for i in range(10)] + [(99, "not a url", "menu of the site")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, text string")
    got = {r.page_id: (r.text, r.n_dropped_lines) for r in site_lines.drop_site_lines(pages, site_lines.host_of(F.col("url")), "page_id", ratio=0.5).collect()}
    assert got[3] == ("own line 3\n\n", 1) and got[99] == ("menu of the site", 0)


def test_stages_handle_the_same_rows(spark, docs, nothing, tmp_path):
    spark.createDataFrame([(1, 1, 0), (4, 0, 1)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a text without a number")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for df in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, str(tmp_path))
            rows = out.collect()
            if name != "packing":
                assert out.columns == df.columns, name
                assert all(r[c] == "x" for r in rows for c in CLASH if c in out.columns), name
                kept = {(r.doc_id, r.text) for r in rows}
                if df is docs and name == "decontamination":
                    assert (None, "a text without a number") not in kept and (5, "12 345 !!") in kept
                if df is docs and name == "near_dedup":
                    assert len([r for r in rows if r.doc_id == 1]) == 1 and (3, "") in kept
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
