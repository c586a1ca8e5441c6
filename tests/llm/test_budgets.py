"""op2 and op7: what keeps them inside their budgets gives the results of the plain forms."""
import pyarrow as pa

from ledgerline.llm import arc_warc, brown_lm


def test_words_are_coded_as_they_are_cut():
    texts = ["", " ", "a A  B\ta", " É é\x0bÉ ", "x\x1cy x y", "\n\r\x0c", "b", None, "a\x00 a\x00\x85"]
    codes, kinds, sizes = brown_lm.coded_words(pa.array(texts))
    assert b"" not in kinds and sorted(set(codes.tolist())) == list(range(len(kinds)))
    at, got = 0, []
    for n in sizes.tolist():
        got.append([kinds[i] for i in codes[at:at + n]])
        at += n
    assert got == [brown_lm.words_of(t or "") for t in texts]
    assert brown_lm.with_ends(codes[:0], sizes[:2], 9).tolist() == [9, 9, 9]


def test_conversion_reads_records_twice_and_sorts_no_payloads(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"{i % 3}" * 200) for i in range(12)], "page_id bigint, url string, html string")
    from ledgerline.session import fresh_path
    path = fresh_path(spark, "arc-t")
    arc_warc.write_arc(pages, path)
    converted = arc_warc.convert(arc_warc.read_arc(spark, path), 2)
    plan = converted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("MapInArrow") == 1  # here; the other time when the digests were written
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [record_id" not in plan
    got = {r.page_id: (r.record_type, r.refers_to) for r in converted.collect()}
    assert got == {i: ("response", None) if i < 3 else ("revisit", i % 3) for i in range(12)}
