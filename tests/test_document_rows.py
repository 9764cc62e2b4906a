"""Rows of documents given whole."""

import pyarrow as pa
from pyspark.sql import functions as F

from wagebook.functions import text as X
from wagebook.operators import pages as P
from wagebook.plans import queries_documents as Q

TOKENS = ["5", "-5", "5.", ".5", "1.234,56", "(128,00)", "{5", "5)", "( 5 )", "1e5", "999999999,999995", "1234567890", "0000000000012", "0,000005", "\x0b5\x0b", "5\u0085", "٥", "12a", "NaN", "--5", "-(5", "1e", "", None]


def test_amounts_of_is_parse_amount(spark):
    got = spark.createDataFrame(list(enumerate(TOKENS)), "i int, t string").orderBy("i").select(X.parse_amount(F.col("t"))).collect()
    assert X.amounts_of(pa.array(TOKENS, pa.string())).to_pylist() == [r[0] for r in got]


def test_document_rows_are_clustered_and_numbered_rows(spark):
    data = [("a", p, s, t, x, x + w, top, top + 10) for p, s, t, x, w, top in [(2, 0, "b", 30.0, 5.0, 10.0), (1, 0, "c", 90.0, 5.0, 12.0), (1, 1, "5,00", 30.0, 5.0, 10.0), (1, 2, "d", 30.0, 5.0, 14.0), (1, 3, "side", 1.0, 5.0, 50.0), (1, 4, "d", 30.0, 5.0, 14.0)]]
    data += [("b", 1, 0, "side", 1.0, 5.0, 50.0, 60.0), ("c", 3, 0, None, 30.0, 40.0, 50.0, 60.0)]
    words = spark.createDataFrame(data, "doc_id string, page int, seq int, text string, x0 double, x1 double, top double, bottom double")
    plain = P.number_rows(P.cluster_rows(P.drop_sidebar(words))).select("doc_id", "page", "row_idx", "doc_row", "top", X.enriched(F.col("words")).alias("words"))
    assert sorted(map(str, P.document_rows(P.whole(words)).collect())) == sorted(map(str, plain.collect()))


def test_rendered_words_are_not_exchanged(spark):
    """Of a document's words no list is made again, so only its lines and what the query needs of its rows are exchanged."""
    plan = Q.QUERIES["d3_detect_s"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    below = plan.split("MapInArrow")[1]
    assert "collect_list(struct(n" in below and below.count("functions=[collect_list") == 1
