"""Where intermediate tables go, and columns that clash."""

from types import SimpleNamespace

import pytest

from panelspark.llm.common import scratch_dir, stored, without, word_count


def session(master: str, **settings):
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))


def test_the_shared_folder_is_the_sessions():
    assert scratch_dir(session("spark://x", **{"spark.checkpoint.dir": "hdfs://a"})) == "hdfs://a"
    own = scratch_dir(session("local[4]"))
    assert own == scratch_dir(session("local")) and "panelspark-" in own
    for master in ("spark://x", "yarn", "local-cluster[1,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(session(master))


def test_stored_rows_are_the_same_and_cut_the_lineage(odd_documents):
    kept = stored(odd_documents)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, odd_documents.collect()))
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()
    assert stored(odd_documents.limit(0)).count() == 0


def test_clashing_columns_go_whatever_their_case(spark):
    frame = spark.range(1).selectExpr("id", "1 as Score", "2 as `a.b`", "3 as x")
    assert without(frame, ["score", "A.B"]).columns == ["id", "x"]


def test_words(spark):
    rows = [(None, 0), ("", 0), (" \t\x0b\n", 0), ("a", 1), (" a\xa0b  c\x1cd ", 2), ("é\n中 ,", 3)]
    frame = spark.createDataFrame(rows, "t string, n long")
    assert frame.where(word_count(frame.t) != frame.n).count() == 0
