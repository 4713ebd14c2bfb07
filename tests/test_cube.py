import json

import pytest
from conftest import by
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelspark.sources.cube import cell_marks, cube_metadata, decode_cube, read_documents


def axis(label, codes, labels=None):
    index = {code: i for i, code in enumerate(codes)}
    return {"label": label, "category": {"index": index, "label": labels or {c: c.title() for c in codes}}}


SPARSE = {
    "label": "Sparse",
    "id": ["freq", "geo", "time"],
    "size": [1, 2, 3],
    "dimension": {
        "freq": axis("Frequency", ["M"]),
        "geo": axis("Geography", ["BG", "DE"], {"BG": "Bulgaria", "DE": "Germany"}),
        "time": axis("Time", ["2024-01", "2024-02", "2024-03"]),
    },
    "value": {"0": 1.5, "2": 3, "5": 9},
}
LISTED = {
    "label": "Listed",
    "id": ["time", "geo"],
    "size": [2, 2],
    "dimension": {"time": axis("Time", ["2024", "2025"]), "geo": axis("Geography", ["RO", "EU"])},
    "value": [1, None, 3, 4],
}


def frame(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "body STRING")


def cells(df, *dims):
    return {tuple(r[d] for d in dims): r["value"] for r in df.collect()}


def test_empty_cells_are_kept_dropped_or_refused(spark):
    raw = frame(spark, SPARSE)
    dims = ["freq", "geo", "time"]
    kept = cells(decode_cube(raw, dims, on_missing="keep"), "geo", "time")
    assert kept == {
        ("BG", "2024-01"): 1.5,
        ("BG", "2024-02"): None,
        ("BG", "2024-03"): 3.0,
        ("DE", "2024-01"): None,
        ("DE", "2024-02"): None,
        ("DE", "2024-03"): 9.0,
    }
    dropped = cells(decode_cube(raw, dims), "geo", "time")
    assert dropped == {k: v for k, v in kept.items() if v is not None}
    with pytest.raises(PySparkException, match="empty cells: 3"):
        decode_cube(raw, dims, on_missing="error").collect()


def test_listed_values_and_another_order_of_dimensions(spark):
    out = decode_cube(frame(spark, LISTED), ["geo", "time"], on_missing="keep")
    assert cells(out, "geo", "time") == {
        ("RO", "2024"): 1.0,
        ("RO", "2025"): 3.0,
        ("EU", "2024"): None,
        ("EU", "2025"): 4.0,
    }
    assert {r.offset for r in out.collect()} == {0, 1, 2, 3}


def test_documents_of_both_kinds_in_one_frame(spark):
    one_geo = dict(SPARSE, id=["geo", "freq", "time"], size=[2, 1, 3])
    out = decode_cube(frame(spark, one_geo, LISTED), ["geo", "time"])
    assert out.count() == 6


def test_large_values_are_exact_in_both_shapes(spark):
    n = 5000
    codes = [f"c{i:05d}" for i in range(n)]
    base = {"label": "L", "id": ["geo", "time"], "size": [2, n]}
    dims = {"geo": axis("G", ["A", "B"]), "time": axis("T", codes)}
    value = {str(i): float(i) for i in range(0, 2 * n, 3)}
    out = decode_cube(frame(spark, dict(base, dimension=dims, value=value)), ["geo", "time"])
    wrong = out.where(
        (F.col("value") != F.col("offset"))
        | (F.col("time") != F.format_string("c%05d", F.col("offset") % n))
        | (F.col("geo") != F.when(F.col("offset") < n, "A").otherwise("B"))
    )
    assert out.count() == len(value) and wrong.count() == 0


def test_labels_and_predicate(spark):
    out = decode_cube(
        frame(spark, SPARSE), ["geo", "time"], "hicp_index", labels={"geo": "country"}, where={"geo": ["DE"]}
    )
    (row,) = out.collect()
    assert (row.geo, row.country, row.hicp_index) == ("DE", "Germany", 9.0)


@pytest.mark.parametrize(
    "change",
    [
        {"id": ["freq", "place", "time"]},  # a listed dimension is absent
        {"size": [1, 2, 4]},  # size and categories disagree
        {"dimension": {**SPARSE["dimension"], "geo": {"label": "G", "category": {"index": {"BG": 0, "DE": 5}, "label": {}}}}},
    ],
)
def test_unsound_documents_raise(spark, change):
    with pytest.raises(PySparkException, match="cube dimensions do not fit"):
        decode_cube(frame(spark, {**SPARSE, **change}), ["geo", "time"]).collect()


def test_a_dimension_with_several_categories_must_be_listed(spark):
    with pytest.raises(PySparkException, match="cube dimensions do not fit"):
        decode_cube(frame(spark, SPARSE), ["time"]).collect()


def test_malformed_text_raises(spark):
    raw = spark.createDataFrame([("{not json",)], "body STRING")
    with pytest.raises(PySparkException, match="not a cube document"):
        decode_cube(raw, ["geo"]).collect()


def test_metadata(spark):
    out = by(cube_metadata(frame(spark, SPARSE)), "dim", "code")
    assert len(out) == 6
    row = out["geo", "DE"]
    assert (row.dataset_label, row.dim_label, row.dim_position, row.dim_size) == (
        "Sparse", "Geography", 1, 2,
    )
    assert (row.label, row.position) == ("Germany", 1)


def test_read_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(SPARSE, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(LISTED))
    raw = read_documents(spark, str(tmp_path))
    assert raw.count() == 2 and raw.columns == ["document", "arrived", "body"]
    out = decode_cube(raw, ["geo", "time"], keep=["document"])
    assert out.select("document").distinct().count() == 2
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "all.jsonl").write_text(json.dumps(SPARSE) + "\n" + json.dumps(LISTED) + "\n")
    assert read_documents(spark, str(lines), per_line=True).count() == 2


def test_decoding_does_not_shuffle(spark):
    plan = decode_cube(frame(spark, SPARSE), ["geo", "time"], on_missing="keep")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


DIRTY = {"0": 1.0, "1": ":", "2": 3.0, "3": 4.0}


@pytest.mark.parametrize("value", [DIRTY, [1.0, ":", 3.0, 4.0]])
def test_a_mark_is_an_empty_cell_and_is_counted(spark, value):
    raw = frame(spark, dict(LISTED, value=value))
    assert sorted(cells(decode_cube(raw, ["geo", "time"]), "geo", "time").values()) == [1.0, 3.0, 4.0]
    assert decode_cube(raw, ["geo", "time"], on_missing="keep").count() == 4
    assert [(r.mark, r.cells) for r in cell_marks(raw).collect()] == [(":", 1)]


def test_a_document_without_values_raises(spark):
    body = {k: v for k, v in SPARSE.items() if k != "value"}
    for document in (body, dict(body, value=None)):
        with pytest.raises(PySparkException, match="without values"):
            decode_cube(frame(spark, document), ["freq", "geo", "time"]).collect()
    assert decode_cube(frame(spark, dict(body, value={})), ["geo", "time"]).count() == 0


def test_a_cell_outside_the_cube_raises(spark):
    with pytest.raises(PySparkException, match="outside"):
        decode_cube(frame(spark, dict(SPARSE, value={"0": 1.0, "999": 2.0})), ["geo", "time"]).collect()


def test_only_the_wanted_cells_must_be_there(spark):
    n = 4
    whole = {"label": "L", "id": ["geo", "time"], "size": [3, n], "dimension": {
        "geo": axis("G", ["A", "B", "C"]), "time": axis("T", [f"t{i}" for i in range(n)])}}
    raw = frame(spark, dict(whole, value={str(i): float(i) for i in range(3 * n) if i != n + 1}))
    for geos, missing in ((["A"], 0), (["A", "C"], 0), (["B"], 1), (["A", "B", "X"], 1)):
        where = {"geo": geos, "time": ["t0", "t1"]}
        kept = decode_cube(raw, ["geo", "time"], on_missing="keep", where=where)
        expected = {(g, t): None if (g, t) == ("B", "t1") else float("ABC".index(g) * n + int(t[1]))
                    for g in geos if g in "ABC" for t in ("t0", "t1")}
        assert cells(kept, "geo", "time") == expected
        strict = decode_cube(raw, ["geo", "time"], on_missing="error", where=where)
        if missing:
            with pytest.raises(PySparkException, match="empty cells: 1"):
                strict.collect()
        else:
            assert strict.count() == 2 * len(geos)


def test_positions_as_a_list_or_left_out_for_one_category(spark):
    listed = json.loads(json.dumps(SPARSE))
    listed["dimension"]["geo"]["category"]["index"] = ["BG", "DE"]
    del listed["dimension"]["freq"]["category"]["index"]
    dims = ["freq", "geo", "time"]
    for on_missing in ("drop", "keep"):
        plain = decode_cube(frame(spark, SPARSE), dims, on_missing=on_missing, labels={"geo": "country"})
        other = decode_cube(frame(spark, listed), dims, on_missing=on_missing, labels={"geo": "country"})
        assert sorted(other.collect()) == sorted(plain.collect())
    columns = ["dim", "code", "label", "position"]
    plain, other = cube_metadata(frame(spark, SPARSE)), cube_metadata(frame(spark, listed))
    assert sorted(other.select(columns).collect()) == sorted(plain.select(columns).collect())
    del listed["dimension"]["time"]["category"]["index"]
    with pytest.raises(PySparkException, match="do not fit"):
        decode_cube(frame(spark, listed), dims).collect()


def test_last_positions_of_an_axis(spark):
    raw = frame(spark, SPARSE)
    assert set(cells(decode_cube(raw, ["geo", "time"], last={"time": 1}), "geo", "time")) == {
        ("BG", "2024-03"), ("DE", "2024-03")}
    kept = decode_cube(raw, ["geo", "time"], last={"time": 2}, where={"geo": ["DE"]}, on_missing="keep")
    assert cells(kept, "geo", "time") == {("DE", "2024-02"): None, ("DE", "2024-03"): 9.0}
    assert decode_cube(raw, ["geo", "time"], last={"time": 9}).count() == 3
