"""Operators against brute force on random data."""

import json
import random
from datetime import date, timedelta

import pandas as pd
import pytest
from conftest import months

from panelspark.operators import growth, reshape, upsert
from panelspark.sources.cube import decode_cube


@pytest.mark.parametrize("seed", range(3))
def test_upsert_is_a_dict_update(spark, seed):
    rng = random.Random(seed)
    target = {rng.randrange(40): rng.randrange(100) for _ in range(25)}
    batch = [(rng.choice([7, rng.randrange(60)]), rng.choice([None, rng.randrange(100)]), i) for i in range(200)]
    expected = dict(target) | {k: v for k, v, _ in batch}
    shuffled = rng.sample(batch, len(batch))
    out = upsert.upsert(
        spark.createDataFrame(list(target.items()), "k INT, v INT"),
        spark.createDataFrame(shuffled, "k INT, v INT, seq INT").repartition(5),
        ["k"],
        ["v"],
        "seq",
    )
    rows = out.collect()
    assert len(rows) == len(expected) and {r.k: r.v for r in rows} == expected


@pytest.mark.parametrize("seed", range(3))
def test_cube_is_row_major(spark, seed):
    rng = random.Random(seed)
    dims = {name: rng.randint(1, 5) for name in rng.sample(["a", "b", "c", "d"], 4)}
    codes = {d: [f"{d}{i}" for i in range(n)] for d, n in dims.items()}
    cells, n = {}, 1
    for size in dims.values():
        n *= size
    for offset in range(n):
        rest, place = offset, {}
        for d in reversed(dims):
            rest, i = divmod(rest, dims[d])
            place[d] = codes[d][i]
        cells[tuple(place[d] for d in "abcd")] = (offset, rng.choice([None, float(rng.randrange(50))]))
    # Categories are written in any order; their stated position counts.
    described = {
        d: {"label": d, "category": {"index": {c: codes[d].index(c) for c in rng.sample(codes[d], len(codes[d]))}, "label": {}}}
        for d in dims
    }
    present = {str(o): v for o, v in cells.values() if v is not None}
    listed = [None] * n
    for o, v in cells.values():
        listed[o] = v
    for value in (present, listed):
        body = json.dumps({"label": "x", "id": list(dims), "size": list(dims.values()), "dimension": described, "value": value})
        raw = spark.createDataFrame([(body,)], "body STRING")
        kept = decode_cube(raw, ["a", "b", "c", "d"], on_missing="keep").collect()
        assert {(r.a, r.b, r.c, r.d): (r.offset, r.value) for r in kept} == cells
        dropped = decode_cube(raw, ["d", "c", "b", "a"]).collect()
        assert {(r.a, r.b, r.c, r.d): (r.offset, r.value) for r in dropped} == {
            k: v for k, v in cells.items() if v[1] is not None
        }


@pytest.mark.parametrize("seed", range(3))
def test_resample_is_the_wide_resample(spark, seed):
    rng = random.Random(seed)
    days = [date(2023, 1, 2) + timedelta(days=7 * w) for w in range(70) if rng.random() > 0.5]
    wide = pd.DataFrame(
        {"date": pd.to_datetime(days), **{g: [rng.choice([None, float(rng.randrange(100))]) for _ in days] for g in "ab"}}
    )
    wide[["a", "b"]] = wide[["a", "b"]].astype(float)
    expected = wide.set_index("date").resample("MS").mean()
    rows = [(d, g, None if pd.isna(v) else v) for g in "ab" for d, v in zip(days, wide[g])]
    long = spark.createDataFrame(rows, "date DATE, geo STRING, v DOUBLE")
    out = reshape.resample_month(long, ["geo"], "date", "v", spine="all").collect()
    assert len(out) == 2 * len(expected)
    for row in out:
        value = expected.loc[pd.Timestamp(row.month), row.geo]
        assert (row.v is None) == pd.isna(value)
        assert row.v is None or row.v == pytest.approx(value)


@pytest.mark.parametrize("seed", range(3))
def test_lags_against_lists(spark, seed):
    rng = random.Random(seed)
    every = months(date(2020, 1, 1), 48)
    series = {g: {m: float(rng.randrange(1, 99)) for m in every if rng.random() > 0.15} for g in "xyz"}
    df = spark.createDataFrame(
        [(m, g, v) for g, values in series.items() for m, v in values.items()], "month DATE, geo STRING, v DOUBLE"
    ).repartition(4)
    for row in growth.add_lags(df, ["geo"], "month", "v", {"l1": 1, "l12": 12}).collect():
        values = list(series[row.geo].values())
        i = list(series[row.geo]).index(row.month)
        assert row.l1 == (values[i - 1] if i >= 1 else None)
        assert row.l12 == (values[i - 12] if i >= 12 else None)
    for row in growth.add_lags(df, ["geo"], "month", "v", {"l12": 12}, mode="calendar").collect():
        assert row.l12 == series[row.geo].get(row.month.replace(year=row.month.year - 1))
