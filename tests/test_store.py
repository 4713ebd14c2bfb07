import random
from datetime import date, datetime
from itertools import permutations
from pathlib import Path

import pytest
from conftest import by
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelspark.operators import upsert
from panelspark.schema import (
    DIESEL,
    FOOD_INDEX,
    FOOD_SHARE,
    INCOME,
    key_breaches,
    narrow,
    normalise_codes,
    rule_report,
    schema_report,
    tag_rows,
)
from panelspark.sources import store
from panelspark.sources.store import LoadRejected, read_table, upsert_table

TARGET = [("a", 1, 1.0), ("b", 1, 2.0)]
BATCH = [("a", 1, 5.0, 1), ("a", 1, 6.0, 2), ("c", 1, 7.0, 3)]


def test_last_write_wins_and_running_again_changes_nothing(spark):
    target = spark.createDataFrame(TARGET, "k STRING, y INT, v DOUBLE")
    batch = spark.createDataFrame(BATCH, "k STRING, y INT, v DOUBLE, seq INT")
    once = upsert.upsert(target, batch, ["k", "y"], ["v"], "seq")
    assert {r.k: r.v for r in once.collect()} == {"a": 6.0, "b": 2.0, "c": 7.0}
    twice = upsert.upsert(once, batch, ["k", "y"], ["v"], "seq")
    assert sorted(twice.collect()) == sorted(once.collect())


def test_a_later_null_wins(spark):
    target = spark.createDataFrame([("a", 1.0)], "k STRING, v DOUBLE")
    batch = spark.createDataFrame([("a", 2.0, 1), ("a", None, 2)], "k STRING, v DOUBLE, seq INT")
    out = upsert.upsert(target, batch, ["k"], ["v"], "seq")
    assert [(r.k, r.v) for r in out.collect()] == [("a", None)]


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(1000).selectExpr("id AS k", "1.0D AS v")
    batch = spark.range(5).selectExpr("id AS k", "2.0D AS v", "id AS seq")
    out = upsert.upsert(target, batch, ["k"], ["v"], "seq")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("more", [0, 200_000])
def test_the_rules_are_the_same_for_any_batch(spark, more):
    target = spark.createDataFrame([("a", 1), ("a", 9), ("b", 2), ("b", 8), (None, 3)], "k STRING, v LONG")
    batch = spark.createDataFrame([("c", 5, 0), ("a", 6, 1)], "k STRING, v LONG, seq LONG").union(
        spark.range(more).selectExpr("concat('x', id)", "id", "id")
    )
    out = upsert.upsert(target, batch, ["k"], ["v"], "seq").where("k IS NULL OR k NOT LIKE 'x%'")
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", 3), ("a", 6), ("b", 2), ("b", 8), ("c", 5)]
    with pytest.raises(PySparkException, match="NULL in the key"):
        nulls = batch.union(spark.createDataFrame([(None, 7, 2)], batch.schema))
        upsert.upsert(target, nulls, ["k"], ["v"], "seq").collect()


def diesel(spark, *rows):
    return spark.createDataFrame(
        [(date(y, m, 1), geo, v, i) for i, (y, m, geo, v) in enumerate(rows)],
        "month DATE, geo STRING, diesel_price_per_1000l DOUBLE, seq INT",
    )


def stored(spark, root, spec=DIESEL, **options):
    return {
        (r.month.year, r.month.month, r.geo): float(r.diesel_price_per_1000l)
        for r in read_table(spark, root, spec, **options).collect()
    }


def test_table_is_empty_before_the_first_load(spark, tmp_path):
    empty = read_table(spark, str(tmp_path), DIESEL)
    assert empty.count() == 0 and empty.columns == DIESEL.schema.names


def test_loads_touch_only_their_years(spark, tmp_path):
    root = str(tmp_path)
    first = diesel(spark, (2023, 1, "BG", 1.23456), (2024, 1, "bg ", 2.0), (2024, 1, "DE", 3.0))
    assert upsert_table(spark, root, DIESEL, first, "seq") == 3
    assert stored(spark, root) == {(2023, 1, "BG"): 1.2346, (2024, 1, "BG"): 2.0, (2024, 1, "DE"): 3.0}

    second = diesel(spark, (2024, 1, "BG", 5.0), (2024, 1, "BG", 6.0), (2024, 2, "BG", 7.0))
    assert upsert_table(spark, root, DIESEL, second, "seq") == 3
    expected = {(2023, 1, "BG"): 1.2346, (2024, 1, "BG"): 6.0, (2024, 1, "DE"): 3.0, (2024, 2, "BG"): 7.0}
    assert stored(spark, root) == expected
    years = [p.name for p in (tmp_path / DIESEL.name / "data").glob("*/period_year=*")]
    assert sorted(years) == ["period_year=2023", "period_year=2024", "period_year=2024"]

    assert upsert_table(spark, root, DIESEL, second, "seq") == 3
    assert stored(spark, root) == expected
    assert set(stored(spark, root, years=(2023, 2023))) == {(2023, 1, "BG")}


def test_a_load_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    upsert_table(spark, root, DIESEL, diesel(spark, (2024, 1, "BG", 1.0)), "seq")
    bad = diesel(spark, (2024, 1, "BG", 9.0)).withColumn(
        "seq", F.when(F.col("seq") == 0, F.raise_error(F.lit("lost"))).cast("int")
    )
    with pytest.raises(PySparkException, match="lost"):
        upsert_table(spark, root, DIESEL, bad, "seq")
    assert stored(spark, root) == {(2024, 1, "BG"): 1.0}
    # Rows of a load whose list was never written are not read.
    orphan = Path(root) / DIESEL.name / "data" / "load=orphan" / "period_year=2024"
    spark.range(1).selectExpr("id").write.parquet(str(orphan))
    assert stored(spark, root) == {(2024, 1, "BG"): 1.0}


def test_rules_reject_the_batch(spark, tmp_path):
    root = str(tmp_path)
    bad = diesel(spark, (2024, 1, "BG", None), (2024, 2, "A" * 17, 1.0))
    with pytest.raises(LoadRejected, match="diesel_price_per_1000l_is_null"):
        upsert_table(spark, root, DIESEL, bad, "seq")
    assert read_table(spark, root, DIESEL).count() == 0
    assert upsert_table(spark, root, DIESEL, diesel(spark).limit(0), "seq") == 0


def test_annual_table(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame(
        [(2023, "BG", 100.005, 0), (2024, "BG", 110.0, 1)], "year INT, geo STRING, income_pps DOUBLE, seq INT"
    )
    assert upsert_table(spark, root, INCOME, batch, "seq") == 2
    out = by(read_table(spark, root, INCOME), "year")
    assert str(out[2023,].income_pps) == "100.01"


def test_narrow_rounds_and_refuses_overflow(spark):
    df = spark.createDataFrame([(2024, "BG", 12.345), (2025, "BG", float("nan"))], "year INT, geo STRING, food_expenditure_share_pct DOUBLE")
    out = by(narrow(df, FOOD_SHARE), "year")
    assert str(out[2024,].food_expenditure_share_pct) == "12.35"
    assert out[2025,].food_expenditure_share_pct is None
    too_large = spark.createDataFrame([(2024, "BG", 1000.0)], df.schema)
    with pytest.raises(PySparkException):
        narrow(too_large, FOOD_SHARE).collect()


def test_reports(spark):
    rows = [(2024, " bg", 1.0), (2024, "BG", 2.0), (None, "X" * 20, 3.0)]
    df = spark.createDataFrame(rows, "year INT, geo STRING, food_expenditure_share_pct DOUBLE")
    clean = normalise_codes(df, FOOD_SHARE)
    (row,) = key_breaches(clean, FOOD_SHARE).collect()
    assert (row.year, row.geo, row.row_count) == (2024, "BG", 2)
    report = rule_report(clean, FOOD_SHARE).first()
    assert report.year_is_null == 1 and report.geo_longer_than_16 == 1 and report.geo_is_null == 0
    assert schema_report(df, FOOD_SHARE) == [
        ("food_expenditure_share_pct", "decimal(5,2)", "double")
    ]
    assert FOOD_INDEX.key == ["month", "geo", "coicop18", "unit", "freq"]
    assert FOOD_INDEX.series == ["geo", "coicop18", "unit", "freq"]


def test_a_hot_year_is_split_over_files(spark, tmp_path, monkeypatch):
    """Most rows in one year: the write must not put that year into one task."""
    monkeypatch.setattr(store, "_current", lambda *_: (0, {}))
    # Small sizes, so that some MB show what AQE does with many GB.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64kb")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16kb")
    try:
        rows = spark.range(200_000).selectExpr(
            "make_date(if(id < 190000, 2024, 2000 + int(id % 10)), 1, 1) AS month",
            "concat('G', id) AS geo",
            "cast(id % 1000 AS DOUBLE) AS diesel_price_per_1000l",
            "id AS seq",
        )
        upsert_table(spark, str(tmp_path), DIESEL, rows, "seq")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    files = list((tmp_path / DIESEL.name / "data").glob("*/period_year=2024/*.parquet"))
    assert len(files) > 1


@pytest.mark.parametrize("left", ["data/load=dead", "current/n=2-dead", "staged/load=dead", "current/n=2"])
def test_a_load_that_died_at_any_step_does_not_block_the_next(spark, tmp_path, left):
    root = str(tmp_path)
    upsert_table(spark, root, DIESEL, diesel(spark, (2024, 1, "BG", 1.0)), "seq")
    dead = tmp_path / DIESEL.name / left / "_temporary" / "0"
    dead.mkdir(parents=True)
    (dead / "part-0.json").write_text('{"period_year": 2024, "load": "dead"}')
    assert stored(spark, root) == {(2024, 1, "BG"): 1.0}
    assert upsert_table(spark, root, DIESEL, diesel(spark, (2024, 2, "BG", 2.0)), "seq") == 1
    assert stored(spark, root) == {(2024, 1, "BG"): 1.0, (2024, 2, "BG"): 2.0}


def test_prune_keeps_what_the_kept_lists_name(spark, tmp_path):
    root = str(tmp_path)
    for month in range(1, 6):
        upsert_table(spark, root, DIESEL, diesel(spark, (2020 + month % 2, month, "BG", float(month))), "seq")
    before = stored(spark, root)
    store.prune(spark, root, DIESEL, keep=1)
    assert stored(spark, root) == before and len(before) == 5
    folder = tmp_path / DIESEL.name
    assert len(list((folder / "current").glob("n=*"))) == 1
    assert len(list((folder / "data").glob("load=*"))) == 2 and not list((folder / "staged").glob("*"))
    assert upsert_table(spark, root, DIESEL, diesel(spark, (2021, 9, "BG", 9.0)), "seq") == 1
    assert len(stored(spark, root)) == 6


def test_a_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    batch = diesel(spark, (2024, 1, "BG", 1.0), (2024, 2, "BG", 2.0))
    counted = spark.createDataFrame(batch.rdd.mapPartitions(count), batch.schema)
    assert upsert_table(spark, str(tmp_path), DIESEL, counted, "seq") == 2
    assert seen.value == 2


def arriving(spark, *rows):
    """``(day of arrival, month, geo, value)`` as a batch; the sequence is the place in the batch."""
    return spark.createDataFrame(
        [(datetime(2024, 5, day), date(2024, m, 1), geo, v, i) for i, (day, m, geo, v) in enumerate(rows)],
        "arrived TIMESTAMP, month DATE, geo STRING, diesel_price_per_1000l DOUBLE, seq INT",
    )


def test_loads_in_any_order_leave_the_same_table(spark, tmp_path):
    january = [(1, 1, "BG", 1.0), (1, 2, "BG", 2.0), (1, 2, "DE", 3.0)]
    february = [(2, 2, "BG", 20.0), (2, 2, "BG", 21.0), (2, 3, "BG", 30.0)]
    march = [(3, 3, "BG", 300.0), (3, 1, "DE", 100.0)]
    expected = {(2024, 1, "BG"): 1.0, (2024, 2, "BG"): 21.0, (2024, 2, "DE"): 3.0,
                (2024, 3, "BG"): 300.0, (2024, 1, "DE"): 100.0}
    for number, order in enumerate(permutations([january, february, march])):
        root = str(tmp_path / str(number))
        for batch in (*order, order[0]):  # and the first one again
            upsert_table(spark, root, DIESEL, arriving(spark, *batch), "seq", arrived="arrived")
        assert stored(spark, root) == expected


def test_merge_by_arrival_on_random_batches(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(6), draw.randrange(100), draw.choice([None, 1, 2, 3])) for _ in range(60)]
    batches = [rows[:20], rows[20:40], rows[40:]]
    at = lambda day: day and datetime(2024, 1, day)
    schema = "k INT, v INT, arrived TIMESTAMP, seq INT"
    table, kept = spark.createDataFrame([], "k INT, v INT, arrived TIMESTAMP"), {}
    for batch in batches:
        df = spark.createDataFrame([(k, v, at(d), i) for i, (k, v, d) in enumerate(batch)], schema)
        table = upsert.merge_by_arrival(table, df, ["k"], ["v"], "seq")
        last = {}
        for k, v, d in batch:
            if k not in last or (d or 0) >= last[k][1]:
                last[k] = (v, d or 0)
        for k, (v, d) in last.items():
            if k not in kept or d >= kept[k][1]:
                kept[k] = (v, d)
    assert {r.k: r.v for r in table.collect()} == {k: v for k, (v, _) in kept.items()}


def test_broken_rows_are_set_aside_with_their_rules(spark, tmp_path):
    root = str(tmp_path)
    batch = diesel(spark, (2024, 1, "BG", 1.0), (2024, 1, "BG", None), (2024, 2, "A" * 17, None), (2024, 3, "DE", 3.0))
    assert store.read_rejected(spark, root, DIESEL).count() == 0
    assert upsert_table(spark, root, DIESEL, batch, "seq", on_breach="quarantine") == 4
    assert stored(spark, root) == {(2024, 1, "BG"): 1.0, (2024, 3, "DE"): 3.0}
    rejected = by(store.read_rejected(spark, root, DIESEL), "geo")
    null = "diesel_price_per_1000l_is_null"
    assert {k[0]: r.broken for k, r in rejected.items()} == {"BG": [null], "A" * 17: [null, "geo_longer_than_16"]}
    # Only rejected rows: nothing to merge, and the table stays.
    assert upsert_table(spark, root, DIESEL, diesel(spark, (2024, 9, "RO", None)), "seq", on_breach="quarantine") == 1
    assert len(stored(spark, root)) == 2 and store.read_rejected(spark, root, DIESEL).count() == 3
    assert not list((tmp_path / DIESEL.name / "staged").glob("*"))


def test_every_row_of_a_batch_is_accepted_or_has_reasons(spark):
    rows = [(2024, "BG", 1.0, 0), (2024, "BG", 2.0, 1), (2024, "BG", None, 2), (None, "DE", 1.0, 3), (2025, "DE", 1.0, 4)]
    df = spark.createDataFrame(rows, "year INT, geo STRING, food_expenditure_share_pct DOUBLE, seq INT")
    tagged = {r.seq: r.broken for r in tag_rows(df, FOOD_SHARE, "seq").collect()}
    assert tagged == {0: ["superseded"], 1: [], 2: ["food_expenditure_share_pct_is_null"], 3: ["year_is_null"], 4: []}
