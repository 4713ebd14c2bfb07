from uuid import uuid4

import pytest
from conftest import by
from test_loads import document

from panelspark.plans import loads
from panelspark.schema import INCOME
from panelspark.sources.store import read_table
from panelspark.streaming.landing import checkpoint_dir, load_new_documents


def test_only_new_files_are_loaded(spark, tmp_path):
    # The shared folder for progress outlives a test run, so the names must be new ones.
    base = tmp_path / uuid4().hex
    landing, root = base / "landing", str(base / "tables")
    landing.mkdir(parents=True)

    def land(name, geo, value):
        body = document(loads.INCOME_DIMS, [geo], ["2023", "2024"], value)
        (landing / name).write_text(body)

    def load():
        load_new_documents(
            spark, str(landing), root, INCOME, loads.income_rows, fallback=str(tmp_path / "progress")
        )
        return by(read_table(spark, root, INCOME), "year", "geo")

    land("one.json", "BG", {"0": 10, "1": 11})
    assert len(load()) == 2
    land("two.json", "BG", {"1": 12})
    land("three.json", "DE", {"0": 20})
    rows = load()
    assert {k: float(r.income_pps) for k, r in rows.items()} == {
        (2023, "BG"): 10.0,
        (2024, "BG"): 12.0,
        (2023, "DE"): 20.0,
    }
    lists = (base / "tables" / INCOME.name / "current").glob("n=*")
    assert len(list(lists)) == 2
    assert load() == rows
    assert len(list((base / "tables" / INCOME.name / "current").glob("n=*"))) == 2


class Session:
    def __init__(self, **settings):
        self.conf = settings


def test_progress_folder_comes_from_the_session():
    shared = Session(**{"spark.checkpoint.dir": "/shared"})
    assert checkpoint_dir(shared, "x", "/mine") == "/shared/x"
    assert checkpoint_dir(Session(), "x", "/mine") == "/mine/x"
    with pytest.raises(ValueError):
        checkpoint_dir(Session(), "x")
