import json
import os

import pytest
from pyspark.sql import functions as F

from borelake import SnapshotStore, build_national
from borelake.plans import stores
from borelake.sources import landed
from borelake.sources.kept_pages import KeptPages, listed_pages

from .conftest import rows
from .test_stores import NOW, land_national, page


def header(eno, lon=None):
    point = None if lon is None else {"type": "Point", "coordinates": [lon, -30.0]}
    return {"geometry": point, "properties": {"eno": eno, "name": f"n{eno}"}}


def log(eno, unit="X"):
    return {"geometry": None, "properties": {"ENO": eno, "INTERVAL_BEGIN_M": 0, "INTERVAL_END_M": 1, "STRAT_UNIT_NAME": unit}}


@pytest.fixture
def pages(spark, tmp_path):
    """Landed header pages, what is kept of them, and the names of the pages that a reading opened."""
    folder, opened = str(tmp_path / "a b" / "headers"), []

    def read(paths):
        opened.extend(sorted(os.path.basename(p) for p in paths))
        return landed.read_header_features(spark, paths)

    def enos(**more):
        opened.clear()
        found = kept.features(folder, read, **more).select("eno").collect()
        return sorted(r["eno"] for r in found), list(opened)

    kept = KeptPages(spark, str(tmp_path / "kept"))
    return folder, enos


def test_only_new_and_changed_pages_are_opened(pages):
    folder, enos = pages
    page(f"{folder}/1.json", [header(1), header(2)], 2)
    page(f"{folder}/2.json", [header(3)], 1)
    page(f"{folder}/none.json", [], 0)
    assert enos() == (["1", "2", "3"], ["1.json", "2.json", "none.json"])
    assert enos() == (["1", "2", "3"], [])
    page(f"{folder}/3.json", [header(4), header(4)], 2)
    page(f"{folder}/2.json", [header(30), header(31)], 2)
    assert enos() == (["1", "2", "30", "31", "4", "4"], ["2.json", "3.json"])
    os.remove(f"{folder}/1.json")
    assert enos() == (["30", "31", "4", "4"], [])


def test_pages_read_anew_and_readings_that_broke_off(spark, pages, tmp_path):
    folder, enos = pages
    page(f"{folder}/1.json", [header(1)], 1)
    assert enos() == (["1"], ["1.json"])
    assert enos(anew=True) == (["1"], ["1.json"])
    assert enos() == (["1"], [])
    # Data without index rows is of a reading that broke off.
    lost = landed.read_header_features(spark, folder).withColumn("_entry", F.lit("zz"))
    lost.write.parquet(str(tmp_path / "kept" / "features" / "zz"))
    assert enos() == (["1"], [])
    # With index rows it is a second reading of the same page, made at the same time: one of the two counts.
    listed_pages(spark, folder).select("page", "stamp", F.lit("zz").alias("_entry")) \
        .write.parquet(str(tmp_path / "kept" / "index" / "zz"))
    assert enos() == (["1"], [])


def test_landing_order_over_several_readings(spark, tmp_path):
    folder, kept = str(tmp_path / "p"), KeptPages(spark, str(tmp_path / "kept"))
    for name, first in (("b", 10), ("d", 30), ("a", 0), ("c", 20)):
        page(f"{folder}/{name}.json", [header(first + i) for i in range(3)], 3)
        features = kept.features(folder, lambda paths: landed.read_header_features(spark, paths))
    whole = landed.with_landing_order(landed.read_header_features(spark, folder))
    assert rows(landed.with_landing_order(features)) == rows(whole)


def test_a_build_opens_new_pages_alone(spark, tmp_path, monkeypatch):
    root, opened = str(tmp_path / "ga"), []
    land_national(tmp_path / "ga")
    for name in ("read_header_features", "read_log_features", "read_hydro_features"):
        def seen(spark, paths, *more, real=getattr(landed, name)):
            opened.extend(sorted("/".join(p.split("/")[-2:]) for p in paths))
            return real(spark, paths, *more)

        monkeypatch.setattr(stores.landed, name, seen)
    store = SnapshotStore(spark, str(tmp_path / "store"))
    build_national(store, root, now=NOW)
    assert len(opened) == 5
    opened.clear()
    build_national(store, root, now=NOW + 1)
    assert opened == []

    # A bore that logs were waiting for: its page alone is read, and its logs are placed.
    page(f"{root}/headers/p3.json", [header(9, 140.0)], 1)
    tables = build_national(store, root, now=NOW + 2)
    assert opened == ["headers/p3.json"]
    assert tables["headers"].count() == 4
    placed = tables["stratigraphy"].where("ENO = '9'").select("code_min_lon", "code_max_lon")
    assert rows(placed) == [(140.0, 140.0)]

    # New logs of old bores: headers stay as they are.
    opened.clear()
    page(f"{root}/stratigraphy/p2.json", [log(9, "New")], 1)
    again = build_national(store, root, now=NOW + 3)
    assert opened == ["stratigraphy/p2.json"]
    assert again["headers"].inputFiles() == tables["headers"].inputFiles()
    assert again["stratigraphy"].where("ENO = '9'").count() == 2
    anew = build_national(SnapshotStore(spark, str(tmp_path / "other")), root, now=NOW)
    for layer in anew:
        assert sorted(json.dumps(r, default=str) for r in anew[layer].collect()) == sorted(json.dumps(r, default=str) for r in again[layer].collect())
