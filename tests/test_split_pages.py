import json
import os
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from borelake import SnapshotStore, build_national
from borelake.operators.ordinal import with_ordinal
from borelake.sources import landed
from checks.queries import land_pages

from .test_stores import land_national

# Texts that look like the structure of a page.
ODD = ["}", "{", "[", "]", '"', "\\", '\\"', "},{", '"features":[{', '"type":"Feature"', "\n", "é", ",", "😀", " ", '\\\\"}']


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[1], "0")
    yield lambda size: spark.conf.set(names[0], str(size))
    for name, value in before.items():
        spark.conf.set(name, value)


def odd_page(rnd, n, base=0):
    def text():
        return "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 8)))

    def feature(i):
        odd = {text(): [{"a": text()}, [{}], []]}
        point = {"type": "Point", "coordinates": [i, 1.5]}
        return {"geometry": rnd.choice([None, point]), "type": "Feature", "properties": {"eno": i, "name": text(), "odd": odd, text(): text()}}

    members = [
        ("title", text()), ("links", [{"rel": text(), "x": [{}]} for _ in range(rnd.randint(0, 3))]), ("empty", []),
        ("crs", {"type": "name", "properties": {"name": text()}}), ("bbox", [1, 2]), ("mixed", [1, {"b": 2}, text()]),
        ("data", {"features": [feature(-1)]}), ("features", [feature(base + i) for i in range(n)]), ("numberMatched", n),
    ]
    rnd.shuffle(members)
    return dict(members)


def numbered(features):
    """The rows in landed order; raw records as values, since the readers differ in white space alone."""
    found = landed.with_landing_order(features).orderBy("row_no").collect()
    return [{**r.asDict(), "source_attributes": json.loads(r["source_attributes"], object_pairs_hook=list)} for r in found]


@pytest.mark.parametrize("seed, size", [(1, 900), (2, 1 << 27)])
def test_split_pages_give_the_rows_of_whole_pages(spark, tmp_path, small_blocks, seed, size):
    rnd = random.Random(seed)
    for k, (n, indent) in enumerate([(0, None), (1, 2), (12, 1), (15, None)]):
        with open(tmp_path / f"{k}.json", "w") as out:
            out.write(json.dumps(odd_page(rnd, n, k * 100), indent=indent, ensure_ascii=bool(k % 2)) + "\n" * (k % 2))
    (tmp_path / "9.json").write_text("")
    small_blocks(size)
    whole = numbered(landed.read_header_features(spark, str(tmp_path)))
    assert [r["eno"] for r in whole] == [str(i) for i in [100, *range(200, 212), *range(300, 315)]]
    assert numbered(landed.read_header_features(spark, str(tmp_path), split=True)) == whole


def test_pages_that_follow_each_other_in_a_file(spark, tmp_path, small_blocks):
    rnd = random.Random(4)
    (tmp_path / "1.json").write_text("\n".join(json.dumps(odd_page(rnd, n, 10 * n)) for n in (3, 0, 2)) + "\n")
    small_blocks(200)
    path = str(tmp_path)
    split = numbered(landed.read_header_features(spark, path, split=True))
    assert [r["eno"] for r in split] == ["30", "31", "32", "20", "21"]
    assert split == numbered(landed.read_header_features(spark, path, multi_line=False))


def test_a_large_page_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    with open(tmp_path / "1.json", "w") as out:
        json.dump({"features": [{"properties": {"eno": i, "name": "x" * 200}} for i in range(5000)]}, out)
    assert os.path.getsize(tmp_path / "1.json") > 1_000_000
    small_blocks(100_000)
    features = landed.read_header_features(spark, str(tmp_path), split=True)
    assert features.select("_block").distinct().count() > 5
    total = features.agg(F.count(F.lit(1)), F.sum(F.col("eno").cast("int"))).first()
    assert tuple(total) == (5000, sum(range(5000)))


@pytest.mark.parametrize("cut", [1, 2, 30, 200])
def test_a_page_that_breaks_off_is_an_error(spark, tmp_path, cut):
    whole = json.dumps({"features": [{"properties": {"eno": i, "name": "}"}} for i in range(20)], "bbox": [1, 2]})
    (tmp_path / "1.json").write_text(whole[:-cut])
    if cut == 1:  # only the root's own brace is missing, so every feature is there
        assert landed.read_header_features(spark, str(tmp_path), split=True).count() == 20
    else:
        with pytest.raises(ValueError, match="1.json"):
            landed.read_header_features(spark, str(tmp_path), split=True)


def test_elements_that_are_no_objects_and_pages_without_features(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"features": [null, 3, {"properties": {"eno": 7}}, null], "links": [{"eno": 1}]}')
    (tmp_path / "2.json").write_text('{"links": [{"properties": {"eno": 8}}], "features": []}')
    (tmp_path / "3.json").write_text("{}")
    assert [r["eno"] for r in landed.read_header_features(spark, str(tmp_path), split=True).collect()] == ["7"]


def test_a_national_build_over_split_pages(spark, tmp_path):
    land_national(tmp_path / "ga")
    stores = [SnapshotStore(spark, str(tmp_path / name)) for name in ("whole", "split")]
    whole, split = (
        build_national(store, str(tmp_path / "ga"), split=bool(i)) for i, store in enumerate(stores)
    )
    assert stores[1].entry("ga-headers")["server_fingerprint"] == stores[0].entry("ga-headers")["server_fingerprint"] == "3"
    for layer in whole:
        without = [c for c in whole[layer].columns if c != "source_attributes"]
        assert split[layer].columns == whole[layer].columns
        assert sorted(map(repr, split[layer].select(without).collect())) == sorted(map(repr, whole[layer].select(without).collect()))


def test_text_of_pages_is_not_shuffled(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"features": [{"properties": {"eno": i}} for i in range(50)]}))
    features = landed.read_header_features(spark, str(tmp_path), split=True)
    plan = features._jdf.queryExecution().executedPlan().toString()
    within = plan[plan.index("MapInArrow"):plan.index("FileScan text")]
    assert "BroadcastHashJoin" in within and "hashpartitioning" not in plan[:plan.index("FileScan text")]
    assert features.count() == 50


@pytest.mark.parametrize("seed, size, batch", [(5, 300, "1"), (6, 1 << 27, "3")])
def test_runs_that_go_on_in_later_batches(spark, tmp_path, small_blocks, seed, size, batch):
    rnd = random.Random(seed)
    for k, n in enumerate([3, 0, 6]):
        (tmp_path / f"{k}.json").write_text(json.dumps(odd_page(rnd, n, k * 100), indent=k or None))
    small_blocks(size)
    whole = numbered(landed.read_header_features(spark, str(tmp_path)))
    assert len(whole) == 9
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert numbered(landed.read_header_features(spark, str(tmp_path), split=True)) == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_landed_pages_end_with_their_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("borelake.operators.ordinal.TASK_ROWS", 100)
    rows = spark.range(1003).select(
        F.col("id").alias("row_no"), F.lit(None).cast("struct<type:string,coordinates:array<double>>").alias("geometry"),
        F.struct(F.col("id").alias("eno"), F.lit('"}\n').alias("name")).alias("properties"),
    )
    assert with_ordinal(rows.select("row_no"), ["row_no"]).rdd.getNumPartitions() >= 10
    path = land_pages(SimpleNamespace(spark=spark), rows.repartition(3), 7)
    pages = landed.read_pages(spark, path, multi_line=False).select("numberMatched", F.size("features").alias("n")).collect()
    assert all(r["numberMatched"] == r["n"] <= 7 for r in pages) and len(pages) >= 1003 / 7
    for split in (False, True):
        found = landed.read_header_features(spark, path, multi_line=False, split=split)
        read = landed.with_landing_order(found).orderBy(F.col("eno").cast("int")).collect()
        assert [r["eno"] for r in read] == [str(i) for i in range(1003)]
        assert {r["name"] for r in read} == {'"}\n'}
