import hashlib
import re

import numpy as np
import pytest
import xxhash

from borelake.llm import bloom_dedup, simhash_gray
from borelake.llm.queries import QUERIES
from checks.compare import duckdb_over
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_equal_texts_of_odd_documents(odd):
    rows = bloom_dedup.duplicate_groups(odd).collect()
    assert len(rows) == len(ROWS)
    found = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in rows)
    want, groups = [], {}
    for doc_id, text, *_ in ROWS:
        groups.setdefault(normal(text), []).append(doc_id)
    for ids in groups.values():
        ids.sort(key=lambda i: (i is None, i or 0))
        want += [(str(i), str(ids[0]), len(ids), k == 0) for k, i in enumerate(ids)]
    assert found == sorted(want)
    kept = bloom_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if w[3])
    assert bloom_dedup.duplicate_groups(odd.where("false")).collect() == []
    assert bloom_dedup.deduplicate(odd.where("false")).collect() == []


def test_lone_rows_pass_the_filter_without_a_shuffle(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    signed = df.select("doc_id", bloom_dedup.digest(df["text"]).alias("text_sha256"))
    maps, bits = bloom_dedup.repeated_bits(signed)
    tested = bloom_dedup.maybe_repeated(signed, maps, bits)
    assert tested.where("_maybe").count() < 500
    assert "Exchange hashpartitioning" not in tested._jdf.queryExecution().executedPlan().toString()


def brute_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, distance=2):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(len(fps))
    while True:
        fresh = np.array([label[near[i]].min() for i in range(len(fps))])
        if (fresh == label).all():
            break
        label = fresh
    least = {}
    for i, one in zip(ids, label, strict=True):
        if i is not None:
            least[one] = min(i, least.get(one, i))
    return [least.get(one) for one in label]


def check_groups(rows, docs):
    ids, fps = [d[0] for d in docs], [brute_fingerprint(d[1]) for d in docs]
    want = sorted((str(i), f"{f:016x}", str(c)) for i, f, c in zip(ids, fps, brute_components(fps, ids), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_near_groups_of_odd_documents(odd):
    check_groups(simhash_gray.near_groups(odd).collect(), [r[:2] for r in ROWS])
    assert simhash_gray.near_groups(odd.where("false")).collect() == []
    kept = simhash_gray.keep_one(odd)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(map(str, brute_kept(odd.collect())))
    assert simhash_gray.keep_one(odd.where("false")).collect() == []


def brute_kept(rows):
    """The first row of each component, by id (nulls last), then by the digest of id and text."""
    def place(row):
        name = f"{'none' if row.doc_id is None else row.doc_id}:{row.text or ''}"
        return row.doc_id is None, row.doc_id or 0, hashlib.sha256(name.encode()).hexdigest()

    label = brute_components([brute_fingerprint(r.text) for r in rows], list(range(len(rows))))
    return [min((r for r, one in zip(rows, label, strict=True) if one == root), key=place) for root in set(label)]


def test_one_row_of_each_component_stays(spark):
    a, near = "one text about a fox and a dog that is long enough " * 4, "something else entirely, of another kind altogether " * 4
    for rows in (
        [(3, a), (5, a), (5, near)], [(None, a), (5, a), (5, a), (None, near), (None, near)], [(7, a), (7, near), (7, a + "x")],
        [(1, None), (1, ""), (2, "  ")],
    ):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        kept = [tuple(r) for r in simhash_gray.keep_one(df).collect()]
        assert len(kept) == len(set(kept)) and all(k in rows for k in kept)
        want = [tuple(r) for r in brute_kept(df.collect())]
        assert sorted(map(repr, kept)) == sorted(map(repr, want)) or {k[0] for k in kept} == {w[0] for w in want} == {1}


def test_op9_over_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_groups(QUERIES["op9_simhash_gray"](spark, SF).collect(), docs)


def walk(n, seed):
    """Patterns in chains: each a few bits from one before it."""
    rng = np.random.default_rng(seed)
    found = [int(rng.integers(1 << 63))]
    while len(found) < n:
        x = found[rng.integers(len(found))]
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= 1 << int(bit)
        found.append(x)
    return np.array(sorted(set(found)), np.uint64)


def gray_order(fps):
    rank = fps.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        rank ^= rank >> np.uint64(shift)
    return fps[np.argsort(rank)]


@pytest.mark.parametrize("n", [17, 300, 2000])
def test_index_of_one_node_loses_no_link(n):
    fps = gray_order(walk(n, n))
    label = simhash_gray.link_node(fps, 2)
    want = brute_components(fps, list(range(len(fps))))
    assert len(set(zip(label, want, strict=True))) == len(set(label)) == len(set(want))


@pytest.mark.parametrize("limit", [2, 1 << 15])
def test_crowded_nodes_split_and_lose_no_link(spark, limit):
    fps = walk(400, 5)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp bigint")
    found = simhash_gray.components(simhash_gray.close_links(df, 2, limit)).collect()
    root = {r.node: r.root for r in found}
    got = [root.get(int(f), int(f)) for f in fps.view(np.int64)]
    want = brute_components(fps, list(range(len(fps))))
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 200)]
    df = spark.createDataFrame([*path, *star, (5, 5)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in simhash_gray.components(df).collect()} == (
        {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 200)}
    )


def test_op5_matches_sql(spark):
    from borelake.llm.queries import ORACLES
    from checks.compare import compare

    assert compare(QUERIES["op5_bloom_dedup"](spark, SF), duckdb_over(SF), ORACLES["op5_bloom_dedup"]) == []
