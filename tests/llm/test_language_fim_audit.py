"""Language identification, fill-in-middle and the filter audit."""

import hashlib
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from borelake.llm import filter_audit, fim, langid
from borelake.llm.common import bounded_rows, labelled_sample
from borelake.llm.queries import ORACLES, QUERIES
from checks.compare import compare, duckdb_over
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


# Fill-in-middle --------------------------------------------------------------------------------


def brute_fim(doc_id, text):
    """n, form, prefix and middle characters, output text."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or re.search("<[PSM]>", text):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fim_rows(docs):
    want = []
    for doc_id, text in docs:
        n, form, p, m, out = brute_fim(doc_id, text)
        want.append((doc_id, n, form, p, m, sha(out), sha(text or "")))
    return sorted(want, key=repr)


TEXT = st.text(alphabet=st.sampled_from("ab\n<>PSM🚀é "), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.integers(-(1 << 63), (1 << 63) - 1)), TEXT, st.integers(1, 9))
def test_output_and_restored_text(doc_id, text, size):
    *_, want = brute_fim(doc_id, text)
    form, out = fim.transform(doc_id, text)
    assert out == want and fim.restore(out, form) == text
    # the same through pieces and fragments of any size
    data = text.encode()
    cut = fim.cut_text(doc_id, data)
    pieces = list(fim.output_pieces(data, cut, size))
    assert b"".join(pieces) == want.encode()
    reader, found = fim.Reader(form), []
    for at in range(0, len(want.encode()), size):
        found += reader.feed(want.encode()[at : at + size])
    found += reader.feed(b"", last=True)
    assert b"".join(piece for _, piece in sorted(found)) == data


def test_fim_of_odd_documents(spark, odd, monkeypatch):
    marked = [(20, "a\nb <P> c\n"), (21, "<S"), (22, "<S\n>\n<\nP>\n"), (23, "\n" * 50), (24, "line\n" * 60_000)]
    more = spark.createDataFrame(marked, "doc_id bigint, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    found = sorted((tuple(r) for r in fim.fim_digests(docs).collect()), key=repr)
    assert found == fim_rows([r[:2] for r in ROWS] + marked)
    assert fim.fim_digests(odd.where("false")).collect() == []
    texts = fim.fim_texts(odd)
    assert texts.columns == [*odd.columns, "fim_form", "fim_text"]
    assert sorted((r.fim_form, r.fim_text) for r in texts.collect()) == sorted(
        (w[1], w[4]) for w in (brute_fim(*r[:2]) for r in ROWS)
    )


def test_one_row_repeated_many_times(spark):
    df = spark.range(0, 6000, 1, 12).selectExpr("7L AS doc_id", "'one\ntwo\nthree\n' AS text")
    assert df.count() == 6000
    found = fim.fim_digests(df).groupBy("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").count()
    assert [tuple(r) for r in found.collect()] == [(*fim_rows([(7, "one\ntwo\nthree\n")])[0], 6000)]
    # the repeats of one input partition alone share a key
    assert fim.pieces(df).select("key").distinct().count() == 12


def test_restoring_sorts_without_a_second_exchange(odd):
    plan = fim.fim_digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1 and plan.count("Sort [key") == 2


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_filter_audit"])
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duckdb_over(SF), ORACLES[name]) == []


# Filter audit ----------------------------------------------------------------------------------


def brute_audit(docs, good, toxic):
    """All counts by walking every order over every document."""
    def fails(doc_id, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {f for f, failed in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(t == text and i is not None and i < doc_id for i, t, _ in docs),
        }.items() if failed}

    docs = [(i, t or "", p or "") for i, t, p in docs]
    failed = [(i, p, fails(i, t)) for i, t, p in docs]
    want, total = {}, {}
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                hit = sum(name in f for _, f in mine)
                want[part, "".join(order), step] = (
                    len(left), len(gone), hit - len(gone), sum(f == {name} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name,
                )
                total[part, name] = total.get((part, name), 0) + len(gone)
    return sorted((*k, *v[:6], total[k[0], v[6]]) for k, v in want.items())


def test_audit_of_odd_documents(spark, odd, labels):
    extra = [
        (30, "SHOUT " * 120, "en"), (31, "SHOUT " * 120, "de"), (32, " ".join(map(str, range(150))), None),
        (33, " ".join(map(str, range(150))) + " #", "en"), (None, "SHOUT " * 120, "en"), (30, "another text", "en"),
    ]
    more = spark.createDataFrame(extra, "doc_id bigint, text string, lang string")
    docs = odd.select("doc_id", "text", "lang").unionByName(more)
    marks = labels.collect()
    good = {r.doc_id for r in marks if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in marks if r.toxic == 1 and r.doc_id is not None}
    rows = [(r[0], r[1], r[2]) for r in ROWS] + extra
    found = sorted(tuple(r) for r in filter_audit.audit(docs, labels).collect())
    assert found == brute_audit(rows, good, toxic)
    assert filter_audit.audit(docs.where("false"), labels).collect() == []


def test_audit_of_own_filters_and_orders(spark, labels):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "ab", "x"), (2, "a", "x"), (3, "b", None)], "doc_id bigint, text string, lang string")
    conditions = {"p": F.col("text").contains("a"), "q": F.col("text").contains("b")}
    rows = filter_audit.audit(df, labels, conditions=conditions, copies=None, orders=["qp"]).collect()
    assert {(r.part, r.step, r.kept, r.removed, r.redundant, r.unique_fails) for r in rows} == {
        ("x", 1, 1, 1, 0, 0), ("x", 2, 0, 1, 1, 1), ("", 1, 0, 1, 0, 1), ("", 2, 0, 0, 0, 0),
    }
    with pytest.raises(ValueError, match="one-letter"):
        filter_audit.audit(df, labels, conditions={"long": F.lit(True)})


# Language identification -----------------------------------------------------------------------

WORDS = {
    "en": "the and of that with which have from they this would there their what about out",
    "de": "der die und den von das nicht mit dem sich auch auf für werden aus durch über",
    "fr": "les des que une dans pour qui sur pas avec sont mais nous comme cette être",
    "es": "los del que una con para las por como más pero sus este entre también hasta",
}


def prose(lang, seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang].split(), n))


def test_held_out_accuracy_of_the_whole_table(spark):
    found = QUERIES["op11_language_id"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang is not None]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_languages_of_odd_documents(spark, odd):
    rows = [(100 + 4 * i + k, prose(lang, 9 * i + k), lang) for i in range(30) for k, lang in enumerate(WORDS)]
    rows += [(900, prose("fr", 900), "en"), (900, prose("es", 901), "en"), (901, "123 ... !!", "en"), (902, None, "de")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = langid.predict(df.unionByName(odd.select("doc_id", "text", "lang"))).collect()
    assert len(found) == len(rows) + len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows if i < 900)
    assert {by_id[i].lang_pred for i in (901, 902, 4, 5, 6)} == {"und"} and by_id[901].score == 0.0
    assert {r.lang_pred for r in found} <= {*WORDS, "und"}
    assert langid.predict(df.where("false")).collect() == []
    unlearned = langid.predict(df.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang"))
    assert {(r.lang_pred, r.score) for r in unlearned.collect()} == {("und", 0.0)}


def test_one_language_needs_no_machine(spark):
    df = spark.createDataFrame([(i, prose("en", i), "en") for i in range(8)], "doc_id bigint, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.predict(df).collect()} == {("en", 1.0)}


def test_counts_cover_the_whole_text(monkeypatch):
    text = "über die Brücke; " * 400
    whole = langid.counts(text)
    letters = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    assert whole.sum() == sum(len(letters) - n for n in range(langid.GRAMS))
    monkeypatch.setattr(langid, "_WINDOW", 64)
    assert (langid.counts(text) == whole).all()
    assert langid.counts(" 12 _ ") is None


def test_machine_separates_what_can_be_separated():
    rng = np.random.default_rng(3)
    rows, signs = [], []
    for i in range(200):
        side = 1 if i % 2 else -1
        at = np.sort(rng.choice(50, 10, replace=False)) + (0 if side > 0 else 40)
        rows.append((at, np.full(10, 0.1**0.5, np.float32)))
        signs.append(side)
    weights = langid.fit(rows, np.array(signs, float))
    right = [np.sign(x @ weights[at] + weights[-1]) == s for (at, x), s in zip(rows, signs, strict=True)]
    assert np.mean(right) > 0.97


def test_votes_decide_within_a_family():
    size = (1 << langid.BITS) + 1
    toward = {("a", "b"): 1.0, ("a", "c"): -0.1, ("b", "c"): -0.1}  # c wins two votes, a has the larger sum
    model = langid.Model({p: np.r_[np.zeros(size - 1), m] for p, m in toward.items()}, {"f": ["a", "b", "c"]})
    assert model.predict("some text")[0] == "c"


# Bounded samples -------------------------------------------------------------------------------


def test_sample_bounds_rows_and_bytes(spark):
    many = spark.range(30_000).selectExpr("5L AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(5, 1)], "doc_id bigint, quality int")
    some = labelled_sample(many, labels, "quality", 5, 4, 1200).collect()
    assert len(some) == 1200 and {(r.doc_id, r.label) for r in some} == {(5, 1)}
    again = labelled_sample(many.repartition(7), labels, "quality", 5, 4, 1200).collect()
    assert sorted(some) == sorted(again)
    repeated = spark.range(9000).selectExpr("id % 3 AS doc_id", "'same' AS text", "id % 3 AS label")
    assert bounded_rows(repeated, 100).count() == 3
    assert bounded_rows(repeated.selectExpr("doc_id", "text", "label"), 1, within="label").count() == 3
    sized = bounded_rows(many.select("doc_id", "text"), 1000, most_bytes=500).collect()
    assert 0 < sum(len(r.text) for r in sized) <= 500
    assert bounded_rows(many.where("false"), 10).collect() == []
