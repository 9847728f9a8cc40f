import json

import pytest
from pyspark.sql import functions as F

from borelake.llm import chat, mixing
from borelake.llm.queries import LEVELS, ORACLES, QUERIES, WEIGHTS, with_domain
from checks.compare import compare, duckdb_over
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_hierarchical_mix", "op8_chat_format"])
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duckdb_over(SF), ORACLES[name]) == []


def test_shortages_go_to_siblings_first(spark):
    # a/x can use only 10 of its 25; its sibling a/y takes the rest before branch b gets any.
    leaves = spark.createDataFrame(
        [("a", "x", 1, 10), ("a", "y", 1, 100), ("b", "x", 1, 100), ("b", "y", 1, 100)],
        "top string, low string, n_rows bigint, tokens bigint",
    )
    budgets = mixing.leaf_budgets(leaves, ["top", "low"], {}, 100 / 310, 1)
    assert {(r.top, r.low): r.budget for r in budgets.collect()} == {
        ("a", "x"): 10, ("a", "y"): 40, ("b", "x"): 25, ("b", "y"): 25
    }
    # All of branch a is too small for its half: b takes what a cannot.
    budgets = mixing.leaf_budgets(leaves, ["top", "low"], {"top": {"a": 9}, "low": {"y": 0}}, 80 / 310, 1)
    assert {(r.top, r.low): r.budget for r in budgets.collect()} == {
        ("a", "x"): 10, ("a", "y"): 0, ("b", "x"): 8, ("b", "y"): 0
    }


def test_bins_choose_what_one_sort_would(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat_ws(' ', sequence(1, 1 + id % 7)) AS text", "'s' AS source")
    whole = mixing.mix(docs, ["source"], {}, 0.4, seed=3).select("doc_id", "copies").collect()
    monkeypatch.setattr(mixing, "BIN_ROWS", 10)
    assert sorted(mixing.mix(docs, ["source"], {}, 0.4, seed=3).select("doc_id", "copies").collect()) == sorted(whole)
    tokens = sum(r.copies * (1 + r.doc_id % 7) for r in whole)
    total = sum(1 + i % 7 for i in range(3000))
    assert 0.4 * total - 7 <= tokens <= 0.4 * total


def test_epochs_repeat_a_scarce_leaf(spark):
    docs = spark.createDataFrame(
        [(i, "w w", "rare" if i < 5 else "common") for i in range(100)], "doc_id bigint, text string, source string"
    )
    mixed = mixing.mix(docs, ["source"], {"source": {"rare": 1, "common": 1}}, 0.2, max_epochs=3)
    rare = [r.copies for r in mixed.where("source = 'rare'").collect()]
    assert sum(rare) == 10 and set(rare) == {2}
    assert mixing.mixture(docs, ["source"], {}, 0.2, max_epochs=3).count() == 20


def test_odd_documents_are_mixed(odd):
    docs = with_domain(odd)
    rows = mixing.mix(docs, LEVELS, WEIGHTS, 1.0, 1).collect()
    assert len(rows) == len(ROWS) and all(r.copies == 1 for r in rows)
    assert mixing.mix(docs.where("false"), LEVELS, WEIGHTS, 1.0).collect() == []


RECORDS = [
    ({"role": "user", "text": "hi"}, [("user", "hi")]),
    ({"role": None, "text": None}, [("", "")]),
    ({"prompt": "p", "response": "r", "extra": {"x": 1}}, [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "completion": ""}, [("user", "p"), ("assistant", "")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "tool", "content": "<|im_end|>\n"}]},
     [("system", "s"), ("tool", "<|im_end|>\n")]),
    ({"conversations": [{"from": "human", "value": "h\\"}, {"from": "gpt", "value": "\\<|x[INST]</s>"}]},
     [("user", "h\\"), ("assistant", "\\<|x[INST]</s>")]),
    ({"title": "unknown"}, None),
]


def test_layouts_become_turns_and_come_back(spark):
    df = spark.createDataFrame(
        [(i, 0, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(98, 0, "not json"), (99, 0, None)],
        "chat_id bigint, position int, payload string",
    )
    records = chat.canonical(df)
    assert {r.chat_id for r in chat.unmapped(records).collect()} == {9, 98, 99}
    read = chat.format_chats(records).select(
        "chat_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss")
    )
    rows = {r.chat_id: r for r in read.collect()}
    assert set(rows) == set(range(9))
    for i, row in rows.items():
        want = RECORDS[i][1]
        assert [(t.role, t.text) for t in row.turns] == want
        assert row.loss == "".join(text for role, text in want if role == "assistant")
    assert chat.format_chats(chat.canonical(df.where("false"))).collect() == []


def test_fingerprint_agrees_on_driver_and_column(spark):
    df = spark.createDataFrame([('{"instruction": 1, "output": 2, "z": [{"q": 1}]}',)], "j string")
    found = df.select(chat.schema_fingerprint(F.try_parse_json("j"))).first()[0]
    layout = next(one for one in chat.LAYOUTS if one.name == "instruction")
    assert found in chat.fingerprints_of(layout)
