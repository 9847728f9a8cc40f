"""Learners and counts against plain versions of themselves."""

import math
from itertools import product

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from borelake.llm import ftrl, line_crf
from borelake.llm.common import table
from borelake.llm.queries import PIECES, QUERIES

SF = "/root/testdata/sf0.001"


def test_ftrl_follows_the_published_update_row_by_row():
    """FTRL-proximal of one coordinate at a time, on plain dictionaries."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(80):
        label = i % 2
        some = rng.choice(np.arange(1, 40) + 30 * label, 12, replace=False)
        rows.append((np.sort(np.append(some, 0)).astype(np.int32), label))
    z, n = {}, {}

    def weight(i):
        zi, bound = z.get(i, 0.0), 0.0 if i == 0 else ftrl.L1
        if abs(zi) <= bound:
            return 0.0
        return -(zi - math.copysign(bound, zi)) / ((ftrl.BETA + math.sqrt(n.get(i, 0.0))) / ftrl.ALPHA + ftrl.L2)

    for _ in range(2):
        for found, label in rows:
            w = {i: weight(i) for i in found.tolist()}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - label
            for i in w:
                rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / ftrl.ALPHA
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
    learned = ftrl.learn(rows, epochs=2)
    for i in range(80):
        assert learned[i] == pytest.approx(weight(i), abs=1e-9)
    assert 0 < np.count_nonzero(learned) < 70 and not learned[80:].any()


def test_features_are_the_grams_and_skip_grams_of_a_text():
    memo = ftrl.WordHashes()
    texts = ["one two three four two", "", "one", "ONE two"]
    found = ftrl.features(texts, memo)
    assert found[1].tolist() == [0] and len(found[2]) <= 2
    words = texts[0].split()
    grams = {(1, w) for w in words} | {(s, w[:s]) for w in words for s in ftrl.STEMS if len(w) > s}
    grams |= {("two", *p) for p in zip(words, words[1:], strict=False)} | {("three", *p) for p in zip(words, words[1:], words[2:], strict=False)}
    grams |= {("skip", *p) for p in zip(words, words[2:], strict=False)}
    assert len(found[0]) == len(grams) + 1  # and the bias
    shared = set(found[3].tolist()) & set(found[0].tolist())
    assert len(shared) == 4  # bias, both words, and the pair
    again = ftrl.features(texts[::-1], ftrl.WordHashes())
    assert [a.tolist() for a in again[::-1]] == [f.tolist() for f in found]


def likelihood(x, counts, labels, theta):
    """Mean log-likelihood per line and document, by enumeration of all labellings."""
    weights, links, at, total = theta[:-4], theta[-4:].reshape(2, 2), 0, 0.0
    for n, label in zip(counts, labels, strict=True):
        energy = x[at : at + n] @ weights

        def score(ys, energy=energy):
            return sum(e * y for e, y in zip(energy, ys, strict=True)) + sum(links[a, b] for a, b in zip(ys, ys[1:], strict=False))

        whole = np.logaddexp.reduce([score(ys) for ys in product((0, 1), repeat=n)])
        total += (score((label,) * n) - whole) / n / len(counts)
        at += n
    return total - line_crf.DECAY / 2 * float(theta @ theta)


def test_field_is_fitted_to_the_likelihood(monkeypatch):
    rng = np.random.default_rng(7)
    counts, labels = np.array([3, 1, 4, 2, 3]), np.array([1, 0, 1, 0, 0])
    x = rng.normal(size=(counts.sum(), 3)) + np.repeat(labels, counts)[:, None]
    monkeypatch.setattr(line_crf, "STEPS", 3000)
    weights, links = line_crf.fit(x, counts, labels)
    theta = np.r_[weights, links.ravel()]
    best = likelihood(x, counts, labels, theta)
    assert best > likelihood(x, counts, labels, np.zeros_like(theta))
    for i in range(len(theta)):  # no direction leads further up
        for step in (-0.05, 0.05):
            moved = theta.copy()
            moved[i] += step
            assert likelihood(x, counts, labels, moved) <= best + 1e-4


def test_document_score_is_the_weighted_mean_of_enumerated_marginals():
    rng = np.random.default_rng(9)
    weights, links = rng.normal(size=3 * line_crf.OWN) / 4, rng.normal(size=(2, 2))
    docs = ["A line of text.\nBUY NOW!!! | | |\nAnother line, of words.", "", "one\n\n\ntwo", "alone"]
    scores = line_crf.document_scores(docs, weights, links)
    for doc, found in zip(docs, scores, strict=True):
        own, size, counts = line_crf.line_features([doc])
        energy = line_crf.with_neighbours(own, counts) @ weights
        labellings = list(product((0, 1), repeat=len(energy)))
        p = np.exp([sum(e * y for e, y in zip(energy, ys, strict=True)) + sum(links[a, b] for a, b in zip(ys, ys[1:], strict=False)) for ys in labellings])
        good = np.array(labellings).T @ p / p.sum()
        assert found == pytest.approx(float((good * size).sum() / size.sum()))


def test_piece_counts_of_the_whole_table(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op4_token_counts"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in docs.items()
    }


def test_pipeline_end_to_end(spark):
    """Every stage's rows follow from the one before: kept texts are its own, and none is lost without cause."""
    import re

    import public_tokenizers
    from borelake.llm.bpe import Encoder
    from borelake.llm.queries import RANKS
    from tests.llm.test_dedup import brute_components, brute_fingerprint

    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.park(stage(spark, docs, SF), name)
        kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    scores = {r.doc_id: r.predicted for r in QUERIES["op10_line_crf_quality"](spark, SF).collect()}
    assert set(kept["quality"]) == {i for i, p in scores.items() if p == 1}
    firsts = {}
    for i in sorted(kept["quality"]):
        firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept["quality"][i]), i)
    assert set(kept["exact_dedup"]) == set(firsts.values())
    ids = sorted(kept["exact_dedup"])
    roots = brute_components([brute_fingerprint(kept["exact_dedup"][i]) for i in ids], ids)
    assert set(kept["near_dedup"]) == set(roots)
    assert set(kept["mix"]) <= set(kept["near_dedup"])
    lines = open(RANKS, "rb").read()
    encoder = Encoder(lines, public_tokenizers.PATTERN)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: bytes(r.ids) for r in rows} == {i: encoder.encode(t) for i, t in kept["mix"].items()}
