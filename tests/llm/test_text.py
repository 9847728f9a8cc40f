import hashlib
import time
from html.parser import HTMLParser

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from borelake.llm import ftrl, html_tree, line_crf, syncmers
from borelake.llm.queries import QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.01"


def brute_syncmers(text, k, s):
    inner = syncmers._mixed(syncmers._rolling(syncmers._mixed(np.array([ord(c) for c in text], np.uint64) + np.uint64(1)), s))
    found = []
    for i in range(len(text) - k + 1):
        window = inner[i : i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            found.append(i)
    return found


def test_syncmers_are_closed_context_free_and_dense():
    text = "".join(chr(97 + int(c)) for c in np.random.default_rng(1).integers(0, 26, 700))
    at, hashes = syncmers.syncmers(text)
    assert at.tolist() == brute_syncmers(text, syncmers.K, syncmers.S)
    assert max(np.diff(at)) <= syncmers.K - syncmers.S
    shifted, again = syncmers.syncmers("some prefix " + text)
    inside = shifted >= 12
    assert (shifted[inside] - 12).tolist() == at.tolist() and (again[inside] == hashes).all()


def test_likeness():
    a = syncmers.sketch(syncmers.syncmers("One text about a brown fox and a dog. " * 3)[1])
    none = syncmers.sketch(syncmers.syncmers("")[1])
    assert syncmers.alike(a, a) == syncmers.alike(none, none) == 1.0
    assert syncmers.alike(a, none) == 0.0
    assert syncmers.alike(a, syncmers.sketch(syncmers.syncmers("q")[1])) == 0.0


def check_edits(rows, docs, ordered=False):
    order = docs if ordered else sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    texts = [d[1] or "" for d in order]
    want = []
    for (doc_id, _), text, following in zip(order, texts, texts[1:] + texts[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_edited_fingerprints_of_odd_documents(odd, spark):
    rows = syncmers.edited_fingerprints(odd).collect()
    check_edits(rows, [r[:2] for r in ROWS])
    one = spark.createDataFrame([(5, "alone")], "doc_id bigint, text string")
    assert [r.near_next for r in syncmers.edited_fingerprints(one).collect()] == [1.0]
    assert syncmers.edited_fingerprints(odd.where("false")).collect() == []
    assert syncmers.fingerprints(odd).count() == syncmers.anchors(odd).count() == len(ROWS)


@pytest.mark.parametrize("ids", [
    [*range(2000), 1 << 62], [-(1 << 63), (1 << 63) - 1, 0, -1], [None] * 500, [7] * 900, [None, 3, 3, -5] * 40, [],
])
def test_any_ids_are_cut_into_parts(spark, ids):
    docs = [(doc_id, f"text number {i} " * (1 + i % 3)) for i, doc_id in enumerate(ids)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    docs.sort(key=lambda d: (d[0] is None, -(d[0] or 0), hashes[d[1]]))
    rows = syncmers.edited_fingerprints(df).collect()
    check_edits(rows, docs, ordered=True)
    if len(docs) >= 500:
        sent = syncmers.with_next(df).groupBy("part", "extra").count().collect()
        parts = [r["count"] for r in sent if not r.extra]
        assert len(parts) > 8 and max(parts) < len(docs) / 4 and sum(parts) == len(docs)
        assert [r["count"] for r in sent if r.extra] == [1] * len(parts)


def test_likeness_follows_the_order_of_anchors():
    rng = np.random.default_rng(4)
    a, b = (rng.choice(1000, 60, replace=False).astype(np.uint32) for _ in range(2))
    for x, y in ((a, b), (a, rng.permutation(a)), (a, np.r_[b[:20], a[20:]]), (a, a[::-1])):
        union = sorted({*x.tolist(), *y.tolist()})[:50]
        kept = [[h for h in z.tolist() if h in union] for z in (x, y)]
        best = np.zeros((len(kept[0]) + 1, len(kept[1]) + 1), int)
        for i, h in enumerate(kept[0]):
            for j, g in enumerate(kept[1]):
                best[i + 1, j + 1] = best[i, j] + 1 if h == g else max(best[i, j + 1], best[i + 1, j])
        assert syncmers.alike(x, y, 50) == pytest.approx(best[-1, -1] / len(union))
    hashes = (rng.integers(0, 400, 5000).astype(np.uint64) << np.uint64(32)) | np.uint64(9)
    short, order = (hashes >> np.uint64(32)).tolist(), []
    for h in short:
        if h in sorted(set(short))[:64] and h not in order:
            order.append(h)
    assert syncmers.sketch(hashes, 64).tolist() == order


def test_op1_over_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op1_syncmer_fingerprints"](spark, SF).collect()
    check_edits(rows, docs)
    prints, texts = {r.doc_id: r.fingerprint for r in rows}, {}
    for doc_id, text in docs:
        assert texts.setdefault(text, prints[doc_id]) == prints[doc_id]
    assert np.mean([r.near_edited for r in rows]) > 0.3 > 0.01 > np.mean([r.near_next for r in rows])


@pytest.mark.parametrize("module, query, label, least", [
    (ftrl, "op6_ftrl_toxicity", "toxic", 0.88), (line_crf, "op10_line_crf_quality", "quality", 0.95),
])
def test_classifiers(spark, odd, labels, module, query, label, least):
    rows = QUERIES[query](spark, "/root/testdata/sf0.1").collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([p == t for p, t in held]) > least
    found = module.score(odd, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    assert module.score(odd.where("false"), labels).collect() == []
    assert {r.score for r in module.score(odd, labels.where("false")).collect()} == {0.5}


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    counts = np.array([3, 1, 4])
    energy, links = rng.normal(size=8), rng.normal(size=(2, 2))
    good, (left, pair) = line_crf.marginals(energy, counts, links)
    at = 0
    for n in counts:
        labels = np.array(np.meshgrid(*[[0, 1]] * n)).reshape(n, -1).T
        score = labels @ energy[at : at + n] + np.array([sum(links[a, b] for a, b in zip(y, y[1:], strict=False)) for y in labels])
        p = np.exp(score) / np.exp(score).sum()
        assert np.allclose(good[at : at + n], p @ labels)
        for k in range(n - 1):
            i = left.tolist().index(at + k)
            assert np.isclose(pair[i, 1, 0], p[(labels[:, k] == 1) & (labels[:, k + 1] == 0)].sum())
        at += n


LONG = "Hello, world, this is a fairly long paragraph of text, with commas, and more."
PAGES = [
    (f"<body><div class='menu'><a href=x>a</a></div><div id=content><h2>T</h2><p>{LONG}</p><p>short</p><ul><li>one"
     f"<li>two</ul></div><div id='comments'><p>{LONG}</p></div><footer><p>x</p></footer></body>",
     f"T\n{LONG}\nshort\none\ntwo"),
    ("", ""), ("plain text &amp; more", "plain text & more"), ("<p>a<b>b</b>c<p>d", "abc\nd"),
    ("<html><body><nav><p>x</p></nav></body></html>", ""), ("<div><p>" * 20_000 + "deep", "deep"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<article><header><h1>x</h1></header><p>body &lt;b&gt; &#233; &nbsp; z</p><form><p>f</p></form>"
     "<script>if(a<b){}</script></article>", "body <b> é z"),
    ("<p>a <!-- x > --> b<br>c</p><p title='>'>d", "a b c\nd"), ("<p>cut <b", "cut"), ("1 < 2 & 3 > 2", "1 < 2 & 3 > 2"),
    (f"<aside><p>{LONG}</p></aside><main><section><p>{LONG}</p></section><section><p>tail</p></section></main>", f"{LONG}\ntail"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_main_text(page, want):
    assert html_tree.main_text(page) == want


PARA = "<p>Some running text, with commas, that goes on for quite a while, as a paragraph of an article does.</p>"


@pytest.mark.parametrize("page, lines", [
    (f'<article class="post has-sidebar">{PARA * 3}</article>', 3),
    (f'<div class="post-hidden-gems">{PARA * 3}</div>', 3),
    (f'<article>{PARA}<section class="related-work">{PARA}</section><p class="notice-period">{PARA[3:]}</article>', 3),
    (f'<body><div class="content-sidebar">{PARA * 4}</div></body>', 4),
    (f'<article>{PARA}</article><section id="comments">{PARA * 9}</section>', 1),
    (f'<article>{PARA}<div class="ad">{PARA * 4}</div><div class="related-posts">{PARA}</div></article>', 1),
    (f'<div class="siteFooter">{PARA}</div><div id="main">{PARA * 2}</div><aside>{PARA}</aside>', 2),
    (f'<div class="comments-area">{PARA * 3}</div>', 0),
])
def test_names_of_elements(page, lines):
    text = html_tree.main_text(page)
    assert len(text.splitlines()) == lines


def test_work_is_linear_in_depth():
    began = time.perf_counter()
    assert html_tree.main_text("<div>word" * 50_000).count("\n") == 49_999
    html_tree.main_text("<p><table><td>" + "<div>x" * 50_000 + "</section>" * 50_000 + "</i>" * 50_000)
    html_tree.main_text("<b>x" * 50_000 + "</i>" * 50_000)
    assert time.perf_counter() - began < 5


class BruteTree(HTMLParser):
    """A tree of well-formed markup, scored as the method says, ancestor by ancestor."""

    def __init__(self, page):
        super().__init__()
        self.nodes, self.at = [("#root", None)], [0]
        self.blocks, self.links = [], 0
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += 1
        else:
            self.nodes.append((tag, self.at[-1]))
            self.at.append(len(self.nodes) - 1)
            self.blocks.append(None)

    def handle_endtag(self, tag):
        if tag == "a":
            self.links -= 1
        else:
            self.at.pop()
            self.blocks.append(None)

    def handle_data(self, data):
        if not self.blocks or self.blocks[-1] is None:
            self.blocks.append([self.at[-1], "", 0])
        self.blocks[-1][1] += data
        self.blocks[-1][2] += len(data) if self.links else 0

    def ancestors(self, node):
        while node is not None:
            yield node
            node = self.nodes[node][1]

    def text(self):
        blocks = [(o, " ".join(t.split()), n) for o, t, n in filter(None, self.blocks) if t.split()]
        chars, linked, points = ([0.0] * len(self.nodes) for _ in range(3))
        for owner, text, n in blocks:
            tag = self.nodes[owner][0]
            for level, node in enumerate(self.ancestors(owner)):
                chars[node] += len(text)
                linked[node] += min(n, len(text))
            if not tag.startswith("h") and tag != "li":
                first = self.nodes[owner][1] if tag in html_tree.PARAGRAPHS else owner
                for level, node in enumerate(self.ancestors(first)):
                    points[node] += (1 + text.count(",") + min(len(text) // 100, 3)) / 2**level
        score = {
            i: points[i] * (1 - linked[i] / chars[i]) for i, (tag, _) in enumerate(self.nodes)
            if chars[i] and tag not in html_tree.PARAGRAPHS
        }
        if not score:
            return ""
        best = max(score, key=score.get)
        if score[best] == 0:
            best = next((i for i in score if self.nodes[i][0] in ("article", "main")), best)
        around = [i for i in self.ancestors(best) if self.nodes[i][0] == "article"]
        inner = [i for i in self.ancestors(best) if self.nodes[i][0] == "main"]
        best = (around or inner[:1] or [best])[-1]
        kept = {best}
        for i, (tag, up) in enumerate(self.nodes):
            if i != best and chars[i] and up is not None and up == self.nodes[best][1]:
                if tag == "p" and chars[i] > 80 and linked[i] < 0.25 * chars[i] or score.get(i, -1) >= score[best] / 5:
                    kept.add(i)
        return "\n".join(t for o, t, _ in blocks if kept.intersection(self.ancestors(o)))


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.integers(1, 5)):
        kind = rng.choice(["div", "section", "article", "main", "p", "p", "p", "h2", "text"])
        words = ", ".join("word" * int(rng.integers(1, 9)) for _ in range(rng.integers(1, 25)))
        if kind in ("p", "h2"):
            out.append(f"<{kind}>{words}</{kind}>" if rng.random() < 0.7 else f"<{kind}>{words} <a>{words}</a></{kind}>")
        elif kind == "text" or depth > 4:
            out.append(words if rng.random() < 0.5 else f"<a>{words}</a>")
        else:
            out.append(f"<{kind}>{random_page(rng, depth + 1)}</{kind}>")
    return "".join(out)


def test_scores_match_a_walk_of_every_ancestor():
    rng = np.random.default_rng(11)
    for _ in range(300):
        page = random_page(rng)
        assert html_tree.main_text(page) == BruteTree(page).text()


def test_links_lower_a_container():
    links = "".join(f"<p><a href=/{i}>{LONG}</a></p>" for i in range(9))
    assert html_tree.main_text(f"<div>{links}</div><div><p>{LONG}</p><p>{LONG}</p></div>") == f"{LONG}\n{LONG}"


def test_extract_of_odd_pages(spark):
    rows = [(1, None, None, 2), (1, "u", "<p>x", 2), (1, "u", "<p>x", 2), (None, "u", "<p>y</p>", 3)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = html_tree.extract(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == [("1", "", 0), ("1", "x", 1), ("1", "x", 1), ("None", "y", 1)]
    assert html_tree.extract(df.where("false")).collect() == []
    assert QUERIES["op7_html_main_text"](spark, SF).count() == 250


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, columns = [], docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.park(stage(spark, docs, SF), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before, names = docs.count(), [*names, name]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == last.where("round_trip").count() == before
    assert "pipeline" in entry.queries() and sum(q.startswith("op") for q in QUERIES) == 13


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.park(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.where("NOT round_trip").count() == 0
