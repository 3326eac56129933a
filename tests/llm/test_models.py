"""op1, op4 and op8: held-out accuracy, brute-force statistics and the defined cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from episcope.llm import page_text as H
from episcope.llm import quality_rules as Q
from episcope.llm import toxicity as X
from episcope.llm.dom import blocks
from episcope.llm.labelled_pages import labelled_pages
from samples import SCHEMA, documents, folder, sentence

INSULTS = ["worthless", "stupid", "idiot", "pathetic", "moron"]


def naive_kernel(s, t, decay=X.DECAY, n=3):
    """By definition: all pairs of equal subsequences of length n, by the spans of both."""
    from itertools import combinations

    total = 0.0
    for a in combinations(range(len(s)), n):
        for b in combinations(range(len(t)), n):
            if all(s[x] == t[y] for x, y in zip(a, b)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_equals_its_definition():
    strings, others = ["^idiot", "id-iot", "abc", "ab", "toidi", "réeuxé"], ["^idiot", "xidiotx", "réeu"]
    want = [[naive_kernel(s, t) for t in others] for s in strings]
    assert np.allclose(X.subsequence_kernel(strings, others), want, rtol=1e-4, atol=1e-6)


@pytest.fixture(scope="module")
def toxic_folder(spark, tmp_path_factory):
    r = random.Random(9)
    docs, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        text = ". ".join(sentence(r, 8) for _ in range(r.randint(1, 6)))
        if toxic:
            text += f". {sentence(r, 3)} {r.choice(INSULTS)} {sentence(r, 2)}."
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (None, "an idiot", "en", "s", 8)]
    return folder(spark, tmp_path_factory.mktemp("toxic"), docs, labels)


def test_toxicity_held_out_and_defined_cases(spark, toxic_folder):
    got = {r.doc_id: r for r in X.op1_toxicity(spark, toxic_folder).collect()}
    assert len(got) == 903
    held = [r for i, r in got.items() if i is not None and i < 9000 and r.held_out]
    assert held and np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[9001].score == got[9002].score and got[9002].predicted == 0
    assert got[None].held_out is False


def test_variants_of_a_stem_leave_room_for_other_landmarks(spark):
    variants = [f"réeux{a}{b}" for a in "abcdefghij" for b in "klmn"]
    rows = [(k, 1, f"{v} bada") for k, v in enumerate(variants * 8)] + [(1000 + k, 1, "achliche bada") for k in range(5)]
    rows += [(2000 + k, 0, f"achlichs bada {v[:2]}") for k, v in enumerate(variants * 20)]
    got = X.choose_landmarks(spark.createDataFrame(rows, "doc_id long, toxic int, text string"), 3)
    assert "^achliche" in got
    got = X.choose_landmarks(spark.createDataFrame(rows + [(3000 + k, 0, "réeux") for k in range(2000)], "doc_id long, toxic int, text string"), 8)
    assert "^achliche" in got and sum(g.startswith("^réeux") for g in got) <= X.VARIANTS + 1


def test_gapped_insults_and_clean_texts(spark, toxic_folder):
    docs = spark.read.parquet(f"{toxic_folder}/documents.parquet")
    model = X.train(docs, spark.read.parquet(f"{toxic_folder}/labels.parquet"))
    texts = ["you i-d-i-o-t", "you i d i o t there", "stuupid thing", "STUPID!", "w.orthless bada", "dalo falo galo kiro", "x" * 5000, "dalo " * 3000]
    got = [r.score for r in X.score(spark.createDataFrame(list(enumerate(texts)), SCHEMA).coalesce(1), model).orderBy("doc_id").collect()]
    assert [s >= 0.3 for s in got] == [True, True, True, True, True, False, False, False]


def test_toxicity_without_labels_and_with_a_clashing_column(spark):
    docs = spark.createDataFrame([(1, "a", 0.7)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.train(docs, labels) is None
    assert X.score(docs, None).first().score == 0.0
    assert X.score(docs.where("doc_id > 1"), None).count() == 0


# ---------------------------------------------------------------- pages

def test_leaf_blocks():
    page = blocks("<html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> --><ul><li>a<li>b</ul><p>x &amp; <b>y\n  z<p>q<br>r"
                  "<script>var t='</p>';</script><div class=\"Ad-Box\">s</div><textarea>no</textarea>&lt;p&gt;</body>")
    assert [b.text for b in page] == ["a", "b", "x & y z", "q r", "s", "<p>"]
    assert page[4].names == {"ad", "box"} and page[0].tags == ("html", "body", "ul", "li")
    assert blocks(None) == [] and blocks("") == [] and blocks("<<<>") != None  # noqa: E711
    assert [b.text for b in blocks("plain < text")] == ["plain < text"]


def test_unclosed_elements_lose_no_text():
    texts = lambda html: [b.text for b in blocks(html)]
    for tag in ("template", "noscript", "iframe", "svg", "select", "button", "object", "canvas", "audio", "video", "math", "b", "div", "li"):
        got = texts(f"<article><p>one</p><{tag}>x<p>two</p><p>three</p></article><p>four")
        assert [t for t in got if t != "x"][-3:] == ["two", "three", "four"] and "one" in got[0], (tag, got)
        closed = texts(f"<article><p>one</p><{tag}>x</{tag}><p>two</p></article>")
        assert closed[0].startswith("one") and closed[-1] == "two"
    assert texts("<button><div>Share</div></button>ok") == ["ok"]
    assert texts("<select><option>A<option>B</select><p>x") == ["x"]
    assert texts("<p>Let <math><mi>x</mi></math> hold.</p>") == ["Let x hold."]
    assert texts("<p>a<![CDATA[abcdef") == ["aabcdef"] and texts("<p>a<![CDATA[b<c]]>d") == ["ab<cd"] and texts("<p>a<![CDATA[b>c") == ["ab>c"]
    assert texts("a <!-- b > c") == ["a"] and texts("a <!-- b") == ["a"] and texts("<title>x</title ><p>y") == ["y"]


def test_hostile_pages_take_linear_time():
    import time

    tagger = H.train([(p, [b.label or 0 for b in p]) for p in map(blocks, labelled_pages(30))], epochs=2)
    n = 50_000
    for html in ("<div class=a>x" * n, "<a " * 2 * n, "<button>x" * n, "".join(f"<div class=c{'ab'[k % 2]}>x</q>" for k in range(n)),
                 "<!-- " * n + ">" + "<a '" * n, "<p>" + "<x-a>" * n + "<li>y" * n):
        start = time.process_time()
        tagger.tag(blocks(html))
        assert time.process_time() - start < 5, html[:40]


def test_tagger_on_held_out_layouts():
    tagger = H.train([(p, [b.label or 0 for b in p]) for p in map(blocks, labelled_pages())])
    right = total = 0
    for page in map(blocks, labelled_pages(100, seed=99)):
        want = [b.label or 0 for b in page]
        right += sum(a == b for a, b in zip(tagger.tag(page), want))
        total += len(want)
    assert right / total > 0.99


def test_viterbi_is_the_best_labelling():
    from itertools import product

    tagger = H.train([(p, [b.label or 0 for b in p]) for p in map(blocks, labelled_pages(30))], epochs=2)
    page = next(p for p in map(blocks, labelled_pages(20, seed=3)) if 4 <= len(p) <= 12)
    p, t = tagger.potentials(page), tagger.transitions
    worth = lambda y: sum(p[k, c] for k, c in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:]))
    assert worth(tagger.tag(page)) == pytest.approx(max(map(worth, product((0, 1), repeat=len(page)))))


def test_page_text_query(spark, tmp_path):
    html = ("<html><body><nav><ul><li><a href=/a>menu</a></li></ul></nav><div class=\"cookie-notice\"><p>We use cookies.</p></div><article><h1>Title</h1>"
            "<p>First &eacute; line.</p><p><b>Second\n line.<br><p>Third.</p></article><div class=\"comments\"><p>Nice one!</p></div><footer>&copy; x</footer></body></html>")
    rows = [(1, "u", html), (1, "u", html), (2, "v", None), (3, "w", ""), (None, "x", "<p>lone"), (4, "y", html.replace("Third.", "Third. " * 20000))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r.page_id, r.text, r.n_chars) for r in H.op4_page_text(spark, str(tmp_path)).collect()]
    want = "Title\nFirst é line.\nSecond line.\nThird."
    assert got.count((1, want, len(want))) == 2
    assert (2, "", 0) in got and (3, "", 0) in got and len(got) == 6
    assert H.main_text(spark.read.parquet(f"{tmp_path}/pages.parquet").where("page_id > 9"), H.train([])).count() == 0
    long_ = next(g for g in got if g[0] == 4)
    assert long_[2] == len(long_[1]) > 130_000


# ---------------------------------------------------------------- quality rules

def brute_statistics(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    count, covered = Counter(grams), set()
    for k, g in enumerate(grams):
        if count[g] > 1:
            covered.update((k, k + 1, k + 2))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_statistics_equal_brute_force(spark):
    rows = documents() + [(8000, "a b c\na b c\n\n \na b c"), (8001, "x# y* <z> |\x0b\x0c\r\n"), (8002, "a a a a"), (8003, "é b   c")]
    got = Q.statistics(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: tuple(r[c] for c in [*Q.BASE, "base_failed"]) for r in got} == {i: brute_statistics(t) for i, t in rows}


def test_rules_are_learned_and_native(spark, tmp_path):
    r = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = sentence(r, 80)
        if bad:
            text = " ".join(w + r.choice("#$%&") for w in text.split()) if i % 8 else " ".join(w.upper() + "!!" for w in text.split())
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not bad), 0))
    path = folder(spark, tmp_path, docs + [(900, None, "en", "s", 0)], labels)
    df = Q.op8_quality_rules(spark, path)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {x.doc_id: x.kept for x in df.collect()}
    assert got.pop(900) is False
    assert got == {i: i % 4 != 0 for i in range(400)}
    kept, rules = Q.quality_filter(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    assert kept.count() == 300 and 1 <= len(rules) <= 4 and all(str(x) for x in rules)


def test_no_labels_no_rules(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    stats = Q.statistics(docs)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.learn(Q.labelled_statistics(stats, empty)) == []
    one_kind = docs.selectExpr("doc_id", "1 as quality")
    assert Q.learn(Q.labelled_statistics(stats, one_kind)) == []
    assert Q.statistics(docs.where("doc_id = 77777")).count() == 0
