"""Bit-sliced top-k, language identification and main text."""

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.edge import awkward, empty
from tryline.llm import bsi_topk, html_text, langid

KIND = "vec_id long, embedding array<float>, label int, score long, rank int, block long, id long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in rows], KIND)


def brute(rows, k):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = set()
    for qi, q in good:
        if qi % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != qi)[:k]
            out |= {(qi, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bsi_topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(bsi_topk, "BLOCK_QUERIES", 3)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(9)]) for i in range(240)]
    rows += [(300 + i, rows[7][1]) for i in range(30)]                       # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf"), 1.0]), (420, []), (440, [0.0] * 9), (None, [1.0])]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in bsi_topk.bsi_topk(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()}
    assert got == brute(rows, 20)


def test_fewer_rows_than_asked_and_none(spark):
    rows = [(0, [1.0, 2.0]), (20, [1000.0, -3.0]), (21, [0.5])]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in bsi_topk.bsi_topk(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()}
    assert got == brute(rows, 20)
    assert bsi_topk.bsi_topk(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []


SYLLABLES = {"xx": "ba ki lo mu".split(), "yy": "the ing ent ion".split(), "zz": "éa ñu ço üß".split()}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_languages_held_out(spark):
    rng = random.Random(1)
    rows = [(i, speech(rng, lang, rng.randint(8, 40)), lang) for i in range(240) for lang in [rng.choice(sorted(SYLLABLES))]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in langid.predict(df, model, ["doc_id"]).collect()}
    held = [(i, lang) for i, _, lang in rows if i % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values()) and model.languages == sorted(SYLLABLES)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "…—"), (5, "中文"), (6, "A")], "doc_id long, text string")
    assert {r.doc_id for r in langid.predict(odd, model, ["doc_id"]).collect() if r.lang_pred == "und"} == {1, 2, 3, 4}


def test_language_of_long_rows_only(spark):
    rng = random.Random(5)
    one, *rest = sorted(SYLLABLES)
    texts = [(speech(rng, lang, 9000 if lang == one else 40), lang) for lang in [one] * 10 + rest * 30]
    assert all((len(x) > langid.SAMPLE_CHARS) == (lang == one) for x, lang in texts)
    df = spark.createDataFrame([(i, x, lang) for i, (x, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.train(df, F.lit(True))
    assert model.languages == sorted(SYLLABLES)
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model, ["doc_id"]).collect()}
    assert all(got[i] == one for i in range(10))


def test_sample_is_bounded_in_characters(spark, monkeypatch):
    """Every language stays within its share of the characters, and none is left out."""
    rng = random.Random(9)
    monkeypatch.setattr(langid, "TOTAL_CHARS", 30_000)
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 400)
    rows = [(i, speech(rng, lang, 100 if lang == "zz" else 30), lang) for i in range(900) for lang in [rng.choice(sorted(SYLLABLES))]]
    rows += [(1000 + i, f"rare {i}", f"r{i:02}") for i in range(20)]
    seen = []
    monkeypatch.setattr(langid, "fit", lambda texts, labels: seen.extend(zip(texts.to_pylist(), labels, strict=True)))
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    share = 30_000 // 23
    chars = {lang: sum(len(t) for t, x in seen if x == lang) for lang in {x for _, _, x in rows}}
    assert min(chars.values()) > 0 and chars["zz"] <= share  # zz has only texts above 400 characters
    assert all(chars[lang] <= 1.5 * share for lang in ("xx", "yy"))


def plain_logits(text, model):
    """The method written out for one text: n-gram buckets of lower-cased bytes, their averaged rows, the linear layer."""
    raw = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    raw = [b if b >= 128 or 97 <= b <= 122 else 32 for b in raw]
    total, n = [0.0] * len(model.languages), 0
    for size in langid.ORDERS:
        for i in range(len(raw) - size + 1):
            gram = raw[i:i + size]
            if any(b != 32 for b in gram):
                h = int.from_bytes(bytes(gram), "little") ^ (size * 0x9E3779B1 & 0xFFFFFFFF)
                h = h * 0x85EBCA6B & 0xFFFFFFFF
                h = (h ^ h >> 15) * 0xC2B2AE35 & 0xFFFFFFFF
                total = [t + float(x) for t, x in zip(total, model.table[h >> (32 - langid.BITS)], strict=True)]
                n += 1
    return [(t / max(1, n) + float(b)) / model.temperature for t, b in zip(total, model.bias, strict=True)]


def test_predictions_equal_the_method_written_out(spark):
    rng = random.Random(11)
    texts = [speech(rng, rng.choice(sorted(SYLLABLES)), rng.randint(1, 60)) for _ in range(40)] + ["A", "Ñu, ba!", "x" * 500, "中文 the"]
    labels = [rng.choice(sorted(SYLLABLES)) for _ in texts]
    model = langid.fit(pa.array(texts), labels)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.predict(df, model, ["doc_id"]).collect():
        x = plain_logits(texts[r.doc_id], model)
        e = [math.exp(v - max(x)) for v in x]
        p = [v / sum(e) for v in e]
        assert abs(r.score - max(p)) < 1e-5 and p[model.languages.index(r.lang_pred)] > max(p) - 1e-5
        assert r.accepted == (r.score >= model.threshold)


def test_language_of_awkward_rows(spark):
    df = awkward(spark)
    model = langid.train(df, F.lit(True))
    assert langid.predict(df, model, ["doc_id", "size"]).count() == df.count()
    none = langid.train(empty(spark), F.lit(True))
    assert all(r.lang_pred == "und" for r in langid.predict(df, none, ["doc_id"]).collect())
    assert langid.predict(empty(spark), model, ["doc_id"]).collect() == []


def test_prediction_is_the_averaged_embedding():
    """Chunks of several texts score as each text alone."""
    texts = ["the ingent ion", "ba ki", "", "x"]
    model = langid.fit(pa.array(["the ing", "ba ki lo"] * 15), ["yy", "xx"] * 15)
    from tryline.llm.textops import chunks
    [c] = list(chunks(pa.array(texts)))
    best, score = langid.predict_chunk(c, model)
    for k, t in enumerate(texts):
        [one] = list(chunks(pa.array([t])))
        b, s = langid.predict_chunk(one, model)
        assert b[0] == best[k] and abs(s[0] - score[k]) < 1e-6


PAGES = [
    ("<html><body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>First, with &amp; sign&nbsp;here\n and  more.</p><p>Second &lt;b&gt;.</p>"
     "<div class='comments'><p>A reader writes, at length, about it all.</p></div></article><footer><p>Foot, note.</p></footer></body></html>",
     "Title\nFirst, with & sign here and more.\nSecond <b>."),
    ("<body><div id=sidebar><p>Side text, a lot of it, really quite a lot of text here.</p></div><div class=content><p>" + "Long text, yes. " * 20
     + "</p><ul><li>One<li>Two</ul></div><aside>No</aside><script>var x = '<p>no</p>';</script><!-- <p>no</p> --></body>",
     " ".join(["Long text, yes."] * 20) + "\nOne\nTwo"),
    ("<article><p><b>Bold text<br><p>Next one</article><footer>x", "Bold text\nNext one"),
    ("plain text, no tags", "plain text, no tags"),
    ("<article><p>Cut off in the mid", "Cut off in the mid"),
    ("<article><p>Cut in a tag <a hre", "Cut in a tag"),
    ("<body><div class='notice'><p>Only a notice, nothing else.</p></div></body>", "Only a notice, nothing else."),
    ("<body><form><p>in a form</p></form><p hidden>gone</p><p style='display: none'>gone</p></body>", ""),
    ("<div>" * 3000 + "<p>deep, down</p>", "deep, down"),
    ("", ""), (None, ""), ("<!-- never closed <p>x</p>", ""), ("<script>never closed <p>x</p>", ""), ("< 3 and <5 &am", "< 3 and <5 &am"),
    ("<table><tr><td>A, cell<td>B, cell<tr><td>C</table>", "A, cell\nB, cell\nC"),
]


def test_main_text():
    for page, want in PAGES:
        assert html_text.main_text(page or "") == want, page[:80] if page else page


BODY = "<p>" + "The article's own text, with commas, goes on. " * 6 + "</p>"
WHOLE = " ".join(["The article's own text, with commas, goes on."] * 6)
TEASER = "<div><p>A teaser, short but with commas, stands beside the article.</p></div>"


def test_names_of_layouts_and_titles_cut_no_article():
    for tag in ("<div class='page has-sidebar'>", "<article class='post no-comments'>", "<div class=widget-layout>", "<form id=aspnet>",
                "<div id=sidebar-left><article>", "<form><main>"):
        got = html_text.main_text(f"<body>{TEASER}{tag}<h1>Title</h1>{BODY * 3}</body>").split("\n")
        assert got[-4:] == ["Title", WHOLE, WHOLE, WHOLE], tag
    page = (f"<article><h1 class=page-header>Title</h1>{BODY}<h2 id=social-impact>Social impact</h2>{BODY}"
            f"<section id=related-work><h2>Related work</h2>{BODY}</section><section><h2 id=cookie-recipes>Cookie recipes</h2>{BODY}</section>"
            "<div id=related-posts><h3>Related posts</h3><p>Another one, not this.</p></div></article>")
    assert html_text.main_text(page).split("\n") == [
        "Title", WHOLE, "Social impact", WHOLE, "Related work", WHOLE, "Cookie recipes", WHOLE]


def test_short_siblings_of_the_best_container():
    short = "<section><p>Short section, one paragraph, of few words.</p></section>"
    rest = "<ul><li>One<li>Two</ul><table><tr><td>A<td>B</table><pre>code</pre><div>Plain division</div>Loose <b>text</b>"
    links = "<ul><li><a href=a>Another page</a><li><a href=b>One more page</a></ul>"
    want = ["Short section, one paragraph, of few words.", *[WHOLE] * 9, "One", "Two", "A", "B", "code", "Plain division", "Loose text"]
    for around in ("%s", "<div>%s</div>", "<div class=has-sidebar><section>%s</section></div>"):
        for inner in ("<section>%s</section>", "<div><div><div>%s</div></div></div>"):
            page = f"<body>{around % (short + inner % (BODY * 9) + rest + links)}<div class=sidebar>Side text.</div></body>"
            assert html_text.main_text(page).split("\n") == want, page[:100]


def test_marked_parts_stay_out():
    answers = f"<div id=comments><div class=comment>{BODY * 20}</div></div>"
    assert html_text.main_text(f"<body><div>{BODY * 3}</div>{answers}</body>") == "\n".join([WHOLE] * 3)
    assert html_text.main_text(f"<body><article>{BODY * 3}{answers}<div class=sidebar><p>Side, text.</p></div></article></body>") == "\n".join([WHOLE] * 3)


def test_an_articles_own_header_is_text():
    head = "<header><h1>Title</h1><p>A lead, short.</p><nav><a href=x>Menu</a></nav></header>"
    site = "<header><h1>Site name</h1><p>Motto, of the site.</p></header>"
    links = "<header><h2><a href=a>Linked only</a></h2></header>"
    assert html_text.main_text(f"<body>{site}<article>{head}{links}{BODY}</article></body>") == f"Title\nA lead, short.\n{WHOLE}"
    assert html_text.main_text(f"<body>{site}<div>{BODY}</div></body>") == WHOLE


def test_deep_and_broken_pages_take_linear_time():
    from time import perf_counter
    n = 100_000
    pages = {"blocks": "<div>a, b " * n, "in an article": "<article>" + "<div>a, b " * n, "end tags": "<b>" * n + "</i>" * n,
             "items": "<ul>" + "<div>" * (n // 2) + "<li>x</li>" * (n // 2), "ids": "<div id=social-impact><h1>" * (n // 4),
             "headers": "<article>" + "<header><h1>a" * (n // 4)}
    for name, page in pages.items():
        start = perf_counter()
        html_text.main_text(page)
        assert perf_counter() - start < 20, name  # about 1 s each; a walk per block or tag would take an hour


def plain_scores(root):
    """Points of every node by recursion over the tree as it stands."""
    def size(x):
        return (len(x) - x.count(" ") if len(x) < 4 else len(x.strip())) if isinstance(x, str) else sum(map(size, x.kids))

    def linked(x):
        return 0 if isinstance(x, str) else size(x) if x.tag == "a" else sum(map(linked, x.kids))

    def commas(x):
        if isinstance(x, str):
            return sum(c in html_text.COMMAS for c in x)
        return sum(commas(k) for k in x.kids if isinstance(k, str) or k.tag not in html_text._PARAGRAPH)

    points = {}

    def visit(x):
        own = any(isinstance(k, str) and k.strip() for k in x.kids)
        paragraph = x.tag in html_text._PARAGRAPH
        if size(x) and (paragraph or own and (x.tag in html_text.BLOCK or x.tag == "#root")):
            p = (1 + commas(x) + min(size(x) / 100, 3)) * (1 - linked(x) / size(x)) * (0.1 if size(x) < 25 else 1) * x.weight
            up = x.up if paragraph else x
            for part in (1, 2, 6, 9, 12):
                if up is not None:
                    points[id(up)] = points.get(id(up), 0.0) + p / part
                    up = up.up
        for k in x.kids:
            if not isinstance(k, str):
                visit(k)

    visit(root)
    return lambda x: points.get(id(x), 0.0) * (1 - linked(x) / max(1, size(x)))


def test_scores_equal_a_plain_recursion():
    rng = random.Random(4)
    tags = "div p ul li b a table tr td h1 section span pre dl dd".split()
    for _ in range(400):
        page = "".join(rng.choice((f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", rng.choice(("a, b", "word " * 9, " ", "x,y,z " * 12))))
                       for _ in range(rng.randint(1, 40)))
        root = html_text.parse(page)
        nodes = html_text._visible(root, True)
        best = html_text._score(nodes)
        want = plain_scores(root)
        assert all(math.isclose(node.score, want(node), abs_tol=1e-9) for node in nodes), page
        assert (best.score if best else 0.0) == max(node.score for node in nodes)


def test_pages_table(spark):
    df = spark.createDataFrame([(i, f"u{i}", p, "clash", 3) for i, (p, _) in enumerate(PAGES)] + [(None, None, None, None, None)],
                               "page_id long, url string, html string, text string, n_chars long")
    got = html_text.extract_main_text(df).collect()
    assert len(got) == len(PAGES) + 1 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id is not None} == {i: w for i, (_, w) in enumerate(PAGES)}
    assert html_text.extract_main_text(df.limit(0)).collect() == []


def test_large_components_are_exact_or_an_error(spark):
    """Components above 2^40 keep their value and order; scores that could wrap raise."""
    import pytest
    rows = [(0, [1.0, 0.0]), (1, [2.0 ** 41, 0.0]), (2, [2.0 ** 43, 1.0]), (3, [5 * 2.0 ** 40, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in bsi_topk.bsi_topk(df, F.col("vec_id") == 0, k=3, scale=1).orderBy("rank").collect()]
    assert got == [(2, 2 ** 43), (3, 5 * 2 ** 40), (1, 2 ** 41)]
    wide = spark.createDataFrame([(0, [2.0 ** 40]), (1, [2.0 ** 41])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        bsi_topk.bsi_topk(wide, F.col("vec_id") == 0, k=3, scale=1).collect()
    huge = spark.createDataFrame([(0, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="doesn't fit"):
        bsi_topk.bsi_topk(huge, F.col("vec_id") == 0, k=3, scale=64).collect()
