"""Language ID, main text, chat formatting, vectors and the pipeline."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverlane.llm import chat, html_text, langid, permutation_index

SYLLABLES = {
    "aa": ["the", "ing", "ough", "and", "wh"],
    "bb": ["der", "ung", "sch", "ich", "ß"],
    "cc": ["que", "ción", "ll", "os", "ñ"],
}


def prose(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(documents):
    rng = random.Random(1)
    rows = [(k, prose(lang, rng.randint(5, 60), rng), lang) for k in range(150) for lang in SYLLABLES]
    return langid.fit(documents(rows), F.col("doc_id") % 4 != 2)


def test_languages_and_mixtures(documents, model, odd_texts):
    rng = random.Random(2)
    rows = [(k, prose(lang, rng.randint(3, 80), rng), lang) for k in range(40) for lang in SYLLABLES]
    got = langid.predict(documents(rows), model).collect()
    truth = {}
    for k, text, lang in rows:
        truth.setdefault(k, set()).add(lang)
    assert sum(r.lang_pred in truth[r.doc_id] for r in got) >= 0.99 * len(got)
    assert all(r.languages[0] == r.lang_pred and 0 < r.score <= 1 for r in got)

    mixed = documents([(1, prose("aa", 70, rng) + " " + prose("bb", 30, rng)), (2, prose("cc", 3, rng)), (2, None), (None, "12 .")])
    rows = langid.predict(mixed.withColumn("languages", F.lit(0)), model).collect()
    by = {(r.doc_id, r.lang_pred): r for r in rows}
    assert len(rows) == 4
    assert by[1, "aa"].languages == ["aa", "bb"] and 0.6 < by[1, "aa"].score < 0.8
    assert by[2, "cc"].score == 1 and by[2, "und"].score == by[None, "und"].score == 0

    odd_texts = [*odd_texts, "½ ² Ⅷ", "½a"]
    odd = documents([(k, t) for k, t in enumerate(odd_texts)])
    found = {r.doc_id: r.lang_pred for r in langid.predict(odd, model).collect()}
    has_letters = {k for k, t in enumerate(odd_texts) if t and any(c.isalpha() for c in t)}
    assert {k for k, v in found.items() if v != "und"} == has_letters
    kept = langid.accepted(odd, model)
    majority = {r.doc_id for r in langid.predict(odd, model).where("score >= 0.5").collect()}
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == majority <= has_letters
    assert langid.predict(documents([]), model).collect() == []


def test_expectation_maximisation_finds_the_likeliest_proportions():
    rng = np.random.default_rng(3)
    log_p = np.log(rng.random((60, 3)) + 1e-3)
    times = rng.integers(1, 5, 60).astype(float)
    share = langid.select(log_p, times, np.array([0, 40]))
    assert np.allclose(share.sum(axis=1), 1, atol=1e-5)

    def score(p, rows):
        return (times[rows] * np.log(np.exp(log_p[rows]) @ p)).sum() - langid.PENALTY * np.log1p(times[rows].sum()) * (p > 1e-6).sum()

    for d, rows in enumerate((slice(0, 40), slice(40, 60))):
        best = max(score(np.eye(3)[k], rows) for k in range(3))
        assert score(share[d], rows) >= best - 0.5


def test_proportions_of_close_languages_have_converged():
    rng = np.random.default_rng(6)
    log_p = np.log(1 + 0.1 * rng.random((3000, 2)))
    first = rng.random(3000) < 0.9  # words that one of the two languages has a little more often
    log_p[np.arange(3000), np.where(first, 0, 1)] += 0.1
    times, starts = np.full(3000, 4.0), np.array([0, 2000])
    share, total = langid.estimate(log_p, times, starts, np.ones((2, 2), bool))
    grid = np.linspace(0, 1, 1001)
    for d, rows in enumerate((slice(0, 2000), slice(2000, 3000))):
        p = np.exp(log_p[rows])
        most = max((times[rows] * np.log(p @ [x, 1 - x])).sum() for x in grid)
        assert total[d] == pytest.approx((times[rows] * np.log(p @ share[d])).sum())
        assert total[d] >= most - langid.TOLERANCE


@pytest.mark.parametrize("n, apart", [(20_000, 1e-3), (20_000, 1e-4), (1_000_000, 1e-3), (1_000_000, 1e-5)])
def test_long_texts_of_close_languages_end_soon(n, apart, monkeypatch):
    rng = np.random.default_rng(8)
    log_p = np.log(1 + apart * rng.random((n, 3)))
    times, allowed = np.ones(n), np.ones((1, 3), bool)
    rounds, real = [], np.add.reduceat

    class Counted:
        def __getattr__(self, name):
            return getattr(np.add, name)

        def reduceat(self, *args, **options):
            rounds.append(1)
            return real(*args, **options)

    class Numpy:
        add = Counted()

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(langid, "np", Numpy())
    share, total = langid.estimate(log_p, times, np.array([0]), allowed)
    assert len(rounds) < 2 * 3 * 60  # two sums a round, three rounds for each extrapolation
    p = np.exp(log_p)
    steps = p / (p @ share[0])[:, None]
    assert n * np.log(steps.mean(axis=0).max()) < 2 * langid.TOLERANCE  # the bound itself, one round later


def test_the_selected_set_is_near_the_best_of_all_sets():
    from itertools import combinations

    rng, k = np.random.default_rng(11), 4
    starts = np.arange(0, 600, 60)
    kinds = rng.integers(1, 4, len(starts))
    log_p = np.log(rng.random((600, k)) * 0.05 + 1e-3)
    for d, (start, few) in enumerate(zip(starts, kinds)):
        said = rng.choice(k, few, replace=False)
        log_p[np.arange(start, start + 60), rng.choice(said, 60)] += 2
    times = rng.integers(1, 4, 600).astype(float)
    chosen = langid.select(log_p, times, starts)
    sums = np.add.reduceat(times, starts)

    def score(allowed):
        _, total = langid.estimate(log_p, times, starts, np.tile(allowed, (len(starts), 1)))
        return total - langid.PENALTY * np.log1p(sums) * allowed.sum()

    sets = [np.isin(np.arange(k), c) for n in range(1, k + 1) for c in combinations(range(k), n)]
    every = np.array([score(s) for s in sets])
    got = [every[[i for i, s in enumerate(sets) if (s == (row > 1e-6)).all()][0], d] for d, row in enumerate(chosen)]
    assert (np.array(got) >= every.max(axis=0) - 0.1).mean() >= 0.9


def test_a_document_stays_by_its_mixture_and_not_its_label(documents):
    rng = random.Random(5)
    rows = [(k, prose(("aa", "bb", "cc")[k % 3], 80, rng), ("aa", "bb", "cc")[k % 3]) for k in range(90)]
    model = langid.fit(documents(rows), F.lit(True))
    mix = " ".join(prose(lang, 60, rng) for lang in ("aa", "bb", "cc"))
    docs = documents([(1, prose("aa", 60, rng), "bb"), (2, mix, "aa"), (3, prose("cc", 60, rng), None), (4, None, "aa"), (5, "12", "aa")])
    assert {(r.doc_id, r.lang) for r in langid.accepted(docs, model).collect()} == {(1, "aa"), (3, "cc")}
    assert {(r.doc_id, r.lang) for r in langid.accepted(docs, model, least=0.2).collect()} >= {(1, "aa"), (3, "cc")}
    assert langid.accepted(docs, model, least=0.2).where("doc_id = 2").count() == 1
    assert [r.doc_id for r in langid.accepted(docs, model, wanted=["aa"]).collect()] == [1]
    assert langid.accepted(docs, model, wanted=[]).collect() == []
    assert langid.accepted(docs.limit(0), model).collect() == []


def test_pages_of_any_depth_parse_in_linear_time():
    import time

    def took(page):
        start = time.process_time()
        html_text.parse(page)
        return time.process_time() - start

    for piece, end in (("<div>x", ""), ("<b>x", "</i>" * 20_000), ("<ul><li>x", ""), ("<a>x<b>", "</a>" * 20_000), ("<div><p>x", "</div>" * 20_000)):
        small, large = (min(took(piece * n + end) for _ in range(2)) for n in (5_000, 40_000))
        assert large < 40 * small + 1, piece
    nodes = html_text.parse("<div>x" * 1_000_000)
    assert len(nodes) == 2_000_001


def test_inline_elements_may_end_in_any_order():
    nodes = html_text.parse("<p><a>one<b>two</a>three</b><p>four<a>five<div>six</a>seven</div>eight")
    runs = [(n.text, n.link_chars) for n in nodes if n.tag == "#text"]
    assert runs == [("onetwothree", 6), ("fourfive", 4), ("sixseven", 0), ("eight", 0)]


def test_odd_pages(spark, odd_texts):
    pages = spark.createDataFrame([(k, f"u{k}", t) for k, t in enumerate(odd_texts)], "page_id long, url string, html string")
    pages = pages.union(spark.createDataFrame([(90, None, "<div>" * 50_000 + "deep"), (91, "u", "<p>" + "long words " * 100_000)], pages.schema))
    found = html_text.extract(pages, html_text.fit(pages)).collect()
    assert len(found) == len(odd_texts) + 2 and all(r.n_chars == len(r.text) for r in found)


def test_no_labels_no_prediction(documents):
    empty = langid.fit(documents([(1, "text", None)]), F.lit(True))
    assert langid.predict(documents([(1, "text")]), empty).first().lang_pred == "und"


def test_no_labels_keep_all_documents_with_letters(documents):
    docs = documents([(1, "text", None), (2, None, None), (3, "12 .", None), (4, "é", None), (None, "no id", None)])
    kept = langid.accepted(docs, langid.fit(docs, F.lit(True)))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "None"]


def test_copies_take_no_places_in_the_sample(documents):
    texts = [f"text {k}" for k in range(90)]
    rows = [(k, t, "aa") for k, t in enumerate(texts)] + [(k, t, "bb") for k in range(120) for t in texts[:3]]
    got = sorted(tuple(r) for r in langid.sample(documents(rows), F.lit(True), 100).collect())
    assert got == sorted([("aa", t) for t in texts] + [("bb", t) for t in texts[:3]])
    copies = documents([(k, t, "aa") for k, t in enumerate(texts + [texts[k] for k in (1, 2, 3)] * 150)])
    assert sorted(r.text for r in langid.sample(copies, F.lit(True), 100).collect()) == sorted(texts)
    few = [r.text for r in langid.sample(copies, F.lit(True), 40).collect()]
    assert len(few) == 40 and set(few) < set(texts)


def test_html_parsing():
    page = "<div class='A-b'>one<br>t&amp;wo <b>three<p>four <i>five</b> six<li>x<li>y</div><script>'</p>'</script>a < b<!-- c --> d<a href='cut"
    nodes = html_text.parse(page)
    assert [n.text for n in nodes if n.tag == "#text"] == ["one t&wo three", "four five six", "x", "y", "a < b d"]
    assert nodes[1].words == ("word a", "word b")
    for odd in ("", "<", "<a", "</p></p>", "<p", "<!--", "&", "<script>never ends", "<p>" * 300 + "x", "a<b\x00>c</b\x00>"):
        html_text.parse(odd)


def test_sum_product_equals_enumeration():
    rng = np.random.default_rng(0)
    parents = [-1, 0, 0, 1, 1, 2, 5]
    under = rng.normal(size=(2, 7)).tolist()
    weights = {}
    for bits in range(2**7):
        y = [bits >> k & 1 for k in range(7)]
        weights[bits] = np.exp(sum(under[y[p] if k else 0][k] for k, p in enumerate(parents) if y[k]))
    total = sum(weights.values())
    wanted = [sum(w for b, w in weights.items() if b >> k & 1) / total for k in range(7)]
    assert np.allclose(html_text.pass_messages(parents, under)[0], wanted)


PAGE = (
    "<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul></nav><header><h1>My site</h1></header>{main}"
    '<div class="comments"><div class="comment"><p>I have read this and I do not agree with it at all, sorry.</p></div></div>'
    '<div class="sidebar"><p>More to read here.</p></div><form><p>Subscribe now</p><input></form>'
    '<div class="cookie-notice"><p>We use cookies, as everyone does.</p></div><footer>&copy; me</footer></body></html>'
)
TEXT = ["A title", "Short.", "A paragraph with &quot;quotes&quot; and a good number of plain words in it, so that it is long enough.", "End &amp; out."]


@pytest.fixture(scope="module")
def pages(spark):
    blocks = f"<h1>{TEXT[0]}</h1><p>{TEXT[1]}</p>\n<p>{TEXT[2]}</p><aside>See also</aside><p>{TEXT[3]}"
    mains = [f"<article>{blocks}</article>", f"<main>{blocks}</main>", f'<div class="post-content">{blocks}</div>']
    rows = [(k, f"u{k}", PAGE.format(main=m)) for k, m in enumerate(mains)]
    rows += [(3, "u3", None), (4, None, ""), (0, "u0", rows[0][2]), (None, "u", "<p>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))


def test_main_text(pages):
    got = html_text.extract(pages, html_text.fit(pages)).collect()
    wanted = "\n".join(TEXT).replace("&quot;", '"').replace("&amp;", "&")
    assert [r.text for r in got if r.page_id in (0, 1, 2)] == [wanted] * 4
    assert [r.text for r in got if r.page_id in (3, 4, None)] == [""] * 3
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).collect() == []


def test_layouts_are_learned():
    rng = random.Random(11)
    lines = ["Some plain words that say nothing. And others, which say less than that."]
    trained = html_text.train([html_text.filled(x, lines, rng) for x in html_text.LAYOUTS for _ in range(20)])
    right = total = 0
    for layout in html_text.LAYOUTS:
        nodes = html_text.parse(html_text.filled(layout, lines, rng))
        for node, main, p in zip(nodes, html_text.labels(nodes), trained.marginals(nodes)):
            if node.tag == "#text":
                right, total = right + (main == (p > 0.5)), total + 1
    assert right >= 0.97 * total


def test_template_round_trip():
    template, rng = chat.Template(), random.Random(5)
    parts = ["<", "|", "\\", "<|end|>", "<|turn|>", "<|text|>", "</s>", "[INST]", "a", "é\n", "<\\|end|>", "|>", "[/INST]"]
    for _ in range(500):
        turns = [("".join(rng.choices(parts, k=rng.randint(0, 3))), "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(3)]
        whole = "".join(template.render(r, t)[0] for r, t in turns)
        assert list(template.parse(whole)) == turns
        assert not any(c in template.escape(t) for _, t in turns for c in (*template.marks, *template.controls))


def test_chat_masks(spark, byte_bpe, monkeypatch):
    rows = [
        (1, 2, "assistant", "Ünï 🙂 done.\n"),
        (1, 0, "system", None),
        (1, 1, "user", "hi </s> <|end|> \\"),
        (1, 3, "assistant", ""),
        (2, 0, "assistant", "<|endoftext|> x"),
        (2, 0, "assistant", "<|endoftext|> x"),
        (2, None, None, "first"),
        (None, 0, "assistant", "no id"),
    ] + [(3, k, "assistant" if k % 2 else "user", f"turn {k} 中文") for k in range(60)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(0))
    wanted = {}
    key = lambda r: (str(r[0]), *[(x is not None, x if x is not None else 0) for x in (r[1],)], r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=key):
        n, turns, loss = wanted.get(conv, (0, "", ""))
        wanted[conv] = n + 1, turns + f"{role or ''}\n{text or ''}\n", loss + (text or "") * (role == "assistant")
    for size in (1, 100, chat.SEGMENT_CHARS):
        monkeypatch.setattr(chat, "SEGMENT_CHARS", size)
        segments = chat.format_conversations(table, byte_bpe)
        got = {r.conv_id: r for r in chat.read_back(segments).collect()}
        assert set(got) == set(wanted)
        for conv, (n, turns, loss) in wanted.items():
            r = got[conv]
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in (turns, loss)]
            assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (n, digests[0], len(loss), digests[1])
        rows_ = segments.collect()
        library = Tokenizer.from_file(byte_bpe)
        for r in rows_:
            assert len(r.ids) == len(r.loss_mask)
            if size == 1 and "assistant" in r.formatted:  # a turn each: what the mask keeps decodes to the text
                kept = [i for i, m in zip(r.ids, r.loss_mask) if m]
                (_, text), = chat.Template().parse(r.formatted)
                assert library.decode(kept, skip_special_tokens=False) == chat.Template().escape(text)
    assert chat.read_back(chat.format_conversations(table.limit(0), byte_bpe)).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    data = np.float32(centres[rng.integers(0, 6, 3000)] + 0.6 * rng.normal(size=(3000, 16)))
    table = vectors(spark, [(k, v.tolist(), 0) for k, v in enumerate(data)])
    exact = data.astype(float)
    for block, least in ((16_384, 500), (700, 100)):
        got = permutation_index.nearest_neighbours(table, table.where("vec_id % 60 = 0"), block=block, ranked_least=least).collect()
        found: dict = {}
        for r in got:
            found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        hits = 0
        for q, rows in found.items():
            distance = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
            distance[q] = np.inf
            hits += len(set(np.lexsort((np.arange(3000), distance))[:10]) & {r[1] for r in rows})
            assert [r[0] for r in sorted(rows)] == list(range(1, 11))
            assert all(r[2] == pytest.approx(distance[r[1]], abs=1e-12) for r in rows)
            assert [(r[2], r[1]) for r in sorted(rows)] == sorted((r[2], r[1]) for r in rows)
        assert len(found) == 50 and hits >= 0.9 * 500


def test_inverted_files_and_footrule_equal_the_definition():
    rng = np.random.default_rng(9)
    data, pivots = rng.normal(size=(300, 5)), rng.normal(size=(40, 5))
    made = permutation_index.orders(data, pivots, 8)
    far = ((data[:, None, :] - pivots[None]) ** 2).sum(axis=2)
    assert (made == np.argsort(far, axis=1, kind="stable")[:, :8]).all()
    files = permutation_index.InvertedFiles(made.astype(np.int64), 40)
    query = made[0].astype(np.int64)
    visited = files.visit(query, 3, 1)
    assert set(visited) == {v for v in range(300) if set(made[v]) & set(query[:3].tolist())} and 0 < len(visited) < 300
    assert len(files.visit(query, 3, len(visited) + 1)) > len(visited) and len(files.visit(query, 3, 300)) == 300

    def place(order, pivot):
        return order.index(pivot) if pivot in order else 8

    for v, got in zip(visited, files.footrule(query, visited)):
        a, b = made[v].tolist(), query.tolist()
        assert got == pytest.approx(sum(abs(place(a, p) - place(b, p)) for p in range(40)) / 72)


def test_a_large_group_of_near_copies_is_ranked_whole(spark):
    rng = np.random.default_rng(6)
    group = rng.normal(size=16) + 1e-3 * rng.normal(size=(900, 16))
    data = np.float32(np.concatenate([group, rng.normal(size=(1800, 16))]))
    table = vectors(spark, [(k, v.tolist(), 0) for k, v in enumerate(data)])
    got = permutation_index.nearest_neighbours(table, table.where("vec_id % 90 = 0"), ranked_least=50).collect()
    exact, hits = data.astype(float), 0
    for q in range(0, 2700, 90):
        distance = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        hits += len(set(np.lexsort((np.arange(2700), distance))[:10]) & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.9 * 300


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 2.0], 0) for k in range(30)] + [(40, [1.0, 3.0], 0), (41, [0.5, 2.0], 0), (41, [0.5, 2.0], 0), (42, [1.0, 2.0, 3.0], 0)]
    rows += [(50, None, 0), (51, [], 0), (52, [0.0, -0.0], 0), (53, [nan, 1.0], 0), (54, [inf, 1.0], 0), (55, [None, 1.0], 0), (None, [1.0, 2.0], 0)]
    table = vectors(spark, rows).withColumn("order", F.lit(0)).withColumn("ids", F.lit(0))
    got = permutation_index.nearest_neighbours(table, table.where("vec_id % 10 = 0 OR vec_id > 40"), k=4).collect()
    found: dict = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: [r[1] for r in sorted(x)] for q, x in found.items()} == {
        0: [1, 2, 3, 4],
        10: [0, 1, 2, 3],
        20: [0, 1, 2, 3],
        40: [0, 1, 2, 3],
        41: [0, 1, 2, 3],
    }
    assert permutation_index.nearest_neighbours(table.limit(0), table.limit(0)).collect() == []


def test_pipeline_against_brute_force(spark, documents, tmp_path):
    import corpus_pipeline
    from tests.llm.test_joins import slow_report
    from tests.llm.test_simhash import slow_components, slow_fingerprint

    rng = random.Random(9)
    rows = [(k, prose(lang, rng.randint(20, 90), rng), lang) for k in range(0, 60, 3) for lang in SYLLABLES]
    rows = [(k, t, lang) for k, (_, t, lang) in enumerate(rows)]
    item = prose("aa", 30, rng)
    rows += [(100, None), (101, ""), (102, "12 34"), (103, rows[3][1], "aa"), (104, rows[3][1] + " end", "aa"), (103, rows[3][1], "aa")]
    rows += [(105, prose("bb", 40, rng) + " " + item, "bb"), (106, item, "aa")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    texts = [(r[0], r[1]) for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    roots = slow_components(np.array([slow_fingerprint(t) for _, t in texts], np.uint64), 4)
    least = {r: min(k for (k, _), x in zip(texts, roots) if x == r) for r in roots}
    kept = {k: t for (k, t), r in zip(texts, roots) if k == least[r]}
    kept = {k: t for k, t in kept.items() if slow_report([(k, t)], [(1, item)], 10)[0][2] == 0}
    assert sorted(r.doc_id for r in got) == sorted(kept) and 103 not in kept and 105 not in kept
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert all(library.encode(kept[r.doc_id], add_special_tokens=False).ids == r.ids and r.n_tokens == len(r.ids) for r in got)


def test_pipeline_stages_take_odd_rows(spark, documents, odd_texts, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, None), (2, "a")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = documents([(k % 12, t) for k, t in enumerate(odd_texts)] + [(None, "no id"), (None, None)])
    odd = odd.withColumn("more", F.lit(1)).withColumn("more2", F.lit(2)).toDF(*odd.columns, "fp", "TEXT")
    for table in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == table.columns
            out.collect()
