"""Quality, toxicity, pages and shards."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from assaylake.llm import hilbert, html_mss, importance, toxicity

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- op5 --------------------------------------------------------------------


def test_weights_against_brute_force(spark, monkeypatch):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    chosen = []
    count = importance.bucket_counts
    monkeypatch.setattr(importance, "bucket_counts", lambda d, ids: (chosen.extend(ids.tolist()), count(d, ids))[1])
    importance.resample(docs, labels, k=1)
    good = set(chosen)
    assert good < {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    grams = {d: Counter(importance._features([t])[1].tolist()) for d, t in texts.items()}
    raw, target = sum(grams.values(), Counter()), sum((grams[d] for d in good if d in grams), Counter())
    share = sum(target.values()) / sum(raw.values())
    s = importance.SMOOTHING
    expected = {b: n * share for b, n in raw.items()}
    ratio = {
        b: 0 if abs(target[b] - e) <= importance.SIGNIFICANT * math.sqrt(e + 1) else math.log((target[b] + s) / (e + s))
        for b, e in expected.items()
    }
    got = importance.resample(docs, labels, k=50).collect()
    for r in got:
        want = sum(n * ratio[b] for b, n in grams[r["doc_id"]].items())
        assert r["n_grams"] == sum(grams[r["doc_id"]].values())
        assert r["log_weight"] == pytest.approx(want, rel=1e-9, abs=1e-6)
    largest = sorted((r["sort_key"] for r in got), reverse=True)[:50]
    assert sorted((r["sort_key"] for r in got if r["selected"]), reverse=True) == largest


def test_noise_is_gumbel(spark):
    scored = spark.range(20000).selectExpr("id as doc_id", "0D as log_weight")
    keys = [r["sort_key"] for r in importance.gumbel_top_k(scored, 10).collect()]
    assert np.mean(keys) == pytest.approx(0.5772, abs=0.04)
    assert np.std(keys) == pytest.approx(math.pi / math.sqrt(6), abs=0.04)


@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_the_kth_largest_is_exact(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.random() * 1e-9, -1e6 * rng.random(), float(rng.randrange(5))]) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert importance.kth_largest(df, "v", k, bins=4) == sorted(values, reverse=True)[k - 1]


def test_bad_documents_are_rejected_and_good_ones_kept(spark):
    docs, labels = read(spark, "documents", LARGER), read(spark, "labels", LARGER)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    # learn from half of the labels, look at the others
    half = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 2 = 0")
    learned = {r["doc_id"] for r in half.collect()}
    got = {r["doc_id"]: r["selected"] for r in importance.resample(docs, half).collect()}
    assert len(got) == docs.count()
    kept = [got[d] for d, q in truth.items() if q == 1 and d not in learned]
    rejected = [not got[d] for d, q in truth.items() if q == 0 and d not in learned]
    assert np.mean(kept) > 0.97 and np.mean(rejected) > 0.9


def test_resampling_of_odd_rows(spark):
    good = "Some plain words here that make a sentence."
    bad = "WORDS!! ### $$$ MORE!! ###"
    docs = spark.createDataFrame(
        [(d, good) for d in range(20)] + [(100 + d, bad) for d in range(20)]
        + [(200, None), (201, ""), (None, bad), (202, bad * 5000), (3, good)], DOCS,
    ).selectExpr("*", "1 as quality", "2 as n_grams", "3 as sort_key")
    labels = spark.createDataFrame(
        [(d, 1) for d in range(10)] + [(100 + d, 0) for d in range(10)] + [(None, 1), (5, None), (300, 1), (15, 0), (15, 1)],
        "doc_id long, quality int",
    )
    got = importance.resample(docs, labels).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r["selected"] for r in got}
    assert all(by[d] for d in range(20)) and not any(by[100 + d] for d in range(20)) and not by[202]
    kept = importance.keep_selected(docs, labels)
    assert kept.columns == docs.columns
    assert None in {r["doc_id"] for r in kept.collect()}
    assert importance.resample(docs.limit(0), labels).collect() == []
    nothing = importance.resample(docs, labels.limit(0)).collect()
    assert all(r["selected"] and r["log_weight"] == 0 for r in nothing)


# ---- op10 -------------------------------------------------------------------


def auc(scores, labels):
    pos, neg = [s for s, y in zip(scores, labels, strict=True) if y], [s for s, y in zip(scores, labels, strict=True) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = read(spark, "labels", sf)
    docs = read(spark, "documents", sf).join(labels.select("doc_id"), "doc_id")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = [r for r in toxicity.toxicity(docs, labels).collect()]
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    out = [r for r in got if r["held_out"]]
    # some 380 toxic documents to learn from; words of the rarer languages are not all seen
    assert auc([r["score"] for r in out], [truth[r["doc_id"]] for r in out]) > 0.95
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.97


def test_held_out_labels_are_not_used(spark):
    docs, labels = read(spark, "documents", LARGER), read(spark, "labels", LARGER)
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic"
    )
    a, b = (sorted(toxicity.toxicity(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def test_misspelt_words_share_subwords():
    rng = random.Random(1)
    plain = lambda: ["".join(rng.choices("abcdefghij", k=6)) for _ in range(40)]
    texts, labels = [], []
    for k in range(300):
        words = plain() + (["horrible", "scoundrel"] if k % 3 == 0 else [])
        texts.append(" ".join(words))
        labels.append(int(k % 3 == 0))
    model = toxicity.train([toxicity.bag(t) for t in texts], labels)
    clean = toxicity.log_odds([" ".join(plain()) for _ in range(50)], model)
    bad = toxicity.log_odds([" ".join([*plain(), "horribel", "scoundrels", "scoundrrel"]) for _ in range(50)], model)
    assert np.mean(bad > 0) > 0.9 and np.mean(clean < 0) > 0.95


def test_scores_are_those_of_the_bags():
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), 0.25)
    texts = ["One two TWO one", "", "x", "two"]
    got = toxicity.log_odds(texts, model)
    assert got[1] == 0.25
    of = lambda w: (toxicity.log_odds([w], model)[0] - 0.25) * (1 + toxicity.PAD)
    assert got[0] - 0.25 == pytest.approx((of("one") + of("two")) / (2 + toxicity.PAD))
    # each text is scored alone
    assert got == pytest.approx([toxicity.log_odds([t], model)[0] for t in texts])
    assert sorted(toxicity.bag("One two, TWO one é_3")) == ["one", "two", "é_3"]


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(d, "you vile rotten person" if d % 2 else "a very kind person") for d in range(40)]
        + [(50, None), (51, ""), (52, "?!"), (None, "rotten vile"), (3, "again 3"), (54, "kind " * 50000)], DOCS,
    ).selectExpr("*", "1 as toxic", "2 as score", "'x' as label")
    labels = spark.createDataFrame(
        [(d, d % 2) for d in range(30)] + [(None, 1), (7, None), (31, 0), (31, 1), (99, 1), (12, 7)], "doc_id long, toxic int"
    )
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[50]["score"] == by[51]["score"] == by[52]["score"]
    assert by[None]["held_out"] is False and by[None]["score"] > 0.5 > by[54]["score"]
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {1 / (1 + math.exp(2))}


# ---- op6 --------------------------------------------------------------------


def inside_article(html):
    """The article of the given pages, whose only markup inside is h1, p, b and br."""
    from html import unescape

    inner = re.search(r"<article>(.*?)(</article>|<footer|\Z)", html, re.S).group(1)
    inner = re.sub(r"</?(?:h1|p|br)>", " ", inner)
    return " ".join(unescape(re.sub(r"</?b>", "", inner)).split())


def test_pages_against_their_articles(spark):
    pages = read(spark, "pages", LARGER)
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r for r in html_mss.extract(pages).collect()}
    assert got.keys() == html.keys()
    for k, r in got.items():
        assert r["text"] == inside_article(html[k])
        assert r["n_chars"] == len(r["text"])


def text_of(html, weights=None):
    return html_mss.main_text(html, html_mss.tag_weights({}) if weights is None else weights)


BODY = "<p>The first paragraph has a number of words in it.</p><p>So has <a href='x'>the second</a> one, <b>bold</b>ly.</p>"
WANT = "The first paragraph has a number of words in it. So has the second one, boldly."


@pytest.mark.parametrize("html", [
    f"<nav><a href=1>Home</a> <a>About us</a></nav><article>{BODY}</article><footer>All rights reserved</footer>",
    f"<header><h1>Site</h1></header><main>{BODY}</main><aside>Look at this too, it is good</aside>",
    f"<div id='cookie-notice'>We use cookies to do things to you, accept</div><div class=content>{BODY}</div>",
    f"<body class='has-sidebar'><div class=\"sidebar\"><p>Other posts of ours</p></div><article>{BODY}</article>"
    "<section class='comments'><p>First! I was here before you were</p><div>Reply now</div></section>",
    f"<article>{BODY[:61]}<div class='ad-slot'>Buy this now for little</div>{BODY[61:]}</article>",
    f"<article><script>if (a < b) document.write('<p>no</p>')</script>{BODY}<form><input> Your name here <button>Go</button></form></article>",
    f"<!-- <p>hidden words</p> --><article>{BODY}<style>p {{x}}</style></article><div style='display: none'>You do not see this</div>",
    f"<article><header class='entry-header'></header>{BODY}<ul class='share-links'><li>Tweet</li></ul>",
])
def test_parts_that_are_no_content(html):
    assert text_of(f"<html><head><title>Title here</title></head><body>{html}</body></html>") == WANT


@pytest.mark.parametrize("html", [
    f"<div class='layout has-sidebar'>{BODY}</div>",
    f"<form id='aspnetForm' method=post><div>{BODY}</div></form>",
    f"<article><div class='content share-enabled'>{BODY}</div></article>",
    f"<div id='search-results'><h1></h1>{BODY}</div>",
    f"<div class='content comments-open'><article>{BODY}</article><section class='comments'><p>First</p></section></div>",
    f"<div class='widget-area page-menu'><main>{BODY}</main><div class='widget'>Words of a widget</div></div>",
    f"<div data-hidden='false' title='the hidden cost of tea'>{BODY}</div><div hidden>not this</div>",
    f"<main><article>{BODY}</article><section class='comments'><article class='comment-body'><p>" + "I disagree " * 30
    + "</p></article></section></main>",
])
def test_names_do_not_empty_a_page(html):
    assert text_of(f"<html><body>{html}</body></html>") == WANT


def test_running_text_under_a_doubtful_name_stays():
    prose = " ".join(f"word{k}" for k in range(60))
    links = "".join(f"<a href='{k}'>More like this one</a>" for k in range(20))
    for name in ("related-work", "search-methods"):
        page = f"<article>{BODY}<section class='{name}'><p>{prose}</p></section></article>"
        assert text_of(page) == f"{WANT} {prose}"
    assert text_of(f"<article>{BODY}<section class='related-work'>{links}</section></article>") == WANT


def test_attributes_are_names_and_values():
    assert html_mss.attributes(''' class="a b" data-hidden='x hidden' title="it's = hidden" id=k checked''') == {
        "class": "a b", "data-hidden": "x hidden", "title": "it's = hidden", "id": "k", "checked": ""}


def test_only_the_scan_tells_this_page():
    """No element or name speaks against the small print around the text; the tags between do."""
    small = "".join(f"<div><div><p>{w} {w}</p></div></div>" for w in ("imprint", "contact", "jobs", "press"))
    page = f"<body><div>{small}</div><div>{BODY}</div><div>{small}</div></body>"
    assert text_of(page) == WANT
    assert not any(t.out for t in html_mss.tokens(page))


def test_references_blocks_and_broken_markup():
    assert text_of("<article><p>a&amp;b &lt;i&gt; &#233;&nbsp;x</p><h2>c</h2>d<br>e<i>f</i><p>g") == "a&b <i> é x c d ef g"
    assert text_of("plain words & more < less") == "plain words & more < less"
    assert text_of("<p title='a>b'>one</p><p>two 3 < 4") == "one two 3 < 4"
    assert text_of("") == text_of("<nav>only a menu</nav>") == text_of("<script>x") == text_of("<!-- x") == ""


def test_the_region_is_the_best_of_all_runs():
    rng = random.Random(2)
    for _ in range(100):
        parts = rng.choices(["<p>", "</p>", "<div>", "</div>", "w ", "w w w ", "<h1>", "</h1>", "<section>"], k=14)
        weights = {k: rng.choice([-0.5, -2.0, -4.0]) for k in ("p", "/p", "div", "/div", "h1", "/h1", "section")}
        found = list(html_mss.tokens("".join(parts)))
        score = [weights[t.kind] if t.kind else len(t.text.split()) for t in found]
        best = max((sum(score[a:b]) for a in range(len(score)) for b in range(a, len(score) + 1)), default=0)
        text = text_of("".join(parts), weights)
        # the words of the region, less its cheapest tags, make up the best sum
        assert any(
            sum(score[a:b]) == best and len(text.split()) == sum(s for s in score[a:b] if s > 0)
            for a in range(len(score)) for b in range(a, len(score) + 1)
        )


@pytest.mark.parametrize("between", [
    '<svg class="i"/>', "<math/>", '<svg-icon name="x"></svg-icon>', "<video-player></video-player>", "<template-x></template-x>",
    "<svg><text>no</text></svg>", "<object data='x'>no</object>", "<video src='x'>", "<script>no</script>", "<script-x></script-x>",
])
def test_text_after_embedded_elements_stays(between):
    html = f"<article><p>one two</p>{between}<p>three four</p></article>"
    assert html_mss.main_text(html, html_mss.tag_weights({})) == "one two three four"


def test_unclosed_scripts_run_to_the_end():
    html = "<article><p>one two</p><script>var x = '<p>no</p>'"
    assert html_mss.main_text(html, html_mss.tag_weights({})) == "one two"


def test_pages_of_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (None, "v", f"<article>{BODY}</article>"), (3, "w", "<p>" + "word " * 200000),
         (3, "w", f"<article>{BODY}</article>")], "page_id long, url string, html string",
    ).selectExpr("*", "'a' as text", "2 as n_chars", "3 as kind")
    got = sorted((str(r["page_id"]), r["n_chars"]) for r in html_mss.extract(pages).collect())
    assert got == sorted([("1", 0), ("2", 0), ("None", len(WANT)), ("3", 999999), ("3", len(WANT))])
    assert html_mss.extract(pages.limit(0)).collect() == []


# ---- op7 --------------------------------------------------------------------


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 3), (3, 4), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(n, bits):
    cells = np.indices((1 << bits,) * n).reshape(n, -1).T
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_rows_law(got, texts, shards=8):
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    raw = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == raw
    assert {(r["law"], r["grown_shard"]) for r in got} <= {("rows", None)}
    ordered = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert ordered == sorted(ordered)


def test_shards_against_the_law(spark):
    docs = read(spark, "documents", LARGER)
    check_rows_law(hilbert.shard(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_shards_of_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (None, "", None, None, None), (2, "é" * 90000, "", "", 9)]
    rows += [(10 + k, "same", "de", "hot", 4) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as shard", "2 as slot", "'x' as law", "3 as curve")
    check_rows_law(hilbert.shard(docs).collect(), [r[:2] for r in rows])
    assert hilbert.shard(docs.limit(0)).collect() == []
    few = hilbert.shard(docs.limit(3)).collect()
    assert len(few) == 3 and {r["slot"] for r in few} == {0}


def test_text_counts_beyond_a_common_prefix(spark):
    rows = [(k, f"https://www.example.org/{k % 16:02d}", k % 7) for k in range(1600)] + [(9000 + k, None, 1) for k in range(5)]
    rows += [(9100 + k, "a" * 100_000, 2) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n int")
    cells = hilbert.quantise(docs, ["source", "n"]).groupBy("source").agg({"__q0": "min", "__q1": "max"}).collect()
    by = {r["source"]: r["min(__q0)"] for r in cells}
    urls = sorted(s for s in by if s and s.startswith("https"))
    assert len({by[s] for s in urls}) >= 15 and [by[s] for s in urls] == sorted(by[s] for s in urls)
    assert by[None] == 0
    raw = docs.withColumn("source", docs["source"].cast("binary"))
    got = {bytes(r["source"]): r["__q0"] for r in hilbert.quantise(raw, ["source"]).filter("source is not null").collect()}
    assert got == {s.encode(): q for s, q in by.items() if s is not None}


def test_files_cover_small_boxes(spark, tmp_path):
    docs = read(spark, "documents", LARGER)
    hilbert.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select("doc_id", "text").collect()) == sorted(docs.select("doc_id", "text").collect())
    cells = back.groupBy("shard").agg({"source": "approx_count_distinct", "lang": "approx_count_distinct"}).collect()
    assert len(cells) == 8
    # a random eighth of the rows has nearly all of the 50 sources and all languages
    kinds = [r["approx_count_distinct(source)"] * r["approx_count_distinct(lang)"] for r in cells]
    assert np.mean(kinds) < 0.6 * 46 * 4
