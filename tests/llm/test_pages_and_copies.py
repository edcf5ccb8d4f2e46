"""Names and awkward markup in page extraction; exact copies with any column names; the pipeline on awkward tables."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from asrprep.llm import exact_dedup, html_text
from conftest import SF001

SHORT, LONG_TEXT = "A short page of text.", "A long page of text. " * 40
NOISY = " ".join(["noise words stand here"] * 24)
NAMES = ("share notice related related-posts author-notice sidebar widget promo banner menu nav cookie-banner popup search tags cookie "
         "ad comments footer login newsletter").split()


@pytest.mark.parametrize("body", [SHORT, LONG_TEXT])
@pytest.mark.parametrize("tag", ["main", "article"])
def test_named_noise_inside_an_article_is_no_text(tag, body):
    for name in NAMES:
        page = f'<body><{tag}><p>{body}</p><div class="x {name}"><p>{NOISY}</p></div></{tag}></body>'
        assert html_text.main_text(page) == body.strip(), name


def test_wrappers_and_names_in_passing_stay_text():
    for page in (f'<div class="has-sidebar"><p>{LONG_TEXT}</p></div>', f'<article><section id="related-work"><p>{LONG_TEXT}</p></section></article>',
                 f'<div class="search"><p>{LONG_TEXT}</p></div>', f'<main><div class="widget"><article><p>{LONG_TEXT}</p></article></div></main>',
                 f'<div id="content-with-comments"><p>{LONG_TEXT}</p></div>'):
        assert html_text.main_text(page) == LONG_TEXT.strip() or "widget" in page and LONG_TEXT.strip() in html_text.main_text(page), page


def test_windows_decide_pages_without_an_article():
    """Unnamed boilerplate around dense text: lines alone, without the windows, would keep it."""
    links = f"<p><a href=x>{'m' * 20}</a></p>" * 4
    boiler = "".join(f"<div>{links}</div><section><p>Line {i}</p></section>" for i in range(6))
    page = f"<body><div>{boiler}{links}</div><section><p>{LONG_TEXT}</p><p>End.</p></section><div><div>{links}</div>{boiler}</div></body>"
    lines, marked = html_text.lines_of(page)
    assert not marked and sum(1 for x in lines if x.linked * 2 <= len(x.text)) > 2
    assert html_text.main_text(page) == LONG_TEXT.strip() + "\nEnd."


def test_awkward_markup_takes_linear_time():
    n = 1 << 18
    pages = ["<div>" * (n // 12) + "</span>" * (n // 14), "<b c='d " * (n // 9), "<b" * (n // 2), "<a '>' " * (n // 7), "<p \"'" * (n // 5),
             "<b>" * (n // 6) + "x</div>" * (n // 14), "<svg>" + "</svg " * (n // 6), "<!" * (n // 2), "<title a='>" * (n // 11),
             "<div class=menu>" * (n // 30) + "<article>" * (n // 18),
             "".join(f"<x{i} class=menu>" for i in range(n // 40)) + "<article>" * (n // 18), "x<p>" * (n // 4)]
    for page in pages:
        begun = time.process_time()
        html_text.main_text(page)
        assert time.process_time() - begun < 5, page[:40]


COPIES = "doc_id long, text string, lang string, source string, n_chars long, _id long, _sha string, _copies int, _n int, _i int, _m int, _s string, row int, copies string"


def test_copies_with_clashing_columns(spark):
    def row(i, text, n=7):
        return (i, text, None, "s", None, 1, "x", 2, n, 4, 5, "y", 6, "z")

    rows = [row(1, "a b"), row(2, "ab"), row(2, "ab", 8), row(3, None), row(4, ""), row(5, " \n"), row(None, "c"), row(None, "c "), row(6, "c"),
            row(7, "d d"), row(7, "d d"), row(7, "dd")]
    docs = spark.createDataFrame(rows, COPIES).repartition(3)
    got = exact_dedup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"], r["_n"]) for r in got.collect()) == [("1", "a b", 7), ("5", " \n", 7), ("7", "d d", 7), ("None", "c ", 7)]
    assert exact_dedup.keep_one(docs.where("doc_id = 2")).count() == 1
    assert exact_dedup.keep_one(docs.limit(0)).collect() == []


def test_stages_on_awkward_tables(spark):
    """Nulls, repeated rows and clashing columns through every stage that returns documents."""
    good = spark.read.parquet(f"{SF001}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0), (1, None, "en", None, 0), (2, "", None, "s", 0),
                                 (None, "word " * 30, "en", "s", 3)], good.schema)
    docs = good.unionByName(good).unionByName(odd)
    for c in ("_id", "_sha", "_copies", "_n", "_i", "_m", "_s", "component_id", "fingerprint", "score", "keep_id", "kept", "n_words"):
        docs = docs.withColumn(c, F.lit(7))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        assert {r["_n"] for r in out.collect()} == {7}, name
