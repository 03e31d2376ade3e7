"""Main text: learned marks, regions against all pairs of positions, broken and deep pages."""

import random
import time

import pytest

from gitsift.llm import page_text

WORDS = "some words of the text here. " * 30
ARTICLE = f"<p>{WORDS}</p>"
LABELLED = (f'<body><div class="promo-box">buy this now</div><article><h1>Title</h1>{ARTICLE}'
            f'<div class="note">kept because it stands in articles</div></article></body>')


@pytest.fixture(scope="module")
def weights(spark):
    rows = [(i, "u", LABELLED) for i in range(20)]
    return page_text.learn_weights(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_marks_are_learned_from_labelled_pages(weights):
    odds = page_text.marks_in(weights)
    assert odds["promo-box"] <= page_text.HOLE < odds["note"]
    text = page_text.main_text(LABELLED, weights)
    assert "kept because" in text and "buy this" not in text
    # The same marks in a page without article, in the middle of its text.
    page = f'<div>{ARTICLE}<div class="promo-box">buy this now</div>{ARTICLE}<p class="note">shared</p>{ARTICLE}</div>'
    text = page_text.main_text(page, weights)
    assert "buy this" not in text and "shared" in text and text.count("some words") == 90


def test_only_as_many_marks_are_kept_as_stated(spark, monkeypatch):
    monkeypatch.setattr(page_text, "MAX_MARKS", 2)
    rows = [(i, "u", f'<body><p class="m{i}">{"w " * (i + 1)}</p><article>{ARTICLE}</article></body>') for i in range(6)]
    found = page_text.learn_weights(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert set(page_text.marks_in(found)) == {"m4", "m5"}


@pytest.mark.parametrize("page, wanted", [
    (f'<div class="overflow-hidden">{ARTICLE}</div>', "some words"),
    (f'<div class="layout with-sidebar">{ARTICLE}</div>', "some words"),
    (f'<article>{ARTICLE}<p>see <a href="/hidden-valley">the valley</a></p></article>', "the valley"),
    (f'<article>{ARTICLE}<p>a <span id="search-tree">search tree</span></p></article>', "search tree"),
    (f"<article>{ARTICLE}<figure><figcaption>a caption</figcaption></figure>{ARTICLE}</article>", "a caption"),
    (f"<article>{ARTICLE}<p>so <math>a + b</math></p></article>", "a + b"),
    (f'<article>{ARTICLE}<p title="hidden">shown</p></article>', "shown"),
    (f'<article>{ARTICLE}<p hidden="false">shown</p></article>', "shown"),
])
def test_article_text_stays(weights, page, wanted):
    assert wanted in page_text.main_text(page, weights)


@pytest.mark.parametrize("attributes", [
    "hidden", 'hidden=""', 'style="color:red; display : none"', "aria-hidden=true", 'class="x advertisement"',
    'role="complementary"', "id='cookie'", 'class="cookie-notice big"', "class=share_widget"])
def test_hidden_and_marked_elements_go(weights, attributes):
    page = f"<article>{ARTICLE}<div {attributes}>goes away</div><p>last line</p></article>"
    text = page_text.main_text(page, weights)
    assert "goes away" not in text and text.endswith("last line")


def test_best_region_equals_all_pairs():
    rng = random.Random(3)
    for _ in range(400):
        scores = [rng.choice((-3.0, -1.0, -0.25, 0.0, 0.5, 1.0, 2.0)) for _ in range(rng.randrange(25))]
        spans = [(a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        best = max((sum(scores[a:b]) for a, b in spans), default=0.0)
        a, b = page_text.best_region(scores)
        assert sum(scores[a:b]) == max(best, 0.0)


@pytest.mark.parametrize("page", [
    "<a " * 350_000, '<a "' * 250_000, "<a " * 300_000 + '">', "<div>" * 200_000,
    "<b>" * 50_000 + "<div></div>" * 50_000, "<li><ul>" + "<div>" * 60_000 + "<li></li>" * 60_000,
    "<p>" + "<i>" * 80_000 + "<td></td>" * 60_000, "<![CDATA[" * 100_000, "<script>" * 120_000, "<!" * 400_000,
    "".join(f'<div class="c{i}">x ' for i in range(40_000)), "a < b & " * 120_000])
def test_broken_and_deep_pages_take_linear_time(weights, page):
    start = time.process_time()
    page_text.main_text(page, weights)
    page_text.count_features(page)
    assert time.process_time() - start < 20  # seconds for a page of about a megabyte, twice


def test_broken_markup_keeps_text(weights):
    assert page_text.main_text(f'<p>{WORDS}<a href="x>open quote</p><p>after</p>', weights).startswith("some words")
    assert page_text.main_text(f"<article>{ARTICLE}<p>the end <b", weights).endswith("the end")
    assert page_text.main_text(f"</div></p>{ARTICLE}</x>", weights).startswith("some words")
