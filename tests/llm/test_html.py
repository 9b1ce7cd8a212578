"""Main text: legal but unusual markup, and generated pages whose article is known."""

import random
import time

import pytest

from assaymill.llm import html

TEXT = ("It was the best of the times and the worst of the times in the city that he had to leave for the sea. " * 3).strip()


@pytest.mark.parametrize("page,texts", [
    (f"<html><head><title>x</title><meta a=b><body><p>{TEXT}</p>", 1),
    (f"<head><title>x</title><link rel=y><p>{TEXT}<p>{TEXT}", 2),
    (f"<body><p title=it's>{TEXT}</p><p>{TEXT}</p>", 2),
    (f"<p title=\"never closed>{TEXT}</p><p>{TEXT}</p>", 2),
    (f"<p title='a > b' data-x=\"it's > that\">{TEXT}</p>", 1),
    (f"<p>{TEXT}</p><p><a href=/topic/>{TEXT}</a></p><p>{TEXT}</p>", 2),
    (f"<p>{TEXT}</p><ul><li><a href=/topic/>A topic</a><li><a href=/b/>Another topic</a></ul><p>{TEXT}</p>", 2),
    (f"<div class=search-and-rescue><p>{TEXT}</p></div>", 1), (f"<section id=notices-of-war><p>{TEXT}</p></section>", 1),
    (f"<div class='social-history'><p>{TEXT}</p></div><div class='social-share'><p>{TEXT}</p></div>", 1),
    (f"<div class=related-posts><p>{TEXT}</p></div><div id=side-bar><p>{TEXT}</p></div><p>{TEXT}</p>", 1),
    (f"<svg class=x /><p>{TEXT}</p><svg><path d='M0 0'/><title>no</title></svg><p>{TEXT}</p>", 2),
    (f"<p/>{TEXT}<br/>{TEXT}", None), ("<p", 0), ("<", 0), ("</", 0), ("&amp;", 0)])
def test_unusual_markup(page, texts):
    got = html.main_text(page)
    assert got == f"{TEXT} {TEXT}" if texts is None else got.split("\n").count(TEXT) == texts and (texts == 0 or set(got.split("\n")) == {TEXT})


def test_time_is_linear_in_broken_pages():
    started = time.perf_counter()
    for n in (20_000, 40_000):
        html.main_text("<b>" * n + "</i>" * n + "x")
        html.main_text("<div>" * n + "</p>" * n + TEXT)
        html.main_text("<nav>" + "<article>" * n + "</div>" * n + TEXT)
        html.main_text("<p " + "a=' " * n + TEXT)
        html.main_text("<p " + "a=\"" * n + TEXT)
        html.main_text("<!--" * n + "<script>" * n + TEXT)
    assert time.perf_counter() - started < 20


def generated(r: random.Random) -> tuple[str, list[str]]:
    """A page with a known article; end tags, quotes and the head's end are left out at random."""
    words = "the of and to in a is that it for on with river stone window market evening letter garden mountain".split()

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n)).capitalize() + "."

    def end(tag):
        return "" if r.random() < 0.5 else f"</{tag}>"

    def attrs():
        return "".join(r.choice([" title=it's", ' data-a="x > y"', " lang=en", " class=body-text", " href=/a/", ""]) for _ in range(2))

    article = [prose(r.randint(60, 120)) for _ in range(r.randint(2, 6))]
    inner = []
    for p in article:
        half = len(p) // 2
        inner.append(f"<p{attrs()}>{p[:half]}<{r.choice(['b', 'i', 'em'])}>{p[half:]}" + end("p"))
    if r.random() < 0.5:
        inner.insert(1, f"<div class=\"{r.choice(['ad-slot', 'share-buttons', 'newsletter-box', 'related-posts'])}\"><p>{prose(50)}</p></div>")
    wrap = r.choice([("<article>", "</article>"), ("<main><article class=post>", "</article></main>"), ("<main>", "</main>"), ("<div id=story>", "</div>")])
    menu = "<nav><ul>" + "".join(f"<li><a href=/{i}/>{prose(2)}</a>" + end("li") for i in range(8)) + "</ul></nav>"
    head = f"<html><head><title>{prose(4)}</title><meta charset=utf-8>" + end("head") + r.choice(["<body>", ""])
    foot = f"<aside><p>{prose(60)}</p></aside><footer><p>{prose(40)}</p></footer><section class=comments><p>{prose(70)}</p></section>"
    return head + menu + wrap[0] + "".join(inner) + wrap[1] + foot + "</stray>" * r.randint(0, 3), article


def test_generated_pages_give_their_article():
    for seed in range(400):
        page, article = generated(random.Random(seed))
        assert html.main_text(page) == "\n".join(article), seed


def test_tables(spark):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "clash", "clash"), (None, "u", f"<p>{TEXT}</p>", None, None), (1, None, None, "clash", "clash"), (2, "v", "", "", "")]
    got = html.extract(spark.createDataFrame(rows, kind)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, "", 0), (1, None, "", 0), (2, "v", "", 0), (None, "u", TEXT, len(TEXT))], key=str)
    assert html.extract(spark.createDataFrame([], kind)).count() == 0
