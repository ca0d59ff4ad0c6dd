"""Main text of pages of many layouts: what must stay and what must go."""

import random

import pytest

from ledgermill.llm import main_text

TREE = main_text.trained_tree()


def prose(n, seed):
    rng = random.Random(seed)
    words = "the river had risen by noon and people of every street carried sacks to walls that would not hold until evening".split()
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


A, B, C, D = prose(48, 1), prose(30, 2), prose(22, 3), prose(14, 4)
MENU = "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/s>Sport</a></ul></nav>"
FOOT = "<footer><p>Copyright by the paper</p><a href=/i>Imprint</a></footer>"


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def text(body):
    return main_text.main_text(f"<html><head><title>x</title></head><body>{MENU}{body}{FOOT}</body></html>", TREE)


@pytest.mark.parametrize("element", [
    "<div class='social-science'>", "<div class='comment-free'>", "<div class='search-results article-body'>", "<div id=content>",
    "<div class='content has-sidebar'>", "<form id=aspnetForm>", "<div class='widget'>", "<section role=main>", "<article>", "<div class='header-less'>",
])
def test_the_element_that_holds_the_text_keeps_it(element):
    tag = element[1:].split()[0].rstrip(">")
    assert text(f"{element}<h1>Rising water</h1>{paragraphs(A, B, C, D)}</{tag}>") == "\n".join(["Rising water", A, B, C, D])


def test_a_paragraph_whose_name_only_hints(): 
    body = f"<div class=content>{paragraphs(A, B)}<div class='share-story'><p>{C}</p></div>{paragraphs(D)}</div>"
    assert text(body) == "\n".join([A, B, C, D])


def test_header_of_an_article():
    body = f"<article><header><h1>Rising water</h1><p>{D}</p></header>{paragraphs(A, B)}</article>"
    assert text(body) == "\n".join(["Rising water", D, A, B])
    body = f"<header class='site-header'><p>{C}</p></header><article>{paragraphs(A, B)}</article>"
    assert text(body) == "\n".join([A, B])


def test_formulas_are_text():
    assert text(f"<article><p>{A} <math><mi>x</mi></math> {B}</p></article>").endswith(f"x {B}")


@pytest.mark.parametrize("element", [
    "<section id=disqus_thread>", "<div class='comments'>", "<div id='comment-list'>", "<aside>", "<div class='sidebar-right'>",
    "<div class='related-posts'>", "<div class='cookie-banner'>", "<div class='newsletter-box'>", "<form class='login'>", "<div class='share-buttons'>",
])
@pytest.mark.parametrize("inside", [True, False])
def test_furniture_goes(element, inside):
    tag = element[1:].split()[0].rstrip(">")
    extra = f"{element}<p>{C}</p><p>{D}</p></{tag}>"
    body = f"<article>{paragraphs(A, B)}{extra}</article>" if inside else f"<article>{paragraphs(A, B)}</article>{extra}"
    assert text(body) == "\n".join([A, B])
    assert text(f"<div class=text>{paragraphs(A, B)}</div>{extra}") == "\n".join([A, B])


def test_many_comments_stay_furniture():
    body = f"<div class=text>{paragraphs(A, B)}</div><div class=comments>{paragraphs(*[prose(30, 50 + i) for i in range(6)])}</div>"
    assert text(body) == "\n".join([A, B])


def test_letters_that_grow_when_lowered():
    body = "\u0130" * 60 + f"<script>var x = 1;</script><article>{paragraphs(A, B)}</article>"
    assert text(body).endswith("\n".join([A, B]))
    assert text(f"<article><p>{'\u0130' * 60}</p><SCRIPT>a</sCript><p>{A}</p><style>b</style><p>{B}</p></article>").endswith("\n".join([A, B]))


@pytest.mark.parametrize("element", ["<article>", "<div class=text>"])
def test_a_short_last_paragraph_before_links(element):
    tag = element[1:].split()[0].rstrip(">")
    links = "<div><a href=/1>One</a> <a href=/2>Two more</a></div>"
    assert text(f"{element}{paragraphs(A, B, prose(9, 9))}</{tag}>{links}") == "\n".join([A, B, prose(9, 9)])


def test_link_lists_go_by_their_links_and_neighbours():
    links = "".join(f"<li><a href=/{i}>{prose(5, 70 + i)}</a>" for i in range(5))
    body = f"<div class=text>{paragraphs(A, B)}</div><div><h3>Elsewhere</h3><ul>{links}</ul></div>"
    assert text(body) == "\n".join([A, B])
