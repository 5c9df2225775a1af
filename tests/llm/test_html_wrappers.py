"""Wrappers around an article have no veto."""

import pytest

from layoutlake.llm import html_text

LONG = "Long words of a paragraph that has no links and goes on for a good while so that nobody takes it for a label or a notice of any kind"


@pytest.mark.parametrize("wrapper", ['<form id="aspnetForm">', '<div class="content has-sidebar">', '<div class="site with-header">', '<div class="no-sidebar">', '<div class="layout-sidebar-right">', '<div class="modal">', "<header>", '<div class="paywall">'])
def test_html_wrappers_do_not_veto_an_article(wrapper):
    end = "</" + wrapper[1:-1].split()[0] + ">"
    for inner in ("article", "main", 'div role="main"'):
        assert html_text.main_text(f"<body><nav><a href=x>Home</a></nav>{wrapper}<{inner}><h1>Head line</h1><p>{LONG}<p>End</{inner.split()[0]}>{end}") == f"Head line\n{LONG}\nEnd"


@pytest.mark.parametrize("wrapper", ['<form id="aspnetForm">', '<div class="content has-sidebar">', '<div class="site with-header">', '<div class="layout-sidebar-right">'])
def test_html_words_decide_in_wrappers_without_article(wrapper):
    assert html_text.main_text(f"<body>{wrapper}<p>{LONG}</p><p>{LONG}</p><p><a href=x>One</a> <a href=y>Two</a></p>") == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("name", ["post-header", "article-header"])
def test_html_keeps_an_articles_headline(name):
    assert html_text.main_text(f"<article><div class={name}><h1>Head line</h1></div><p>{LONG}</p></article>") == f"Head line\n{LONG}"


@pytest.mark.parametrize("around", ["aside", "div class=comments", "div class=related", "nav", "footer", "div hidden"])
def test_html_other_articles_stay_out(around):
    assert html_text.main_text(f"<article><p>{LONG}</article><{around}><article><p>A teaser or comment {LONG}</article></{around.split()[0]}>") == LONG
