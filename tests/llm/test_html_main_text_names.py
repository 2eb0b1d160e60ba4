import pytest

from prosemill.llm.html_main_text import main_text

from .test_html_main_text import BODY, PAGE, TEXT

LONG = "A long passage of the article that goes on for many words and has no link in it at all, so that it is dense. " * 3


@pytest.mark.parametrize("name", ["content-with-sidebar", "layout has-sidebar", "page sidebar", "widget"])
@pytest.mark.parametrize("inner", ["article", "main"])
def test_a_wrapper_keeps_its_article(name, inner):
    assert main_text(PAGE.format(main=f"<div class='{name}'><div><{inner}>{BODY}</{inner}></div><div class='sidebar'><p>{LONG}</p></div></div>")) == TEXT


@pytest.mark.parametrize("name", ["content-with-sidebar", "widget"])
def test_a_wrapper_keeps_the_densest_node(name):
    text = main_text(f"<body><div class='menu'>Home</div><p>Site</p><div class='{name}'><div><p>{LONG}</p><p>{LONG}</p></div></div></body>")
    assert text == "\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("name", ["comment-body", "share-page", "related-work"])
def test_dense_sections_of_an_article_stay(name):
    page = PAGE.format(main=f"<article>{BODY}<section class='{name}'><p>{LONG}</p></section><div class='comments'><p>{LONG}</p></div></article>")
    assert main_text(page) == f"{TEXT}\n{LONG.strip()}"


def test_the_threshold_holds_below_an_article():
    thin = "<div>" + "".join(f"<span><i>{x}</i></span>" for x in "abc") + "</div>"
    assert main_text(f"<article>{BODY}{thin}<ul><li>first point of the list</li><li>second point of the list</li></ul></article>") == (
        f"{TEXT}\nfirst point of the list\nsecond point of the list")
