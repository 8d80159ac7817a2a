"""Layout elements that carry a word like sidebar around the main text."""

import pytest

from quaymart.llm import html_wrappers as H

TEXT = "A long paragraph of the article with many words in it. " * 4
SIDE = '<div class="sidebar"><p>Side text of some words</p></div>'
ARTICLE = f"<article><h1>Title</h1><p>{TEXT}</p><div class='share'>Share it</div></article>"
WANT = "Title\n" + TEXT.strip()


@pytest.mark.parametrize("page", [
    f'<body><div class="row has-sidebar">{ARTICLE}{SIDE}</div></body>',
    f'<body><div id="page" class="right-sidebar"><div class="search-results widget">{ARTICLE}</div>{SIDE}</div></body>',
    f'<body><main><h2>Site</h2><div class="with-related">{ARTICLE}{SIDE}</div></main></body>',
    f'<body><p>A line</p><section class="discussion"><div role="main"><h1>Title</h1><p>{TEXT}</p></div></section></body>',
    f'<body><p>A line</p><div class="no-sidebar"><h1>Title</h1><p>{TEXT}</p>{SIDE}</div></body>',
])
def test_layout_around_the_text(page):
    got = H.extract(page, set())
    assert got in (WANT, "A line\n" + WANT) and "Side" not in got and "Share" not in got
    wrapper = None
    for i in range(4):
        wrapper = H.align(wrapper, H.seed(H.parse(page.replace("long", f"long{i}"))[0]))
    assert "long" in H.extract(page, {tuple(p) for p in H.main_paths(wrapper)})


@pytest.mark.parametrize("page", [
    f'<body>{ARTICLE}<div class="related"><article><p>{TEXT * 9}</p></article></div></body>',
    f'<body><main><h1>Title</h1><p>{TEXT}</p><div class="related"><article><p>Teaser</p></article></div></main></body>',
    f'<body><div class="c1"><h1>Title</h1><p>{TEXT}</p></div><div class="comments"><p>{TEXT * 9}</p></div><div class="ad">{TEXT * 9}</div></body>',
    f'<body><div class="c1"><h1>Title</h1><p>{TEXT}</p></div><div class="sidebar"><p>{TEXT * 2}</p></div></body>',
])
def test_words_still_tell(page):
    assert H.extract(page, set()) == WANT
