"""Tags of any length, and pages in which many tags never end."""

import time

from quaymart.llm import html_wrappers as H

LONG = "data:image/png;base64," + "iVBORw0KGgo/" * 20_000


def test_inline_image():
    for q in "\"'":
        page = f"<article><p>before <img src={q}{LONG}{q} alt={q}a > b{q}> after</p><a href={q}{LONG}{q}>link</a></article>"
        assert H.extract(page, set()) == "before after\nlink"


def test_window_does_not_show():
    for n in (H.WINDOW - 20, H.WINDOW - 1, H.WINDOW, H.WINDOW + 20):
        for tag in (f"<b title='{'x>' * (n // 2)}'>", f"<b {'y ' * (n // 2)}>", f"<b{'z' * n}>", f"<b a=\"{'x' * n}\"{'>' * 3}"):
            got = [t for t in H.tokens(f"1{tag}2")]
            assert got[0] == ("text", "", "1") and got[1][0] == "start" and got[2][2] in ("2", ">>2")


def test_endless_tags_take_linear_time():
    for page in ("<a '" * 100_000 + ">", "<a <b \"" * 50_000 + ">", "<a" * 200_000 + "\">", "<a \"'" * 50_000 + ">", "<a x" * 100_000, "<a x" * 100_000 + "\">"):
        start = time.perf_counter()
        list(H.tokens(page))
        assert time.perf_counter() - start < 10, page[:20]
