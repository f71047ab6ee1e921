import pytest

from tidelog.llm.html import learn_tree, main_text

TREE = learn_tree()
LONG = " ".join(f"word{i}" for i in range(60)) + "."
MORE = " ".join(f"more{i}" for i in range(45)) + "."
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About us</a></li></ul></nav>"


def text(html):
    return main_text(html, TREE)


@pytest.mark.parametrize("remark", [
    '<section class="comment-list"><article class="comment"><p>{0}</p></article></section>',
    '<article class="comment"><p>{0}</p></article>',
    '<div id="comments"><article class="c1"><p>{0}</p></article></div>',
    '<article class="sponsored"><p>{0}</p></article>',
    '<article class="ad-300x250"><p>{0}</p></article>',
    '<div class="user-comments"><p>{0}</p><p>{0}</p></div>',
])
@pytest.mark.parametrize("page", ["<main><article><h1>Title</h1><p>{0}</p><p>{1}</p></article>{2}</main>", "<article><h1>Title</h1><p>{0}</p><p>{1}</p></article>{2}"])
def test_what_readers_and_sponsors_say_goes(page, remark):
    html = MENU + page.format(LONG, MORE, remark.format("I disagree with all of this " * 8)) + "<footer><p>All rights reserved</p></footer>"
    assert text(html) == f"Title\n\n{LONG}\n\n{MORE}"


@pytest.mark.parametrize("name", ["story social-science", "public-notice-board", "ad-free", "with-comments", "has-sidebar", "header-fixed"])
def test_parts_of_names_do_not_lose_an_article(name):
    assert text(f'{MENU}<div class="{name}"><p>{LONG}</p><p>{MORE}</p></div>') == f"{LONG}\n\n{MORE}"


@pytest.mark.parametrize("name", ["cookie-notice", "site-header", "ad-slot", "sidebar-left", "newsletter-box", "ad", "social-links"])
def test_names_of_boilerplate_do(name):
    small = " ".join(f"small{i}" for i in range(14))
    assert text(f'<div class="{name}"><p>{small}</p></div><article><p>{LONG}</p><p>{MORE}</p></article>') == f"{LONG}\n\n{MORE}"


def test_text_without_spaces():
    first, second = "中文字符没有空格" * 38 + "。", "日本語のテキスト" * 25 + "。"
    assert text(f"{MENU}<div><p>{first}</p><p>{second}</p></div><footer><a href='/'>联系我们</a></footer>") == f"{first}\n\n{second}"


def test_a_paragraph_of_one_link_between_kept_ones():
    link = "<p>See <a href='/x'>this long link to the report that was published last week</a></p>"
    html = f"{MENU}<article><p>{LONG}</p>{link}<p>{MORE}</p></article>"
    assert text(html) == f"{LONG}\n\nSee this long link to the report that was published last week\n\n{MORE}"
    assert "Also read" not in text(f'<article><p>{LONG}</p><div class="related"><a href="/y">Also read</a></div><p>{MORE}</p></article>')
