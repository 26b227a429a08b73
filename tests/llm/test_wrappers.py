"""Wrapper induction: what only the comparison of a host's pages can tell, and what names must not decide."""

import random
from functools import lru_cache
from itertools import combinations

import pytest

from civiq.llm import wrappers

SHAPE = "page_id long, url string, html string, text string, host string, slot string"


def extracted(llm, pages, url="http://a.example/x"):
    rows = [(i, u if u is not None else url, h, "t", "h", "s") for i, (u, h) in enumerate(pages)]
    return {r.page_id: r.text for r in wrappers.extract(llm.createDataFrame(rows, SHAPE)).collect()}


def plain_page(i, comments):
    """No element says what it is for; menu, notice and imprint are the same on all pages, comments vary in number."""
    pick = random.Random(i)
    said = "".join(f"<div class=x><div class=y>User {pick.randrange(99)}</div><p>{pick.choice(['I agree', 'Not so'])} number {pick.random()}</p></div>"
                   for _ in range(comments))
    body = f"<h1>Title {i}</h1><p>Opening words of page {i} about {pick.random()} and more of it to read here.</p><p>It goes on, page {i}, for {pick.random()} lines more.</p>"
    return (f"<body><div class=a><ul><li>Home</li><li>Topics</li></ul></div><div class=b>We are moving house soon.</div>"
            f"<div class=c>{body * 3}</div><div class=d>{said}</div><div class=e>Imprint of the publisher</div></body>"), (
            f"Title {i}", f"Opening words of page {i}")


def test_menus_notices_and_comments_without_telling_names(llm):
    pages = [plain_page(i, (0, 2, 3, 1, 4, 0, 2)[i]) for i in range(7)]
    found = extracted(llm, [(None, h) for h, _ in pages])
    for i, (html, (title, opening)) in enumerate(pages):
        text = found[i]
        assert text.startswith(f"{title}\n\n{opening}") and text.count(title) == 3 and len(text.split("\n\n")) == 9
        for foreign in ("Home", "moving house", "Imprint", "User", "number"):
            assert foreign not in text
        # Without induction none of it could be told.
        alone = wrappers.main_text(wrappers.parse(html), set())
        assert "Home" in alone and "moving house" in alone and "Imprint" in alone


def test_a_host_of_few_pages_induces_nothing(llm):
    pages = [plain_page(i, 0) for i in range(2)]
    assert all("Imprint" in t for t in extracted(llm, [(None, h) for h, _ in pages]).values())


def test_copies_of_a_page_make_nothing_template(llm):
    html = [f"<body><div class=ad>Buy {i}</div><div class=c><p>The same article on every page of the host.</p></div></body>" for i in range(9)]
    assert set(extracted(llm, [(None, h) for h in html]).values()) == {"The same article on every page of the host."}


@pytest.mark.parametrize("element", [
    '<section id="related-work"><p>{}</p></section>', '<h2 id="search-trees">{}</h2>', '<p class="social-history">{}</p>',
    '<div id="notice-of-appeal"><p>{}</p></div>', '<div class="no-sidebar"><p>{}</p></div>', '<p class="notice">{}</p>',
    '<ul><li class="comment">{}</li></ul>', '<h3 id="search">{}</h3>',
])
def test_article_text_stays_whatever_its_elements_are_called(element):
    page = f"<body><nav>menu</nav><article><h1>Top</h1>{element.format('Kept words')}</article><footer>foot</footer></body>"
    assert wrappers.main_text(wrappers.parse(page), set()) == "Top\n\nKept words"


@pytest.mark.parametrize("page", [
    '<div class="page has-sidebar"><p>Words</p></div>', '<div class="with-comments"><p>Words</p></div>', '<div class="page-with-menu"><p>Words</p></div>',
])
def test_a_page_is_not_lost_by_a_name_around_it(page):
    assert wrappers.main_text(wrappers.parse(f"<body>{page}</body>"), set()) == "Words"


@pytest.mark.parametrize("name", ["ad", "ad-slot", "site-footer", "comment-list", "cookie-banner", "sidebar right", "widget_area", "top-nav"])
def test_whole_words_tell(name):
    page = f'<body><article><p>Text</p><div class="{name}"><span>away</span></div></article><div id="{name}">away too</div></body>'
    assert wrappers.main_text(wrappers.parse(page), set()) == "Text"


def test_labels_and_buttons_in_a_sentence_are_words_of_it():
    page = ("<article><p>Press <button>OK</button> to go on, or tick <label>the <b>box</b></label> first.</p>"
            "<label>Name</label><button>Send</button><form><p><label>Mail</label></p></form></article>")
    assert wrappers.main_text(wrappers.parse(page), set()) == "Press OK to go on, or tick the box first."


def test_records_are_small_and_vary_in_number():
    reference = "0>html|1>body|2>section|3>h2|3>p|2>div.r|6>div|6>p|2>div.two|9>p"
    def stat(slot, chars, times, fewest, most):
        return {"slot": slot, "pages": 5, "chars": chars, "times": times, "fewest": fewest, "most": most}

    sections = [stat(3, 0, 20, 2, 6), stat(4, 200, 20, 2, 6), stat(5, 9000, 60, 2, 20)]
    records = [stat(6, 0, 30, 0, 9), stat(7, 300, 30, 0, 9), stat(8, 2000, 30, 0, 9)]
    same = [stat(9, 0, 10, 2, 2), stat(10, 500, 10, 2, 2)]
    assert wrappers.record_slots(reference, sections + records + same, set()) == {6}
    # Sections with headings are no records, even where they have the lesser part of the text.
    assert wrappers.record_slots(reference, [*sections[:2], stat(5, 900, 60, 2, 20), *records], set()) == set()
    rooted = reference.replace("1>body", "1>article")
    assert wrappers.record_slots(rooted, sections + records, set()) == set()


def random_tree(pick, size):
    keys = ["page"] + [pick.choice("abc") for _ in range(size)]
    parents = [-1] + [pick.randrange(i) for i in range(1, size + 1)]
    return "|".join(f"{p}>{k}" for p, k in zip(parents[1:], keys[1:]))


def best_matching(a, b):
    """The most nodes that any order-keeping match of two trees pairs, children under matched parents, by trying all."""
    (keys_a, below_a), (keys_b, below_b) = wrappers.tree_of(a), wrappers.tree_of(b)

    @lru_cache(None)
    def best(x, y):
        if keys_a[x] != keys_b[y]:
            return 0
        most = 0
        for k in range(min(len(below_a[x]), len(below_b[y])) + 1):
            for left in combinations(below_a[x], k):
                for right in combinations(below_b[y], k):
                    each = [best(p, q) for p, q in zip(left, right)]
                    if all(each):
                        most = max(most, sum(each))
        return most + 1

    return best(0, 0)


@pytest.mark.parametrize("seed", range(40))
def test_alignment_matches_as_much_as_any(seed):
    pick = random.Random(seed)
    a, b = random_tree(pick, pick.randint(0, 8)), random_tree(pick, pick.randint(0, 8))
    found = wrappers.align(a, b)
    (keys_a, below_a), (keys_b, below_b) = wrappers.tree_of(a), wrappers.tree_of(b)
    assert len(found) == best_matching(a, b) and len(set(found.values())) == len(found)
    above = {c: p for p, children in enumerate(below_a) for c in children}
    up = {c: p for p, children in enumerate(below_b) for c in children}
    for x, y in found.items():
        assert keys_a[x] == keys_b[y] and (x == 0 or found[above[x]] == up[y])


def test_the_query_keeps_every_page_and_no_markup(llm):
    from civiq.llm import queries

    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in llm.read.parquet(f"{folder}/pages.parquet").collect()}
    found = {r.page_id: r for r in queries.QUERIES["op6_wrappers"](llm, folder).collect()}
    assert found.keys() == pages.keys()
    for i, html in pages.items():
        # These pages have their text in an article without anything else in it.
        inner = html.partition("<article>")[2].partition("</article>")[0] if html else ""
        if inner and "<" not in (body := wrappers.main_text(wrappers.parse(inner), set())):
            assert found[i].text == body and found[i].n_chars == len(body)
