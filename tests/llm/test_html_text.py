"""Main texts that stand in several parts of a page."""

import random

import pytest

from smeltery.llm import html_text

LONG = "A long paragraph, with commas, and with more of the text than any other, " * 3
P = f"<p>{LONG}</p>"
L = LONG.strip()


@pytest.mark.parametrize(("page", "text"), [
    (f"<body><article>{P * 3}</article><article>{P}</article></body>", [L] * 4),
    (f"<body><article>{P * 9}</article><article><p>A short second part of the text.</p></article></body>", [L] * 9 + ["A short second part of the text."]),
    (f"<div><div><article>{P * 3}</article></div><div><article>{P * 2}</article></div></div>", [L] * 5),
    (f"<main><h1>T</h1><article>{P * 2}</article><p>The last words, beside the article.</p></main>", ["T", L, L, "The last words, beside the article."]),
    (f"<main><header><h1>T</h1></header><div><article>{P * 2}</article><article>{P}</article></div></main>", ["T", L, L, L]),
    (f"<body><h1>T</h1><main>{P}</main><p>short</p></body>", ["T", L]),
    (f"<body><article>{P * 3}</article><article><h3><a href=x>Another page of this site</a></h3><p>in short</p></article><div class=comments>{P}</div></body>", [L] * 3),
])
def test_parts_beside_an_article(page, text):
    assert html_text.main_text(page) == "\n".join(text)


M = "A menu of this site, and of others, with many entries"


@pytest.mark.parametrize(("page", "text"), [
    # Names that only look like those of menus, notices and adverts.
    (f"<div class='page no-sidebar'>{P * 2}</div>", [L] * 2),
    (f"<div id=content class='with-sidebar'><article>{P}</article></div>", [L]),
    (f"<body class='x'><div class='modal-open'>{P}</div></body>", [L]),
    (f"<article>{P}<p class='legal-basis'>The law, that is.</p><div class='ad-hoc'>A remark.</div>{P}</article>", [L, "The law, that is.", "A remark.", L]),
    (f"<div class='sidebar'>{P * 3}</div><p>x</p>", [L] * 3),
    # Names that are those, alone or beside words that say nothing.
    (f"<div class='site-footer'><p>{M}</p></div><div>{P * 2}</div><div class='AdBox ad_box_2'><p>{M}</p></div>", [L] * 2),
    (f"<article>{P}<div class='newsletter-signup'><p>{M}</p></div>{P}</article><div id=cookieNotice><p>{M}</p></div>", [L] * 2),
    (f"<article>{P}</article><section class='comment-list'>{P * 5}</section>", [L]),
    # Quotes in unquoted values.
    (f"<p title=Bob's>{LONG}</p>{P}", [L] * 2),
    (f"<div><p>See <a title=Bob's>here</a> what is, in truth, not isn't near: {LONG}</p>{P}</div>", [f"See here what is, in truth, not isn't near: {L}", L]),
    (f"<div data-x = 'a > b' data-y=\"c > d\">{P}</div>", [L]),
    (f"<p title='never closed>{LONG}", []),
    # Lists and tables of sources belong to the article.
    (f"<article>{P}<ul><li><a href=a>A source, of some length</a></li><li><a href=b>Another one</a></li></ul></article>", [L, "A source, of some length", "Another one"]),
    (f"<article>{P}<table><tr><td><a href=a>A link that is longer</a></td><td>cell</td></tr></table></article>", [L, "A link that is longer", "cell"]),
    (f"<div>{P}<ul><li><a href=a>Home</a></li><li><a href=b>Shop</a></li></ul>{P}</div>", [L] * 2),
])
def test_names_quotes_and_lists_of_links(page, text):
    assert html_text.main_text(page) == "\n".join(text)


def plain_best(tree):
    """The container whose paragraphs give it the most points, counted container by container."""
    nodes, todo = [], [tree]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += [c for c in node.children if not isinstance(c, str)]
    text = lambda n: sum(len(c.strip()) if isinstance(c, str) else text(c) for c in n.children)
    links = lambda n: text(n) if n.tag == "a" else sum(links(c) for c in n.children if not isinstance(c, str))
    dense = lambda n: links(n) / text(n) if text(n) else 0.0
    commas = lambda n: sum(c.count(",") if isinstance(c, str) else commas(c) for c in n.children)

    def points(container):
        total = 0.0
        for p in nodes:
            up, level = p.parent, 0
            while up is not None and up is not container:
                up, level = up.parent, level + 1
            if p.tag == "p" and up is container and level < 5 and text(p):
                total += (1 + commas(p) + min(text(p) / 100, 3)) * (1 - dense(p)) / (1, 2, 6, 9, 12)[level]
        return total * (1 - dense(container))

    return max((n for n in nodes if n.tag == "div"), key=points)


def test_best_container_of_small_trees():
    """Divisions of paragraphs, in any nesting: what is kept holds the container that a plain count finds."""
    rng = random.Random(2)

    def tree(depth):
        if depth == 0 or rng.random() < 0.4:
            link = "<a href=x>a link of some words</a>" if rng.random() < 0.3 else ""
            return f"<p>{'word, ' * rng.randint(0, 8)}{'more text ' * rng.randint(1, 30)}{link}</p>"
        return f"<div>{''.join(tree(depth - 1) for _ in range(rng.randint(1, 4)))}</div>"

    for _ in range(300):
        page = f"<div>{tree(4)}{tree(3)}</div>"
        root = html_text.parsed(page)
        kept = html_text.kept_nodes(html_text.measured(root))
        best = plain_best(root)
        assert any(k is best for k in kept)
