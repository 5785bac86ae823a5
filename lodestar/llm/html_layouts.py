"""Labelled pages on which the extractor is trained.

Pages are composed by a seeded rule from layouts in common use.  Every part
says by ``data-main`` whether its blocks are main text ("1") or not ("0"); the
extractor never uses that attribute as a feature.  Parts nest: adverts,
related links, forms and reader comments also stand inside the article.
"""

from __future__ import annotations

import random

_SYLLABLES = "ba den lor mi que ter sa ung ver ento ist ona ier ré ñu chä th er ing wh".split()

ARTICLES = [("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="main-content"'),
            ("div", 'class="post-body entry"'), ("section", 'class="article-text"'), ("div", 'class="story"'),
            ("div", 'itemprop="articleBody" class="text"'), ("div", 'class="entry-content"'), ("td", 'class="body"')]
MENUS = [("nav", ""), ("ul", 'class="menu"'), ("div", 'class="navbar"'), ("div", 'id="nav"'), ("nav", 'class="breadcrumb"'),
         ("div", 'class="breadcrumbs"'), ("div", 'role="navigation"'), ("ul", 'class="topnav links"'), ("menu", ""),
         ("div", 'class="pagination"'), ("div", 'class="tags"')]
HEADERS = [("header", ""), ("div", 'class="header"'), ("div", 'id="masthead"'), ("header", 'class="site-header"'),
           ("div", 'class="topbar"'), ("div", 'role="banner"')]
FOOTERS = [("footer", ""), ("div", 'class="footer"'), ("div", 'id="copyright"'), ("footer", 'class="site-footer"'),
           ("div", 'class="legal"')]
SIDEBARS = [("aside", ""), ("div", 'class="sidebar"'), ("aside", 'class="related"'), ("div", 'id="sidebar" class="widget"'),
            ("div", 'class="related-posts"'), ("div", 'class="recommended"'), ("div", 'role="complementary"')]
NOTICES = [("div", 'class="cookie-notice"'), ("div", 'class="notice"'), ("div", 'id="cookie-banner"'),
           ("div", 'class="alert"'), ("div", 'class="consent popup"'), ("div", 'class="gdpr"'), ("p", 'class="disclaimer"'),
           ("div", 'role="alert"'), ("dialog", ""), ("div", 'class="modal"')]
ADVERTS = [("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'id="advert"'), ("div", 'class="advertisement"'),
           ("div", 'class="sponsored"'), ("div", 'class="promo"'), ("aside", 'class="ad"'), ("ins", 'class="adsbygoogle"'),
           ("section", 'class="banner"'), ("p", 'class="ad"')]
FORMS = [("form", ""), ("form", 'class="newsletter"'), ("div", 'class="subscribe signup"'), ("div", 'class="login"'),
         ("form", 'class="search"'), ("form", 'id="comment-form"'), ("fieldset", ""), ("div", 'class="newsletter"')]
COMMENTS = [("div", 'class="comments"'), ("section", 'id="comments"'), ("div", 'class="comment"'), ("ol", 'class="comment-list"'),
            ("section", 'class="reader-comments"'), ("div", 'id="disqus_thread"'), ("div", 'class="replies"'),
            ("div", 'class="discussion"')]
SHARES = [("div", 'class="share"'), ("ul", 'class="social"'), ("div", 'class="byline meta"'), ("div", 'class="author-bio"')]
WRAPPERS = [("div", ""), ("div", 'class="wrapper"'), ("div", 'id="page"'), ("div", 'class="container"'), ("section", "")]


class _Writer:
    def __init__(self, rnd: random.Random):
        self.rnd = rnd

    def words(self, low: int, high: int) -> str:
        rnd = self.rnd
        out = ["".join(rnd.choice(_SYLLABLES) for _ in range(rnd.choice([1, 1, 2, 2, 3])))
               for _ in range(rnd.randint(low, high))]
        return " ".join(out).capitalize()

    def sentences(self, most: int) -> str:
        return " ".join(self.words(1, 14) + self.rnd.choice(["."] * 5 + ["?", "!", ""])
                        for _ in range(self.rnd.randint(1, most)))

    def part(self, kinds, inner: str, main: int) -> str:
        tag, attributes = self.rnd.choice(kinds)
        return f'<{tag} {attributes} data-main="{main}">{inner}</{tag}>'

    def links(self) -> str:
        tag = self.rnd.choice(["li", "li", "div", "p", "span"])
        items = "".join(f'<{tag}><a href="/x">{self.words(1, 4)}</a></{tag}>' for _ in range(self.rnd.randint(1, 7)))
        return f"<ul>{items}</ul>" if tag == "li" else items

    def text(self, most: int = 3) -> str:
        rnd = self.rnd
        return rnd.choice([
            lambda: self.sentences(most), lambda: f"<p>{self.sentences(most)}</p>",
            lambda: f"<h3>{self.words(1, 4)}</h3><p>{self.sentences(most)}</p>", self.links,
            lambda: "".join(f"<p>{self.sentences(most)}</p>" for _ in range(rnd.randint(1, 3)))])()

    def other(self) -> str:
        rnd = self.rnd
        kind = rnd.choice(["menu", "sidebar", "notice", "advert", "form", "share", "comments"])
        if kind == "menu":
            return self.part(MENUS, self.links(), 0)
        if kind == "sidebar":
            return self.part(SIDEBARS, self.text(), 0)
        if kind == "notice":
            return self.part(NOTICES, self.text() + rnd.choice(["", "<button>Ok</button>"]), 0)
        if kind == "advert":
            return self.part(ADVERTS, self.text(), 0)
        if kind == "form":
            return self.part(FORMS, f"<label>{self.words(1, 3)}</label><input name=q><p>{self.sentences(1)}</p>"
                             f"<button>{self.words(1, 2)}</button><select><option>{self.words(1, 2)}</select>", 0)
        if kind == "share":
            return self.part(SHARES, self.text(1), 0)
        return self.part(COMMENTS, "".join(
            rnd.choice([f"<div class=comment><b>{self.words(1, 2)}</b><p>{self.sentences(4)}</p></div>",
                        f"<li><p>{self.sentences(3)}</p></li>", f"<p>{self.sentences(3)}</p>"])
            for _ in range(rnd.randint(1, 4))), 0)

    def paragraph(self) -> str:
        rnd = self.rnd
        text = self.sentences(6)
        if rnd.random() < 0.2:
            text += f' <a href="/y">{self.words(1, 4)}</a> ' + self.sentences(2)
        return rnd.choice([
            *[f"<p>{text}</p>"] * 8, f"<p><b>{text}<br>", f"<p>{text}", f"<h2>{self.words(1, 6)}</h2>",
            f"<ul><li>{text}</li><li>{self.words(1, 8)}</li></ul>", f"<blockquote>{text}</blockquote>",
            f"<pre>{text}</pre>", f"<div>{text}</div>", f"<table><tr><td>{self.words(1, 3)}<td>{self.words(1, 5)}</table>",
            f"<figure><figcaption>{text}</figcaption></figure>", f"<p>{self.words(1, 2)}.</p>"])

    def page(self) -> str:
        rnd = self.rnd
        body = []
        if rnd.random() < 0.8:
            body.append(f"<h1>{self.words(2, 12)}</h1>")
        for _ in range(rnd.randint(0, 9)):
            body.append(self.paragraph())
            if rnd.random() < 0.15:
                body.append(self.other())
        top, bottom = [], []
        if rnd.random() < 0.6:
            top.append(self.part(HEADERS, rnd.choice([self.text(1), f"<h1>{self.words(1, 5)}</h1>"]), 0))
        top += [self.other() for _ in range(rnd.randint(0, 3))]
        bottom += [self.other() for _ in range(rnd.randint(0, 3))]
        if rnd.random() < 0.8:
            bottom.append(self.part(FOOTERS, rnd.choice(["&copy; " + self.sentences(2), self.text(1)]), 0))
        whole = "".join(top) + self.part(ARTICLES, "".join(body), 1) + "".join(bottom)
        if rnd.random() < 0.5:
            tag, attributes = rnd.choice(WRAPPERS)
            whole = f"<{tag} {attributes}>{whole}</{tag}>"
        return f'<html><head data-main="0"><title>{self.words(1, 9)}</title></head><body>{whole}</body></html>'


def labelled_pages(n: int, seed: int = 5) -> list[str]:
    writer = _Writer(random.Random(seed))
    return [writer.page() for _ in range(n)]
