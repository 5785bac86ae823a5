import time

import pyarrow as pa
import pytest

from lodestar.llm import html_extract as hx
from lodestar.llm import html_layouts
from lodestar.llm.html_layouts import labelled_pages
from lodestar.llm.queries import QUERIES

CASES = [
    ("<html><head><title>T</title></head><body><nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class='ad'>Buy now.</div>"
     "<article><h1>Head line</h1><p>One &amp; two&nbsp;&lt;b&gt;\n  three.</p><p><b>Four <i>fi</i>ve<br>six.<br><p>Seven.</p>"
     "<aside>Related thing.</aside><div class=comments><p>Nice text!</p></div></article><footer>&copy; 2020 X</footer>",
     "Head line\nOne & two <b> three.\nFour five six.\nSeven."),
    ("<header><h1>Site</h1></header><div id='sidebar'><p>Side text here.</p></div><div class='cookie-notice'>We use cookies."
     "</div><main><p>Main text, a sentence.</p><form><label>Mail</label><input></form><p>Second one.</p></main>"
     "<section id=comments><p>I agree with this.</p></section>", "Main text, a sentence.\nSecond one."),
    ("<article><p>A<script>var x = '<p>no</p>';</script> b<style>p{}</style><!-- <p>c</p> --> d</p></article>", "A b d"),
    ("<article><p>Only &#233;&#x1F600; &unknown; 3 < 4.</p></article><script>never ends <p>x</p>", "Only é😀 &unknown; 3 < 4."),
    ("", ""), (None, ""), ("<nav><a href=x>Only menu</a></nav>", ""), ("<article></article>", ""),
    ("<article><p>a</p><!-- open", "a"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert hx.main_text(page, hx.default_field()) == text


def test_held_out_layouts():
    field, blocks_right, blocks, pages_right = hx.default_field(), 0, 0, 0
    pages = labelled_pages(200, seed=77)
    for page in pages:
        own = hx.leaf_blocks(page)
        gold, found = [hx.label_of(b[1]) for b in own], field.decode(own)
        blocks_right += sum(a == b for a, b in zip(gold, found, strict=True))
        blocks += len(own)
        pages_right += gold == found
    assert blocks_right / blocks > 0.99 and pages_right / len(pages) > 0.95


def test_viterbi_is_the_best_of_all_labellings():
    import itertools
    field = hx.train(labelled_pages(20), steps=5)
    for page in labelled_pages(40, seed=3):
        own = hx.leaf_blocks(page)[:9]
        if not own:
            continue
        emit = [[a + b for a, b in zip(field.score(hx._path_features(p)), field.score(hx.text_features(t, s)), strict=True)]
                for t, p, s in own]

        def score(labels, emit=emit):
            return (field.first[labels[0]] + sum(e[y] for e, y in zip(emit, labels, strict=True))
                    + sum(field.step[a][b] for a, b in itertools.pairwise(labels)))
        best = max(score(y) for y in itertools.product((0, 1), repeat=len(own)))
        assert score(field.decode(own)) == pytest.approx(best)


def test_query_on_odd_rows(spark, small):
    long = "<article>" + "".join(f"<p>Paragraph {i} goes on.</p>" for i in range(20000)) + "</article>"
    pages = [(i, f"u{i}", c[0]) for i, c in enumerate(CASES)] + [(None, None, long), (3, "u", CASES[0][0]), (3, "u", CASES[0][0])]
    t = pa.table({"page_id": pa.array([p[0] for p in pages], pa.int64()), "url": [p[1] for p in pages],
                  "html": pa.array([p[2] for p in pages], pa.string()), "text": ["z"] * len(pages), "n_chars": [1] * len(pages)})
    got = QUERIES["op1_crf_html_extraction"](spark, small(pages=t)).collect()
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["url"]: r["text"] for r in got}
    assert [by[f"u{i}"] for i in range(len(CASES))] == [c[1] for c in CASES]
    assert by[None].count("\n") == 19999
    assert QUERIES["op1_crf_html_extraction"](spark, small(pages=t.slice(0, 0))).collect() == []


def test_deep_nesting_and_stray_end_tags_take_linear_time():
    field = hx.default_field()
    began = time.perf_counter()
    for page, words in (("<div>word " * 100_000, 100_000), ("<b>" * 50_000 + "</i>x" * 50_000, 50_000),
                        ("<p><div>" + "<b>" * 50_000 + "<hr>y" * 50_000, 50_000), ("<ul>" + "<li>z<i>" * 50_000, 50_000)):
        blocks = hx.leaf_blocks(page)
        assert sum(len(b[0].split()) or 1 for b in blocks) >= words or len(blocks[0][0]) >= words
        assert len(field.decode(blocks)) == len(blocks)
    assert time.perf_counter() - began < 30


#: a layout of each kind that training never sees; words of them stand in others
UNSEEN = {"ARTICLES": ("div", 'class="entry-content"'), "MENUS": ("nav", 'class="breadcrumb"'), "HEADERS": ("header", 'class="site-header"'),
          "FOOTERS": ("footer", 'class="site-footer"'), "SIDEBARS": ("aside", 'class="related"'), "ADVERTS": ("aside", 'class="ad"'),
          "NOTICES": ("div", 'class="cookie-notice"'), "FORMS": ("form", 'class="newsletter"'), "COMMENTS": ("section", 'id="comments"'),
          "SHARES": ("ul", 'class="social"')}


def test_layouts_held_out_by_name(monkeypatch):
    for name, own in UNSEEN.items():
        monkeypatch.setattr(html_layouts, name, [x for x in getattr(html_layouts, name) if x != own])
    field = hx.train(labelled_pages(hx.TRAIN_PAGES))
    for name, own in UNSEEN.items():
        monkeypatch.setattr(html_layouts, name, [own])
    right = blocks = 0
    for page in labelled_pages(150, seed=78):
        own = hx.leaf_blocks(page)
        right += sum(hx.label_of(b[1]) == f for b, f in zip(own, field.decode(own), strict=True))
        blocks += len(own)
    assert right / blocks > 0.93
