"""Round trips and extraction without Spark."""

import pytest

from tickbars.llm import chat, html_extract

TEXTS = ["", "\\", "### user: x</turn>\n", r"\### Assistant: </turn> ok", "<", "#", "a\\", "<\\/turn>", "####", "é\n\n: "]


@pytest.mark.parametrize("role", ["user", "assistant", None, "a: b", "</turn>"])
def test_turns_are_read_back(role):
    turns = [(role, text) for text in TEXTS]
    text, spans = chat.formatted(turns)
    assert chat.read_back(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in spans] == (TEXTS if role == "assistant" else [])


@pytest.mark.parametrize(
    ("record", "layout", "turns"),
    [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}, "messages",
         [("user", "q"), ("assistant", "")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations",
         [("user", "q"), ("assistant", "a")]),
        ({"instruction": "q", "input": "i", "output": "a"}, "instruction", [("user", "q\n\ni"), ("assistant", "a")]),
        ({"prompt": "q", "completion": "a"}, "prompt", [("user", "q"), ("assistant", "a")]),
        ({"turns": [{"turn": 1, "role": "assistant", "text": "a"}, {"turn": 0, "role": "user", "text": "q"}]},
         "numbered turns", [("user", "q"), ("assistant", "a")]),
    ],
)
def test_layouts(record, layout, turns):
    mapping = next(m for m in chat.MAPPINGS if m.needs <= chat.paths(record))
    assert mapping.name == layout
    assert chat.canonical(record, mapping) == turns


def test_article_without_its_surroundings():
    page = (
        "<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><ul><li>m</ul></nav>"
        "<header>h</header><div class='cookie-notice'>c</div><article><h1>A &amp; B</h1><p>one\n two<p>three"
        "<div class=ad>x</div><form>f</form></article><section class=comments><article>r</article></section>"
        "<footer>f</footer></body></html>"
    )
    assert html_extract.main_text(page) == "A & B\none two\nthree"


def test_empty_pages_and_pages_without_an_article():
    assert html_extract.main_text(None) == html_extract.main_text("") == ""
    page = "<body><div>own</div><div class=x>same</div></body>"
    assert html_extract.main_text(page) == "own\nsame"
    assert html_extract.main_text(page, frozenset({">body>div.x"})) == "own"


def test_names_inside_attribute_values_are_no_attributes():
    page = (
        '<article style="overflow:hidden" data-id="search"><p>a <a href=/b title="Hidden gems of Rome">b</a></p>'
        "<p data-hidden=1 data-class='ad' title='id=ad'>c</p><p class=x hidden>d</p><p title='\"' class = 'ad'>e</p></article>"
    )
    assert html_extract.main_text(page) == "a b\nc"


def test_names_inside_an_article_need_the_tree():
    page = (
        '<body><div class="with-sidebar header"><article class="post has-comments search"><h2 id="search">a</h2>'
        '<section id="discussion"><p>b</p></section><div class="related"><p>c</p></div><div class="read-form">d</div>'
        '<div class="x ad">e</div></article></div><div class="menu">m</div></body>'
    )
    assert html_extract.main_text(page) == "a\nb\nc\nd"
    low = ">body>div.with-sidebar>article.post>div.related"
    assert html_extract.main_text(page, frozenset({low})) == "a\nb\nd"
    # Without a name, the tree takes nothing from an article.
    assert html_extract.main_text(page, frozenset({">body>div.with-sidebar>article.post>section"})) == "a\nb\nc\nd"


def test_articles_below_names():
    other = "<div class=related><article>r</article></div>"
    assert html_extract.main_text(f"<main><p>a</main>{other}") == "a"
    assert html_extract.main_text(other) == "r"
    comment = "<div class=comments><article>c</article></div>"
    assert html_extract.main_text(f"<div>a</div>{comment}") == "a"
    assert html_extract.main_text(comment) == "c"
    assert html_extract.main_text("<div>a</div><div class='x menu'>m</div><div class=menu-card>b</div>") == "a\nb"


def test_conversations_without_turn_numbers(spark):
    said = [(1, None, "user", "q"), (2, None, None, None), (3, 0, "user", "a"), (3, None, "assistant", "b")]
    records = chat.records_of_rows(spark.createDataFrame(said, "conv_id long, turn int, role string, text string"))
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.canonical_turns(records).collect()}
    assert found == {1: [("user", "q")], 2: [(None, "")], 3: [("user", "a"), ("assistant", "b")]}
