"""Chat formatting and page extraction: round trips, odd cases, templates."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterlens.llm import chat_format, wrapper_induction
from clusterlens.llm.bpe import TOKENIZER, Vocabulary


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    parts = ["<", "|", "\\", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|turn|>",
             "<|end|>", "[", "INST]", "a", " ", "s>", "/", "é"]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t
        assert not any(c in e for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_mask_covers_assistant_texts_exactly():
    fmt, vocab = chat_format.Formatter(TOKENIZER), Vocabulary(TOKENIZER)
    rng = random.Random(2)
    parts = ["ok", " ", "\n", "<|end|>", "é", "日本", "🙂", "the ", "<|endoftext|>", "[INST]", "\\"]
    for _ in range(400):
        turns = [(rng.choice(["user", "assistant", "system", "<|turn|>", ""]),
                  "".join(rng.choices(parts, k=rng.randint(0, 9)))) for _ in range(rng.randint(1, 6))]
        text, ids, mask = fmt(turns)
        assert chat_format.parse(text) == turns
        want = [t for r, t in turns if r == "assistant" and t]
        assert chat_format.learned_texts(ids, mask, vocab) == want


def test_mask_of_takes_tokens_that_straddle_a_span():
    starts, ends = np.array([0, 2, 5, 9]), np.array([2, 5, 9, 12])
    assert chat_format.mask_of(starts, ends, [(4, 6), (9, 12)]).tolist() == [0, 1, 1, 1]
    assert chat_format.mask_of(starts, ends, []).tolist() == [0, 0, 0, 0]


def test_conversations_with_odd_rows(spark):
    long = "word " * 20_000
    rows = [(1, 1, "assistant", None), (1, 0, None, "hi"), (1, 1, "assistant", "x"),
            (1, 1, "assistant", "x"), (2, None, "user", ""), (None, 0, "assistant", "lost"),
            (3, 0, "assistant", long)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.digest(chat_format.format_conversations(df.withColumn("ids", F.lit(1))))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {1, 2, 3, None} and got[1].n_turns == 4 and got[2].n_turns == 1
    assert got[1].turns_sha256 == hashlib.sha256(
        b"\nhi\nassistant\n\nassistant\nx\nassistant\nx\n").hexdigest()
    assert got[1].loss_chars == 2 and got[2].loss_chars == 0 and got[3].loss_chars == len(long)
    assert got[None].loss_sha256 == hashlib.sha256(b"lost").hexdigest()
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_tree_matching_counts_and_aligns():
    a = ["r", [["x", []], ["y", [["z", []]]], ["w", []]]]
    b = ["r", [["y", [["z", []], ["z", []]]], ["w", []]]]
    n, pairs = wrapper_induction.tree_matching(a, b)
    assert n == 4 and [p[0][0] for p in pairs].count("z") == 1
    assert wrapper_induction.tree_matching(["a", []], ["b", []]) == (0, [])


def page(title, *paragraphs, side="", note="Every page says this."):
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (f"<!doctype html><html><head><title>t</title><style>p{{}}</style></head><body>"
            f"<nav><ul><li><a href='/'>Home</a></ul></nav><div class='box'>{note}</div>"
            f"<div class='sidebar'>{side}</div><div class='text'><h1>{title}</h1>{body}</div>"
            f"<div class='comments'><p>first!</div><script>var t='</p>';</script>"
            f"<form><input>mail</form><footer>&copy; x</footer></body></html>")


def test_template_slots_go_and_content_stays(spark):
    rows = [(i, f"https://Host.example/{i}?a", page(f"T{i} &amp; co", f"one  {i}<br>more", "two\n&eacute;"))
            for i in range(6)]
    rows += [(10, "https://other.example/", page("Only", "page")),       # nothing to compare with
             (11, None, None), (12, "x", ""), (13, "y", "plain &lt; text"), (0, "https://Host.example/0?a", rows[0][2])]
    rows += [(20 + i, "http://same.example", page("Same", "copy")) for i in range(5)]   # equal pages
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper_induction.extract(df.withColumn("text", F.lit(0))).collect()}
    assert got[3] == "T3 & co\none 3 more\ntwo é"
    assert got[10] == "Every page says this.\nOnly\npage"
    assert got[11] == "" and got[12] == "" and got[13] == "plain < text"
    assert got[20].endswith("Same\ncopy")
    assert wrapper_induction.extract(df).count() == len(rows)
    assert wrapper_induction.extract(df.limit(0)).count() == 0


def test_article_wins_and_its_title_stays(spark):
    html = ("<body><header><h1>Site</h1></header><div>loose</div><article><header><h2>Title</h2></header>"
            "<p>a<div class='ad-box'>buy</div><p>b <b>c</b><aside>side</aside><ul><li>x<li>y</ul></article></body>")
    df = spark.createDataFrame([(1, "http://a.example/1", html)], "page_id long, url string, html string")
    assert wrapper_induction.extract(df).first().text == "Title\na\nb c\nx\ny"


def test_names_do_not_lose_the_main_text(spark):
    pages = ["<article class='post comments-open'><p>story</article>",
             "<div id='page' class='has-sidebar'><p>story</div>",
             "<main class='content no-header'><p>story</main>",
             "<article><header class='entry-header'><h1>title</h1></header><p>story</article>",
             "<article><div class='article-header'><h1>title</h1></div><p>story</article>",
             "<article><div class='header'><h1>title</h1></div><p>story</article>",
             "<div class='sidebar'><article><p>story</article></div>",
             "<div class='notice'><p>story</div>",
             "<article><p>story<p class='share'>no</p><p>on <span class='ad'>no</span> on</article>"
             "<div class='comments'><article class='comment'><p>no</article></div>",
             "<div class='text'><p>story</div><div class='sidebar'><p>no</div>"]
    df = spark.createDataFrame([(i, f"http://h{i}.example/", f"<body class='sidebar'>{h}</body>")
                                for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper_induction.extract(df).collect()}
    title = "title\nstory"
    assert [got[i] for i in range(len(pages))] == ["story"] * 3 + [title] * 3 + ["story"] * 2 + [
        "story\non on", "story"]


def test_varying_slots_decide_before_tags(spark):
    """A teaser article beside the story, a story in its article beside smaller
    varying text, and too few pages to tell."""
    story = "It was a dark and stormy night number {i} and nobody slept. " * 5
    teaser = ("<body><div class='box'><p>Same on all.</div><article><p>Read more {i}</article>"
              "<div class='text'><h1>Title {i}</h1><p>%s</div></body>" % story)
    inside = "<body><div class='box'><p>Same on all.</div><article><p>%s</article><div><p>On day {i}</div></body>" % story
    pages = [(h, i, html.format(i=i)) for h, html, n in (("t", teaser, 6), ("i", inside, 6), ("few", teaser, 2))
             for i in range(n)]
    df = spark.createDataFrame([(k, f"http://{h}.example/{i}", x) for k, (h, i, x) in enumerate(pages)],
                               "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper_induction.extract(df).collect()}
    for k, (h, i, _) in enumerate(pages):
        text = story.format(i=i).strip()
        assert got[k] == {"t": f"Title {i}\n{text}", "i": text, "few": f"Read more {i}"}[h]
    # without the wrapper's say the story is lost: the method changes these pages
    alone = {r.page_id: r.text for r in wrapper_induction.extract(df, min_pages=1_000).collect()}
    assert sorted(k for k in got if got[k] != alone[k]) == [k for k, p in enumerate(pages) if p[0] == "t"]


def test_two_pages_are_not_three(spark):
    rows = [(i, f"http://h.example/{i % 2}", page(f"T{i % 2}", f"one {i % 2}")) for i in range(2_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all("Every page says this." in r.text for r in wrapper_induction.extract(df).collect())


def plain_matching(a, b):
    """Simple tree matching by its definition, without keeping pairs."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain_matching(x, y))
    return m[-1][-1] + 1


def test_tree_matching_equals_its_definition():
    rng = random.Random(5)

    def tree(depth):
        return [rng.choice("abc"), [tree(depth - 1) for _ in range(rng.randrange(4) if depth else 0)]]
    for _ in range(200):
        a, b = tree(3), tree(3)
        size, pairs = wrapper_induction.tree_matching(a, b)
        assert size == plain_matching(a, b) == len(pairs)
        assert all(x[0] == y[0] for x, y in pairs)


def test_layouts_round_trip_and_shapes_fold():
    rng = random.Random(6)

    def tree(depth):
        kids = [tree(depth - 1) for _ in range(rng.randrange(4))] if depth else []
        return ["#" if not kids else rng.choice("ab"), kids]
    for _ in range(100):
        t = tree(4)
        assert wrapper_induction.unflat(wrapper_induction.flat(t))[0] == t
    # equal neighbours fold into one, in page order
    layout, blocks = wrapper_induction.layout_of(
        "<ul><li>a</li><li>b</li></ul><div><p>c</p></div><ul><li>d</li></ul>")
    assert [(s, x) for s, x, *_ in blocks] == [(0, "a"), (0, "b"), (1, "c"), (2, "d")]


@pytest.mark.parametrize("depth", [30, 10_000])
def test_deep_pages(spark, depth):
    page = "<html><body>" + "<div><p>{}</p>" * depth + "<p>deep</p>" + "</div>" * depth + "</body></html>"
    rows = [(i, f"http://h/{i}", page.replace("{}", f"text {i}")) for i in range(3)]
    got = wrapper_induction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 3
    for r in got:
        lines = r.text.split("\n")
        assert lines.count(f"text {r.page_id}") == depth
