"""HTML extraction, URL rules and chat formatting."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from ledgerloom.llm.chat_format import CONTROLS, conversation_digests, escape, format_chats, unescape
from ledgerloom.llm.html_extract import extract, extract_main_text
from ledgerloom.llm.queries import URL_RULES, tokenizer_path
from ledgerloom.llm.url_filters import judge_urls

LONG = "A sentence of some length, with commas, that goes on for a while and says things of interest to readers. " * 3


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="sidebar">{LONG}</div><div class=ad>Buy, now, here</div>
    <article><h1>Head &amp; title</h1><p><b>{LONG}<br><p>Second &eacute;\n\t para</p><ul><li>one<li>two</ul><form>Your name<input></form>
    <blockquote><p>Quote</blockquote></article><div id="comments"><p>{LONG}</p></div><footer>&copy; x</footer></body>"""
    assert extract(page) == " ".join(f"Head & title {LONG} Second é para one two Quote".split())


def test_container_without_semantic_tags():
    page = f"<body><div class=menu><a href=a>one</a> <a href=b>two</a></div><div><div><p>{LONG}</p><p>{LONG}</p></div></div><div><a href=c>{LONG}</a></div></body>"
    assert extract(page) == " ".join((LONG + LONG).split())


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "just text &lt;b&gt;", "x"), (4, "u", "<p>unclosed <b>bold <i>both", "x"), (5, "u", "<<<>>> </p></div> & a", "x"), (6, "u", "<div>" * 3000 + "deep", "x")]
    got = {r.page_id: r for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert [got[i].text for i in (1, 2, 3, 4, 6)] == ["", "", "just text <b>", "unclosed bold both", "deep"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[2].url is None


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<p title="the hidden gem">{LONG}</p>', LONG),
        (f'<p data-x="a role=search b">{LONG}</p>', LONG),
        ('See <a href="x>foo bar', "See foo bar"),
        (f'<div class="comment-content"><p>{LONG * 9}</p></div><div><p>Short article text, here.</p></div>', "Short article text, here."),
        (f'<div class="main-sidebar"><p>{LONG * 9}</p></div><div><p>Short article text, here.</p></div>', "Short article text, here."),
        (f'<article><p>{LONG}</p><p class="post-meta">by me</p><figure><img><figcaption>A caption</figcaption></figure></article>', LONG + "A caption"),
        (f'<div class="page-with-sidebar sidebar"><p>{LONG}</p></div>', LONG),  # all of the page
        (f"<article><p hidden>no</p><p HIDDEN=''>no</p><p style='display : none'>no</p><p>{LONG}</p></article>", LONG),
    ],
)
def test_attributes_classes_and_captions(page, text):
    assert extract(page) == " ".join(text.split())


TEXT = "A long paragraph, of the article, with a number of words and commas, that reads as running text for people."
TALK = "<p>I liked this, and so did my friends, who all said that it was good, long and full of commas, truly.</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<h1>Title</h1><div class='layout has-sidebar'><p>{TEXT}</p><p>{TEXT}</p></div>", f"Title {TEXT} {TEXT}"),
        (f"<h1>Title</h1><div class='post comments-open'><p>{TEXT}</p></div>", f"Title {TEXT}"),
        (f"<form id='aspnetForm'><div><h1>T</h1><p>{TEXT}</p></div><input><button>Go</button></form>", f"T {TEXT}"),
        (f"<article><h1>T</h1><p>{TEXT}</p><section class='social history'><p>{TEXT}</p><p>{TEXT}</p></section></article>", f"T {TEXT} {TEXT} {TEXT}"),
        (f"<article><p>{TEXT}</p><div class='social'><a href=x>Share</a> <a href=y>Tell</a></div></article>", TEXT),
        (f"<div><p>Intro, short.</p><div><p>{TEXT}</p><p>{TEXT}</p></div><p>End, short.</p></div>", f"Intro, short. {TEXT} {TEXT} End, short."),
        (f"<body><div class='page comments-closed'><div class=post-content><p>{TEXT}</p></div><div class=comments>{TALK * 9}</div></div></body>", TEXT),
        (f"<body><div class=comment-list><article class=comment>{TALK * 5}</article></div><div class=entry><p>{TEXT}</p></div></body>", TEXT),
        (f"<main><h1>T</h1><p>{TEXT}</p><p>Short one.</p><ul><li>one</li><li>two</li></ul><p>{TEXT}</p></main>", f"T {TEXT} Short one. one two {TEXT}"),
        (f"<article><p>{TEXT}</p><form><p>Your name and mail, please, so that we can write to you now and then.</p></form></article>", TEXT),
        (f"<div class=cookie-notice><p>{TEXT}</p></div><div id=content><p>{TEXT * 2}</p></div>", TEXT * 2),
        (f"<div role=banner><p>{TEXT}</p></div><div><p>{TEXT}</p><table><caption>Cap</caption><tr><td>1</td><td>two</td></tr></table></div>", f"{TEXT} Cap 1 two"),
        (f"<div class='wrapper sidebar'><div class=sidebar><p>{TEXT}</p></div><main><p>{TEXT * 2}</p></main></div>", TEXT * 2),
        ("<div class=sidebar><a href=x>all links</a></div>", ""),
    ],
)
def test_surroundings_are_told_by_their_share_of_the_text(page, text):
    assert extract(page) == text


@pytest.mark.parametrize("part", ['<p class="x', "<a '", "<b>", "<p><b>", "<!--", "<script>", "<", "<li><i>", '<a b="'])
def test_odd_pages_of_a_megabyte_take_linear_time(part):
    def took(size):
        began = time.perf_counter()
        extract(part * (size // len(part)))
        return time.perf_counter() - began

    assert took(1_000_000) < 0.5 + 12 * max(took(250_000), 0.2)


def random_tree(rnd, depth=0):
    """(tag, class, children); children are texts and trees."""
    say = lambda: " ".join(rnd.choice(["lorem", "ipsum,", "dolor", "sit.", "amet"]) for _ in range(rnd.randint(1, 40)))
    children = []
    for _ in range(rnd.randint(1, 4)):
        pick = rnd.random()
        if depth > 4 or pick < 0.3:
            children.append(("p", "", [say(), ("a", "", [say()]), say()][: rnd.randint(1, 3)]))
        elif pick < 0.4:
            children.append((rnd.choice(["nav", "aside", "footer"]), "", [say()]))
        elif pick < 0.5:
            children.append(("ul", "", [("li", "", [say()]), ("li", "", [("b", "", [say()])])]))
        elif pick < 0.6:
            children.append((rnd.choice(["h1", "h2", "pre", "blockquote"]), "", [say()]))
        elif pick < 0.65:
            children.append(say())
        else:
            children.append((rnd.choice(["div", "section", "article"]), rnd.choice(["", "", "content", "sidebar"]), random_tree(rnd, depth + 1)))
    return children


def rendered(children):
    return "".join(c if isinstance(c, str) else f'<{c[0]} class="{c[1]}">{rendered(c[2])}</{c[0]}>' for c in children)


def running(children, quiet=False):
    """Characters outside links and headings, and whether h1 or article stands there."""
    size, head = 0, False
    for child in children:
        if isinstance(child, str):
            size += 0 if quiet else len(child.strip())
        elif child[0] not in ("nav", "aside", "footer"):
            inner, found = running(child[2], quiet or child[0] in ("a", "h1", "h2"))
            size, head = size + inner, head or found or child[0] in ("h1", "article")
    return size, head


def scored_by_definition(children):
    """The article of a tree, straight from the rules: no tokens, every container's points summed over all blocks in it."""
    whole = running(children)[0]

    def dropped(n):
        if n[1] != "sidebar" or n[0] == "article":
            return n[0] in ("nav", "aside", "footer")
        own, head = running(n[2])
        return not (own == whole > 0 or 2 * own >= whole > 0 and head)

    blocks, run = [], []

    def flush(path):
        text = " ".join("".join(t for t, _ in run).split())
        if text:
            blocks.append((path, text, sum(len(t.strip()) for t, linked in run if linked)))
        run.clear()

    def walk(children, path, linked):
        for child in children:
            if isinstance(child, str):
                run.append((child, linked))
            elif dropped(child):
                run.append((" ", False))
            elif child[0] in ("a", "b"):
                walk(child[2], path, linked or child[0] == "a")
            else:
                flush(path)
                walk(child[2], [*path, child], linked)
                flush([*path, child])

    body = ("body", "", children)
    walk(children, [body], False)
    flush([body])
    points, places = {}, {}
    for path, text, linked in blocks:
        own = (1 + text.count(",") + min(len(text) / 100, 3)) * max(0, 1 - linked / len(text)) * (0.25 if path[-1][0] in ("li", "h1", "h2") else 1)
        containers = [(i, n) for i, n in enumerate(path) if n[0] in ("article", "section", "div", "body", "blockquote")]
        for k, (depth, n) in enumerate(reversed(containers)):
            points[id(n)] = points.get(id(n), 0) + own / max(1, 2 * k)
            places[id(n)] = depth, n, path[:depth]
    if not points:
        return " ".join(t for _, t, _ in blocks)
    score = {k: p * (2 if places[k][1][0] == "article" else 1.25 if places[k][1][1] == "content" else 1) for k, p in points.items()}
    depth, best, above = max((places[k] for k in score), key=lambda x: (score[id(x[1])], x[0]))
    chosen = {id(best)}
    for sibling in above[-1][2] if above else []:
        if not isinstance(sibling, str) and sibling is not best:
            own = [(t, linked) for path, t, linked in blocks if any(n is sibling for n in path)]
            size = sum(len(t) for t, _ in own)
            links = sum(linked for _, linked in own) / max(size, 1)
            reads = sibling[0] in ("p", "blockquote", "pre") and (size > 80 or above[-1][0] != "body") and links < 0.25
            heads = sibling[0] in ("h1", "h2") and best[0] not in ("article", "body")
            if own and (score.get(id(sibling), 0) >= max(10, 0.2 * score[id(best)]) and links < 0.25 or reads or heads):
                chosen.add(id(sibling))
    row = [n for n in above[-1][2] if not isinstance(n, str)] if above else []
    places = [i for i, n in enumerate(row) if id(n) in chosen]
    for sibling in row[places[0] : places[-1]] if row else []:
        own = [(t, linked) for path, t, linked in blocks if any(n is sibling for n in path)]
        if own and sibling[0] in ("p", "blockquote", "pre", "ul", "h2") and sum(n for _, n in own) < 0.25 * sum(len(t) for t, _ in own):
            chosen.add(id(sibling))
    return " ".join(t for path, t, _ in blocks if any(id(n) in chosen for n in path))


def test_extraction_matches_the_rules_by_definition():
    rnd, kept = random.Random(12), 0
    for _ in range(400):
        tree = random_tree(rnd)
        page = f"<html><body>{rendered(tree)}</body></html>"
        expected = scored_by_definition(tree)
        assert extract(page) == expected
        kept += bool(expected)
    assert kept > 300


def test_pages_of_an_empty_table_and_repeated_rows(spark):
    schema = "page_id long, url string, html string, n_chars string"
    assert extract_main_text(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, "<p>b", "x")]
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in extract_main_text(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, None, "b", 1), (1, "u", "a", 1), (1, "u", "a", 1)]


def brute_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    best = None
    for rule, verdict in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, best[0] if best else None, best[1] if best else "allow"


def test_url_rules_match_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "http://Example.ORG/en/12?x#y", "https://a.b.example.org/es/", "https://example.org/es", "http://xexample.org/es/1", "http://x.com/fr/de", "http://x.com/de/fr",
        "ftp://com/de/", "http://a.org", "http://a.org?q=/en/1", "http://a.org#/x", "http://org/", "http://É.COM/fr/é", "x://y://example.org/en/1", "http://example.org//en/1", "http://a.net/x/y\n/z", "http://" + "a." * 500 + "org/" + "p" * 5000,
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls * 2)], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got == {i: brute_verdict(u) for i, u in enumerate(urls * 2)}
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_equal_length_rules_prefer_the_longer_host_then_block(spark):
    pages = spark.createDataFrame([(1, "http://a.bc.de/xy/z")], "page_id long, url string")
    rules = spark.createDataFrame([("bc.de/xy/", "allow"), ("a.bc.de/x", "block"), ("a.bc.de/x", "allow")], "rule string, verdict string")
    assert judge_urls(pages, rules).first()[3:] == ("a.bc.de/x", "block")


@given(st.text(st.sampled_from("<>/\\turnsay x"), max_size=40))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


def test_chats_read_back_what_went_in(spark):
    nasty = "\\### Assistant: </turn> ok <\\turn> <says> <|endoftext|> <turn"
    rows = [
        (1, 1, "assistant", nasty, 0), (1, 0, "user", "hi é 日本", 0), (2, 0, None, None, 0), (3, 0, "assistant", "", 0), (3, 1, "</turn>", "x", 0), (3, 2, "assistant", "b", 0), (3, 2, "assistant", "a", 0),
        (None, None, "user", "lost", 0), (4, 0, "user", "again", 0), (4, 0, "user", "again", 0), (5, 0, "assistant", "word " * 30000, 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids int")
    formatted = format_chats(turns, tokenizer_path())
    one = formatted.where("conv_id = 1 and turn = 1").first()
    assert len(one.ids) == len(one.loss_mask) and one.formatted.count("</turn>") == 1 and one.formatted.startswith("<turn>assistant<says>")
    got = {r.conv_id: r for r in conversation_digests(formatted, tokenizer_path()).collect()}
    assert len(got) == 6
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        written = "".join(f"<turn>{escape(role)}<says>{escape(text)}</turn>" for _, _, role, text in own)
        expected = (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(written))
        assert tuple(got[conv])[1:] == expected
    assert conversation_digests(format_chats(turns.limit(0), tokenizer_path()), tokenizer_path()).count() == 0


def test_a_long_conversation_is_put_together_from_many_tasks(spark):
    rows = [(7, i // 2, "assistant" if i % 2 else "user", f"turn {i} " + "word é " * 150) for i in range(3000)]
    rows += [(i, t, "user", f"{i} {t}") for i in range(20) if i != 7 for t in range(3)] + [(8, None, "assistant", "same")] * 500
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = {r.conv_id: r for r in conversation_digests(format_chats(turns, tokenizer_path()), tokenizer_path()).collect()}
    assert len(got) == 20
    for conv in range(20):
        own = sorted((r[1] is not None, r[1] or 0, r[2], r[3]) for r in rows if r[0] == conv)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for _, _, role, text in own).encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars, got[conv].loss_sha256) == (len(own), len(loss), hashlib.sha256(loss.encode()).hexdigest())
