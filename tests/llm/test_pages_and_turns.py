from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventloom.llm import extraction, preference, warc

BODY = "Plenty of words stand in this paragraph of the article, more than anywhere else on the page. "


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<nav>Menu</nav><footer>End</footer>", ""),
        ("<body><nav><a href=x>Home</a> <a href=y>About us and more</a></nav><article><h1>T &amp; t</h1><p>One<b>two</b>\n three.<br>four<p>five</article><footer>&copy; x</footer>", "T & t Onetwo three. four five"),
        (f"<html><head><title>no</title><style>p{{}}</style></head><body><div id=wrap><div class='ad box'>{BODY}</div><div id=main><p>{BODY}</p><p>Short.</p></div><div class=comments>{BODY}</div></div></body>", f"{BODY.strip()} Short."),
        (f"<body><article><p>{BODY}</p><script>var x='</p>';</script><form>Name <input></form><aside>{BODY}</aside><div class='cookie-notice'>We use</div></article></body>", BODY.strip()),
        (f"<body><header>Site</header><main><header>Kept head</header><p>{BODY}</main><!-- <p>gone</p> -->", f"Kept head {BODY.strip()}"),
        ("<article><p>a&nbsp;b &lt;p&gt; &#233;&#x1F642; &bogus;</p></article>", "a b <p> é🙂 &bogus;"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table></article>", "one two x y z"),
        ("<article><p>unclosed <b>bold<p>next</article", "unclosed bold next"),
        ("<article>x < y and <3 & z</article>", "x < y and <3 & z"),
    ],
)
def test_extraction(html, text):
    assert extraction.extract(html) == text


def test_extraction_of_a_table(spark):
    deep = "<div>" * 3000 + BODY + "</div>" * 3000
    rows = [(1, "u", "<article>x</article>", "clash"), (1, "u", "<article>x</article>", "clash"), (None, None, None, None), (2, "v", deep, ""), (3, "w", "<article><p>" + BODY * 5000, "")]
    got = extraction.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == ["x", "x"] and next(r.text for r in got if r.page_id == 2) == BODY.strip()
    assert len(next(r.text for r in got if r.page_id == 3)) == len(BODY) * 5000 - 1
    assert extraction.extract_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_density_prefers_text_to_links():
    links = "".join(f"<p><a href=x>link number {i} goes somewhere else</a></p>" for i in range(10))
    page = f"<body><div>{links}</div><div><p>{BODY}</p><p>{BODY}</p></div></body>"
    root = extraction.parse(page)
    order = extraction.measure(root)
    anchors = [n.density for n in order if n.tag == "a"]
    assert max(anchors) < max(n.density for n in order if n.tag == "p")


RECORD = "record_id bigint, url string, ts timestamp, status int, headers map<string,string>, seen string, slot bigint"


def records(spark, rows):
    made = [(i, u, None if t is None else t, s, h, "x", 9) for i, u, t, s, h in rows]
    frame = spark.createDataFrame(made, RECORD.replace("ts timestamp", "ts bigint"))
    return frame.withColumn("ts", F.timestamp_seconds("ts"))


def test_revisits(spark):
    full = lambda e, m=None: {k: v for k, v in (("etag", e), ("last-modified", m), ("content-length", "9"), ("server", "a")) if v}
    rows = [
        (1, "http://www.A.org/p/?b=2&a=1&utm_source=z#f", 100, 200, full('"1"')),
        (2, "https://a.org:443/p?a=1&b=2", 200, 304, {"etag": 'W/"1"', "content-length": "0", "date": "d"}),
        (3, "http://a.org/p?a=1&b=2", 200, 200, full('"2"')),
        (4, "http://a.org/p?a=1&b=2", 200, 200, full('"3"')),
        (5, "http://a.org/p?a=1&b=2", 90_000, 304, {"etag": '"3"'}),
        (6, "http://a.org/p?a=1&b=2", 90_001, 304, {"etag": '"1"'}),
        (7, "http://a.org/q", 50, 304, {"etag": '"1"'}),
        (8, None, 50, 304, {"etag": '"1"'}),
        (9, "http://a.org/p", None, 304, None),
        (10, "http://a.org/q", 60, 200, None),
        (11, "http://a.org/q", 70, 304, {"etag": '"1"'}),
        (12, "http://a.org/r", 10, 200, full(None, "then")),
        (13, "http://a.org/r", 20, 304, {"last-modified": "then", "server": "b"}),
        (13, "http://a.org/r", 20, 304, {"last-modified": "then", "server": "b"}),
        (14, "http://a.org/r", 5, 500, None),
        (None, "http://a.org/r", 30, 304, {"last-modified": "now"}),
    ]
    for slot in (10, 3600, 10**6):
        got = {r.record_id: r for r in warc.resolve_revisits(records(spark, rows), slot).collect()}
        said = {i: (r.resolution, r.response_id) for i, r in got.items()}
        assert said == {
            2: ("resolved", 1), 5: ("resolved", 4), 6: ("validator_mismatch", 4), 7: ("no_earlier_response", None), 8: ("no_key", None),
            9: ("no_key", None), 11: ("no_validator", 10), 13: ("resolved", 12), None: ("validator_mismatch", 12),
        }
        assert got[2].headers == {"etag": 'W/"1"', "content-length": "9", "server": "a", "date": "d"}
        assert got[13].headers["server"] == "b" and got[2].canonical_url == "a.org/p?a=1&b=2"
    assert warc.resolve_revisits(records(spark, rows)).count() == 10
    assert warc.resolve_revisits(records(spark, [])).count() == 0


TURN = "pair_id bigint, turn bigint, role string, text string, part string, piece string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURN)


def plain_pairs(chosen, rejected):
    out = {}
    key = lambda r: (1 << 63 if r[1] is None else r[1], r[2] or "", r[3] or "")
    sides = [{p: sorted((r for r in s if r[0] == p), key=key) for p in {r[0] for r in s if r[0] is not None}} for s in (chosen, rejected)]
    for pair in sides[0].keys() & sides[1].keys():
        a, b = ([(key(r)[0], r[2] or "", r[3] or "") for r in s[pair]] for s in sides)
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        show = lambda ts: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, t in ts)
        rest = (show(a[:n]), show(a[n:]), show(b[n:]))
        trained = []
        for side, text in ((a[n:], rest[1]), (b[n:], rest[2])):
            at, own = 0, []
            for _, role, body in side:
                start = at + len(f"<|im_start|>{role}\n")
                at = start + len(body) + len("<|im_end|>\n")
                if role == "assistant":
                    own.append(text[start : at - 1])
            trained.append(own)
        out[pair] = (n, *rest, *trained)
    return out


@pytest.mark.parametrize("block", [1, 3, 64])
def test_preference_pairs(spark, block):
    user, bot = "user", "assistant"
    same = [(5, i, [user, bot][i % 2], f"turn {i} é🙂") for i in range(12)]
    chosen = [(1, 0, user, "hi"), (1, 1, bot, "yes"), (2, 0, user, "same"), (2, 1, bot, "same"), (3, 0, user, "only here"), (None, 0, user, "x"), *same, (5, 12, bot, "good"), (6, None, bot, "late"), (6, 0, None, None), (7, 0, user, "a"), (7, 0, user, "a"), (7, 2, bot, "b"), (8, 0, user, "x" * 50000)]
    rejected = [(1, 0, user, "hi"), (1, 1, bot, "no"), (1, 2, user, "why"), (1, 3, bot, "so"), (2, 0, user, "same"), (2, 1, bot, "same"), (4, 0, user, "only there"), *same, (6, 0, None, None), (7, 0, user, "a"), (7, 1, bot, "b"), (8, 0, bot, "x")]
    got = preference.format_pairs(turns(spark, chosen), turns(spark, rejected), block).collect()
    want = plain_pairs(chosen, rejected)
    assert len(got) == len(want)
    cut = lambda text, spans: [text[s.start : s.end] for s in spans]
    for r in got:
        assert (r.n_prefix, r.prompt, r.chosen, r.rejected, cut(r.chosen, r.chosen_spans), cut(r.rejected, r.rejected_spans)) == want[r.pair_id]
    assert preference.format_pairs(turns(spark, []), turns(spark, rejected)).count() == 0


LONG = f"<p>{BODY}</p>" * 3
SHORT = "<p>A second part, sparser than the first.</p>" * 2
LINKS = "".join(f"<li><a href=x>number {i} goes elsewhere</a></li>" for i in range(12))
BOTH = f"{' '.join([BODY.strip()] * 3)} {' '.join(['A second part, sparser than the first.'] * 2)}"


@pytest.mark.parametrize(
    "body",
    [
        f"<nav>Menu</nav><main><article>{LONG}</article><article>{SHORT}</article></main>",
        f"<article>{LONG}</article><article>{SHORT}</article><footer>End</footer>",
        f"<div>{LONG}</div><div>{SHORT}</div>",
        f"<div><div>{LONG}</div><div><ul>{LINKS}</ul></div><div>{SHORT}</div></div>",
        f"<div><ul>{LINKS}</ul>{LONG}{SHORT}</div>",
        f"<main><div><ul>{LINKS}</ul></div><div>{LONG}</div></main><div><div>{SHORT}</div></div>",
    ],
)
def test_split_articles_and_link_blocks(body):
    assert extraction.extract(f"<body>{body}</body>") == BOTH


@pytest.mark.parametrize("name", ["class='site has-sidebar'", "class='no-sidebar'", "class='entry related-enabled'", "id='content-widget'", "class=widget"])
def test_names_of_wrappers_do_not_silence_the_text(name):
    page = f"<body><nav>Menu</nav><div {name}><div>{LONG}</div><div class='post-comments'>{SHORT}</div></div></body>"
    assert extraction.extract(page) == " ".join([BODY.strip()] * 3)


def test_names_inside_code_do_not_silence():
    page = f"<body><article>{LONG}<pre>x = 1 <span class='comment'># kept</span></pre><span class='share'>Share this</span></article></body>"
    assert extraction.extract(page) == " ".join([BODY.strip()] * 3) + " x = 1 # kept"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<body><article><p title=it's>{BODY}</p></article></body>", BODY.strip()),
        ("<article><p title='a > b' lang=\"x>y\">one</p><p title='open>two</p></article>", "one two"),
        ("<article><p>super<wbr>cali my<foo-x>word</foo-x>s <ruby>k<rt>a</rt></ruby>i<img src=x>j</p></article>", "supercali mywords kaij"),
        (f"<body><div class=content><h1>T</h1><p>{BODY}</p></div><div class='comments'>{''.join(f'<p>{BODY}</p>' for _ in range(20))}</div></body>", f"T {BODY.strip()}"),
        (f"<body><div class=post><p>{BODY}</p></div><section id='comments-area'>{''.join(f'<div><p>{BODY}</p></div>' for _ in range(9))}</section></body>", BODY.strip()),
        (f"<body><div class=comments><p>{BODY}</p></div></body>", BODY.strip()),
        (f"<body><div class='banner'><article><p>{BODY}</p></article></div><p>x</p></body>", BODY.strip()),
        (f"<body><div class='site has-sidebar'><div class='content-widget'><p>{BODY}</p><p>{BODY}</p></div></div></body>", BODY + BODY.strip()),
        (f"<body><div><p>We use cookies.</p></div><div>{f'<p>{BODY * 3}</p>' * 6}</div><div><p>(c) 2024 Us.</p></div></body>", (BODY * 18).strip()),
    ],
)
def test_markup_and_names(html, text):
    assert extraction.extract(html) == text


def test_hostile_markup_takes_time_in_proportion():
    import time

    for piece in ("<a ", "<a x=\"", "<a x='", "<!--", "<", "<p title=it's>x", "</", "<!"):
        start = time.perf_counter()
        extraction.extract("<p>text" + piece * (400_000 // len(piece)) + '"')
        assert time.perf_counter() - start < 20, piece
