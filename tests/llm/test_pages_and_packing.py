import re
import zlib
from fnmatch import fnmatchcase

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import best_fit_packing, html_extraction, queries, url_filter

DATA = "/root/testdata/sf0.001"


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


# -- URL filter ------------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab*?/", max_size=9), min_size=1, max_size=30), st.lists(st.text("ab/", max_size=12), min_size=1, max_size=8))
def test_automaton_equals_plain_glob_matching(globs, subjects):
    found = url_filter.GlobAutomaton(globs).match([s.encode() for s in subjects])
    assert found.tolist() == [[fnmatchcase(s, g) for g in globs] for s in subjects]


def plain_verdict(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://COM/", "http://a.com/", "http://a.com", "HTTP://WWW.Example.com/en/x?q#f", "http://example.com/en/", "http://x.example.com/EN/", "http://a.net/es/", "http://net/fr/1", "http://b.org/c.com/en/", "http://x.com:80/", "a://b://c.com/", "http://ÄB.com/é", "http://xcom/", "http://q.com?x=/", "http://q.net/es/\n\r", "http://" + "a." * 3000 + "net/fr/" + "z" * 9000]


def test_url_filter_edge_cases(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://a.com/", None, None), (1, "", "x", "y")]
    got = url_filter.judge(frame(spark, rows, "page_id long, url string, host string, verdict string"), queries.URL_RULES).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *plain_verdict(u, queries.URL_RULES)) for i, u, *_ in rows), key=repr)


def test_url_filter_without_rules_or_rows(spark):
    assert [tuple(r) for r in url_filter.judge(frame(spark, [(1, "http://a/b")], "page_id long, url string"), []).collect()] == [(1, "a", "/b", None, "allow")]
    assert url_filter.judge(frame(spark, [], "page_id long, url string"), queries.URL_RULES).collect() == []


# -- HTML extraction -------------------------------------------------------------------------------------------------

PARAGRAPH = "A sentence of ordinary running text that goes on for a while, as articles do. " * 3


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("just words", "just words"),
        ("<nav>menu</nav><footer>f</footer>", ""),
        (f"<body><nav><ul><li><a href='/'>Home</a></ul></nav><article><h1>Title</h1><p>{PARAGRAPH}</p><p>Short.</p></article><footer>&copy; x</footer>", f"Title {PARAGRAPH.strip()} Short."),
        (f"<article><p>{PARAGRAPH}<p>a&amp;b &eacute; &#x41;</article><div class='comments'><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH.strip()} a&b é A"),
        (f"<main><p>{PARAGRAPH}</p><aside>{PARAGRAPH}</aside><script>var a='<p>';</script><form>{PARAGRAPH}</form></main>", PARAGRAPH.strip()),
        (f"<div class='ad'>{PARAGRAPH}</div><div class='post'><p>{PARAGRAPH}</p><p>ok.</p><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH.strip()} ok. {PARAGRAPH.strip()}"),
        (f"<article><p>one <b>t</b>wo\n\tthree{PARAGRAPH}<br>four</p></article>", f"one two three{PARAGRAPH.strip()} four"),
        (f"<article><div class='entry-header'><h1>Head</h1><p>By me</p></div><p>{PARAGRAPH}</p></article><section class='comments'><article><p>{PARAGRAPH}</p></article></section>", f"Head {PARAGRAPH.strip()}"),
        (f"<article><p>{PARAGRAPH}</p></article><article class='comment'><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article>", PARAGRAPH.strip()),
        ("<p>" + "x " * 300_000 + "</p>", ("x " * 300_000).strip()),
        ("<div>" * 5000 + "deep " * 40, ("deep " * 40).strip()),
    ],
)
def test_extract_text(html, want):
    assert html_extraction.extract_text(html) == want


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f"<div class='post'><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><article class='card'><p>Short card.</p></article>", f"{PARAGRAPH.strip()} {PARAGRAPH.strip()}"),
        (f"<article class='card'><p>Short card.</p></article><div class='post'><p>{PARAGRAPH}</p><p>ok.</p><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH.strip()} ok. {PARAGRAPH.strip()}"),
        ("".join(f"<article><h2>{n}</h2><p>{PARAGRAPH}</p></article>" for n in ("One", "Two", "Three")), " ".join((PARAGRAPH.strip(), "Two", PARAGRAPH.strip(), "Three", PARAGRAPH.strip()))),
    ],
)
def test_text_outside_containers(html, want):
    assert html_extraction.extract_text(html).removeprefix("One ") == want


STORY = f"<h1>Head</h1><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p>"
TOLD = f"Head {PARAGRAPH.strip()} Short. {PARAGRAPH.strip()}"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f"<div class='container no-sidebar'>{STORY}</div>", TOLD),
        (f"<div id='sideBarBox'><p>{PARAGRAPH}</p></div><div>{STORY}</div>", TOLD),
        (f"<article><div class='entry widget-content'>{STORY}</div></article>", TOLD),
        (f"<article><p>{PARAGRAPH}</p><div class='section-header'><h2>Next</h2></div><p>{PARAGRAPH}</p></article>", f"{PARAGRAPH.strip()} Next {PARAGRAPH.strip()}"),
        (f"<article>{STORY}</article><article>{STORY}</article>", f"{TOLD} {TOLD}"),
        (f"<article>{STORY * 5}</article><article>{STORY}</article>", " ".join([TOLD] * 6)),
        (f"<form id='page'><div class='banner'>x y</div>{STORY}</form>", TOLD),
        (f"<div class='related'>{STORY}</div>", TOLD),
        (f"<article>{STORY}</article><div class='comments'><p>{PARAGRAPH * 9}</p></div>", TOLD),
        (f"<article><header><h1>Head</h1></header><p>{PARAGRAPH}</p></article><div class='post comment'><p>{PARAGRAPH}</p></div>", f"Head {PARAGRAPH.strip()}"),
        (f"<p>{PARAGRAPH}</p><span role='alert'>Careful</span>", PARAGRAPH.strip()),
    ],
)
def test_class_words_are_weak_evidence(html, want):
    assert html_extraction.extract_text(html) == want


MENU = "<div>" + "".join(f"<div><b>Part</b> <i>number</i> <b>{n}</b> <i>of</i> <u>all</u></div>" for n in range(40)) + "</div>"
#: Pages without an article, and without a word or an element that tells their menus and notes.
PLAIN_PAGES = [
    f"<body>{MENU}<div>{STORY}</div>{MENU}<div>All <b>rights</b></div></body>",
    f"<body><table><tr><td>{MENU}</td><td>{STORY}</td><td>{MENU}</td></tr></table></body>",
    f"<body>{MENU}{STORY}{MENU}</body>",
    f"<body><div>{MENU}<div><div>By <i>me</i></div><div>{STORY}</div></div></div>{MENU}</body>",
]


@pytest.mark.parametrize("html", PLAIN_PAGES)
def test_density_alone_selects_the_region(html, monkeypatch):
    assert html_extraction.extract_text(html) == TOLD
    # without the threshold every line is marked, and the menus come with the text
    monkeypatch.setattr(html_extraction, "_threshold", lambda values: -1.0)
    assert html_extraction.extract_text(html) != TOLD


def test_extraction_of_no_pages_and_repeated_rows(spark):
    assert html_extraction.extract(frame(spark, [], "page_id long, url string, html string, text string")).collect() == []
    rows = [(1, "u", "<p>a b</p>", "x"), (1, "u", "<p>a b</p>", "x"), (None, None, None, None)]
    got = html_extraction.extract(frame(spark, rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0)], key=repr)


def test_pages_without_their_articles_keep_the_text(spark):
    """The pages of the table with their article made an unnamed element, beside unnamed menus and notes."""
    pages = [r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect() if r.html]
    whole, kept, added = 0, 0, 0
    for html in pages:
        want = html_extraction.extract_text(html).split()
        plain = re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", html).replace(' class="ad"', "")
        got = html_extraction.extract_text(plain).split()
        whole += len(want)
        kept += sum(a == b for a, b in zip(want, got))
        added += max(0, len(got) - len(want))
    assert kept >= 0.95 * whole and added <= 0.02 * whole


LINK = "<a href='/x'>A linked reference of some length</a>"
LINKED = "A linked reference of some length"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f"<article><p>{PARAGRAPH}</p><p>{LINK} too</p><ul><li>{LINK}<li>{LINK}</ul></article><p>{LINK}</p>", f"{PARAGRAPH.strip()} {LINKED} too {LINKED} {LINKED}"),
        (f"<main><ul><li>{LINK}<li>{LINK}</ul></main>", f"{LINKED} {LINKED}"),
        ("".join(f"<article><p>{PARAGRAPH}</p><p>{LINK}</p><p>{PARAGRAPH}</p></article>" for _ in range(3)), " ".join(f"{PARAGRAPH.strip()} {LINKED} {PARAGRAPH.strip()}" for _ in range(3))),
        (f"<div><p>{PARAGRAPH}</p><article><p>{LINK}</p></article><p>{LINK}</p><p>{PARAGRAPH}</p></div>", f"{PARAGRAPH.strip()} {LINKED} {LINKED} {PARAGRAPH.strip()}"),
        (f"<p>{PARAGRAPH}</p><p>see <a href='/x'>{' ' * 300}here{' ' * 300}</a> and there, please</p><p>{PARAGRAPH}</p>", f"{PARAGRAPH.strip()} see here and there, please {PARAGRAPH.strip()}"),
        (f"<p>{PARAGRAPH}</p><p>{LINK}</p><p>{PARAGRAPH}</p>", f"{PARAGRAPH.strip()} {LINKED} {PARAGRAPH.strip()}"),
        (f"<p>{LINK}</p><p>{PARAGRAPH}</p><p>{LINK}</p>", PARAGRAPH.strip()),
    ],
)
def test_links_in_and_outside_articles(html, want):
    assert html_extraction.extract_text(html) == want


def test_extract_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, "<p>a</p>", "t"), (1, "u", None, "t")]
    got = html_extraction.extract(frame(spark, rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "u", "", 0), (None, None, "a", 1), (1, "u", "", 0)], key=repr)


def test_articles_of_the_pages_table(spark):
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in queries.op4_html_extraction(spark, DATA).collect():
        article = re.search(r"(?s)<article>(.*)</article>", pages[r.page_id])[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|br|h1)>", article))
        assert r.text == " ".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


# -- packing ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(queries.vocabulary_path())
    found.encode_special_tokens = True
    return found


ODD_TEXTS = ["", " \n", "Don't I'LL 'sx ''s", "ΣΑΣ ς İstanbul", "a\u0301 e\u0301\u0301x", "\x1cab\x1f", "日本語 テキスト", "🙂🙂 ok", "x" * 5000, "<|endoftext|>", "ǅ ﬁ ß ẞ", "1234 ５６ ²", "\u00a0a\u2003b\u180ec\u200bd", "a" * 3 + "\u0300" * 50, "\u1100\u1161\u11a8"]


def test_chunk_tokenizer_equals_library(library):
    mine = best_fit_packing.tokenizer(queries.vocabulary_path())
    ids, edges = mine.encode([*ODD_TEXTS, None], b"\0\0\0\0")
    for i, text in enumerate([*ODD_TEXTS, ""]):
        assert ids[edges[i] : edges[i + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text


def test_chunk_tokenizer_equals_library_on_every_code_point(library):
    mine = best_fit_packing.tokenizer(queries.vocabulary_path())
    texts = [f"ab{chr(c)}1 {chr(c)}s" for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    ids, edges = mine.encode(texts)
    for i, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[edges[i] : edges[i + 1]].tolist() == found.ids, hex(i)


def test_a_vocabulary_with_another_pre_tokenizer_is_left_to_the_library():
    import public_tokenizers

    mine = best_fit_packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Hello  World,\n it's ok", "", "é 日本"]
    ids, edges = mine.encode(texts)
    assert not mine.known_plan
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [mine.whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_chunk_tokenizer_equals_library_on_any_text(text):
    from tokenizers import Tokenizer

    mine = best_fit_packing.tokenizer(queries.vocabulary_path())
    assert mine.encode([text])[0].tolist() == mine.whole.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 20), max_size=200), st.integers(1, 6))
def test_open_bins_place_best_fit_within_bounds(lengths, most):
    bins, used = best_fit_packing.OpenBins(20, most), {}
    for length in lengths:
        number, offset = bins.place(length)
        assert offset == used.get(number, 0)
        used[number] = offset + length
        assert used[number] <= 20 and bins.count <= most
        assert bins.free == sum(1 << f for f, s in enumerate(bins.by_free) if s)


def check_packing(pieces, texts, library, capacity):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        parts = sorted(by_doc.pop(doc_id), key=lambda p: p.piece)
        assert [(p.piece, p.start, p.length) for p in parts] == [(i, at, len(ids[at : at + capacity])) for i, at in enumerate(range(0, len(ids), capacity))]
        assert [p.ids_crc32 for p in parts] == [zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[p.start : p.start + p.length])) for p in parts]
    assert not by_doc
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_the_documents_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    pieces = queries.op8_best_fit_packing(spark, DATA).collect()
    sequences = check_packing(pieces, texts, library, 2048)
    assert sequences <= -(-sum(p.length for p in pieces) // 2048) * 1.03 + 1


def test_packing_edge_cases(spark, library):
    texts = dict(enumerate([None, *ODD_TEXTS, "word " * 9000]))
    rows = [(k, v, 1) for k, v in texts.items()]
    pieces = best_fit_packing.pack(frame(spark, rows, "doc_id long, text string, piece int"), queries.vocabulary_path(), 64, open_bins=2, with_ids=True).collect()
    check_packing(pieces, texts, library, 64)
    assert all(len(p.ids) == p.length for p in pieces)
    twice = best_fit_packing.pack(frame(spark, [(None, "a"), (None, "a")], "doc_id long, text string"), queries.vocabulary_path()).collect()
    assert len(twice) == 2
    assert best_fit_packing.pack(frame(spark, [], "doc_id long, text string"), queries.vocabulary_path()).collect() == []
