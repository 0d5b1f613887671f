"""Pages, archives, URLs, vectors and pieces."""

import gzip
import math
import random
import time
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import embedding, html_text, pieces, url_filter, warc

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    '<header><h2>Site</h2></header><nav><ul><li><a href="/x">menu</a></ul></nav><div class="cookie-notice">We use cookies</div>'
    '<div class="ad">Buy</div><article><header><h1>A &amp; B</h1></header><p><b>Bold<br>next <i>it</i>em.\n <p>Two&nbsp;&lt;x&gt; &copy;'
    '<form><input value="q">Search</form><aside>More</aside><section class="comments"><p>I think</p></section><!-- c --><p>Last</p></article>'
    "<footer>&copy; site</footer></body></html>"
)


def test_main_text_of_a_page():
    assert html_text.extract(PAGE, None, None) == "A & B\n\nBold next item.\n\nTwo <x> ©\n\nLast"
    assert html_text.extract(PAGE[: PAGE.index("Last") + 2], None, None).endswith("La")
    for odd in (None, "", "plain", "<", "<p", "<p a='", "</p></b>", "<script>x", "<!-- x", "a<b"):
        html_text.extract(odd, None, None)
    assert html_text.extract("plain &amp; &am text", None, None) == "plain & &am text"
    assert html_text.extract('<main><h1 title="a>b">x</h1>y</main>z', None, None) == "x\n\ny"


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div id=page class=no-comments", "div class=with-header", "div class=content-sidebar-wrap", "form action=/x"])
def test_wrappers_are_not_beside_the_article(wrapper):
    side = "<div class=sidebar><p>Links</p></div>"
    open_, close = f"<body><{wrapper}>", f"{side}</{wrapper.split()[0]}><p>low</p></body>"
    assert html_text.extract(f"{open_}<article><p>Text</p><form>Find</form></article>{close}", None, None) == "Text"
    assert html_text.extract(f"{open_}<main>Text</main>{close}", None, None) == "Text"
    assert html_text.extract(f"{open_}<p>A text of its own, without an article</p>{close}", None, None) == "A text of its own, without an article\n\nlow"
    assert html_text.extract("<main>Text</main><div class=related><article>A longer text beside the short one</article></div>", None, None) == "Text"
    menu = "<div class=menu><p>Links that every page of the host has</p></div><p>Short</p>"
    known = [html_text._said(place, text) for place, *_, text in html_text.Page(menu).read if text.startswith("Links")]
    assert html_text.extract(menu, known, None) == "Short"


def test_comments_of_readers_are_left_out():
    """Also where they are longer than the post and no article tells it apart."""
    talk = "<p>I think that this is a very good post and have much to say</p>" * 9
    for name in ("class=comments", "id=comment-list", "class='post-comments wide'"):
        assert html_text.extract(f"<body><p>Short post</p><div {name}>{talk}</div></body>", None, None) == "Short post"
        assert html_text.extract(f"<body><article><p>Short post</p><div {name}>{talk}</div></article></body>", None, None) == "Short post"
    assert html_text.extract("<div class=comments><article>Post</article></div>", None, None) == "Post"
    assert html_text.extract("<div class=alert><p>Buy</p></div><article><p>a</p><div class=alert><p>Most of the article's text</p></div></article>", None, None) == "a\n\nMost of the article's text"
    assert html_text.extract("<article><p>The article's own text</p><div class=alert>Buy</div></article>", None, None) == "The article's own text"


def test_markup_comments_that_end_at_once():
    for empty in ("<!-->", "<!--->", "<!-- x -->", "<!-- x --!>"):
        assert html_text.extract(f"<p>a</p>{empty}<p>b</p><!-- c --><p>d</p>", None, None) == "a\n\nb\n\nd"


def test_deep_nesting_is_linear():
    for page in ("<div>" * 100_000 + "x", "<p>" + "<span>" * 50_000 + "<div></b>" * 50_000 + "x", "<div class=ad>" * 50_000 + "x"):
        began = time.perf_counter()
        read = html_text.Page(page)
        assert [t for *_, t in read.blocks() if t] == ["x"]
        assert len(read.within("")) == len(read.parent) and time.perf_counter() - began < 20


def classes_of(pages):
    """(said, container) of one host's pages, from whole occurrence vectors."""
    vectors, size = defaultdict(lambda: [0] * len(pages)), Counter()
    above = {}
    for i, html in enumerate(pages):
        page = html_text.Page(html)
        above |= page.parent
        for place, dropped, main, text in page.blocks():
            if text and dropped == 2:
                continue
            token = (place, html_text._mark(text) if text else "")
            vectors[token][i] += 1
            if text and not dropped:
                long = len(text) * (2 if main else 1)
                size[token] += long
                size[page.parent[place], ""] += long
    seen = {t: sum(map(bool, v)) for t, v in vectors.items()}
    often = {t: tuple(v) for t, v in vectors.items() if seen[t] >= 0.9 * max(seen.values())}
    groups = defaultdict(list)
    for token, vector in often.items():
        groups[vector].append(token)
    valid = {t for g in groups.values() if len(g) > 1 and any(not mark for _, mark in g) for t in g}
    slots = Counter()
    for place, mark in valid:
        slots[above[place] if mark else place] += -size[place, mark] if mark else size[place, mark]
    slots = {p: n for p, n in slots.items() if (p, "") in valid}
    best = max(slots.items(), key=lambda x: (x[1], x[0]), default=("", 0))
    return {f"{p}\n{m}" for p, m in valid if m}, best[0] if best[1] > 0 else None


def test_templates_against_whole_vectors(spark):
    rng = random.Random(8)
    rows = []
    for host in range(5):
        parts = [f"<div class=c{rng.randint(0, 3)}><p>fixed {host} {k}</p></div>" for k in range(4)]
        for i in range(rng.randint(4, 9)):
            body = "".join(rng.choice(["<p>t {} {}</p>", "<article><p>a {} {}</p></article>", "<form>f</form>", "<nav>n</nav>"]).format(i, rng.random()) for _ in range(rng.randint(1, 5)))
            shown = [x for x in parts if rng.random() < 0.95]
            rows.append((f"h{host}", len(rows), f"<body>{''.join(shown[:2])}<div id=body>{body}</div>{''.join(shown[2:])}</body>"))
    df = spark.createDataFrame(rows, "host string, key long, html string").repartition(4)
    got = {r.host: (set(r.said), r.container) for r in html_text.templates(df).collect()}
    want = {f"h{h}": classes_of([x for host, _, x in rows if host == f"h{h}"]) for h in range(5)}
    assert got == want and any(said for said, _ in want.values())


def site(n, text):
    return [(i, f"http://h.example.org/{i}", f"<html><body><div id=top>Our site</div><div id=body><p>{text(i)}</p>" + "<p>extra</p>" * (i % 3) + "</div><div id=low>All rights</div></body></html>") for i in range(n)]


def test_template_of_a_host(spark):
    rows = site(12, lambda i: f"text number {i} with words")
    df = spark.createDataFrame([*rows, (99, None, "<p>alone</p>"), (98, "x", None), (97, "http://e.org", ""), rows[0]], "page_id long, url string, html string")
    got = html_text.main_text(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == 16 and text[4] == "text number 4 with words\n\nextra" and text[99] == "alone" and text[98] == "" and text[97] == ""
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.main_text(df.limit(0)).count() == 0


def test_template_in_articles(spark):
    """What a host repeats inside its articles goes, whatever its class; so do teasers
    that are articles beside the container, and copies of one page keep their text."""
    def page(i):
        teaser = f"<article><p>see {i}</p></article>" if i % 2 else ""
        return (
            f"<html><body><article id=post-{10 + i}><h1>Title {i}</h1><p>Share this story</p><div class=lead><p>Body of {i}, long enough</p><p>More {i * i}</p></div>"
            f"<p class=x>Read our letter</p></article><div class=cards>{teaser}</div></body></html>"
        )
    rows = [(i, f"http://h.example.org/{i}", page(i)) for i in range(9)]
    rows += [(100 + i, f"http://copies.example.org/{i}", page(1)) for i in range(5)]
    rows += [(200, "http://few.example.org/", page(3))]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(9):
        assert got[i] == f"Title {i}\n\nBody of {i}, long enough\n\nMore {i * i}"
    assert "Body of 1, long enough" in got[100] and "Share this story" in got[200]


def test_pages_hold_their_documents(spark):
    """On the given tables the article is a heading and the lines of a document."""
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet").withColumn("page", F.lit("clash"))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in html_text.main_text(pages).collect():
        doc = docs[int(r.url.split("://")[1].split("/")[2].split("?")[0].split("#")[0].split(".")[0])]
        assert r.text.split("\n\n")[1:] == [" ".join(x.split()) for x in doc.split("\n") if x.split()]


def test_host_and_path(spark):
    urls = {
        "http://A.Example.com/en/x?q#f": ("a.example.com", "/en/x"), "https://b": ("b", ""), "b/c": ("", ""), None: ("", ""), "": ("", ""),
        "x://h?a/b": ("h", ""), "x://h#a": ("h", ""), "http://É.com/É": ("É.com", "/É"), "a://b://c/d": ("b:", "//c/d"),
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_filter.host_and_path(F.col("url"))
    for r in df.select("url", host.alias("h"), path.alias("p")).collect():
        assert (r.h, r.p) == urls[r.url]


def test_registered_domains(spark):
    hosts = {
        "www.example.com": ("example.com", "com"), "a.b.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "xco.uk": ("xco.uk", "uk"),
        "me.github.io": ("me.github.io", "github.io"), "example.org:8080": ("example.org", "org"), "b:": ("b", "b"), "": ("", ""), "localhost": ("localhost", "localhost"),
        "a.com.au": ("a.com.au", "com.au"), "com.example.net": ("example.net", "net"), "[::1]": ("", ""),
    }
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = df.select("host", url_filter.domain_of(F.col("host")).alias("d"), url_filter.suffix_of(F.col("host")).alias("s")).collect()
    for r in found:
        if r.host != "co.uk" and r.host != "[::1]":
            assert (r.d, r.s) == hosts[r.host]


def beta(rows, mu):
    """Posterior means and strengths of {key: (good, n)} with means above ``mu``."""
    over = sum(n * (g / n - mu[k]) ** 2 - mu[k] * (1 - mu[k]) for k, (g, n) in rows.items() if n)
    weight = sum(mu[k] * (1 - mu[k]) * (n - 1) for k, (g, n) in rows.items() if n)
    rho = min(0.9, max(0.001, over / weight if weight else 0.001))
    prior = 1 / rho - 1
    return {k: ((prior * mu[k] + g) / (prior + n), prior + n) for k, (g, n) in rows.items()}


def test_url_filter_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        host = rng.choice(("a", "b", "c", "www", "m")) + "." + rng.choice(("example.com", "example.org", "site.org", "bad.net"))
        good = None if rng.random() < 0.3 else int(rng.random() < (0.2 if "bad" in host or host.startswith("c.") else 0.9))
        rows.append((i, f"http://{host}/{rng.choice(('en', 'fr', 'es'))}/{i}", good))
    rows += [(900, None, None), (901, "junk", 0), (902, "http://new.site.org/", None), (None, "http://zz.quite.new/", None), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, good int").withColumn("host", F.lit("clash"))
    got = url_filter.url_filter(df.drop("good"), df.select("url", "good")).collect()
    assert len(got) == len(rows)

    def add(pairs):
        out = {}
        for k, g, n in pairs:
            a, b = out.get(k, (0, 0))
            out[k] = (a + g, b + n)
        return out

    hosts = add(((u.split("://")[1].split("/")[0] if u and "://" in u else ""), g or 0, g is not None) for _, u, g in rows)
    domain = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    domains = add((domain[h], *v) for h, v in hosts.items())
    suffixes = add((d.split(".")[-1], *v) for d, v in domains.items())
    good, n = map(sum, zip(*suffixes.values()))
    by_suffix = beta(suffixes, dict.fromkeys(suffixes, (good + 1) / (n + 2)))
    by_domain = beta(domains, {d: by_suffix[d.split(".")[-1]][0] for d in domains})
    by_host = beta(hosts, {h: by_domain[domain[h]][0] for h in hosts})
    for r in got:
        fits = [(s, h + p) for s, h, p in url_filter.RULES if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        rule = max(fits, key=lambda x: len(x[1]), default=None)
        mean, strength = by_host[r.host]
        says = "allow" if mean - 1.28 * (mean * (1 - mean) / (strength + 1)) ** 0.5 >= 0.5 else "block"
        assert (r.rule, r.verdict) == ((rule[1], rule[0]) if rule else (None, says))
    assert {r.verdict for r in got if not r.rule} == {"allow", "block"}
    assert url_filter.url_filter(df.limit(0), df.limit(0).select("url", "good")).count() == 0


RECORD = "record_id string, warc_type string, url string, date timestamp, status int, headers map<string,string>, payload binary, page string"


def test_revisits_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        url = "HTTP://Hot.example.com:80" if rng.random() < 0.4 else f"http://h{rng.randint(0, 9)}.org/p{rng.randint(0, 2)}#x"
        full = rng.random() < 0.3
        headers = {k: v for k, v in {"etag": rng.choice(("A", "W/A", "B", None)), "last-modified": rng.choice(("t1", "t2", None)), "server": f"s{i}", "date": f"d{i}"}.items() if v}
        rows.append((f"r{i:04}", "response" if full else "revisit", url, rng.randint(0, 300), 200 if full else 304, headers, f"body{i}".encode() if full else None, "clash"))
    rows += [("n1", "revisit", None, 5, 304, {"etag": "A"}, None, None), ("n2", None, None, None, None, None, None, None), ("n3", "revisit", "http://none.org", 5, 304, None, None, None)]
    df = spark.createDataFrame([(*r[:3], None, *r[4:]) for r in rows], RECORD).drop("date")
    days = spark.createDataFrame([(r[0], r[3]) for r in rows], "record_id string, s long")
    df = df.join(days, "record_id").withColumn("date", F.timestamp_seconds("s")).drop("s").repartition(5)
    got = {r.record_id: r for r in warc.resolve_revisits(df).collect()}
    assert len(got) == len(rows)

    def key(u):
        return "http://hot.example.com/" if u and u.startswith("HTTP") else u.split("#")[0].replace("none.org", "none.org/") if u else None

    for r in rows:
        me = got[r[0]]
        if r[1] != "revisit":
            assert me.outcome == ("full" if r[1] else "other") and me.payload == r[6] and me.headers == r[5]
            continue
        earlier = [x for x in rows if x[1] == "response" and key(x[2]) == key(r[2]) and r[2] and x[3] < r[3]]
        last = max(earlier, key=lambda x: (x[3], x[0]), default=None)
        h = r[5] or {}
        if last is None:
            want = "orphan"
        elif "etag" not in h and "last-modified" not in h:
            want = "no validator"
        else:
            same = h["etag"].removeprefix("W/") == last[5].get("etag", "?").removeprefix("W/") if "etag" in h else h["last-modified"] == last[5].get("last-modified")
            want = "resolved" if same else "mismatch"
        assert me.outcome == want
        if want == "resolved":
            assert me.refers_to == last[0] and me.payload == last[6]
            assert me.headers == {**last[5], **{k: v for k, v in h.items() if k in warc.PERMITTED}}
        else:
            assert me.payload is None and (me.headers or {}) == h
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_archive_files(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nETag: \"a\"\r\nVary: x\r\nVary: y\r\n\r\nhello \xff"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:1>\r\nWARC-Target-URI: http://a.org/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: %d\r\n\r\n" % len(body)
    (tmp_path / "a.warc").write_bytes((head + body + b"\r\n\r\n") * 2 + head + body[:9])
    (tmp_path / "b.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert len(rows) == 2 and rows[0].headers == {"etag": '"a"', "vary": "x, y"} and bytes(rows[0].payload) == b"hello \xff"
    assert rows[0].status == 200 and rows[0].url == "http://a.org/" and rows[0].record_id == "<urn:1>"


def test_archive_files_in_gzip(spark, tmp_path, monkeypatch):
    def record(i, size):
        body = random.Random(i).randbytes(size)
        return f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:{i}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n", body

    made = [record(i, size) for i, size in enumerate((0, 10, 200_000, 65_536, 5))]
    packed = b"".join(gzip.compress(raw) for raw, _ in made)
    assert list(warc.members(packed)) == [raw for raw, _ in made]
    assert len(list(warc.members(packed[:-30]))) == 4 and list(warc.members(b"")) == [b""]
    (tmp_path / "a.warc.gz").write_bytes(packed + gzip.compress(made[1][0])[:-3])
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(made[0][0] + made[1][0]))  # several records in a member
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in rows) == sorted([b for _, b in made] + [made[0][1], made[1][1]])


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):
        c = rng.normal(size=24)
        c /= np.linalg.norm(c)
        rows.append((10 * i + 1, c.tolist()))
        for k in range(rng.integers(0, 4)):
            o = rng.normal(size=24)
            o -= o @ c * c
            o /= np.linalg.norm(o)
            z = rng.uniform(0.93, 0.999)
            rows.append((10 * i + 2 + int(k), (3 * (z * c + np.sqrt(1 - z * z) * o)).tolist()))
    rows += [(5000 + i, rows[0][1]) for i in range(40)]  # copies
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    odd = [(6000, None), (6001, [0.0] * 24), (6002, [float("nan")] + [1.0] * 23), (6003, [1.0, None]), (6004, [float("inf")] * 24), (6005, []), (6006, [2.0, 4.0]), (6007, [1.0, 2.0]), rows[0], (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("node", F.lit("clash"))
    got = {r.vec_id: r for r in embedding.embedding_groups(df).collect()}
    assert len(got) == len(rows) + 9
    for i in (6000, 6001, 6002, 6003, 6004, 6005, None):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert got[6006].component_id == 6006 and got[6007].component_id == 6006 and got[6007].n_links == 1
    found = sum(got[r[0]].n_links for r in rows)
    assert 0.9 * near.sum() <= found <= near.sum()
    assert got[5039].n_links >= 40 and got[5039].component_id == 1 and not got[5039].kept
    assert embedding.embedding_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize(("dim", "nodes"), [(24, 10**4), (64, 10**6), (128, 10**6), (384, 10**7)])
def test_tables_follow_the_dimension(dim, nodes):
    """Few pairs just above the least cosine are missed, at any dimension."""
    rotations = math.ceil(math.log(nodes) / math.log(2 * (1 << (dim - 1).bit_length())))
    tables = embedding.tables_for(dim, rotations)
    rng = np.random.default_rng(dim)
    a, b = rng.standard_normal((2, 1500, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.951 * a + math.sqrt(1 - 0.951**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    of_a, of_b = (embedding.bucket_codes(x, tables, rotations) for x in (a, b))
    met = ((of_a[:, :, :1] == of_b).any(axis=2) | (of_b[:, :, :1] == of_a).any(axis=2)).any(axis=1)
    assert met.mean() > 0.985 and tables <= 20


def test_hadamard_is_orthogonal():
    h = embedding.hadamard(np.eye(8))
    assert (h @ h.T == 8 * np.eye(8)).all() and set(np.unique(h)) == {-1.0, 1.0}


TEXTS = ["", " ", "  a  b ", "Hello, wörld!\n\n\tx", "▁ ▁▁ marks", "日本語 テスト 😀 \u0301\x00", "<0x41> <s> </s>", "a" * 3000, " " * 100, "é" * 70, "x y " * 500]


def test_pieces_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null key"), (50, None), (3, TEXTS[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    got = pieces.sampled_pieces(df).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert {r.doc_id: r.n_pieces for r in got}[0] == 0 and next(r for r in got if r.doc_id == 50).ids is None
    assert len({tuple(r.ids) for r in got if r.doc_id == 3}) == 1
    again = pieces.sampled_pieces(df.repartition(1)).collect()
    assert {(r.doc_id, tuple(r.ids or ())) for r in again} == {(r.doc_id, tuple(r.ids or ())) for r in got}
    other = pieces.sampled_pieces(df, seed=1).collect()
    assert {(r.doc_id, tuple(r.ids or ())) for r in other} != {(r.doc_id, tuple(r.ids or ())) for r in got}
    assert pieces.sampled_pieces(df.limit(0)).count() == 0


def test_segmentations_have_their_probabilities():
    vocabulary = [(" a", 0), ("b", 1), ("ab", 2), (" ", 3), ("a", 4), (" ab", 5), ("ba", 6), ("  ", 7)]
    lattice = pieces.Lattice(vocabulary, list(range(100, 356)), 0.5)
    text, n = "aba", 20000
    target = " " + text
    paths = {}
    for cuts in product((0, 1), repeat=len(target) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(target)]
        parts = [target[a:b] for a, b in zip(at, at[1:])]
        found = [next((k for k, (t, _) in enumerate(vocabulary) if t == p), None) for p in parts]
        if None not in found:
            paths[tuple(vocabulary[k][1] for k in found)] = np.prod([(k + 3.0) ** -0.5 for k in found])
    total = sum(paths.values())
    ids, sizes = lattice.sample([text] * n, pieces.row_seeds(np.arange(n), 7))
    ends = np.cumsum(sizes)
    seen = Counter(tuple(ids[e - s : e].tolist()) for e, s in zip(ends, sizes))
    assert set(seen) <= set(paths)
    for path, p in paths.items():
        assert abs(seen[path] / n - p / total) < 4 * (p / total / n) ** 0.5 + 1e-3


def test_runs_of_characters_without_pieces_leave_others_alone(spark):
    """Gothic letters, CJK extension B and new emoji have no piece, and weigh four bytes each."""
    rare = ["\U00010330" * 64, "\U00020000\U00020001" * 200, "x" + "\U0001fae0" * 26, " " * 40 + "\U00010331" * 4000]
    plain = [(i, f"ordinary words of row {i} and some more") for i in range(40)]
    alone = {r.doc_id: r.ids for r in pieces.sampled_pieces(spark.createDataFrame(plain, "doc_id long, text string")).collect()}
    rows = [(100 + i, t) for i, t in enumerate(rare)]
    got = pieces.sampled_pieces(spark.createDataFrame([*plain[:20], *rows, *plain[20:]], "doc_id long, text string").coalesce(1)).collect()
    assert all(r.lossless for r in got)
    assert {r.doc_id: r.ids for r in got if r.doc_id < 100} == alone
    raw, texts, of_byte = pieces.vocabulary()
    lattice = pieces.Lattice(texts, of_byte, pieces.ALPHA)
    lattice.learn([" " + rare[0], " and", rare[3]])
    assert not np.isnan(lattice.tables[0]).any() and (np.diff(lattice.tables[0]) >= 0).all()


def test_forward_pass_follows_only_beginnings_of_pieces(monkeypatch):
    """The longest piece has 16 characters and more; few beginnings go on that far."""
    _, texts, of_byte = pieces.vocabulary()
    lattice, hashed = pieces.Lattice(texts, of_byte, pieces.ALPHA), []
    for name in ("_hashes", "_longer"):
        work = getattr(pieces, name, None)
        times = (lambda _: 1) if name == "_longer" else (lambda length: length)
        counted = lambda x, y, work=work, times=times: hashed.append(len(x) * times(y)) or work(x, y)
        monkeypatch.setattr(pieces, name, counted, raising=False)
    words = [" " + "".join(w) for w in product("etaq", repeat=6)]
    lattice.learn(words)
    assert lattice.longest >= 16 and sum(hashed) <= 4 * 7 * len(words)


def test_edges_match_a_plain_forward_pass():
    _, texts, of_byte = pieces.vocabulary()
    lattice, weights = pieces.Lattice(texts, of_byte, pieces.ALPHA), {t: (k, i) for k, (t, i) in enumerate(texts)}
    runs = [" the", " nation", " thathing", "  a", "a", "日本語", " x\U00010330\u2581é", "   ", " " + "at" * 40, "\x00\n\t"]
    lattice.learn(runs[:4])
    lattice.learn(runs[4:])
    keys, lengths, ids = (x.tolist() for x in lattice.tables)
    node = edge = 0
    for run in runs:
        reach = [1.0]
        for end in range(1, len(run) + 1):
            here = []
            for length in range(1, min(end, lattice.longest) + 1):
                char = run[end - length : end]
                if char in weights:
                    place, known = weights[char]
                    here.append((reach[end - length] * (place + 3.0) ** -pieces.ALPHA, length, known))
                elif length == 1:
                    of = [of_byte[b] for b in char.encode()]
                    here.append((reach[end - 1] * (len(texts) + 3.0) ** (-pieces.ALPHA * len(of)), 1, of))
            reach.append(sum(x[0] for x in here))
            assert lattice.first[node] == edge
            below = 0.0
            for value, length, known in here:
                below += value / reach[-1]
                spelled = lattice.extra_ids[-1 - ids[edge]] if ids[edge] < 0 else ids[edge]
                assert spelled == (known[0] if isinstance(known, list) and len(known) == 1 else known)
                assert lengths[edge] == length and abs(keys[edge] - node - below) < 1e-9
                edge += 1
            node += 1
    assert edge == len(keys) and node == len(lattice.first)


@pytest.mark.parametrize("length", [1, 5, 16])
def test_hashes_follow_code_points(length):
    a, b = pieces._points("xyzabcdefghijklmnopq"), pieces._points("abcdefghijklmnopqrst")
    assert (pieces._hashes(a, length)[3 : 3 + 18 - length] == pieces._hashes(b, length)[: 18 - length]).all()


def test_decode_on_a_cluster(spark):
    sent = pieces.Pieces(spark)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(99, None)], "doc_id long, text string")
    cut = df.select("text", sent.encode(F.col("text"), F.col("doc_id")).alias("ids"))
    assert all(r.text == r.back for r in cut.select("text", sent.decode(F.col("ids")).alias("back")).collect())
