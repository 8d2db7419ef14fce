"""WARC round trips and main-text extraction."""

import gzip
import hashlib
import random
import re
import uuid

from pyarrow import fs as pafs

from kinelab.llm.warc import read_archives, write_archives
from kinelab.llm.wrappers import Wrapper, extract, main_text, parse
from kinelab.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, kind int, shard int"
BODY = "<p>" + "text " * 40 + "</p>"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 7, 7) for r in rows], SCHEMA)


PAGES = [(5, "http://a.example/x y\r\nInjected: 1", BODY), (3, None, BODY), (9, "http://b.example/", BODY), (4, "u", None), (6, "u", None),
         (7, "u", "short"), (8, "u", "short"), (10, "u", "é一\r\n\r\n" * 200), (10, "u", "é一\r\n\r\n" * 200), (None, "u", BODY), (11, "u", "x" * 300_000)]


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out, used = [], set()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and (i != first[h] or h in used)
        used |= {h} if i == first.get(h) else set()
        out.append((i is None, i or 0, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


def round_trip(spark, df, **kw):
    path = scratch_path(spark, "test-archives")
    manifest = write_archives(df, path, **kw)
    return path, manifest, read_archives(spark, manifest, path).collect()


def test_round_trip(spark):
    path, manifest, rows = round_trip(spark, frame(spark, PAGES), shard_bytes=2_000, file_bytes=500)
    got = [(r["page_id"] is None, r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(got, key=str) == expected(PAGES)
    html = {i: h or "" for i, _, h in PAGES}
    assert all(r["payload"] == html[r["page_id"]] for r in rows if r["record_type"] == "response")
    files = manifest.collect()
    assert len(files) > 3
    fs, base = pafs.FileSystem.from_uri(path)
    listed = [f.base_name for f in fs.get_file_info(pafs.FileSelector(base)) if not f.base_name.startswith(".")]
    assert sorted(listed) == sorted(f["file"] for f in files)  # nothing of the temporary names is left
    ids = []
    for f in files:
        with fs.open_input_stream(f"{base}/{f['file']}", compression=None) as s:
            raw = s.read()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (f["bytes"], f["sha256"])
        text = gzip.decompress(raw).decode()
        assert text.startswith("WARC/1.1\r\nWARC-Type: warcinfo\r\n") and "\r\nInjected: 1" not in text
        ids += re.findall(r"WARC-Record-ID: <urn:uuid:([0-9a-f-]+)>", text)
        refers = re.findall(r"WARC-Refers-To: <urn:uuid:([0-9a-f-]+)>", text)
        assert all(uuid.UUID(x) for x in refers)
    assert len(ids) == len(set(ids)) == len(PAGES) + len(files)


def test_same_pages_give_the_same_files(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    _, a, rows = round_trip(spark, df, shard_bytes=40_000, file_bytes=8_000)
    _, b, _ = round_trip(spark, df.repartition(7), shard_bytes=40_000, file_bytes=8_000)
    key = lambda m: sorted((r["file"], r["records"], r["bytes"], r["sha256"]) for r in m.collect())
    assert key(a) == key(b) and len(key(a)) > 3
    assert sum(r[1] for r in key(a)) == len(rows) == df.count()


def test_a_hot_page_id_is_cut_over_shards(spark):
    """Half of the pages under one id, a tenth without: shards stay near their size, one task each."""
    rows = [(7 if i % 2 else None if i % 10 == 0 else i, f"http://a/{i}", f"<p>{i} " + "x" * 1000) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path, manifest, back = round_trip(spark, df, shard_bytes=20_000, file_bytes=10**9)
    per_shard = {}
    for r in manifest.collect():
        per_shard[r["file"][5:11]] = per_shard.get(r["file"][5:11], 0) + r["records"]
    assert len(per_shard) >= 18 and max(per_shard.values()) <= 2 * 400 / 20
    assert sorted(hashlib.sha256(h.encode()).hexdigest() for _, _, h in rows) == sorted(r["payload_digest"] for r in back)


def test_no_pages(spark):
    _, manifest, rows = round_trip(spark, frame(spark, PAGES).limit(0))
    assert rows == [] and manifest.count() == 0


def one(page):
    w = Wrapper()
    p = parse(page)
    w.learn(p)
    return main_text(w, w.main_slots(), p)


def test_article_without_boilerplate():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
      <nav><ul><li><a href="/a">A</a><li>B</ul></nav><!-- <article>no</article> --><div class="ad">Buy</div>
      <article class='post'><h1>Head &amp; line</h1><p>One <b>bold<br>two &lt;x&gt; &copy;&nbsp; end <p>Next
        <a href="x>y">link</a><script>if (a < b) {}</script> tail</p><form>Name <input value=q> <textarea>a < b</textarea></form>
      <aside>Side</aside><div id="cookie-notice">Cookies</div><blockquote>Quote</blockquote><ul><li>i1<li>i2</ul>
      <button>Press</button><section class="comments"><p>First!</p></section></article><footer>&copy; F</footer></body></html>"""
    assert one(page) == "Head & line\n\nOne bold two <x> © end\n\nNext link tail\n\nQuote\n\ni1\n\ni2"


def test_truncated_and_odd_pages():
    assert one("") == "" and one("<nav>menu</nav>") == ""
    assert one("<article><p>a &amp") == "a &" and one("<article><h1>x &am</h1><p>b") == "x &am\n\nb"
    assert one("<div class=ad>x<article><p>kept</article>") == "kept"
    assert one("<article><p>1 < 2 and 3 > 2 <") == "1 < 2 and 3 > 2 <"
    assert one("<p>" * 3000 + "deep" + "<div>" * 3) == "deep"


def test_template_without_article_element(spark):
    def page(i, n):
        body = "".join(f"<p>Body {i} paragraph {j} with enough words to matter here.</p>" for j in range(n))
        extra = f"<div class='related'>Other {i}</div>" if i % 2 else ""
        return (i, f"http://h.example/{i}", f"<html><body><div id=top><a href=/>Home</a> <a href=/b>About</a></div><div id=c><h2>Title {i}</h2>{body}</div>"
                f"{extra}<div id=bottom>All rights reserved {2000}</div></body></html>")
    rows = [page(i, 1 + i % 5) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in extract(frame(spark, rows)).collect()}
    for i, *_ in rows:
        want = "\n\n".join([f"Title {i}"] + [f"Body {i} paragraph {j} with enough words to matter here." for j in range(1 + i % 5)])
        assert got[i] == want


def test_title_and_lead_beside_the_body_are_kept(spark):
    def page(i):
        return (i, f"http://h.example/{i}", f"<html><body class=has-sidebar><div id=top><a href=/>Home</a></div><div id=c><h2>Title {i}</h2><p class=lead>Lead {i}</p>"
                f"<div class=body>{''.join(f'<p>Body {i} paragraph {j} with enough words.</p>' for j in range(4 + i % 3))}</div></div>"
                "<div class=sidebar-left>Archive</div></body></html>")
    got = {r["page_id"]: r["text"] for r in extract(frame(spark, [page(i) for i in range(8)])).collect()}
    for i in range(8):
        assert got[i] == "\n\n".join([f"Title {i}", f"Lead {i}"] + [f"Body {i} paragraph {j} with enough words." for j in range(4 + i % 3)])


def test_names_with_a_hint_word_are_no_boilerplate(spark):
    def page(i, host):
        return (i, f"http://{host}/{i}", f"<body><article><h2 id=related-work>Related {i}</h2><p>Text {i}</p><section id=social-impact><h3>Impact</h3><p>Impact {i}</p></section>"
                "<div class=share-row><p>Share</p><p>Mail</p></div><div class=related>More</div></article></body>")
    got = {r["page_id"]: r["text"] for r in extract(frame(spark, [page(i, "h.example") for i in range(6)] + [page(9, "lone.example")])).collect()}
    for i in range(6):
        assert got[i] == f"Related {i}\n\nText {i}\n\nImpact\n\nImpact {i}"
    assert got[9] == "Related 9\n\nText 9\n\nImpact\n\nImpact 9\n\nShare\n\nMail"
    assert one("<body class='has-sidebar'><p>kept</p><div id='main-menu'>no main</div></body>").startswith("kept")


def test_wrapper_has_optional_and_repeated_groups():
    w = Wrapper()
    for n, extra in ((1, ""), (3, "<h3>x</h3>"), (2, "")):
        w.learn(parse(f"<body><div><p>{n}</p>{extra}{'<dl><dt>a</dt></dl>' * n}</div></body>"))
    div = w.root.items[0].items[0]
    assert [(x.label, x.optional, x.repeated) for x in div.items] == [("p", False, False), ("h3", True, False), ("dl", False, True)]


def brute(page):
    """The main text of the test pages: what stands in the article element."""
    import html
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    blocks = re.split(r"</?(?:p|h1|article)>", m[1]) if m else []
    texts = [" ".join(html.unescape(re.sub(r"</?(?:b|br)>", lambda t: " " if "br" in t[0] else "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_pages_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    html = {r["page_id"]: r["html"] for r in df.collect()}
    rows = extract(df).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(html)
    assert [r["page_id"] for r in rows if r["text"] != brute(html[r["page_id"]])] == []
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_extract_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "http://u:p@H.Example:80/x", "<article>a"), (3, "http://h.example", "<article>b")]
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract(frame(spark, rows)).collect())
    assert got == [(0, "a", 1), (1, "", 0), (2, "", 0), (2, "", 0), (3, "b", 1)]
    assert extract(frame(spark, rows).limit(0)).count() == 0


def page_text(spark, pages):
    rows = [(i, f"http://h{h}.example/{i}", text) for i, (h, text) in enumerate(pages)]
    return {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_deeply_nested_pages_keep_text_and_order(spark):
    deep = "<article>" + "".join(f"<div class=l{i % 3}>t{i}" for i in range(5000)) + "".join(f"</div>u{i}" for i in range(4999, -1, -1)) + "</article>"
    spans = "<body><article>" + "<section><p>x</p>" * 3000 + "end</article><nav>" + "<div>" * 2000 + "menu</nav></body>"
    got = page_text(spark, [(1, deep), (1, "<article><p>plain</p></article>"), (2, spans)])
    assert got[0].split("\n\n") == [f"t{i}" for i in range(5000)] + [f"u{i}" for i in range(4999, -1, -1)]
    assert got[1] == "plain"
    assert got[2] == "\n\n".join(["x"] * 3000 + ["end"])


def test_many_irregular_siblings(spark):
    rng = random.Random(4)
    pages = []
    for _ in range(3):
        tags = [rng.choice(["p", "h2", "blockquote", "pre", "div class=a", "div class=b"]) for _ in range(50_000)]
        pages.append([(f"<{t}>w{i}</{t.split()[0]}>", f"w{i}") for i, t in enumerate(tags)])
    got = page_text(spark, [(1, "<main>" + "".join(a for a, _ in p) + "</main>") for p in pages])
    for i, p in enumerate(pages):
        assert got[i] == "\n\n".join(b for _, b in p)


def test_comment_containers_inside_the_article(spark):
    for name in ("comments-area", "comment-list", "user-comments", "post-comments", "comments", "commentlist wide"):
        page = f'<article><p>Body on code comments.</p><div class="{name}"><p>First!</p><p>I agree</p></div><p class="comment-free">End</p></article>'
        assert page_text(spark, [(1, page)])[0] == "Body on code comments.\n\nEnd", name
