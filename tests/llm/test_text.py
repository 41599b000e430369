"""WARC, HTML, LM scores, packing, quality rules, mixing and licences."""

import collections
import gzip
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickfold.llm import html_text, licenses, lm_score, mixing, packing, quality_rules, warc

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PAGES = "page_id long, url string, html string"
DOCS = "doc_id long, text string, lang string, source string"


# -- 1: WARC --------------------------------------------------------------------

def test_warc_round_trip(spark):
    long = "é" * 200
    rows = [(5, "http://a/", long), (3, "http://b/?x=1: 2", long), (9, None, long), (1, "u\r\nWARC-Type: x", "tiny"),
            (2, "u%0A", "tiny"), (4, "", None), (None, "n", long), (6, "c", "\r\n\r\nWARC/1.1\r\n" * 40),
            (7, "d", "x" * 3_000_000), (3, "http://b/again", long), (8, "e", "")]
    index = warc.write(spark.createDataFrame(rows, PAGES).repartition(3))
    records = warc.read(index)
    assert sorted(map(str, (tuple(r)[1] for r in records.select("page_id", "url").collect()))) == \
        sorted(str(u) for _, u, _ in rows)
    got = sorted(tuple(r) for r in warc.with_payloads(records).select(
        F.coalesce("page_id", F.lit(-1)), "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = h == long and i != 3
        want.append((-1 if i is None else i, len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(want, key=str) or sorted(map(str, got)) == sorted(map(str, want))
    some = warc.read(index.filter("url = 'd'")).collect()  # any selection can be read
    assert [r.payload for r in some] == ["x" * 3_000_000]
    assert warc.read(warc.write(spark.createDataFrame([], PAGES))).collect() == []


DATE = "2024-01-02T03:04:05Z"


def test_records_have_dates_and_ids_of_their_own(spark, tmp_path):
    rows = [(7, "http://a/", "x" * 200, "clash")] * 3 + [(8, "http://b/", "x" * 200, "clash")]
    index = warc.write(spark.createDataFrame(rows, PAGES + ", archive string").repartition(1), str(tmp_path / "w"), DATE)
    (path,) = {r.archive for r in index.collect()}
    heads = [x.partition("\r\n\r\n")[0].split("\r\n") for x in gzip.open(path, "rt", newline="").read().split("WARC/1.1")[1:]]
    ids = [next(f for f in h if f.startswith("WARC-Record-ID")) for h in heads]
    assert len(set(ids)) == 4 and all(f"WARC-Date: {DATE}" in h for h in heads)
    records = warc.read(index)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in records.collect()) == \
        [(7, "response", None)] * 3 + [(8, "revisit", 7)]
    assert records.rdd.getNumPartitions() > 1 or spark.sparkContext.defaultParallelism == 1


def test_ranges_are_joined_up_to_a_gap_and_a_size():
    gap, most = warc.GAP, warc.READ
    rows = [(0, 10), (10, 5), (15 + gap, 10), (26 + 2 * gap, most), (30 + 2 * gap + most, 1)]
    assert list(warc.ranges(rows)) == [rows[:3], rows[3:4], rows[4:]]
    assert list(warc.ranges([])) == []


def test_a_damaged_record_is_noticed():
    raw = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, DATE, "a/0")
    assert warc.parse(raw)[-1] == "payload"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError):
        warc.parse(raw[:-3])


# -- 4: HTML ---------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><nav><a href=x>menu</a></nav>
<main><article class="post"><h1>Ti &amp; tle %d</h1><div class="ad">buy</div><p>One&nbsp;<b>two</b>
  three&#33; %d<p>Four<br>five &lt;six&gt;</p><script>var t = "</p>";</script><ul><li>a %d<li>b</ul><form>f</form>
<div class="disclaimer-text">All on this page is the same</div></article>
<section id="comments"><article class="comment">first!</article></section></main>
<aside>side</aside><footer>&copy; f</footer>"""


def test_article_without_what_surrounds_it(spark):
    rows = [(i, "http://h.org/%d" % i, PAGE % (i, i, i)) for i in range(12)]
    rows += [(100, None, None), (101, "no url", ""), (102, "http://x/", "<p>a<div>b<i>c</i> d</div>e<"),
             (103, "http://y/", "<article>" + "<div>x" * 3000), (104, "http://z/", "<p>long " + "word " * 100_000)]
    got = {r.page_id: r for r in html_text.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    for i in range(12):  # the constant slot is template, the rest varies or is structure
        assert got[i].text == f"Ti & tle {i}\nOne two three! {i}\nFour five <six>\na {i}\nb" and got[i].url == rows[i][1]
    assert got[100].text == got[101].text == "" and got[100].n_chars == 0
    assert got[102].text == "a\nbc d\ne<" and got[102].n_chars == len(got[102].text)
    assert got[103].text == "\n".join("x" * 3000) and got[104].n_chars == len("long" + " word" * 100_000)
    assert html_text.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_without_landmarks_the_varying_slots_are_the_content(spark):
    page = "<body><div class=top>Same on all pages</div><div class=x><p>Text {0}</p><p>More {0}</p></div><div class=end>The end</div>"
    rows = [(i, "http://h/", page.format(i)) for i in range(9)]
    got = html_text.main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.text for r in got} == {f"Text {i}\nMore {i}" for i in range(9)}


def test_the_whole_article_is_read():
    page = ("<body><svg width='1' /><main><h1>Title</h1><p>intro <math/>x</p><article><p>one</p></article>"
            "<article class=b><h2>two</h2></article><svg a=b/>no</svg></main><article>aside</article>")
    assert html_text.text_of(page, None) == "Title\nintro x\none\ntwo"  # math is part of a line
    page = "<body><p>top</p><article><p>a</p></article><article class=b><h2>b</h2><svg hidden/>c</article>"
    assert html_text.text_of(page, None) == "a\nb\nc"


def test_template_of_any_tags_goes_though_a_page_differs(spark):
    page = ("<body><div class=top><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><div><span>site name</span></div>"
            "<div class=x><p>Text {0} <b>in bold</b> and more</p></div><a>Imprint</a></body>")
    rows = [(i, "http://h/", page.format(i)) for i in range(20)]
    rows += [(20, "http://h/", page.format(20).replace("Home", "Start")), (21, "http://h/", page.format(21).replace("site", "my"))]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert {got[i] for i in range(20)} == {f"Text {i} in bold and more" for i in range(20)}
    assert got[20] == "Start\nNews\nText 20 in bold and more" and got[21] == "my name\nText 21 in bold and more"


def test_copies_of_a_page_are_no_template(spark):
    copy = "<body><nav>{0}</nav><article><h1>Copied</h1><pre>code</pre><p>same</p></article></body>"
    rows = [(i, "http://a/", copy.format(i)) for i in range(12)]
    rows += [(100 + i, "http://a/", f"<body><article><h1>T {i}</h1><p>x {i}</p></article></body>") for i in range(9)]
    rows += [(200 + i, "http://b/", "<p>one</p><div class=d>two</div>") for i in range(8)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert {got[i] for i in range(12)} == {"Copied\ncode\nsame"} and {got[200 + i] for i in range(8)} == {"one\ntwo"}
    assert all(got[100 + i] == f"T {i}\nx {i}" for i in range(9))


def test_a_host_of_many_layouts_keeps_its_template(spark):
    layout = "".join(f"<div class=k{{0}}q{chr(97 + k % 26)}{chr(97 + k // 26)}><p>t {{1}}</p></div>" for k in range(300))
    rows = [(i, "http://h/", f"<body><div class=b><p>boiler</p></div>{layout.format(chr(97 + i % 26), i)}</body>") for i in range(40)]
    got = html_text.main_text(spark.createDataFrame(rows, PAGES).repartition(8)).collect()
    assert all(r.text == "\n".join([f"t {r.page_id}"] * 300) for r in got)


def test_names_alone_decide_nothing():
    def page(x):
        return html_text.text_of(x, None)

    body = "<article><h1>T</h1><p>one two three four five six</p>%s</article>"
    for around in ('<div class="page has-sidebar">%s</div>', '<div class="content-sidebar-wrap">%s</div>',
                   '<div class="sidebar">%s</div>', '<form>%s</form>', '<div id="comments">%s</div>'):
        assert page(around % (body % "")) == "T\none two three four five six"
    for inner, text in (('<h2 id="search-trees">Search trees</h2>', "Search trees"), ('<p class="notice-board">n</p>', "n"),
                        ('<div class="related-work">w</div>', "w"), ('<p>a <a class="share-link">b</a> c</p>', "a b c"),
                        ('<div class="promoted"><a>l</a> long text</div>', "l long text"), ("<p>a<math>x</math>b</p>", "ab"),
                        ("<p>a <label>x</label><select><option>y</select>b</p>", "a b")):
        assert page(body % inner) == "T\none two three four five six\n" + text
    for inner in ('<div class="ad">x</div>', '<div class="share-links">x</div>', '<div class="related-work"><a>x</a></div>',
                  '<ol class="comment-list"><li><article>x</article></ol>', '<form><p>x</p></form>',
                  '<section id="comments"><p>' + "x" * 100 + "</p></section>", '<div class="cookie-notice">x</div>'):
        assert page(body % inner) == "T\none two three four five six"
    assert page(body % "" + '<div class="related"><article>y</article></div>') == "T\none two three four five six"


def wrapped_by_hand(rows):
    """The result of main_text by plain loops: whole hosts, all layouts at once."""
    cuts, out = {}, {}
    for i, host, html in rows:
        root = html_text.slots([html_text.parse(html)])
        cuts.setdefault(host, []).append((i, html, root))
    for pages in cuts.values():
        layouts = collections.defaultdict(list)
        for _, _, root in pages:
            layouts[root.cut].append(root)
        trees = {c: min(x, key=html_text.dump) for c, x in layouts.items()}
        wrapper = None
        for c in sorted(layouts, key=lambda c: (-len(layouts[c]), c))[:html_text.LAYOUTS]:
            wrapper = trees[c] if wrapper is None else html_text.fold(wrapper, trees[c])
        wrapper = html_text.load(html_text.dump(wrapper))
        where = {c: html_text.places(t, wrapper) for c, t in trees.items()}
        counts = collections.Counter()
        distinct = {root.text: root for _, _, root in pages}
        for root in distinct.values():
            counts.update(set(zip(where[root.cut], (x.text for x in html_text.preorder(root)), strict=True)))
        for i, html, root in pages:
            held = {(n, x.text) for n, (p, x) in enumerate(zip(where[root.cut], html_text.preorder(root), strict=True))
                    if counts[p, x.text] >= max(html_text.SUPPORT, len(distinct) / html_text.ONE_IN)}
            out[i] = html_text.text_of(html, held)
    return out


def test_wrappers_against_plain_loops(spark):
    r = random.Random(5)
    rows = []
    for i in range(240):
        host = "h%d" % (i % 3 if i % 2 else 0)
        parts = [f"<div><p>Boiler {host}</p></div>", f"<div><p>Text {i}</p><ul><li>a {i}<li>b</ul></div>"]
        if r.random() < .5:
            parts.insert(r.randint(0, 2), f"<div><p>Offer {r.randint(0, 2)}</p></div>")
        if r.random() < .3:
            parts.insert(r.randint(0, 2), f"<section><h3>S {i}</h3><b>x</b></section>")
        rows.append((i, host, "<body>" + "".join(parts) + f"<div><p>End of {host}</p></div></body>"))
    rows.append((240, "h9", "<div><p>same</p></div>" * 9))  # often on one page is not on many pages
    want = wrapped_by_hand(rows)
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", x, "clash") for i, h, x in rows], PAGES + ", layout string")
    got = {x.page_id: x.text for x in html_text.main_text(frame.repartition(5)).collect()}
    assert got == want
    assert sum("Boiler" in x or "End of" in x for x in want.values()) == 0  # though neighbours of one key move about
    assert all(f"Text {i}\na {i}\nb" in want[i] for i in range(240)) and want[240] == "\n".join(["same"] * 9)


def test_long_rows_of_neighbours_are_paired_in_order():
    def row(keys):
        return [html_text.Slot(k, 1, 0, 1, []) for k in keys]

    a, b = row("ab" * 90), row("ab" * 40 + "c" + "ba" * 60)
    pairs = html_text.aligned(a, b)
    at = [(a.index(x), b.index(y)) for x, y in pairs]
    assert at == sorted(at) and all(x.key == y.key for x, y in pairs) and len(pairs) > 100
    assert all(p < q and s < t for (p, s), (q, t) in zip(at, at[1:], strict=False))


def naive_matching(a, b):
    if a.key != b.key:
        return 0
    m = [[0] * (len(b.below) + 1) for _ in range(len(a.below) + 1)]
    for i, x in enumerate(a.below):
        for j, y in enumerate(b.below):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + naive_matching(x, y))
    return (3 if a.seen & b.seen else 1) + m[-1][-1]


def test_tree_matching_is_the_largest(spark):
    r = random.Random(2)

    def tree(depth):
        below = [tree(depth - 1) for _ in range(r.randint(0, 4))] if depth else []
        return html_text.Slot(r.choice("abc"), 1, r.randint(0, 3), 1, below)

    def size(x):
        return 1 + sum(map(size, x.below))

    for _ in range(200):
        a, b = tree(3), tree(3)
        assert html_text.matching(a, b) == naive_matching(a, b)
        b.key = a.key
        both = html_text.fold(a, b)
        assert both.pages == 2 and both.chars == 2
        assert size(both) >= max(size(a), size(b))


# -- 6: LM scores -----------------------------------------------------------------

def all_segmentations(model, counts, word):
    size = model.get_piece_size()
    total = sum(counts.values()) + size
    score = {}
    for i in range(size):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            score[model.id_to_piece(i)] = (counts.get(i, 0) + 1) / total
    byte = {int(model.id_to_piece(i)[3:-1], 16): (counts.get(i, 0) + 1) / total
            for i in range(size) if model.is_byte(i)}
    text = lm_score.START + word

    def p(at):
        if at == len(text):
            return 1.0
        ways = [(score[text[at:j]], j) for j in range(at + 1, len(text) + 1) if text[at:j] in score]
        if text[at] not in score:
            ways.append((math.prod(byte[b] for b in text[at].encode()), at + 1))
        return sum(w * p(j) for w, j in ways)

    return math.log10(p(0))


def test_lattice_sums_all_segmentations():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = lm_score._pieces(path)
    r = random.Random(1)
    counts = {i: r.randint(1, 1000) for i in range(300, 32000, 7)}
    lattice = lm_score.Lattice(path, counts)
    for word in ("a", "hello", "straße", "日x本", "ก\U0001f600", "...!!", "the"):
        assert math.isclose(lattice.log10(word), all_segmentations(model, counts, word), rel_tol=1e-9)
    assert lattice.log10("x" * 5000) < -1000  # no underflow


def lm_rows():
    r = random.Random(4)
    rows = [(i, " ".join(r.choices(["The", "the", "cat", "Zug", "é", "x1"], k=r.randint(0, 30)))) for i in range(60)]
    return [*rows, (1000, None), (1001, ""), (1002, "y " * 50_000), (1003, "\n"), (2000, "again"), (2000, "again")]


def test_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_CHARS", 5000)
    rows = lm_rows()
    got = collections.defaultdict(list)
    for x in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[x.doc_id].append(x)
    tokens = {}
    train = collections.Counter()
    for i, t in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        tokens[i] = [*WORDS.findall(lowered), None]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(tokens[i])
    n, v = sum(train.values()), len(train)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = lm_score._pieces(path)
    pieces = collections.Counter()
    for w, c in train.items():
        for p in model.encode(w) if w else [model.eos_id()]:
            pieces[p] += c
    lattice = lm_score.Lattice(path, pieces)
    score = {w: lattice.log10(w) for w in {w for t in tokens.values() for w in t if w}}
    score[None] = lattice.end / math.log(10)
    assert {i: len(x) for i, x in got.items()} == collections.Counter(i for i, _ in rows)
    for i, found in got.items():
        for x in found:
            assert (x.held_out, x.n_tokens, x.train_tokens) == (
                zlib.crc32(str(i).encode()) % 7 == 2, len(tokens[i]), n)
            assert x.n_known == sum(train[w] > 0 for w in tokens[i])
            assert math.isclose(x.base_score, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens[i]))
            assert math.isclose(x.score, sum(score[w] for w in tokens[i]))


def test_scores_of_nothing(spark):
    assert lm_score.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# -- 7: packing -------------------------------------------------------------------

def test_packing_round_trip(spark):
    r = random.Random(6)
    rows = [(i, " ".join(r.choices(["word", "Haus.", "x\ny", "  a", "é", "it's"], k=r.choice([0, 3, 200, 900, 3000]))))
            for i in range(120)] + [(500, None), (501, ""), (502, " tail "), (None, "none")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for x in got:
        docs[x.doc_id].append(x)
        sequences[x.sequence_id].append(x)
        assert x.length > 0 and x.doc_tokens == len(ids[x.doc_id])
        assert x.ids_crc32 == zlib.crc32(ids[x.doc_id][x.start:x.start + x.length].tobytes())
    assert set(docs) == set(ids)
    for i, pieces in docs.items():
        pieces.sort(key=lambda x: x.start)
        assert [x.start for x in pieces] == [0, *np.cumsum([x.length for x in pieces])[:-1]]
        assert sum(x.length for x in pieces) == len(ids[i])
    steps = collections.Counter()
    for pieces in sequences.values():
        pieces.sort(key=lambda x: x.offset)
        assert [x.offset for x in pieces] == [0, *np.cumsum([x.length for x in pieces])[:-1]]
        size = sum(x.length for x in pieces)
        assert size == pieces[0].tier and size <= 2048 and size & (size - 1) == 0  # no padding
        assert len({x.step_group for x in pieces}) == 1
        steps[pieces[0].step_group] += size
    assert max(steps.values()) <= packing.STEP_IDS
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rests_fill_longer_windows_before_windows_of_their_own():
    packer = packing.Packer(0)
    for i, n in enumerate((1500, 500, 48, 700, 300, 24)):
        packer.add(i, np.arange(n, dtype="<u4"))
    packer.finish()
    first = [r for r in packer.rows if r[5] == 0]
    assert [(r[0], r[2]) for r in first] == [(0, 1500), (1, 500), (2, 48)] and first[0][7] == 2048
    assert [r[0] for r in packer.rows if r[5] == 1] == [3, 4, 5] and packer.rows[-1][7] == 1024


def test_encoder_equals_the_library_on_odd_texts():
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a  b", " a", "a ", "a \n b", "x\n \ny", "it's 's  't", "a\tb c", "  x", "ab\0 c", "é ü  ", "", " ", "a\x1c b",
           "1 2, 3!! <|endoftext|> a", "\n\n a\n\n b", "日本語 ß é b á กิ d", "ab. cd, ef\ngh", "　x \xa0 y"]
    want = [np.array(x.ids, "<u4").tobytes() for x in encoder.tokenizer.encode_batch(odd, add_special_tokens=False)]
    assert encoder(odd) == want and [encoder([x])[0] for x in odd] == want


def test_encoder_remembers_parts_and_puts_texts_together():
    r = random.Random(11)
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["".join(r.choices("ab Zé,.!\n0'-²Ѫא日", k=r.randrange(40))) for _ in range(800)]
    want = [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.lists(texts).to_pylist() == want and encoder.lists([]).to_pylist() == []
    encoder.lists.known.clear()
    encoder.lists([" ".join(w + m for w in ("one", "two", "three") for m in " ,.!?;:".strip())])
    assert {"one", "two", "three"} <= set(encoder.lists.known) and len(encoder.lists.known) <= 3 + 1 + 6
    assert encoder.lists(["two. three?\none: two"]).to_pylist() == [
        encoder.tokenizer.encode("two. three?\none: two", add_special_tokens=False).ids]


# -- 10: quality rules ---------------------------------------------------------------

def naive_counts(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), len(lines))


def test_counts_against_brute_force():
    r = random.Random(8)
    texts = [None, "", " \n\t", "a", "x y z x y z x y z x y z", "\x1c a\x0b|é|\n\na\na\n a", "日本 " * 30]
    texts += ["".join(r.choices(["a", "bé", " ", "\n", "|", "\x0c", "<"], k=r.randint(0, 120))) for _ in range(200)]
    for t in texts:
        assert quality_rules.text_counts(t)[:6] == naive_counts(t), t


def quality_docs(spark):
    r = random.Random(9)
    words = [f"w{i}x" for i in range(3000)]
    clean = [(i, " ".join(r.sample(words, 80)), r.choice(["en", "de"]), "s%d" % (i % 3)) for i in range(600)]
    loud = [(1000 + i, " ".join(w + "%%%" for w in r.sample(words, 80)), "en", "s1") for i in range(20)]
    odd = [(2000, None, "en", "s1"), (2001, "", None, None), (2002, "too few words", "en", "s1"), (2003, clean[0][1], None, None),
           (2004, " ".join(["again and again it says"] * 10), "de", "s2"), (2004, clean[1][1], "de", "s2"),
           (2004, clean[1][1], "de", "s2"), (2005, " ".join(r.sample(words, 2900) * 20), "en", "s0")]
    return clean, loud, odd, spark.createDataFrame(clean + loud + odd, DOCS)


def test_thresholds_adapt_to_the_group_and_spare_clean_documents(spark):
    clean, loud, odd, docs = quality_docs(spark)
    got = collections.defaultdict(list)
    for x in quality_rules.score(docs).collect():
        got[x.doc_id].append(x)
    assert all(x.kept for i, *_ in clean for x in got[i])
    assert not any(x.kept or x.base_failed for i, *_ in loud for x in got[i])
    for i in (2000, 2001, 2002, 2005):
        assert [(x.base_failed, x.kept) for x in got[i]] == [(True, False)]
    assert got[2003][0].kept and sorted(x.kept for x in got[2004]) == [False, True, True]
    # In a source where all texts are like that, they are no outliers.
    all_loud = spark.createDataFrame([(i, t, g, "loud") for i, t, g, _ in loud * 10], DOCS).union(
        spark.createDataFrame(clean, DOCS))
    assert quality_rules.score(all_loud).filter("doc_id >= 1000 AND kept").count() == 200


def test_quality_stage_keeps_columns_and_rows(spark):
    _, _, _, docs = quality_docs(spark)
    docs = docs.withColumn("counts", F.lit(1)).withColumn("Kept", F.lit("x")).withColumn("cuts", F.lit(2))
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == quality_rules.score(docs).filter("kept").count()
    assert quality_rules.keep_good(docs.limit(0)).collect() == [] == quality_rules.score(docs.limit(0)).collect()


def test_most_groups_have_cutoffs_of_their_own(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    counted = docs.select("lang", "source", quality_rules.counts_udf("text").alias("counts"))
    sketch = quality_rules.sketches(counted).cache()
    cuts = quality_rules.cutoffs(sketch).collect()
    assert len(cuts) == 80
    every = quality_rules.quantiles(sketch, "lang", "source").collect()
    for rate in ("upper", "word_length"):
        apart = [r for r in every if r.rate == rate and r.high > r.low]
        assert len(apart) > 60
        assert len({c.cuts[rate].high for c in cuts}) > 2


def test_sketches_merge_and_are_near_the_quantiles(spark):
    r = np.random.default_rng(3)
    values = r.lognormal(9, 2, 4000).astype(int)
    cells = spark.createDataFrame([("en", "s", "symbols", int(v)) for v in values],
                                  "lang string, source string, rate string, v long")
    sketch = cells.withColumn("cell", quality_rules.cell(F.col("v"))).groupBy("lang", "source", "rate", "cell").agg(
        F.count(F.lit(1)).alias("n"))
    row = quality_rules.quantiles(sketch.union(sketch)).first()  # merging doubles counts only
    assert row.docs == 8000
    for q, got in ((0.25, row.low), (0.75, row.high)):
        exact = np.quantile(values, q, method="inverted_cdf")
        assert exact * (1 - 1 / 16) <= got <= exact


# -- 2: mixing ---------------------------------------------------------------------

def test_raking_meets_all_margins(spark):
    r = random.Random(10)
    cells = [(f"s{i}", g, t, r.randint(1, 5000)) for i in range(4) for g in ("en", None) for t in range(3)]
    frame = spark.createDataFrame(cells, "source string, lang string, topic int, tokens long")
    targets = {"source": [("s0", 4.0), ("s1", 1.0), ("s2", 1.0), ("s3", 2.0), ("absent", 9.0)],
               "lang": [("en", 0.7), (None, 0.3)], "topic": [(0, 0.2), (1, 0.3), (2, 0.5)]}
    kinds = {"source": "string", "lang": "string", "topic": "int"}
    goals = {d: spark.createDataFrame(t, f"value {kinds[d]}, share double") for d, t in targets.items()}
    got = {(x.source, x.lang, x.topic): x.weight * x.tokens for x in mixing.rake(frame, goals).collect()}
    # the same in numpy
    table = np.array([c[3] for c in cells], float).reshape(4, 2, 3)
    want = table.copy()
    shares = [np.array([4, 1, 1, 2]) / 8, np.array([.7, .3]), np.array([.2, .3, .5])]
    for _ in range(200):
        for axis, s in enumerate(shares):
            other = tuple(a for a in range(3) if a != axis)
            shape = [-1 if a == axis else 1 for a in range(3)]
            want *= (s * table.sum() / want.sum(axis=other)).reshape(shape)
    for (s, g, t, _), w in zip(cells, want.ravel(), strict=True):
        assert abs(got[s, g, t] - w) < 2e-3 * table.sum()


def test_one_odd_document_hardly_moves_the_sample(spark):
    r = random.Random(12)
    rows = [(i, " ".join(r.choices([f"{g}{k}" for k in range(200)], k=50)), g, f"s{i % 4}")
            for i, g in enumerate(r.choices(["en", "de"], [3, 1], k=2000))]
    share = []
    for more in ([], [(5000, "word", "xx", "odd")]):
        scored = mixing.score(spark.createDataFrame(rows + more, DOCS)).cache()
        total, kept, odd = scored.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("probability")),
                                      F.max(F.when(F.col("doc_id") == 5000, F.col("probability")))).first()
        share.append(kept / total)
        assert odd in (None, 1.0)
    assert abs(share[0] - share[1]) < 0.01


def test_the_sample_has_the_target_margins(spark):
    sizes = {("a", "en"): 300, ("a", "de"): 40, ("b", "en"): 60, ("b", "de"): 5}
    body = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"{body} {s}", g, s) for i, (s, g) in enumerate(k for k, n in sizes.items() for _ in range(n))]
    scored = mixing.score(spark.createDataFrame(rows, DOCS)).collect()
    total, sampled = sum(x.tokens for x in scored), sum(x.tokens * x.probability for x in scored)
    assert all(0 < x.probability <= 1 for x in scored) and sampled <= mixing.KEEP * total + 1e-6
    for d in mixing.DIMENSIONS:
        have, got = collections.Counter(), collections.Counter()
        for x in scored:
            have[x[d]] += x.tokens
            got[x[d]] += x.tokens * x.probability
        whole = sum(n ** mixing.TEMPER for n in have.values())
        for value, n in have.items():
            assert abs(got[value] / sampled - n ** mixing.TEMPER / whole) < 1e-3


def test_a_column_of_labels_is_the_topic(spark):
    labels = {"law": 300, "art": 80, None: 20}
    rows = [(i, f"w{i} and some words", "en", "s", t) for i, t in enumerate(t for t, n in labels.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, DOCS + ", `my topic` string")
    goals = spark.createDataFrame([("law", 0.5), ("art", 0.4), (None, 0.1)], "value string, share double")
    targets = {"topic": goals, **{d: spark.createDataFrame([(v, 1.0)], "value string, share double")
                                  for d, v in (("source", "s"), ("lang", "en"))}}
    scored = mixing.score(docs, targets, topic="my topic").collect()
    sampled = sum(x.tokens * x.probability for x in scored)
    for label, share in (("law", 0.5), ("art", 0.4), (None, 0.1)):
        got = [x.tokens * x.probability for x in scored if x.topic == label]
        assert len(got) == labels[label] and abs(sum(got) / sampled - share) < 1e-3
    kept = mixing.sample(docs, targets, topic="my topic")
    assert kept.columns == docs.columns and kept.count() == sum(x.kept for x in scored)


def test_sampling_is_repeatable_and_near_its_probabilities(spark):
    _, _, _, docs = quality_docs(spark)
    docs = docs.withColumn("cell", F.lit("x")).withColumn("Features", F.lit(0)).withColumn("topic", F.lit(9))
    once, again = (sorted(map(str, mixing.sample(d, keep=0.5).collect())) for d in (docs, docs.repartition(7)))
    assert once == again and mixing.sample(docs, keep=0.5).columns == docs.columns
    scored = mixing.score(docs, keep=0.5).cache()
    assert scored.count() == docs.count() and scored.filter("kept").count() == len(once)
    expected = scored.filter("doc_id < 1000").agg(F.sum("probability")).first()[0]
    assert abs(scored.filter("doc_id < 1000 AND kept").count() - expected) < 75
    assert mixing.sample(docs.limit(0)).collect() == [] == mixing.score(docs.limit(0)).collect()
    blank = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (None, "", "en", "s")], DOCS)
    assert mixing.sample(blank).count() == 3  # nothing to weigh: all stay


def test_topics_read_the_whole_text():
    assert mixing.topic_of("") == (0, 0)
    base = "a b c d e f g h"
    assert mixing.topic_of(base) == mixing.topic_of(base + " a" * 100)[:1] + (8,)
    assert mixing.topic_of(base + " " + " ".join(f"z{i}" for i in range(50)))[1] == 58


# -- 3: licences ---------------------------------------------------------------------

def test_whole_licences_and_notices_of_any_version_are_found(spark):
    whole = dict(licenses.texts())
    rows = [(0, whole["GPL-2.0"]), (1, whole["MPL-2.0"].replace("\n", " \r\n")), (2, licenses.BSD3), (3, whole["LGPL-3.0"].upper()),
            (4, "x\nLicensed under the GNU General Public License, version 2\nThis file is released under CC BY-SA 3.0."),
            (5, "This software is distributed under version 2.0 of the Mozilla Public License."), (6, "Licensed under the Apache License"),
            (7, whole["Apache-2.0"]), (8, whole["GPL-2.0"] + " but")]
    got = {x.doc_id: (x.license, x.notices) for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i][0] for i in (0, 1, 2, 3, 5, 7)] == ["GPL-2.0", "MPL-2.0", "BSD-3-Clause", "LGPL-3.0", "MPL-2.0", "Apache-2.0"]
    assert got[4] == (None, "CC-BY-SA-3.0,GPL-2.0") and got[5][1] == "MPL-2.0" and got[6] == (None, None) and got[8][0] is None


def test_bodies_without_title_and_later_versions_are_found(spark):
    body = licenses.MIT.split("\n", 1)[1]
    rows = [(0, body), (1, "The MIT License (MIT)\n" + body), (2, licenses.BSD3.split("\n", 1)[1]), (3, "Available under the MIT License."),
            (4, "GPL, version 2 or later"), (5, "x\nSPDX-License-Identifier: GPL-2.0-or-later"), (6, "# SPDX-License-Identifier: LGPL-3.0-only"),
            (7, "This program is distributed under the GNU General Public License, version 3 or (at your option) any later version."),
            (8, "Available under the MIT License if you ask.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("x")).withColumn("License", F.lit(1))
    got = {x.doc_id: x.license or x.notices for x in licenses.scan(docs).collect()}
    assert got == {0: "MIT", 1: "MIT", 2: "BSD-3-Clause", 3: "MIT", 4: "GPL-2.0-or-later", 5: "GPL-2.0-or-later", 6: "LGPL-3.0-only",
                   7: "GPL-3.0-or-later", 8: None}


def test_licences_in_other_clothes_are_found(spark):
    mit = licenses.MIT
    same = [mit, mit.upper(), mit.replace("\n\n", "\r\n"), mit.replace("(c) <year> <copyright holders>", "2024 Someone"),
            mit.replace("Copyright (c) <year> <copyright holders>", " * (C) 1999, X\n# © 2001 Y"),
            mit.replace("License", "Licence").replace('"', "''").replace("sublicense", "sublicence")]
    rows = [(i, t) for i, t in enumerate(same)]
    rows += [(10, mit + " not"), (11, None), (12, ""), (13, "..."), (14, licenses.ISC), (15, licenses.ZERO_BSD), (16, licenses.BSD2),
             (17, "Text.\nreleased under the MIT licence\nmore\nLicensed under the Apache License, version 2.0"),
             (18, "x " * 100_000), (18, "Released under the MIT License."), (None, "Released under the MIT License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.license or "", x.notices or "") for x in licenses.scan(docs).collect())
    want = [(-1, "MIT", "MIT"), *[(i, "MIT", "") for i in range(6)], (10, "", ""), (11, "", ""), (12, "", ""), (13, "", ""), (14, "ISC", ""),
            (15, "0BSD", ""), (16, "BSD-2-Clause", ""), (17, "", "Apache-2.0,MIT"), (18, "", "MIT"), (18, "MIT", "MIT")]
    assert got == want
    assert licenses.scan(docs.limit(0)).collect() == []
