"""Extraction, token ids, records, WARC, token counts and packing against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spark_recs.llm import html, packing, records, unigram, warc
from spark_recs.llm.crc32c import Crc32c, _byte_table
from spark_recs.llm.tokens import ChunkEncoder, vocabulary_path
from spark_recs.session import scratch_path

from llm.helpers import docs_of  # noqa: F401

ODD = ["", " ", "\n", "a  b", " a b", "a\n\n b", "a \n b", "don't  stop 's\tx", "ŒUVRE  x  y", "Á b é", "<|endoftext|> a",
       "x" * 200 + " y", "a b ", "ΣΑΣ ΣΣ x", "a\r\n b", "12 345,6  7", "naïve café's don't WE'LL", "日本 語 テキスト", None]
VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module")
def encoders():
    out = {}
    for v in VOCABULARIES:
        tok = Tokenizer.from_file(vocabulary_path(v))
        tok.encode_special_tokens = True
        out[v] = tok, ChunkEncoder(vocabulary_path(v), cache_words=8)
    return out


@pytest.mark.parametrize("v", VOCABULARIES)
def test_ids_equal_the_whole_tokenizer(encoders, v):
    tok, enc = encoders[v]

    @settings(max_examples=150, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("abé's ,.\n\t 1ßÀ日 !'tre  ")), max_size=40))
    def check(text):
        assert np.frombuffer(enc.one(text) if text else b"", "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids

    check()
    for t, ids in zip(ODD, enc.batch(ODD)):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y\u3000z", "The <|endoftext|><|endoftext|>  end\n<|startoftext|>", "<|ENDOFTEXT|> <|endof text|>"]


@pytest.mark.parametrize("v", VOCABULARIES)
def test_added_tokens_in_a_text_as_the_library_has_them(docs_of, v):
    tok, enc = Tokenizer.from_file(vocabulary_path(v)), ChunkEncoder(vocabulary_path(v), special=True)
    for t, ids in zip([*ODD, *SPECIAL], enc.batch([*ODD, *SPECIAL])):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_queries_give_added_tokens_their_ids(spark, docs_of):
    rows, crc = list(enumerate(SPECIAL)), lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    path, start = vocabulary_path(records.VOCABULARY), 0
    got = sorted(records.record_digests(spark, docs_of(rows), path, records.END_ID).collect(), key=lambda r: r["doc_id"])
    for r, (i, t) in zip(got, rows, strict=True):
        ids = Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids + [records.END_ID]
        assert tuple(r) == (i, start, len(ids), crc(ids))
        start += len(ids)
    path = vocabulary_path(packing.VOCABULARY)
    for r in packing.pack_documents(docs_of(rows), path).collect():
        ids = Tokenizer.from_file(path).encode(SPECIAL[r["doc_id"]], add_special_tokens=False).ids + [packing.END_ID]
        assert (r["length"], r["ids_crc32"]) == (len(ids), crc(ids))


def test_crc32c():
    table = _byte_table()

    def plain(data):
        r = 0xFFFFFFFF
        for x in data:
            r = int(table[(r ^ x) & 255]) ^ (r >> 8)
        return r ^ 0xFFFFFFFF
    assert plain(b"123456789") == 0xE3069283
    rng = np.random.default_rng(0)
    n = np.array([0, 1, 63, 64, 65, 1023, 1025, 17000, 0, 5])
    data = rng.integers(0, 256, n.sum()).astype(np.uint8)
    at = np.cumsum(n) - n
    assert Crc32c().many(data, n).tolist() == [plain(data[a:a + k].tobytes()) for a, k in zip(at, n)]


def test_records_round_trip(spark, docs_of):
    rows = [(7, "hello there"), (3, None), (None, "no id"), (3, "again"), *[(100 + i, t) for i, t in enumerate(ODD)]]
    path, tok = vocabulary_path(records.VOCABULARY), Tokenizer.from_file(vocabulary_path(records.VOCABULARY))
    tok.encode_special_tokens = True
    ids = lambda t: tok.encode(t or "", add_special_tokens=False).ids + [2]
    docs = docs_of(rows).withColumn("start", F.lit("clash")).repartition(5)
    manifest = records.write_records(docs, path, 2)
    got = sorted(records.read_digests(manifest).collect(), key=lambda r: r["start"])
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (key, text) in zip(got, want, strict=True):
        x = ids(text)
        assert tuple(r) == (key, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        start += len(x)
    mixed = records.read_shuffled(manifest, 5).collect()
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in mixed) == sorted((k or -1, ids(t)) for k, t in rows)
    assert records.record_digests(spark, docs_of([]), path, 2).count() == 0


def test_damaged_record_is_found(spark, docs_of):
    manifest = records.write_records(docs_of([(1, "some words here")]), vocabulary_path(records.VOCABULARY), 2)
    row = manifest.first()
    fs, path = records.open_fs(row["path"])
    data = bytearray(fs.open_input_file(path).read())
    data[-6] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        records.unframe(bytes(data), records.read_index(row["index_path"])[:, 1])


def test_sum_of_squares_packs_every_piece_once():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 2049, 3000)
    seq, off = packing.sum_of_squares(sizes, 2048)
    for b in np.unique(seq):
        o = np.argsort(off[seq == b])
        s = sizes[seq == b][o]
        assert (off[seq == b][o] == np.cumsum(s) - s).all() and s.sum() <= 2048
    assert seq.max() + 1 <= 1.02 * sizes.sum() / 2048 + 1


def test_sum_of_squares_choice():
    """Every choice has the smallest sum of squares, tightest of equals (brute force)."""
    rng = random.Random(1)
    sizes = np.array([rng.randrange(1, 13) for _ in range(60)])
    seq, off = packing.sum_of_squares(sizes, 12)
    gaps: dict[int, int] = {}

    def total(g):
        return sum(list(g.values()).count(x) ** 2 for x in set(g.values()) - {0})
    for i in np.lexsort((np.arange(len(sizes)), -sizes)):
        s = int(sizes[i])
        options = [(total({**gaps, b: g - s}), g, b) for b, g in gaps.items() if g >= s]
        if not options:  # a new sequence only where no open one has room
            options.append((total({**gaps, "new": 12 - s}), 12, "new"))
        best = min(options[:], key=lambda x: (x[0], x[1]))
        had = gaps.get(int(seq[i]), 12)
        assert (total({**gaps, int(seq[i]): had - s}), had) == best[:2]
        gaps[int(seq[i])] = had - s


def test_packing_contract(docs_of):
    rng = random.Random(2)
    rows = [(i, " ".join("alpha beta gamma, delta".split() * rng.randrange(0, 900))) for i in range(60)] + [(3, "twin"), (None, None)]
    tok = Tokenizer.from_file(vocabulary_path(packing.VOCABULARY))
    docs = docs_of(rows).withColumn("length", F.lit("clash"))
    got = packing.pack(packing.pieces(docs, vocabulary_path(packing.VOCABULARY), 0, 2048), 2048, block_pieces=16).collect()
    want = []
    for key, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        cut, at = len(ids) % 2048 or 2048, 0
        piece = 0
        while at < len(ids):
            part = ids[at: at + (cut if piece == 0 else 2048)]
            want.append((key, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            at, piece = at + len(part), piece + 1
    null_first = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r)[:5] for r in got], key=null_first) == sorted(want, key=null_first)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 2048
    assert packing.pack_documents(docs_of([]), vocabulary_path(packing.VOCABULARY)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">a</a></li></ul></nav><div id="cookie-notice">Cookies, ok?</div>
<div class="content"><h2>Head &amp; more</h2><div><p>One, two,   three.<br>Four <b>five</b></p><p>Six &lt;7&gt;</div>
<div><p>More, text, here, is, some, of, it.</p></div></div><aside>side</aside><form><p>mail?</p></form>
<div id="comments"><p>nice, post, really, good, yes, indeed</p></div><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE).split("\n") == ["Head & more", "One, two, three. Four five", "Six <7>", "More, text, here, is, some, of, it."]
    assert html.main_text(None) == html.main_text("") == html.main_text("<p> </p>") == ""
    assert html.main_text("just &quot;text&quot;") == 'just "text"'
    short = '<body><div class="ad">Buy, now, buy, now, it is a long advert.</div><article><h1>A. B.</h1><p><b>A. B.<br></article><footer>foot, of, page</footer>'
    assert html.main_text(short) == "A. B.\nA. B."
    assert html.main_text("<article><p>" + "long, " * 50_000 + "</p>").count("long") == 50_000
    assert html.main_text("<div>" * 5000 + "<p>deep, text</p>") == "deep, text"


BODY = "<h1>Head</h1><p>One, two, three, and a long first paragraph.</p><p>Four, five, six, the second paragraph.</p>"
BODY_TEXT = "Head\nOne, two, three, and a long first paragraph.\nFour, five, six, the second paragraph."


@pytest.mark.parametrize("page", [
    f"<body><div class='layout has-sidebar'><article>{BODY}</article></div></body>",
    f"<main id='content' class='with-sidebar'>{BODY}</main>",
    f"<article class='post has-comments'>{BODY}</article>",
    f"<article class='post comments-open widget'>{BODY}</article>",
    f"<div class='post-share-wrap'><article>{BODY}</article></div>",
    f"<div class='widget'><div class='social'><main>{BODY}</main></div></div>",
    f"<div class='layout hasSidebar noComments'><div>{BODY}</div></div>",
    f"<div class='content-widget'><div>{BODY}</div></div><p>Home</p>",
    f"<div class='elementor-widget'><div>{BODY}</div></div>",
    f"<div class='layout has-sidebar'><article>{BODY}<div class='post-share'><p>Tell all, tell more, of your friends.</p></div></article>"
    "<div id='comments'><article class='comment-body'><p>nice, post, really, good, yes, indeed.</p></article></div><div class='sidebar'><p>More, of, all, that.</p></div></div>"])
def test_named_wrappers_keep_their_article(page):
    assert html.main_text(page) == BODY_TEXT


def test_short_content_siblings_stay():
    long = "<div><p>" + "many, words, of, it, " * 40 + "end.</p></div>"
    page = f"<div id='x'>{long}<div><p>A short close.</p></div><div><a href='/a'>More. Read on.</a></div><div>Tags</div><div class='ad'><p>Buy this now.</p></div></div>"
    assert html.main_text(page).split("\n")[1:] == ["A short close."]


_P = "This is a paragraph of the article, with commas, and more than a few words in it, so that it counts as text."


@pytest.mark.parametrize("page, want", [
    (f"<article>{f'<p>{_P}</p>' * 4}</article><section>{'<p>Nice one, thanks.</p>' * 6}</section>", [_P] * 4),
    (f"<article>{f'<p>{_P}</p>' * 4}</article><div class='discussion'>{'<p>Nice one, thanks.</p>' * 6}</div>", [_P] * 4),
    (f"<article><p>Short, but the article.</p></article><section><h3>3 Responses</h3><ul>{f'<li>{_P * 3}</li>' * 2}</ul></section>", ["Short, but the article."]),
    (f"<div class='txt'><p>{_P}</p><p>{_P}</p><h3>Comments (2)</h3><ul>{f'<li>{_P}</li>' * 2}</ul></div>", [_P] * 2),
    (f"<main><article class='post'><p>{_P}</p></article><article class='comment'><p>{_P}, I think</p></article></main>", [_P]),
    (f"<main><article class='post'><p>{_P}</p></article><article class='related'><p>{_P}</p></article></main>", [_P]),
    (f"<main><article class='comment'><p>{_P}</p></article></main>", [_P]),
    (f"<h1>Title</h1><div class='byline'>By Anna Writer</div><div class='txt'><p>{_P}</p><p>{_P}</p></div>", ["Title", _P, _P]),
    (f"<article><p>{_P}</p><p>Let <math><mi>x</mi></math> be <label>one</label> <button>two</button>.</p></article>", [_P, "Let x be one two."]),
    (f"<article><h2>Discussion</h2><p>{_P}</p></article>", ["Discussion", _P]),
])
def test_articles_without_comments_and_with_their_own_text(page, want):
    assert html.main_text(f"<html><body>{page}</body></html>").split("\n") == want


def test_deep_nesting_takes_linear_time():
    import time
    t0 = time.process_time()
    text = html.main_text("<html><body>" + "".join(f"<div>line {i}, here</span>" for i in range(20_000)))
    assert text and time.process_time() - t0 < 4


def test_extraction_of_empty_and_repeated_rows(spark):
    schema = "page_id long, url string, html string"
    assert html.extract(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "u", f"<article><p>{_P}</p></article>")] * 3 + [(None, None, None)]
    got = html.extract(spark.createDataFrame(rows, schema)).collect()
    assert [r["text"] for r in got].count(_P) == 3 and [r["text"] for r in got].count("") == 1


def test_extraction_on_pages(spark):
    import html as h
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("text", F.lit("clash"))
    extra = spark.createDataFrame([(None, None, None, None), (5, "u", "", "x")], "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["url"]): r for r in html.extract(pages.unionByName(extra)).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        want = "\n".join(x for x in (" ".join(h.unescape(p).split()) for p in parts) if x)
        g = got[r["page_id"], r["url"]]
        assert (g["text"], g["n_chars"]) == (want, len(want))
    assert got[None, None]["text"] == got[5, "u"]["text"] == ""


def test_warc(spark):
    big, small = "é" * 700, "tiny"
    rows = [(1, "u1", big), (2, "u\n2", big), (9, None, big), (3, "u3", small), (4, "u4", small), (5, "u5", None), (None, "n", big),
            (6, "u6", ""), (7, "a", "x" * 1000), (7, "b", "x" * 1000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, sha1 string")
    root = warc.write_archive(pages)
    got = sorted((tuple(r) for r in warc.read_archive(spark, root).drop("url").collect()), key=str)
    ref = {big: 9, "x" * 1000: 7}
    want = []
    for key, _, body in rows:
        data = (body or "").encode()
        again = body in ref and key != ref[body]
        want.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", ref[body] if again else None))
    assert got == sorted(want, key=str)
    records = warc.read_records(spark, root)
    assert sorted((tuple(r) for r in records.drop("url").collect()), key=str) == got
    assert sorted(r["url"] for r in records.collect()) == sorted((u or "").replace("\n", " ") for _, u, _ in rows)
    assert spark.read.parquet(f"{root}/payloads").count() == 4
    files = warc.export_warc(spark, root, scratch_path(spark, "warc-out")).collect()
    blocks = [x for f in files for x in warc.parse_warc(open(re.sub("^file:/+", "/", f["path"]), "rb").read())]
    assert sorted(len(b) for h, b in blocks if h["WARC-Type"] == "response") == sorted(w[1] for w in want if w[3] == "response")
    assert all(b == b"" for h, b in blocks if h["WARC-Type"] == "revisit") and len(blocks) == len(rows)
    empty = warc.write_archive(pages.limit(0))
    assert warc.read_archive(spark, empty).count() == warc.read_records(spark, empty).count() == 0


def _plain_counts(model, word):
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        options = []
        for k in range(1, i + 1):
            piece = word[i - k: i]
            if piece in model.score:
                options.append((best[i - k][0] + model.score[piece], -(-best[i - k][1] + 1) if False else best[i - k][1] + 1))
        c = word[i - 1]
        if c not in model.score:
            n = len(c.encode())
            options.append((best[i - 1][0] + n * model.byte, best[i - 1][1] + n))
        best.append(max(options, key=lambda x: (x[0], -x[1])))
    return best[-1][1], -best[-1][0]


def test_token_counts(docs_of):
    texts = ["the thing thing thinking theory", None, "", "日本 naïve 🙂🙂 x" + "y" * 300, "the end " * 3]
    model = unigram.Unigram(vocabulary_path(unigram.MODEL))
    docs = docs_of([(i, t) for i, t in enumerate(texts)]).withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: r for r in unigram.token_counts(docs).collect()}
    for i, t in enumerate(texts):
        each = [_plain_counts(model, unigram.MARK + w) for w in (t or "").split()]
        assert (got[i]["n_words"], got[i]["n_tokens"]) == (len(each), sum(n for n, _ in each))
        assert math.isclose(got[i]["neg_log_score"], sum(s for _, s in each), abs_tol=1e-5)
    assert unigram.token_counts(docs_of([])).count() == 0
