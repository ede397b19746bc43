"""Operators that treat each text alone: pages, languages, tokens, pieces, statistics."""

import random

import numpy as np
import public_tokenizers
import pytest

from gearlog.llm import html_text, language, pieces, quality_rules, token_counts
from tests.llm import brute

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, _text string, size int"
ODD = [
    None, "", " ", "\n\n", "a", "  a  b ", "a\n b\n b", "é́ 日本語 ​ x", "▁x ▁▁y", "<s> </s> <|endoftext|>z",
    "\x00a", "tab\tx\x0b\x0c\r", "🙂🙂 12 !!", "x" * 5000, " " * 3000, "it's we're  I'll", "a b c a b c a b c d",
]


def odd_docs(spark):
    rows = [(i, t, "en", "clash", 1) for i, t in enumerate(ODD)]
    rows += [(3, "same id", None, None, None), (None, "no id", "en", None, None), (0, None, "en", None, 1)]
    return spark.createDataFrame(rows, DOCS)


# --- pages ---------------------------------------------------------------------


def page(body):
    return f"<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


LONG = "Some words that make up a paragraph of the article, long enough to be dense, and then some more of them."


@pytest.mark.parametrize(
    "body, text",
    [
        ("", ""),
        ("<nav><ul><li><a href='/a'>Home</a></li></ul></nav><article><h1>Head</h1><p>One&nbsp;two &lt;x&gt;</p><p>Hi.</p></article><footer>&copy; me</footer>", "Head\n\nOne two <x>\n\nHi."),
        ("<article><p><b>Bold<br><p>Next</article><div class='ad'>Buy</div>", "Bold\n\nNext"),
        ("<article>A<aside>side</aside><form>f<input></form><p>B</p><div class='comments'><p>reader</p></div></article>", "A\n\nB"),
        (f"<div><div><a href='x'>Menu one</a> <a>Menu two</a></div><p>{LONG}</p><p>short</p><p>{LONG}</p></div>", f"{LONG}\n\nshort\n\n{LONG}"),
        ("<article><p>a <!-- ad --> b</p><p>x<!-- open", "a b\n\nx"),
        ("<article><p title='a>b'>q</p><p>1 < 2 & 3</p></article>", "q\n\n1 < 2 & 3"),
        ("<main><header>site</header><p>kept</p><p hidden>no</p></main>", "kept"),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(page(body)) == text


@pytest.mark.parametrize(
    "body, text",
    [
        ('<div class="content no-sidebar"><p>A</p></div>', "A"),
        ('<div class="post comments-open" style="overflow:hidden" aria-hidden="false"><p>A</p></div>', "A"),
        ('<div data-x="hidden" title="a hidden thing"><a href="/hidden/x">A</a> b</div>', "A b"),
        ('<p>A</p><p class="share">no<p>B</p>', "A\n\nB"),
        ('<p>A</p><div><p class="share">no</div>B<p>C', "A\n\nB\n\nC"),
        ('<ul><li>A<li class="ad">no<li>B</ul>C', "A\n\nB\n\nC"),
        ('<ul><li>A<li class="ad">no<ul><li>no</ul></ul><p>C', "A\n\nC"),
        ('<table><tr class="ad"><td>no<tr><td>A</table>B', "A\n\nB"),
        ('A<div class="site-footer">no</div><div id="ad_slot">no</div><div style="color:red;display : none">no</div><div aria-hidden="true">no</div><p HIDDEN>no</p>B', "A\n\nB"),
    ],
)
def test_names_hide_only_what_they_name(body, text):
    assert html_text.main_text(page(f"<article class='post comments-open'>{body}</article>")) == text
    whole = f'<html><body class="has-sidebar" style="overflow:hidden"><main id="menu">{body}</main></body></html>'
    assert html_text.main_text(whole) == text


@pytest.mark.parametrize(
    "attrs",
    ["class='cookie-notice'", "class='reader-comments'", "class='x comment-thread'", "class='ad-container'", "class='related-posts'",
     "class='sidebar-left'", "class='adverts'", "class='advertising'", "id='copyright'", "class='article-comments'", "class='post_share'"],
)
def test_noise_words_in_class_names(attrs):
    body = f"<p>{LONG}</p><div {attrs}><p>{LONG} But not this.</p></div><p>{LONG}</p>"
    assert html_text.main_text(page(body)) == f"{LONG}\n\n{LONG}"
    assert html_text.main_text(page(f"<article>{body}</article>")) == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("attrs", ["class='sidebar-content'", "class='nav-open'", "class='article-body'", "id='related-work'", "class='has_ads'"])
def test_names_of_content(attrs):
    assert html_text.main_text(page(f"<div {attrs}><p>{LONG}</p></div>")) == LONG


def test_header_of_an_article():
    body = f"<header>site</header><article><header><h1>Title</h1><nav>no</nav></header><p>{LONG}</p></article>"
    assert html_text.main_text(page(body)) == f"Title\n\n{LONG}"


def plain_text(node):
    """Blocks of a tree of (tag, noisy, children or text), by recursion."""
    out, now = [], []

    def flush():
        t = " ".join("".join(now).split())
        if t:
            out.append(t)
        now.clear()

    def walk(n):
        tag, noisy, children = n
        if noisy:
            if tag in html_text.BLOCKS:
                flush()
            return
        block = tag in html_text.BLOCKS
        if block:
            flush()
        for c in children:
            now.append(c) if isinstance(c, str) else walk(c)
        if block:
            flush()

    walk(node)
    return "\n\n".join(out)


@pytest.mark.parametrize("seed", range(30))
def test_random_trees_equal_a_plain_stripper(seed):
    rng = random.Random(seed)
    noise = ["class='cookie-notice'", "class='ads'", "hidden", "style='display:none'", "id='comments'"]

    def tree(depth):
        tag = rng.choice(["div", "p", "section", "b", "i", "span", "h2", "ul", "blockquote"])
        noisy = rng.random() < 0.15
        n = rng.randrange(1, 4)
        inline = tag in ("p", "h2", "b", "i", "span")
        kids = [
            f" word{rng.randrange(99)}  x " if depth == 0 or inline or rng.random() < 0.4 else tree(depth - 1)
            for _ in range(n)
        ]
        return tag, noisy, kids

    def text(n):
        tag, noisy, kids = n
        inner = "".join(k if isinstance(k, str) else text(k) for k in kids)
        return f"<{tag} {rng.choice(noise) if noisy else 'class=box'}>{inner}</{tag}>"

    root = ("article", False, [tree(4) for _ in range(5)])
    inner = "".join(text(k) for k in root[2])
    assert html_text.main_text(f"<html><body><article>{inner}</article></body></html>") == plain_text(root)


MENU = "<ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li><li><a href='/c'>Three</a></li></ul>"


@pytest.mark.parametrize(
    "body, text",
    [
        (f"{MENU}<p>A short article.</p>", "A short article."),
        (MENU + "".join(f"<p>line {i} of verse</p>" for i in range(6)), "\n\n".join(f"line {i} of verse" for i in range(6))),
        ("<dl><dt>One</dt><dd>the first</dd><dt>Two</dt><dd>the second</dd></dl>", "One\n\nthe first\n\nTwo\n\nthe second"),
        (f"<p>{LONG}</p>{MENU}<p>The end.</p>{MENU}", f"{LONG}\n\nThe end."),
        (f"<p>{LONG}</p><p><a href='/x'>A link of its own</a></p><p>{LONG}</p>", f"{LONG}\n\nA link of its own\n\n{LONG}"),
        (f"<article>Teaser card</article><div><p>{LONG}</p><p>{LONG}</p></div>", f"Teaser card\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p>Hi.</p></article><div>Some words outside</div>", f"{LONG}\n\nHi."),
        (MENU, ""),
        (f"{MENU}<h1>Title</h1><p>Lead one.</p><p>By Ann.</p><p>{LONG}</p>", f"Title\n\nLead one.\n\nBy Ann.\n\n{LONG}"),
        (f"<p>Tagline</p>{MENU}<p><a href='/'>Up</a></p><h1>Title</h1><p><a href='/t'>Topic</a></p><p>{LONG}</p>", f"Title\n\nTopic\n\n{LONG}"),
    ],
)
def test_density_is_relative_to_the_page(body, text):
    assert html_text.main_text(page(body)) == text


def test_pages_with_nulls_and_extra_columns(spark):
    rows = [(1, "u", None, 5, "x"), (1, "u", None, 5, "x"), (None, None, "", 5, "x"), (2, "v", page("<article>é</article>"), 5, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(map(tuple, html_text.extract(df, ["page_id", "url"]).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "", 0), (2, "v", "é", 1)], key=str)
    assert html_text.extract(df.filter("false"), ["page_id", "url"]).count() == 0


def test_article_of_every_page(spark):
    """The given pages against their own article elements."""
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(rows, ["page_id"]).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [
            re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", x))).strip()
            for x in re.split(r"</?(?:p|h1)>", inner)
        ]
        assert got[r["page_id"]] == "\n\n".join(filter(None, parts))


# --- languages -----------------------------------------------------------------


def test_held_out_accuracy_and_rejects(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").collect()
    assert len(held) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert np.mean([r["ambiguous"] for r in held]) < 0.02
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_of_odd_texts(spark):
    model = language.fit(
        np.stack([language.features(t) for t in ("the of and is", "der die und ist", "the and of", "und das der")]),
        ["en", "de", "en", "de"],
    )
    got = language.predict(odd_docs(spark), model).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        assert r["lang_pred"] in ("en", "de", "und")
    by_text = {r["doc_id"]: r for r in got if r["doc_id"] not in (0, 3, None)}
    assert by_text[1]["lang_pred"] == "und" and by_text[1]["score"] == 0
    assert by_text[14]["lang_pred"] == "und"
    assert by_text[15]["lang_pred"] in ("en", "de")
    none = language.identify(odd_docs(spark).filter("lang IS NULL")).collect()
    assert len(none) == 1
    assert language.identify(odd_docs(spark).filter("false")).count() == 0
    only = language.identify(odd_docs(spark)).filter("lang_pred = 'en'").collect()
    assert only and all(r["score"] == 1.0 for r in only)


def test_codewords_tell_all_languages_apart():
    for n in (2, 3, 5, 9, 30):
        code = language.codewords(n)
        assert len({tuple(r) for r in code}) == n
        least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert least >= (2 if n > 2 else 1)


def test_decoding_corrects_a_wrong_bit():
    code = language.codewords(4)
    model = language.Codes(list("abcd"), code, np.eye(code.shape[1]), np.zeros(code.shape[1]), np.full(code.shape, 1 / code.shape[1]))
    margins = 4 * code.copy()
    margins[:, 0] *= -0.2
    best, score, gap = model.decode(margins)
    assert best.tolist() == [0, 1, 2, 3] and (gap > 0).all() and (score > 0.25).all()


# --- tokens --------------------------------------------------------------------


def test_spliced_chunks_equal_the_whole():
    tok = token_counts._tokenizer(BPE)
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "<|endoftext|>", "é", "日本", "'s", "'re", "12", "!!", "🙂", "\t", "<|end", "text|>", "x" * 40, " " * 30]
    for _ in range(400):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))
        got = token_counts.encode_ids(s, BPE, chunk=40, overlap=rng.choice([4, 10, 20]))
        assert got == tok.encode(s, add_special_tokens=False).ids, s


def test_token_counts_of_odd_texts(spark):
    tok = token_counts._tokenizer(BPE)
    docs = odd_docs(spark)
    want = sorted(
        (str(r["doc_id"]), len((r["text"] or "").encode()), len(tok.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in docs.collect()
    )
    for chunk in (32768, 64):
        got = token_counts.count_tokens(docs, BPE, chunk=chunk, overlap=16).collect()
        assert sorted((str(r[0]), r[1], r[2]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert token_counts.count_tokens(docs.filter("false"), BPE).count() == 0


# --- pieces --------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    from hashlib import sha256

    model = pieces.load(PIECES)
    docs = odd_docs(spark).unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), True
    )
    want = []
    for r in docs.collect():
        ids = model.whole.encode(r["text"] or "", add_bos=True, add_eos=True)
        raw = np.asarray(ids, "<u4").tobytes()
        want.append((str(r["doc_id"]), len(ids), sha256(raw).hexdigest(), sha256(model.whole.decode(ids).encode()).hexdigest()))
    got = pieces.encode_digest(docs, PIECES).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == sorted(want)
    assert pieces.encode_digest(docs.filter("false"), PIECES).count() == 0


def test_spans_split_the_source(spark):
    docs = odd_docs(spark)
    text = {str(r["doc_id"]) + str(r["lang"]): r["text"] or "" for r in docs.collect()}
    got = pieces.encode_documents(docs, PIECES)
    for r in got.collect():
        options = [t.encode() for k, t in text.items() if k.startswith(str(r["doc_id"]))]
        assert any(b"".join(o[a:b] for a, b in zip(r["begins"], r["ends"])) == o for o in options)


def test_words_of_a_batch_equal_texts_alone():
    model = pieces.load(PIECES)
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "日本", "🙂", "\t", "the", " of", "▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    want = model.whole.encode(texts, add_bos=True, add_eos=True)
    got = model.encode_batch(texts)
    assert [g[0].tolist() for g in got] == want
    for t, (ids, a, b) in zip(texts, got):
        x, y = model.spans(t, ids.tolist())
        assert x[1:-1].tolist() == a[1:-1].tolist() and y[1:-1].tolist() == b[1:-1].tolist()


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf", "identity"])
def test_longest_prefix_normaliser(rule):
    """Against the library's own normaliser of the same compiled map."""
    import sentencepiece as sp
    from sentencepiece import sentencepiece_model_pb2 as pb

    try:
        theirs = sp.SentencePieceNormalizer(rule_name=rule)
    except Exception:
        pytest.skip("this library has no normaliser of that name")
    proto = pb.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    model = object.__new__(pieces.Pieces)
    spec = proto.normalizer_spec
    model.charmap, model.suffix_marks = pieces.CharMap(spec.precompiled_charsmap), False
    model.prefix, model.trim, model.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
    for t in ["ＡＢＣ ①② ﬁ", "é é ｶﾞ", "日本　語", "Straße ẞ", "plain text", "🙂", ""]:
        mine, source = model.normalise(t.encode())
        assert mine.decode() == theirs.normalize(t)
        assert len(source) == len(mine) + 1 and (np.diff(source) >= 0).all()


# --- quality -------------------------------------------------------------------


def test_counts_equal_plain_python(spark):
    docs = odd_docs(spark).select("doc_id", "text").unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality_rules.judge(docs, []).collect()
    want = sorted((str(r["doc_id"]), *(brute.quality_counts(r["text"])[n] for n in names)) for r in docs.collect())
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert (r["base_failed"], r["kept"], r["rule"]) == (failed, not failed, 0)


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    poor = (x["a"] > 0.8) & (x["b"] <= 0.5) | (x["c"] > 0.95)
    rules = quality_rules.learn(x, poor)
    found = np.zeros(3000, bool)
    for r in rules:
        found |= quality_rules._covers(r, x, 3000)
    assert (found == poor).mean() > 0.97
    assert quality_rules.learn(x, np.zeros(3000, bool)) == []


def test_rules_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules.filter_quality(docs, labels).join(labels, "doc_id").filter("NOT base_failed").collect()
    good = [r for r in got if r["quality"] == 1]
    poor = [r for r in got if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) > 0.97
    assert np.mean([r["kept"] for r in poor]) < 0.4
    empty = quality_rules.filter_quality(docs.filter("false"), labels)
    assert empty.count() == 0
    assert quality_rules.filter_quality(docs.limit(5), labels.filter("false")).count() == 5
