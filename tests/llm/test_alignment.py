"""Alignment of two tokenizers against the libraries, token by token."""

import collections
import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from gearlog.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, pair long, times int, row long"
ODD = [
    None, "", " ", "  ", " a ", "a   b", "x　 y  z ", "▁x", "a▁b c", "a \n b\t c", "\x1c x", "𓀀𓀁 x", "日本語テキスト です",
    "<|endoftext|> <s> </s>", "it's we're  I'll", "\x00a", "é é", "\n\n", "a\r\n b", "x;\r\ny", "x" * 3000, " " * 500,
    "ok​ z", "a\u0085 b", "a  b   c", "end \n", "🙂🙂 12 !!",
]


@functools.lru_cache(maxsize=1)
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(text):
    """(ids of A, ids of B, groups, linked pairs), with loops over tokens and bytes."""
    tok, sp = libraries()
    if not text:
        return [], [], [], []
    raw, at = (" " + text).encode(), alignment._byte_of()
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    parts = [bytes(at[c] for c in tok.id_to_token(i)) for i in a], [
        bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    if any(b"".join(p) != raw for p in parts):
        return [], [], [], []
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    groups, links = [([], [])], []
    for byte in range(1, len(raw) + 1):
        for k, ids in enumerate((a, b)):
            if byte in ends[k]:
                groups[-1][k].append(ids[ends[k].index(byte)])
        if byte in ends[0] and byte in ends[1]:
            links.append((groups[-1][0][-1], groups[-1][1][-1]))
            groups.append(([], []))
    return a, b, groups[:-1], links


def digest(groups):
    return hashlib.sha256(";".join(alignment.show(groups)).encode()).hexdigest() if groups else ""


def random_texts(n):
    rng = random.Random(3)
    signs = list("ab  \n\t\r'sé日🙂.,;1  　𓀀<|>▁"[:-1])
    return ["".join(rng.choices(signs, k=rng.randrange(1, 30))) for _ in range(n)]


def test_units_give_what_whole_texts_give():
    both = alignment.Aligner(A, B)
    assert both.by_unit
    texts = ODD + random_texts(400)
    for text, (sizes, sha, pairs) in zip(texts, both.documents(texts)):
        a, b, groups, links = plain(text)
        assert sizes.tolist() == [len(a), len(b), len(groups), len(links)], text
        assert sha == digest(groups)
        assert sorted(pairs.tolist()) == sorted(x << 32 | y for x, y in links)


def test_rare_units_are_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "UNITS_KEPT", 5)
    both, fresh = alignment.Aligner(A, B), alignment.Aligner(A, B)
    for text in random_texts(60):
        (s, h, p), (s2, h2, p2) = both.documents([text])[0], fresh.documents([text])[0]
        assert (s.tolist(), h, p.tolist()) == (s2.tolist(), h2, p2.tolist())
        assert len(both.shown) <= 5 and len(both.slots) == len(both.shown)


def test_spans_give_way_to_bytes():
    # two tokens of one three-byte character, then a plain one
    assert alignment.byte_ends(np.array([[0, 3], [0, 3], [3, 4]]), np.array([1, 2, 1])).tolist() == [1, 3, 4]
    assert alignment.byte_ends(np.array([[0, 1], [1, 4], [1, 4]]), np.array([1, 1, 2])).tolist() == [1, 2, 4]


@pytest.mark.parametrize("hot", [1 << 16, 3])
def test_counts_over_all_texts(spark, hot):
    texts = ODD + random_texts(40) + ["same same same text"] * 20
    rows = [(i, t, 1, 1, 1) for i, t in enumerate(texts)] + [(3, "a second text of id 3", 1, 1, 1), (None, "no id", 1, 1, 1)]
    got = alignment.align_digest(spark.createDataFrame(rows, SCHEMA), A, B, hot_pairs=hot).collect()
    every = [plain(t) for _, t, *_ in rows]
    counts = collections.Counter(x for *_, links in every for x in links)
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = [
        (d, len(a), len(b), len(g), len(k), sum(counts[x] == most[x[1]] for x in k), sum(counts[x] for x in k), digest(g))
        for (d, *_), (a, b, g, k) in zip(rows, every)
    ]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_groups_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab 日本語 x", 0, 0, 0), (2, "▁", 0, 0, 0)], SCHEMA)
    got = {r["doc_id"]: [(g["a"], g["b"]) for g in r["groups"]] for r in alignment.align_documents(df, A, B).collect()}
    assert got == {1: [tuple(g) for g in plain("ab 日本語 x")[2]], 2: []}
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.align_digest(empty, A, B).collect() == []
