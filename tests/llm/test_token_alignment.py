import functools
import hashlib
import itertools
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import advisorium.llm.token_alignment as m

ONE, TWO = Tokenizer.from_file(m.TOKENIZER_A), sentencepiece.SentencePieceProcessor(model_file=m.TOKENIZER_B)
ONE.encode_special_tokens = True
TEXTS = [
    "The quick brown fox.", "héllo 好吗 🙂 a 𝔘𓀀", "İstanbul  x", "a <|endoftext|> <0x41> </s> <s>", "\u0000x\r\n\t ", "\n" * 700, " lead", "▁x", "tail ", "  ", "好" * 300, "aa" * 500, "𓀀𓀁 𓀂", "É̀e‍👩‍👩‍👧", "x", "",
    None, "The quick brown fox.", "﻿x y　z", "İ" * 40, "0123456789" * 30, "ñandú " * 400,
]


@functools.cache
def bytes_of_a(i):
    keys = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(k): k for k in keys}
    n = 0
    for b in range(256):
        if b not in keys:
            table[chr(256 + n)] = b
            n += 1
    return bytes(table[c] for c in ONE.id_to_token(i))


@functools.cache
def bytes_of_b(i):
    piece = TWO.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if TWO.is_byte(i) else piece.replace("▁", " ").encode()


def groups(text):
    """Groups of (ids of A, ids of B) by decoded bytes alone."""
    if not text:
        return []
    a = [(i, bytes_of_a(i)) for i in ONE.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes_of_b(i)) for i in TWO.encode(text)]
    raw = (" " + text).encode()
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return []
    ends_a, ends_b = ([*itertools.accumulate(len(x) for _, x in side)] for side in (a, b))
    out, low = [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for (i, _), e in zip(a, ends_a) if low < e <= cut], [i for (i, _), e in zip(b, ends_b) if low < e <= cut]))
        low = cut
    return out


def shown(found):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


def brute(rows):
    links = [Counter((a, b) for x, y in groups(t) for a in x for b in y) for _, t in rows]
    held = Counter(p for x in links for p in x)
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (i, t), own in zip(rows, links):
        g = groups(t)
        best = sum(k for p, k in own.items() if held[p] == most[p[0]])
        sha = hashlib.sha256(shown(g).encode()).hexdigest() if g else ""
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), best, sum(k * held[p] for p, k in own.items()), sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("head,wide,chunk", [(1 << 19, 4096, 200_000), (20, 1, 40), (300, 0, 1)])
def test_counts_equal_brute_force(spark, monkeypatch, head, wide, chunk):
    monkeypatch.setattr(m, "WIDE", wide)
    monkeypatch.setattr(m, "CHUNK", chunk)
    texts = TEXTS[:-1] if chunk == 1 else TEXTS
    rows = [*enumerate(texts), (3, TEXTS[3]), (None, "The quick")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, pairs string").repartition(3)
    got = m.alignment_counts(docs, head=head)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_groups_equal_decoded_bytes(text):
    assert m.groups_text(m.aligner(m.TOKENIZER_A, m.TOKENIZER_B).align([text])[0]) == shown(groups(text))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé好🙂𓀀 \n▁<0x>é̀ß", max_size=30))
def test_groups_of_multibyte_texts(text):
    assert m.groups_text(m.aligner(m.TOKENIZER_A, m.TOKENIZER_B).align([text])[0]) == shown(groups(text))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["the", "The", "don't", "it's", "'s", "ñandú", "日本", "x1", "42", "3.14", "--", "(a)", "_", "😀", "\u0301e", "\u200b", "<0x41>", "▁", "\n", "\t", "\u00a0", "\u180e", "\ufeff", "\x1c", "", "."]), max_size=12), st.sampled_from([" ", "  ", " \n", ""]))
def test_segments_equal_whole_texts(words, gap):
    """Both tokenizers cut before a single space, so segments joined are the text encoded whole."""
    own = m.aligner(m.TOKENIZER_A, m.TOKENIZER_B)
    assert own.splits
    for text in (" ".join(words), gap.join(words), " ".join(words) + gap):
        assert m.groups_text(own.align([text])[0]) == shown(groups(text))


def test_token_groups_give_the_bytes_back(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")
    for r in m.token_groups(docs).collect():
        text = TEXTS[r.doc_id]
        raw = (" " + text).encode() if r.ids_a else b""
        assert b"".join(map(bytes_of_a, r.ids_a)) == b"".join(map(bytes_of_b, r.ids_b)) == raw
        assert r.cuts_a[-1:] == [len(r.ids_a)] * bool(raw) and r.cuts_b[-1:] == [len(r.ids_b)] * bool(raw)


@pytest.mark.parametrize("most", [0, 1, 5, 64, 300, 10_000])
def test_head_holds_the_most_frequent_pairs_and_no_more(spark, most):
    counts = [1] * 500 + [2] * 200 + [8, 8, 8, 9, 100, 101, 127, 128, 129, 4000]
    table = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "pair long, n long")
    least = m._head_from(table, most)
    assert sum(n >= least for n in counts) <= most


def test_empty_table(spark):
    assert m.alignment_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_kept_pairs_take_eight_bytes_each():
    """The segments of many texts are cut with arrays; what a worker keeps of one holds no number objects."""
    texts = ["The quick brown fox, and the fox.", "ñandú 好吗 x", "ab" * 300]
    for text, found in zip(texts, m.aligner(m.TOKENIZER_A, m.TOKENIZER_B).align(texts)):
        pairs = Counter(a << m.B_BITS | b for one, two in groups(text) for a in one for b in two)
        assert m.groups_text(found) == shown(groups(text)) and {type(x.pairs) for x in found} == {bytes}
        (keys, times), = m.links_of([found])
        assert dict(zip(keys.tolist(), times.tolist())) == pairs and (sum(x.n_a for x in found), sum(x.n_b for x in found)) == tuple(sum(map(len, side)) for side in zip(*groups(text)))
