import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from advisorium.llm import piece_codec as pc
from advisorium.llm.packing import VOCABULARY, _encoder, combinations, make_plan, pack_documents, solve_counts

HF = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SP = sentencepiece.SentencePieceProcessor(model_file=pc.MODEL)
TEXTS = st.text(alphabet=st.one_of(st.sampled_from("ab éß日🎉  \n\t'.,1２▁"), st.characters(codec="utf-8", exclude_categories=["Cs"])), max_size=80)


CODEC = pc.segmentations_of(pc.MODEL)


def encode(text, owner=0, seed=0, dropout=0.0):
    return pc.encode_texts(CODEC, [text], [owner], seed, dropout)[0].tolist()


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_ids_equal_the_tokenizers_library(text):
    assert _encoder(VOCABULARY)(text) == HF.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(TEXTS.filter(lambda t: "▁" not in t and t))
def test_pieces_without_dropout_equal_the_library(text):
    assert encode(text) == SP.encode(text)


def agenda(text, owner, seed, dropout):
    """Every word by the plain agenda with its own key, one hash at a time."""
    words = pc.split_words(CODEC.pieces, text)
    keys = pc.word_keys(seed, owner, len(words))
    return [i for w, k in zip(words, keys.tolist()) for i in pc.merge_by_agenda(CODEC.pieces, w, k, dropout)]


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 5), st.integers(0, 2**63), st.sampled_from([0.05, 0.3, 0.9, 1.0]))
def test_kept_segmentations_equal_the_agenda(text, owner, seed, dropout):
    got = encode(text, owner, seed, dropout)
    assert got == agenda(text, owner, seed, dropout)
    assert b"".join(CODEC.pieces.text[i] for i in got)[1:].decode("utf-8", "surrogatepass") == text


def test_words_of_every_length_equal_the_agenda():
    r = random.Random(1)
    text = " ".join("".join(r.choice("abeénrtßchingtheou日🎉\n") for _ in range(r.randrange(1, 90))) for _ in range(600))
    for dropout in (0.0, 0.1, 0.4):
        assert encode(text, 7, 3, dropout) == agenda(text, 7, 3, dropout)


def test_a_word_varies_by_document_and_place():
    text = "understanding " * 400
    one, two = encode(text, "a", 1, 0.1), encode(text, "b", 1, 0.1)
    assert one != two and one == encode(text, "a", 1, 0.1) and one != encode(text, "a", 2, 0.1)
    words = pc.split_words(CODEC.pieces, text)
    coded = pc.segment_words(CODEC, words, pc.word_keys(1, "a", len(words)), 0.1)
    assert len({c for c, w in zip(coded, words) if w == " understanding"}) > 8


def test_model_with_more_than_65536_pieces():
    letters = [chr(0x4E00 + k) for k in range(400)]
    names = ["<unk>"] + [f"<0x{b:02X}>" for b in range(256)] + [" ", *letters] + [a + b for a in letters for b in letters][:80_000]
    p = pc.Pieces(names, [-float(i) for i in range(len(names))], {i + 1: i for i in range(256)}, {0})
    text = "".join(letters[i] for i in (199, 399, 3, 5, 198, 377)) + " é"
    ids = pc.encode_texts(pc.Segmentations(p), [text], [1], 0, 0.0)[0].tolist()
    assert max(ids) > 65_536 and b"".join(p.text[i] for i in ids)[1:].decode() == text


def test_full_caches_are_emptied(monkeypatch):
    text = " ".join(f"word{k}ing" for k in range(500))
    want = encode(text, 1, 1, 0.2)
    monkeypatch.setattr(pc, "CHUNK_WORDS", 60)
    monkeypatch.setattr(pc, "CACHE_WORDS", 40)
    assert pc.encode_texts(CODEC, [text[:900], text, None, ""], [0, 1, 2, 3], 1, 0.2)[1].tolist() == want


def test_what_is_kept_or_dropped_from_the_caches_changes_nothing(monkeypatch):
    rng = random.Random(5)
    syllables = ["an", "the", "tion", "er", "wor", "ld", "ñe", "日本", "12"]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 6))) for _ in range(400)) for _ in range(6)]
    want = [encode(t, k, 2, 0.2) for k, t in enumerate(texts)]
    for name, value in (("CHUNK_WORDS", 150), ("BLOCK_WORDS", 20), ("CACHE_WORDS", 200), ("CACHE_SEGMENTATIONS", 300)):
        monkeypatch.setattr(pc, name, value)
    small = pc.Segmentations(CODEC.pieces)
    for _ in range(3):
        assert [x.tolist() for x in pc.encode_texts(small, texts, range(6), 2, 0.2)] == want
    assert len(small.base) < 1000 and len(small.number) == len(small.base) == len(small.word_used) == len(small.first) - 1


def test_only_chosen_merges_are_hashed(monkeypatch):
    hashed, mixed = [], pc._mixed
    monkeypatch.setattr(pc, "_mixed", lambda x: hashed.append(x.size) or mixed(x))
    text, (word,) = "standing " * 2000, set(pc.split_words(CODEC.pieces, "standing"))
    ids = pc.encode_texts(pc.Segmentations(CODEC.pieces), [text], [1], 1, 0.01)[0].tolist()
    taken = sum(hashed)
    assert ids == agenda(text, 1, 1, 0.01)
    names = CODEC.pieces.ids
    spans = [(i, m, j) for i in range(len(word)) for j in range(i + 2, len(word) + 1) for m in range(i + 1, j)]
    candidates = sum(word[i:j] in names and word[i:m] in names and word[m:j] in names for i, m, j in spans)
    assert taken < 2000 * candidates


def test_words_with_many_candidates_are_merged_in_arrays(monkeypatch):
    text = "internationalinternationalinternation " * 20 + "interinterestingstandingthethe"
    want = {d: agenda(text, 3, 1, d) for d in (0.0, 0.1, 0.6)}
    monkeypatch.setattr(pc, "merge_by_agenda", None)
    for dropout, ids in want.items():
        assert encode(text, 3, 1, dropout) == ids


def test_nothing_to_segment():
    fresh = pc.Segmentations(CODEC.pieces)
    assert pc.encode_texts(fresh, [], [], 1, 0.1) == []
    assert [x if x is None else x.tolist() for x in pc.encode_texts(fresh, [None, "", None], [1, 2, 3], 1, 0.1)] == [None, [], None]
    assert pc.segment_words(fresh, [], np.zeros(0, np.uint64), 0.1) == []


def test_one_step_equals_encoding_then_decoding(spark):
    df = spark.createDataFrame([(1, "two  words"), (2, None), (3, ""), (None, "日本 x")], "doc_id long, text string")
    got = df.select("doc_id", "text", pc.encode_pieces("text", "doc_id", 1, 0.3).alias("ids"), pc.encode_and_decode("text", "doc_id", 1, 0.3).alias("both"))
    rows = got.withColumn("back", pc.decode_pieces("ids")).collect()
    assert len(rows) == 4 and all((r.both.ids, r.both.back) == (r.ids, r.back) and r.back == r.text for r in rows)


def test_round_trip_and_dropout(spark):
    texts = ["", None, " ", "  two  spaces \n\t", "▁ and ▁▁", "héllo wörld 日本語 🎉", "x" * 5000, "the quick brown fox " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for dropout, seed in ((0.0, 0), (0.2, 1), (0.2, 2)):
        coded = df.withColumn("ids", pc.encode_pieces("text", "doc_id", seed, dropout))
        rows = {r.doc_id: r for r in coded.withColumn("back", pc.decode_pieces("ids")).collect()}
        assert [rows[i].back for i in range(len(texts))] == texts
    one = coded.select("doc_id", "ids").collect()
    again = df.withColumn("ids", pc.encode_pieces("text", "doc_id", 2, 0.2)).select("doc_id", "ids").collect()
    other = df.withColumn("ids", pc.encode_pieces("text", "doc_id", 1, 0.2)).select("doc_id", "ids").collect()
    assert sorted(one) == sorted(again) and sorted(one, key=lambda r: r.doc_id) != sorted(other, key=lambda r: r.doc_id)
    assert len(rows[7].ids) > len(SP.encode(texts[7]))


def check_pieces(rows, texts, window):
    ids = {i: _encoder(VOCABULARY)(t or "") + [0] for i, t in texts.items()}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(ids[r.doc_id])
    assert parts.keys() == ids.keys()
    for i, own in parts.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(ids[i])
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing_is_whole_and_tight(spark):
    r = random.Random(6)
    texts = {i: " ".join(r.choice(["alpha", "beta", "gamma,", "delta\n", "zz"]) for _ in range(r.choice([1, 7, 7, 7, 50, 50, 300, 900, 2500]))) for i in range(150)}
    texts |= {200: None, 201: "", 202: "a" * 30000, 203: texts[0]}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, length int").repartition(5)
    assert check_pieces(pack_documents(df).collect(), texts, 1024) == 0
    assert check_pieces(pack_documents(df, window=64).collect(), texts, 64) == 0
    assert pack_documents(df.limit(0)).collect() == []


def test_one_length_that_nothing_complements(spark):
    texts = {i: "word " * 600 for i in range(100)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert check_pieces(pack_documents(df).collect(), texts, 1024) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=31, max_size=31))
def test_plan_never_uses_more_than_there_is(counts):
    h = np.array([0, *counts])
    combos = combinations(32, np.flatnonzero(h))
    assert all(sum(c) == 32 and len(c) <= 4 for c in combos)
    used = np.zeros(32, int)
    for c, n in zip(combos, solve_counts(combos, h)):
        for length in c:
            used[length] += n
    assert (used <= h).all() and (make_plan(h, 32).taken == used).all()


def test_repeated_rows_are_packed_each(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert pack_documents(df).agg(F.sum("length")).first()[0] == 2 * len(_encoder(VOCABULARY)("a b") + [0])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.sampled_from(["<|endoftext|>", " <|endoftext|> ", "<|endoftext", "|>"])), max_size=8).map("".join))
def test_ids_equal_the_library_with_added_tokens(text):
    assert _encoder(VOCABULARY)(text) == HF.encode(text, add_special_tokens=False).ids


def test_added_token_is_one_id():
    assert _encoder(VOCABULARY)("a <|endoftext|> b") == [64, 220, 50256, 275]


def test_very_long_runs_of_white_space(spark):
    for run in (" " * 10**6, "\n" * 10**6, " \n\t" * 10**5):
        text = f"a {run} <|endoftext|> b"
        assert _encoder(VOCABULARY)(text) == HF.encode(text, add_special_tokens=False).ids
    texts = {1: "a" + " " * 10**6, 2: " " * 999 + "b", 3: "\n" * 1001}
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in texts.items()], "doc_id long, text string, part int, rank int")
    assert check_pieces(pack_documents(df).collect(), texts, 1024) == 0


def test_codec_with_repeated_rows_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([(1, "under standing " * 9, 5), (1, "under standing " * 9, 5), (None, "x", 6), (None, None, 7)], "doc_id long, text string, ids int")
    rows = df.select("doc_id", "text", pc.encode_pieces("text", "doc_id", 1, 0.3).alias("coded")).collect()
    assert rows[0] == rows[1] and rows[2].coded and rows[3].coded is None
    assert df.limit(0).select(pc.encode_pieces("text", "doc_id")).collect() == []


def test_decoding_makes_no_object_of_an_id():
    import tracemalloc

    import pyarrow as pa

    from advisorium.llm.piece_codec import MODEL, _decoded, _encoded

    texts = pa.array(["The quick brown fox " * 20_000, None, "", "好 x"])
    ids = _encoded(MODEL, texts, pa.array([1, 2, 3, 4]), 1, 0.1)
    tracemalloc.start()
    assert _decoded(MODEL, ids).equals(texts) and _decoded(MODEL, ids.slice(1)).equals(texts.slice(1))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * len(ids.flatten())
