"""SentencePiece-style encoding with seeded merge-dropout, and lossless decoding.

Byte-pair merging as in a merge-type SentencePiece model: of all adjacent pieces whose join is a
piece, the pair with the best score merges first, the leftmost on ties.  With dropout every
candidate merge is skipped with chance p by a keyed hash of (seed, document key, number of the word
in its document, the candidate's three borders), so a segmentation depends on nothing but those and
can be repeated anywhere, and each occurrence of a word has its own.  White space keeps its place as
a word start, unknown characters become byte pieces, nothing is normalised: decoding gives back
every text exactly.

Speed comes from what does not depend on the key.  The segmentation of a word without skips and the
merges that lead to it are kept per task.  An occurrence whose key skips none of these merges has that
segmentation, as the agenda would have chosen the same merges; only the others are merged anew under
their own key, in arrays of many words that take one merge each at a time.  A word is kept from the
second time that a task meets it; when there are too many, what was not used lately goes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import small_batches

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
CACHE_WORDS, CACHE_SEGMENTATIONS = 200_000, 4_000_000  # kept words; ids and merges of these, taken together
LONG_WORD = 48  # longer runs are merged one by one with a heap
CHUNK_WORDS = 1 << 19  # words that are worked on at a time; texts are put together until they have more characters
BLOCK_WORDS = 8_192  # words that are merged in arrays at a time
MET = 1 << 22  # bytes that tell which words were met before
PAIR_BITS = 20
LAST = 2**31 - 1  # in the order of merging, after all pieces
_U = np.uint64
_MASK = 2**64 - 1
_ODD = _U(0x5851F42D4C957F2D)
_BORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class Pieces:
    """The vocabulary of a model: names, their order of merging, and the bytes of each piece."""

    def __init__(self, names: Sequence[str], scores: Sequence[float], byte_values: dict[int, int], silent: set[int]):
        """``byte_values`` has the byte of each byte piece, ``silent`` the control and unknown pieces."""
        self.byte_ids = [0] * 256
        self.text: list[bytes] = []
        self.ids: dict[str, int] = {}
        for i, name in enumerate(names):
            if i in byte_values:
                self.byte_ids[byte_values[i]] = i
                self.text.append(bytes([byte_values[i]]))
            elif i in silent:
                self.text.append(b"")
            else:
                name = name.replace(SPACE, " ")
                self.ids[name] = i
                self.text.append(name.encode())
        self.spelling = pa.array(self.text, pa.large_binary())
        order = sorted(range(len(names)), key=lambda i: (-scores[i], i))
        self.order = np.empty(len(names), np.int64)  # the place of each piece in the order of merging
        self.order[order] = np.arange(len(names))
        self.rank = {name: int(self.order[i]) for name, i in self.ids.items()}
        self.by_order = np.array(order, _U)
        self.none = len(names)  # in place of the piece of a character that has none
        self.of_char = np.full(0x110000, self.none, np.int32)
        for name, i in self.ids.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        joins = [(self.ids.get(name[:k], -1), self.ids.get(name[k:], -1), r) for name, r in self.rank.items() for k in range(1, len(name))]
        left, right, rank = np.array([x for x in joins if x[0] >= 0 and x[1] >= 0], np.int64).reshape(-1, 3).T
        keys = left.astype(_U) * _U(self.none + 1) + right.astype(_U)
        slot = keys * _ODD >> _U(64 - PAIR_BITS)
        at = np.argsort(slot)
        self.in_slot = int(np.bincount(slot.astype(np.int64)).max()) if len(slot) else 0
        self.pairs = np.concatenate([keys[at], np.full(self.in_slot + 1, _MASK, _U)])  # pairs of pieces whose join is a piece, by their slots
        self.pair_rank = np.concatenate([rank[at], np.full(self.in_slot + 1, LAST)]).astype(np.int32)
        self.place = np.full(1 << PAIR_BITS, len(keys), np.int32)  # of a slot: where its pairs begin
        self.place[slot[at][::-1]] = np.arange(len(keys))[::-1]
        self.beside = np.zeros(1 << 20, bool)  # neighbours in some piece; others may be among them, which only means fewer cuts
        pairs = np.array(sorted({(ord(a), ord(b)) for name in self.ids for a, b in zip(name, name[1:])}), np.uint32).reshape(-1, 2)
        self.beside[_pair_hash(pairs[:, 0], pairs[:, 1])] = True

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place in the order of merging of the joins of two pieces, LAST where a join is no piece."""
        key = left * _U(self.none + 1) + right
        at = self.place[key * _ODD >> _U(64 - PAIR_BITS)]
        out = np.where(self.pairs[at] == key, self.pair_rank[at], np.int32(LAST))
        rest = np.flatnonzero((out == LAST) & (at < len(self.pairs) - self.in_slot - 1))
        for step in range(1, self.in_slot):
            further = at[rest] + step
            hit = self.pairs[further] == key[rest]
            out[rest[hit]] = self.pair_rank[further[hit]]
        return out

    def spelled(self, text: str) -> list[int]:
        """The piece of a text, or the bytes of a character that has none."""
        i = self.ids.get(text)
        return [i] if i is not None else [self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = range(model.vocab_size())
    names = [model.id_to_piece(i) for i in size]
    return Pieces(
        names, [model.get_score(i) for i in size], {i: int(names[i][3:5], 16) for i in size if model.is_byte(i)}, {i for i in size if model.is_control(i) or model.is_unknown(i)}
    )


def _border_hash(start: int, mid: int, end: int) -> int:
    return (start * _BORDERS[0] + mid * _BORDERS[1] + end * _BORDERS[2]) & _MASK


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _limit(dropout: float) -> int:
    """A candidate is skipped where the upper 53 bits of its hash lie below this."""
    return int(np.ceil(dropout * 2**53))


def skipped(key: int, start: int, mid: int, end: int, dropout: float) -> bool:
    """Whether the join of [start, mid) and [mid, end) is skipped in the word with this key."""
    return int(_mixed(np.array([key ^ _border_hash(start, mid, end)], _U))[0]) >> 11 < _limit(dropout)


def word_keys(seed: int, owner: object, count: int) -> np.ndarray:
    """The keys of the words of a document, by their number."""
    document = xxhash.xxh64_intdigest(str(owner).encode("utf-8", "surrogatepass"), seed=seed % 2**64)
    return _mixed(_U(document) + np.arange(1, count + 1, dtype=_U) * _U(_BORDERS[0]))


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA6B)) >> np.uint32(12)


def _ramp(count: np.ndarray, start: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1 and so on, count[k] numbers for each k."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def merge_in_arrays(p: Pieces, codes: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, ...]:
    """Words of one block: the number of ids of each, all ids, the number of merges of each, the hashes of the merges' borders in order."""
    n, wide, limit = len(size), int(size.max()) + 1, _U(_limit(dropout))  # the last column holds no piece, so nothing joins across
    column = np.arange(wide)
    inside = column < size[:, None]
    at = np.where(inside, start[:, None] + column, start[:, None])
    ids = np.where(inside, p.of_char[codes[at]], p.none).astype(_U).ravel()
    after, before, stands = np.arange(1, n * wide + 1), np.arange(-1, n * wide - 1), inside.ravel()
    rank = np.full(n * wide, LAST, np.int32)
    by_word = rank.reshape(n, wide)

    def look(left: np.ndarray, right: np.ndarray, row: np.ndarray) -> None:
        found = p.joined(ids[left], ids[right])
        if dropout > 0:
            hit = np.flatnonzero(found != LAST)
            lo, mid, end, of = left[hit], right[hit], after[right[hit]], row[hit]
            found[hit[_mixed(keys[of] ^ borders(of * wide, lo, mid, end)) >> _U(11) < limit]] = LAST
        rank[left] = found

    def borders(zero: np.ndarray, lo: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (lo - zero).astype(_U) * _U(_BORDERS[0]) + (mid - zero).astype(_U) * _U(_BORDERS[1]) + (end - zero).astype(_U) * _U(_BORDERS[2])

    left = np.flatnonzero(stands[:-1] & stands[1:])
    look(left, left + 1, left // wide)
    live, rows, hashes = np.arange(n), [np.empty(0, np.int64)], [np.empty(0, _U)]
    while len(live):
        lo = live * wide + by_word[live].argmin(axis=1)
        best = rank[lo]
        going = best != LAST
        live, lo, best = live[going], lo[going], best[going]
        mid = after[lo]
        end = after[mid]
        rows.append(live)
        hashes.append(borders(live * wide, lo, mid, end))
        ids[lo], ids[mid] = p.by_order[best], p.none
        rank[mid], stands[mid], after[lo], before[end] = LAST, False, end, lo
        look(np.concatenate([before[lo], lo]), np.concatenate([lo, end]), np.concatenate([live, live]))
    row, merges = np.concatenate(rows), np.concatenate(hashes)
    found = np.flatnonzero(stands)
    pieces, of = ids[found].astype(np.int32), found // wide
    bare = np.flatnonzero(pieces == p.none)
    if len(bare):
        chars, kind = np.unique(codes[at.ravel()[found[bare]]], return_inverse=True)
        spelled = [p.spelled(chr(c)) for c in chars.tolist()]
        long = np.array([len(x) for x in spelled])
        many = np.ones(len(pieces), np.int64)
        many[bare] = long[kind]
        pieces, of = np.repeat(pieces, many), np.repeat(of, many)
        pieces[_ramp(long[kind], (np.cumsum(many) - many)[bare])] = np.array([i for x in spelled for i in x], np.int32)[_ramp(long[kind], (np.cumsum(long) - long)[kind])]
    return np.bincount(of, minlength=n), pieces, np.bincount(row, minlength=n), merges[np.argsort(row, kind="stable")]


def merge_words(p: Pieces, codes: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, ...]:
    """The order in which words are worked off, by size, and in that order what ``merge_in_arrays`` gives."""
    order = np.argsort(size, kind="stable")
    blocks = [order[k : k + BLOCK_WORDS] for k in range(0, len(order), BLOCK_WORDS)]
    parts = [merge_in_arrays(p, codes, start[b], size[b], keys[b], dropout) for b in blocks]
    none = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, _U)
    return order, *(np.concatenate(x) for x in zip(none, *parts))


class Segmentations:
    """The words met twice, with their segmentations without skips and the merges that lead to these."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.met, self.met_count, self.turn = np.zeros(MET, bool), 0, 0
        self.number: dict[bytes, int] = {}  # of a word, its characters as UTF-32, in the order of the numbers
        self.base, self.many, self.word_used = (np.zeros(0, np.int64) for _ in range(3))  # of a word: where its ids begin, how many these are, the chunk that used it last
        self.ids = np.zeros(0, np.int32)
        self.first, self.merges = np.zeros(1, np.int64), np.zeros(0, _U)  # where the merges of a word begin; the hashes of their borders

    def met_before(self, words: list[bytes]) -> np.ndarray:
        """Whether each word was met in an earlier chunk, or one that shares its place: this decides what is kept, not what comes out."""
        if self.met_count > MET >> 2:
            self.met, self.met_count = np.zeros(MET, bool), 0
        at = np.fromiter(map(hash, words), np.int64, len(words)) & MET - 1
        before = self.met[at]
        self.met[at] = True
        self.met_count += int((~before).sum())
        return before

    def shrink(self) -> None:
        """Where there are too many words, or these are too long, those go that were used longest ago."""
        if len(self.base) <= CACHE_WORDS and len(self.ids) + len(self.merges) <= CACHE_SEGMENTATIONS:
            return
        stays = np.flatnonzero(self.word_used > np.partition(self.word_used, len(self.base) // 2)[len(self.base) // 2])
        words, many = list(self.number), self.first[stays + 1] - self.first[stays]
        self.number = {words[k]: n for n, k in enumerate(stays.tolist())}
        self.merges, self.first = self.merges[_ramp(many, self.first[stays])], np.concatenate([[0], np.cumsum(many)])
        self.ids, self.many, self.word_used = self.ids[_ramp(self.many[stays], self.base[stays])], self.many[stays], self.word_used[stays]
        self.base = np.cumsum(self.many) - self.many

    def add(self, words: list[bytes]) -> None:
        size = np.array([len(w) // 4 for w in words], np.int64)
        codes = np.frombuffer(b"".join(words), np.uint32)
        order, many, ids, merged, merges = merge_words(self.pieces, codes, np.cumsum(size) - size, size, np.zeros(len(words), _U), 0.0)
        self.number.update((words[k], n) for n, k in enumerate(order.tolist(), len(self.base)))
        self.base = np.concatenate([self.base, len(self.ids) + np.cumsum(many) - many])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(merged)])
        self.many, self.ids, self.merges = np.concatenate([self.many, many]), np.concatenate([self.ids, ids]), np.concatenate([self.merges, merges])
        self.word_used = np.concatenate([self.word_used, np.full(len(words), self.turn)])

    def unskipped(self, number: np.ndarray, keys: np.ndarray, dropout: float) -> np.ndarray:
        """Whether a word's key skips none of the merges of its segmentation without skips."""
        out = np.ones(len(number), bool)
        for k in range(0, len(number) if dropout > 0 else 0, BLOCK_WORDS):
            part, key = number[k : k + BLOCK_WORDS], keys[k : k + BLOCK_WORDS]
            many = self.first[part + 1] - self.first[part]
            skips = _mixed(np.repeat(key, many) ^ self.merges[_ramp(many, self.first[part])]) >> _U(11) < _U(_limit(dropout))
            out[k + np.repeat(np.arange(len(part)), many)[skips]] = False
        return out


@lru_cache(maxsize=2)
def segmentations_of(path: str) -> Segmentations:
    return Segmentations(pieces_of(path))


def merge_by_agenda(p: Pieces, word: str, key: int, dropout: float) -> list[int]:
    """One word with a heap as agenda and each skip hashed when a candidate turns up; no array grows with the square of its length."""
    n, limit = len(word), _limit(dropout)
    ends, prev, nxt, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(at: list[int]) -> None:
        there = [(i, nxt[i]) for i in at if i >= 0 and nxt[i] >= 0]
        there = [(p.rank.get(word[i : ends[j]]), i, j) for i, j in there if word[i : ends[i]] in p.ids and word[j : ends[j]] in p.ids]
        there = [x for x in there if x[0] is not None]
        if dropout > 0 and there:
            hashes = np.array([key ^ _border_hash(i, j, ends[j]) for _, i, j in there], _U)
            there = [x for x, h in zip(there, (_mixed(hashes) >> _U(11)).tolist()) if h >= limit]
        for r, i, j in there:
            heapq.heappush(agenda, (r, i, j, ends[i], ends[j]))

    offer(list(range(n)))
    while agenda:
        _, i, j, mid, end = heapq.heappop(agenda)
        if alive[i] and alive[j] and nxt[i] == j and ends[i] == mid and ends[j] == end:
            ends[i], alive[j], nxt[i] = end, False, nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            offer([prev[i], i])
    return [x for i in range(n) if alive[i] for x in p.spelled(word[i : ends[i]])]


def segment_words(s: Segmentations, words: list[str], keys: np.ndarray, dropout: float) -> list[bytes]:
    """The ids of each word, as bytes, under its key."""
    many, ids = _segmented(s, _codes("".join(words)), np.cumsum([0, *map(len, words)]), keys, dropout)
    ends = np.cumsum(many).tolist()
    return [ids[lo:hi].tobytes() for lo, hi in zip([0, *ends], ends)]


def _segmented(s: Segmentations, codes: np.ndarray, ends: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each word and all ids; words lie between ``ends``, the first of which is 0."""
    s.shrink()
    s.turn += 1
    start, size = ends[:-1], np.diff(ends)
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends * 4), pa.py_buffer(codes)]).dictionary_encode()
    index, ends_of = spelled.indices.to_numpy(), np.frombuffer(spelled.dictionary.buffers()[1], np.int64, len(spelled.dictionary) + 1)
    data, at = (spelled.dictionary.buffers()[2] or pa.py_buffer(b"")).to_pybytes(), ends_of.tolist()
    words = [data[lo:hi] for lo, hi in zip(at, at[1:])]
    number, short = np.fromiter(map(s.number.get, words, repeat(-1)), np.int64, len(words)), np.diff(ends_of) <= LONG_WORD * 4
    new = np.flatnonzero((number < 0) & short)
    new = new[(np.bincount(index, minlength=len(words))[new] > 1) | s.met_before([words[k] for k in new.tolist()])]
    added = [words[k] for k in new.tolist()]
    s.add(added)
    number[new] = [s.number[w] for w in added]
    s.word_used[number[number >= 0]] = s.turn
    of, short = number[index], short[index]
    kept = np.flatnonzero(of >= 0)
    kept = kept[s.unskipped(of[kept], keys[kept], dropout)]
    alone = short.copy()
    alone[kept] = False
    alone = np.flatnonzero(alone)
    order, many, ids, _, _ = merge_words(s.pieces, codes, start[alone], size[alone], keys[alone], dropout)
    heap = np.flatnonzero(~short).tolist()
    by_heap = [merge_by_agenda(s.pieces, codes[start[i] : ends[i + 1]].tobytes().decode("utf-32-le", "surrogatepass"), int(keys[i]), dropout) for i in heap]
    count = np.zeros(len(size), np.int64)
    count[kept], count[alone[order]], count[heap] = s.many[of[kept]], many, [len(x) for x in by_heap]
    out, at = np.empty(int(count.sum()), np.int32), np.cumsum(count) - count
    out[_ramp(count[kept], at[kept])] = s.ids[_ramp(count[kept], s.base[of[kept]])]
    out[_ramp(many, at[alone[order]])] = ids
    for i, x in zip(heap, by_heap):
        out[at[i] : at[i] + len(x)] = x
    return count, out


def encode_texts(s: Segmentations, texts: Sequence[str | None], owners: Sequence[object], seed: int, dropout: float) -> list[np.ndarray | None]:
    """The piece ids of each text."""
    out: list[np.ndarray | None] = []
    chunk: list[tuple[str | None, object]] = []

    def flush() -> None:
        size = np.array([len(t) + 1 if t else 0 for t, _ in chunk], np.int64)
        codes, text_ends = _codes("".join(" " + t for t, _ in chunk if t)), np.cumsum(size)
        ends = _word_ends(s.pieces, codes, text_ends)
        words = np.searchsorted(ends, text_ends) - np.searchsorted(ends, text_ends - size)
        keys = [word_keys(seed, owner, n) for (_, owner), n in zip(chunk, words.tolist())]
        key, parts = np.concatenate([np.empty(0, _U), *keys]), [(np.empty(0, np.int64), np.empty(0, np.int32))]
        for k in range(0, len(key), CHUNK_WORDS):
            part = ends[k : k + CHUNK_WORDS + 1]
            parts.append(_segmented(s, codes[part[0] : part[-1]], part - part[0], key[k : k + CHUNK_WORDS], dropout))
        count, ids = (np.concatenate(x) for x in zip(*parts))
        at = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(words)])].tolist()
        out.extend(None if t is None else ids[lo:hi] for (t, _), lo, hi in zip(chunk, at, at[1:]))
        chunk.clear()

    held = 0
    for text, owner in zip(texts, owners):
        chunk.append((text, owner))
        held += len(text or "")
        if held > CHUNK_WORDS:
            flush()
            held = 0
    flush()
    return out


def _word_ends(p: Pieces, codes: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
    """0 and the ends of all words: where a text ends, where a run of spaces begins and where no piece has the two characters beside each other."""
    left, right = codes[:-1], codes[1:]
    ends = np.zeros(len(codes) + 1, bool)
    ends[1:-1] = ~p.beside[_pair_hash(left, right)] | ((right == 32) & (left != 32))
    ends[0] = ends[text_ends] = True
    return np.flatnonzero(ends)


def split_words(p: Pieces, text: str) -> list[str]:
    """The text, with a space before it, cut where a run of spaces begins and where no piece has the two characters beside each other: no join reaches across."""
    if not text:
        return []
    text = " " + text
    ends = _word_ends(p, _codes(text), np.array([len(text)])).tolist()
    return [text[i:j] for i, j in zip(ends, ends[1:])]


def encode_pieces(text: Column | str, key: Column | str, seed: int = 0, dropout: float = 0.1, model: str = MODEL) -> Column:
    """array<int> of pieces of a text column.  ``key`` (a document id) is part of every skip hash.

    Null gives null, an empty text an empty array.  Equal texts with equal keys are segmented
    alike, on any machine, and so are repeated rows; equal texts with different keys are not; a null
    key is a key like any other; ``dropout`` 0 gives the model's own segmentation.
    """

    small_batches()

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, owners in batches:
            yield _encoded(model, texts, owners, seed, dropout)

    return encode(text, key)


def decode_pieces(ids: Column | str, model: str = MODEL) -> Column:
    """The text of a piece column; null gives null."""

    small_batches()

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield _decoded(model, rows)

    return decode(ids)


def encode_and_decode(text: Column | str, key: Column | str, seed: int = 0, dropout: float = 0.1, model: str = MODEL) -> Column:
    """struct<ids, back>: the pieces as ``encode_pieces`` gives them and the text that ``decode_pieces`` makes of these, in one Python step.

    Both functions in a row would take two Python workers a task, each with caches of its own.
    """

    small_batches()

    @F.arrow_udf("struct<ids:array<int>,back:string>")
    def both(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, owners in batches:
            ids = _encoded(model, texts, owners, seed, dropout)
            yield pa.StructArray.from_arrays([ids, _decoded(model, ids)], ["ids", "back"])

    return both(text, key)


def _encoded(model: str, texts: pa.Array, owners: pa.Array, seed: int, dropout: float) -> pa.ListArray:
    ids = encode_texts(segmentations_of(model), texts.to_pylist(), owners.to_pylist(), seed, dropout)
    ends = np.cumsum([0] + [0 if x is None else len(x) for x in ids]).astype(np.int32)
    flat = np.concatenate([np.empty(0, "<i4"), *(x for x in ids if x is not None)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=pa.array([x is None for x in ids], pa.bool_()))


def _decoded(model: str, rows: pa.ListArray) -> pa.Array:
    flat = rows.flatten()  # null rows have no ids
    count = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
    spelled = pieces_of(model).spelling.take(flat)
    ends, data = np.frombuffer(spelled.buffers()[1], np.int64, len(flat) + 1), memoryview(spelled.buffers()[2] or b"")
    at = ends[np.concatenate([[0], np.cumsum(count)])].tolist()
    found = [data[lo + 1 : hi] if there else None for lo, hi, there in zip(at, at[1:], rows.is_valid().to_pylist())]
    return pa.array(found, pa.binary()).cast(pa.string())
