"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

The n-grams of all documents are ordered by a 64-bit hash (one global order, known without a
pass over the data) and that order is cut into ``2**q`` equal fragments.  ``q`` follows from the
size of a set, so that a fragment of a document holds a few n-grams.

* Two sets with Jaccard similarity of at least t differ in at most D = (1-t)/(1+t) * (|A|+|B|)
  n-grams, so at most D fragments differ.  Of a document's first D+1 non-empty fragments at
  least one is therefore the same in every partner: (q, fragment, digest of the fragment) are the
  join keys.  A set near the limit of its size class also gives the keys of the next class.
  A set with fewer than D+1 filled fragments also gives its n-gram prefix as keys.
* Sets that are equal collapse into one class first, whatever the number of copies.  A class is
  named by the 64-bit digest of its set, so repeated or missing document ids cannot mix classes.
* Within a key, members are first compared with the smallest class only (a star).  What is still in
  different components afterwards is compared in blocks of bounded size, through the length bound
  and parity sketches whose Hamming distance never exceeds the true difference.  A block hands out
  at most ``PER_MEMBER`` pairs a member, the nearest of each two components first; where it had
  more, it is looked at again once those links have joined components, and what is left then is
  verified in place, where only links that join two components leave the task.  So
  no key, however hot, gives more rows than a constant times its members, and no pair is skipped.
* Candidates are verified exactly: overlaps are counted per fragment and summed per pair.
* All links of a set lie inside its component.  They are counted there, every two members once,
  in blocks of bounded size and as one number per member: no pair leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_ids, small_batches, written
from .components import connected_components

SKETCH_WORDS = 16  # 1024 parity bits for each set
WIDE_WORDS = 256  # a second sketch has two bits for each n-gram, up to so many words; of larger sets it only bounds less tightly
VERIFY_BITS = 2  # verification counts overlaps in 4 fragments
BLOCK = 8192  # members of a key that one task compares with as many others
BLOCK_GRAMS = 4_000_000  # n-grams of those members, about
PER_MEMBER = 4  # pairs that a block hands out for each member before they are verified in place
LINK_BLOCK = 4096  # members of a component whose links one task counts with as many others
LINK_GRAMS = 4_000_000  # n-grams of those members, at most
CACHE_WORDS = 300_000
_U = np.uint64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; A-Z lower-cased, words split at ASCII white space."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, _U)
    hashes = np.fromiter(map(_HASHES.__getitem__, tokens), _U, len(tokens))
    width = min(words, len(hashes))
    total = np.full(len(hashes) - width + 1, _U(width))
    for i in range(width):
        total = _mix(total + hashes[i : len(hashes) - width + 1 + i] * _U(2 * i + 0x9E3779B97F4A7C15))
    return np.unique(total)


class Plan(Protocol):
    """Which keys a set of n-gram hashes has: sets that share one are candidates."""

    def keys(self, s: np.ndarray) -> np.ndarray: ...


class _Plan:
    """How a set of n n-grams gives keys at similarity ``t``."""

    def __init__(self, t: Fraction):
        self.t = t
        # A fragment holds at most `most` n-grams on average, so that D stays below the number of fragments.
        self.most = float(2 * t / (1 - t)) * 0.44 if t < 1 else 1.0

    def difference(self, n: int) -> int:
        """The largest difference from any partner of a set of n: the partner has at most n/t."""
        return int((1 - self.t) / (1 + self.t) * (n + Fraction(n) / self.t))

    def classes(self, n: int) -> list[int]:
        low = self.most / 2
        q = max(0, math.floor(math.log2(n / low))) if n >= low else 0
        return [q, q + 1] if n >= float(self.t) * low * 2 ** (q + 1) - 1e-9 else [q]

    def keys(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        d = self.difference(n)
        if d < 1:
            return np.empty(0, np.int64)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(_mix(s), dtype=_U)])
        found, short = [], False
        for q in self.classes(n):
            part = (s >> _U(64 - q)) if q else np.zeros(n, _U)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            short |= len(starts) < d + 1
            ends = np.append(starts[1:], n)[: d + 1]
            starts = starts[: d + 1]
            found.append(_mix(sums[ends] - sums[starts] + _mix(part[starts] * _U(64) + _U(q + 1))))
        if short:
            prefix = s[: n - math.ceil(self.t * n) + 1]
            found.append(_mix(prefix ^ _U(0x5BD1E9955BD1E995)))
        return np.concatenate(found).view(np.int64)


def _parity(s: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the n-grams in each of ``bits`` classes.  XOR of its halves is the parity in half as many classes."""
    odd = np.bincount(((s >> _U(7)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sketch of fixed size, and one with at least two bits for each n-gram where WIDE_WORDS allow it."""
    wide = _parity(s, min(64 * WIDE_WORDS, max(64 * SKETCH_WORDS, 1 << (2 * len(s) - 1).bit_length())))
    narrow = wide
    while len(narrow) > SKETCH_WORDS:
        narrow = narrow[: len(narrow) // 2] ^ narrow[len(narrow) // 2 :]
    return narrow, wide


def _sets(batches: Iterator[pd.DataFrame], words: int, plan: Plan) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), pdf["text"]):
            s = shingle_hashes(text, words)
            rows.append((doc_id, len(s), _name(s), plan.keys(s), *_sketches(s)))
        yield pd.DataFrame(rows, columns=["doc_id", "n", "sig", "keys", "sketch", "wide"])


def _name(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def _grams_of(texts: DataFrame, words: int) -> DataFrame:
    """texts(doc_id, text) -> id (name of the set), grams."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [shingle_hashes(t, words) for t in pdf["text"]]
            yield pd.DataFrame({"id": [_name(s) for s in found], "grams": [s.view(np.int64) for s in found]})

    return texts.mapInPandas(sets, "id long, grams array<long>")


def _fragments(batches: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            s = shingle_hashes(text, words)
            cuts = np.searchsorted(s >> _U(64 - VERIFY_BITS), np.arange(1, 2**VERIFY_BITS, dtype=_U))
            rows += [(_name(s), i, part.view(np.int64)) for i, part in enumerate(np.split(s, cuts))]
        yield pd.DataFrame(rows, columns=["id", "fragment", "grams"])


class _Roots:
    """Union-find over the components that meet in a block."""

    def __init__(self, comp: np.ndarray):
        _, self.of = np.unique(comp, return_inverse=True)

    def join(self, a: int, b: int) -> None:
        self.of[self.of == self.of[b]] = self.of[a]


def _folded(lists: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each sketch length: where the rows of that length or more are in a matrix of sketches folded to it."""
    ends, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy().view(_U)
    size, found = np.diff(ends), {}
    for length in np.unique(size).tolist():
        rows = np.flatnonzero((size == length) | (size == 2 * length))
        out = np.empty((len(rows), length), _U)
        for k, i in enumerate(rows.tolist()):
            part = flat[ends[i] : ends[i + 1]]
            out[k] = part if len(part) == length else part[:length] ^ part[length:]
        at = np.full(len(size), -1)
        at[rows] = np.arange(len(rows))
        found[length] = (at, out)
    return found


def _candidates(table: pa.Table, num: int, den: int, roots: _Roots) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, partners, distances) of one block for every row, smaller sets first: what length, component and sketch allow.

    Components are looked up when a row's turn comes, so that links found meanwhile count.
    """
    n, block = table["n"].to_numpy(), table["block"].to_numpy()
    apart = table["bi"][0].as_py() != table["bj"][0].as_py()
    lists = table["wide"].combine_chunks()
    length, folded = np.diff(lists.offsets.to_numpy()), _folded(lists)
    order = np.argsort(n, kind="stable")
    ends = np.searchsorted(n[order], n[order] * den // num, side="right")  # a partner has at most n / t n-grams
    for k, end in enumerate(ends.tolist()):
        x, y = order[k], order[k + 1 : end]
        y = y[roots.of[y] != roots.of[x]]
        if apart:
            y = y[block[y] != block[x]]
        at, bits = folded[int(length[x])]
        y = y[at[y] >= 0]
        allowed, distance = (n[x] + n[y]) * (den - num) // (den + num), np.zeros(len(y), np.int64)
        for lo, hi in ((0, 4), (4, 16), (16, bits.shape[1])):  # the first words drop most
            if hi > lo and lo < bits.shape[1] and len(y):
                distance += np.bitwise_count(bits[at[y], lo:hi] ^ bits[at[x], lo:hi]).sum(axis=1, dtype=np.int64)
                keep = distance <= allowed
                y, distance, allowed = y[keep], distance[keep], allowed[keep]
        if len(y):
            yield x, y, distance


NEAREST = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("bi", pa.int32()), ("bj", pa.int32())])


def _nearest(table: pa.Table, num: int, den: int) -> pa.RecordBatch:
    """Candidate pairs (a, b) of one block, PER_MEMBER for each row at most; and the block itself (key, bi, bj) if it had more."""
    ids, roots = table["id"].to_numpy(), _Roots(table["comp"].to_numpy())
    best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    more, room = False, PER_MEMBER * len(table)
    seen = 0
    for x, y, distance in _candidates(table, num, den, roots):
        seen += len(y)
        order = np.argsort(distance, kind="stable")
        y, distance = y[order], distance[order]
        _, first = np.unique(roots.of[y], return_index=True)  # the nearest of each component
        picked = np.sort(first)[:PER_MEMBER] if seen > room else np.arange(len(y))
        more |= len(picked) < len(y)
        for j in picked.tolist():
            ends = tuple(sorted((int(roots.of[x]), int(roots.of[y[j]]))))
            best.setdefault(ends, []).append((int(distance[j]), int(x), int(y[j])))
    left, right = [], []
    if seen > room:  # of each two components the nearest pair; its links may make the others needless
        more |= any(len(v) > 1 for v in best.values())
        best = {k: [min(v)] for k, v in best.items()}
    for pairs in best.values():
        for _, x, y in pairs:
            left.append(min(ids[x], ids[y]))
            right.append(max(ids[x], ids[y]))
    mark = [table[c][0].as_py() for c in ("key", "bi", "bj")] if more else None
    void = [None] * len(left)
    columns = [left + [None] * more, right + [None] * more] + [void + ([mark[i]] if more else []) for i in range(3)]
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, NEAREST)], schema=NEAREST)


def _uniting(table: pa.Table, num: int, den: int) -> pa.RecordBatch:
    """Links (a, b) of one block that join two components, verified in place against the n-grams of its members."""
    ids, n, roots = table["id"].to_numpy(), table["n"].to_numpy(), _Roots(table["comp"].to_numpy())
    grams = table["grams"].combine_chunks()
    ends = grams.offsets.to_numpy()
    _, code = np.unique(grams.flatten().to_numpy(), return_inverse=True)
    mark, left, right = np.zeros(int(code.max()) + 1 if len(code) else 1, bool), [], []
    for x, y, distance in _candidates(table, num, den, roots):
        y = y[np.argsort(distance, kind="stable")]
        mark[code[ends[x] : ends[x + 1]]] = True
        while len(y):
            part, y = y[:64], y[64:]
            for j in part.tolist():
                if roots.of[j] != roots.of[x]:
                    common = int(mark[code[ends[j] : ends[j + 1]]].sum())
                    if den * common >= num * (int(n[x]) + int(n[j]) - common):
                        roots.join(x, j)
                        left.append(ids[x])
                        right.append(ids[j])
            y = y[roots.of[y] != roots.of[x]]
        mark[code[ends[x] : ends[x + 1]]] = False
    return pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _by_block(batches: Iterator[pa.RecordBatch], search: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, bi, bj): ``search`` sees each block of two rows or more whole."""

    def of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        change = np.zeros(len(table) - 1, bool)
        for c in ("key", "bi", "bj"):
            change |= np.diff(table[c].to_numpy()) != 0
        edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(table)]]).tolist()
        found = [search(table.slice(lo, hi - lo)) for lo, hi in zip(edges[:-1], edges[1:]) if hi - lo > 1]
        yield from pa.Table.from_batches(found).combine_chunks().to_batches() if found else ()

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        if not len(held):
            continue
        key = np.stack([held[x].to_numpy() for x in ("key", "bi", "bj")])
        last = np.flatnonzero((key != key[:, -1:]).any(axis=0))
        if len(last):  # the last block may go on in the next batch
            cut = int(last[-1]) + 1
            yield from of(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and len(held):
        yield from of(held)


def _apart(x: str, y: str) -> str:
    """SQL for the Hamming distance of two sketches; the longer one, at most twice as long, is folded first."""
    fold = "if(size({0}) > size({1}), zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (p, q) -> p ^ q), {0})"
    return f"aggregate(zip_with({fold.format(x, y)}, {fold.format(y, x)}, (p, q) -> bit_count(p ^ q)), 0, (s, p) -> s + p)"


def _close(pairs: DataFrame, facts: DataFrame, sketch: str, num: int, den: int) -> DataFrame:
    """The distinct pairs(a, b) whose sizes and sketches allow the similarity; neither bound ever drops a link.

    ``facts`` has one row for each id, so pairs stay distinct and no step behind the joins keeps a hot id from being split.
    """
    side = lambda k: facts.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col(sketch).alias(f"s{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(f"abs(na - nb) * {den + num} <= (na + nb) * {den - num}")
    return both.where(f"{_apart('sa', 'sb')} * {den + num} <= (na + nb) * {den - num}").select("a", "b")


def _texts(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the documents that stand for the given classes, and of those without an id."""
    wanted = written(classes.join(ids, classes["sig"] == ids["id"], "left_semi").select(F.col("cls").alias("doc_id")).where("doc_id is not null"), "wanted")
    return by_ids(docs, wanted, "left_semi").unionByName(docs.where("doc_id is null"))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """pairs(a, b) that are linked: partial overlaps per fragment, summed per pair."""
    texts = _texts(docs, classes, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    parts = written(texts.mapInPandas(lambda it: _fragments(it, words), "id long, fragment int, grams array<long>"), "fragments")
    left = parts.select(F.col("id").alias("a"), "fragment", F.col("grams").alias("x"))
    right = parts.select(F.col("id").alias("b"), "fragment", F.col("grams").alias("y"))
    partial = (
        pairs.join(left, "a").join(right, ["b", "fragment"])
        .select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("total"))
    )
    summed = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), F.sum("total").alias("total"))
    return summed.where(f"{den} * common >= {num} * (total - common)").select("a", "b")


def _count_links(table: pa.Table, num: int, den: int) -> pa.Table:
    """The members of two blocks of a component (or of one): id, documents that it links to in the other block."""
    ids, block, docs = (table[x].to_numpy() for x in ("id", "block", "docs"))
    grams = table["grams"].combine_chunks()
    n = np.diff(grams.offsets.to_numpy()).astype(np.int32)
    row = np.repeat(np.arange(len(n)), n)
    _, col, count = np.unique(grams.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = count[col] > 1  # what one member alone has is common to no pair
    row, col = row[shared], (np.cumsum(count > 1) - 1)[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    bi, bj = table["bi"][0].as_py(), table["bj"][0].as_py()
    left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
    common = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, LINK_BLOCK):
        at = slice(*np.searchsorted(col, [lo, lo + LINK_BLOCK]))
        has = np.zeros((len(n), LINK_BLOCK), np.float32)
        has[row[at], col[at] - lo] = 1
        common += has[left] @ has[right].T
    total = np.zeros(len(n), np.int64)
    for lo in range(0, len(left), 256):
        part = left[lo : lo + 256]
        both = common[lo : lo + 256].astype(np.int64)
        linked = (den + num) * both >= num * (n[part, None] + n[None, right].astype(np.int64))
        if bi == bj:
            linked[np.arange(len(part)), np.arange(lo, lo + len(part))] = False
        else:
            total[right] += docs[part] @ linked
        total[part] += linked @ docs[right]
    return pa.table({"id": ids, "n": total})


def _links(comp: DataFrame, links: DataFrame, classes: DataFrame, sizes: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """id, n_links of the classes that are linked with other ones: how many documents of other classes they link to."""
    named = comp.join(classes.select(F.col("sig").alias("id"), "docs"), "id").join(sizes, "id")
    edges = links.select(F.col("a").alias("id")).join(comp, "id").groupBy("component").agg(F.count("*").alias("edges"))
    groups = named.groupBy("component").agg(F.count("*").alias("size"), F.sum("docs").alias("all"), F.sum("n").alias("grams"))
    groups = written(groups.join(edges, "component"), "groups")
    named = written(named.join(groups, "component"), "named")
    whole = named.where("edges * 2 = size * (size - 1)").select("id", (F.col("all") - F.col("docs")).alias("n_links"))
    blocks = F.greatest(F.ceil(F.col("size") / LINK_BLOCK), F.ceil(F.col("grams") / LINK_GRAMS)).cast("int")
    rest = written(named.where("edges * 2 < size * (size - 1)").select("id", "component", "docs", blocks.alias("blocks")), "rest")
    grams = _grams_of(_texts(docs, classes, rest.select("id")), words).join(rest, "id").dropDuplicates(["id"])
    rows = grams.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = (
        rows.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("block", "to").alias("bi"), F.greatest("block", "to").alias("bj"), "block", "id", "docs", "grams")
    )
    counted = rows.groupBy("component", "bi", "bj").applyInArrow(lambda t: _count_links(t, num, den), "id long, n long")
    return whole.unionByName(counted.groupBy("id").agg(F.sum("n").alias("n_links")))


def _across(members: DataFrame, links: DataFrame, one: DataFrame, docs: DataFrame, classes: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """links and components after every two members of a key in different components were compared, in three passes of ever fewer blocks."""
    comp = written(connected_components(links), "labels")

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")

    named = labelled(members).join(one.select("id", "n"), "id")
    mixed = (
        named.groupBy("key")
        .agg(F.count("*").alias("size"), F.sum("n").alias("grams"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("who"))
        .where("lo < hi and size > 2")
        .groupBy("who", "size").agg(F.min("key").alias("key"), F.max("grams").alias("grams"))  # keys with the same members are one
        .select("key", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    )
    rows = members.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = written(
        rows.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "to").cast("int").alias("bi"), F.greatest("block", "to").cast("int").alias("bj"), "block", "id"),
        "blocks",
    )
    if rows.isEmpty():
        return links, comp
    ordered = lambda df: df.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    schema = "a long, b long, key long, bi int, bj int"
    for _ in range(2):  # the second time only where a block had more, with the links of the first time in the components
        full = ordered(labelled(rows).join(one.select("id", "n", "wide"), "id"))
        found = written(full.mapInArrow(lambda it: _by_block(it, lambda t: _nearest(t, num, den)), schema), "nearest")
        close = written(found.where("a is not null").select("a", "b").distinct(), "close")
        if not close.isEmpty() and not (more := written(_verified(close, docs, classes, words, num, den), "more-links")).isEmpty():
            links = links.unionByName(more)
            comp = written(connected_components(links), "labels")
        left = found.where("a is null").select("key", "bi", "bj")
        if left.isEmpty():
            return links, comp
        rows = written(rows.join(left, ["key", "bi", "bj"], "left_semi"), "blocks")
    texts = _texts(docs, classes, rows.select("id").distinct())
    facts = _grams_of(texts, words).join(one.select("id", "n", "wide"), "id").dropDuplicates(["id"])
    full = ordered(labelled(rows).join(facts, "id"))
    uniting = written(full.mapInArrow(lambda it: _by_block(it, lambda t: _uniting(t, num, den)), "a long, b long"), "uniting")
    if not uniting.isEmpty():
        links = links.unionByName(uniting.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        comp = written(connected_components(links), "labels")
    return links, comp


def ngram_jaccard_groups(docs: DataFrame, words: int = 3, threshold: tuple[int, int] = (90, 100), count_links: bool = True) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, class_id, component_id, n_links.

    ``class_id`` is the smallest doc_id with the same n-gram set, ``component_id`` the smallest
    doc_id that links reach.  ``n_links`` is the number of other documents that the document is
    linked with, those with the same n-grams included; without ``count_links`` the column is left
    out.  Null, empty and blank texts have no n-grams and link with nothing;
    a text with fewer words than ``words`` is one n-gram.  Repeated rows come back repeated and count
    as one document; rows that share a doc_id but not the n-grams are compared each for itself.
    Rows without a doc_id take part too; a group of nothing but such rows has null as its ids.  An
    empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    return jaccard_groups(docs, words, threshold, _Plan(Fraction(*threshold)), count_links)


def jaccard_groups(docs: DataFrame, words: int, threshold: tuple[int, int], plan: Plan, count_links: bool) -> DataFrame:
    """The groups of ``ngram_jaccard_groups`` for any plan of candidate keys: sets that share a key are compared, whatever the keys are."""
    small_batches()
    num, den = threshold
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(
        docs.mapInPandas(lambda it: _sets(it, words, plan), "doc_id long, n long, sig long, keys array<long>, sketch array<long>, wide array<long>"), "sets"
    )
    filled = sets.where("n > 0")
    classes = written(filled.select("sig", "doc_id").distinct().groupBy("sig").agg(F.min("doc_id").alias("cls"), F.count("*").alias("docs")), "classes")
    copies = filled.select("sig", "doc_id").join(classes.where("docs > 1"), "sig").where("doc_id <> cls").select("doc_id").distinct()
    one = by_ids(filled, written(copies, "copies"), "left_anti")
    one = one.select(F.col("sig").alias("id"), "n", "keys", "sketch", "wide")
    if one.count() > classes.count():  # rows repeat, or ids are missing or shared
        one = written(filled.select(F.col("sig").alias("id"), "n", "keys", "sketch", "wide").dropDuplicates(["id"]), "one")
    one = one.where(F.size("keys") > 0)
    keys = one.select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("rep"), F.max("id").alias("top")).where("rep < top").select("key", "rep")
    members = written(keys.join(shared, "key"), "members")

    star = members.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct()
    near = written(_close(written(_close(star, one, "sketch", num, den), "star"), one, "wide", num, den), "near")
    links = written(_verified(near, docs, classes, words, num, den), "links")
    links, comp = _across(members.select("key", "id"), links, one, docs, classes, words, num, den)

    least = comp.join(classes.select(F.col("sig").alias("id"), "cls"), "id").groupBy("component").agg(F.min("cls").alias("component_id"))
    where = classes.join(comp.join(least, "component").select(F.col("id").alias("sig"), "component_id"), "sig", "left")
    where = where.withColumn("component_id", F.coalesce("component_id", "cls"))
    if count_links:
        degree = written(_links(comp, links, classes, one.select("id", "n"), docs, words, num, den), "degrees")
        where = where.join(degree.withColumnRenamed("id", "sig"), "sig", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("docs") - 1)
    extra = ["n_links"] * count_links
    where = where.select("sig", "cls", "component_id", *extra)
    hit = filled.select("doc_id", "n", "sig").join(where, "sig").select("doc_id", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), "component_id", *extra)
    none = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return hit.unionByName(none.select(hit.columns))
