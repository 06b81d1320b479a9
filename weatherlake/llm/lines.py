"""Fuzzy line deduplication.

Lines are normalised (letters in lower case, runs of anything but letters and
digits as one blank).  Lines that may be similar meet under keys:

- **SimHash blocks.**  Lines of three words and 20 code points or more have a
  SimHash of their words; two lines that agree on a whole block of it are
  candidates.  By the pigeonhole principle every pair that differs in fewer
  bits than there are blocks shares a block, and most pairs that differ in
  more bits do.
- **Deletion neighbourhoods** for short lines, whose few words leave a SimHash
  little to agree on.  Up to ``FEW`` words: the line without each one of its
  words, and the whole line, so lines that differ in one word (changed, inserted or
  deleted) always meet.  Up to two words, or under 20 code points: the same with code
  points, which is exact for every line under 20 (there one edit is allowed), or the
  first and last 16 where the line has more than 40.  Lines under ten code points
  are similar to equal ones only.

Lines under a key are compared in one place: those whose letter counts alone
rule out the edit distance are passed over (every edit changes at most two
counts by one, so nothing is lost), the others are verified by edit
similarity, and pairs that are connected already are not.  What goes on is a
forest of links, not all pairs.  A key with more than ``TILE`` lines is dealt
into parts; lines that are not connected after that meet all lines of
the other parts.  Connected lines form a group, and one occurrence per group,
the first by document id and line number, is kept.
"""

from __future__ import annotations

import contextlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.components import connected_components
from weatherlake.llm.contamination import folded_tokens
from weatherlake.llm.shared import Bloom, cut, extended, fresh, modest_batches, stored, table, tidy, whole_groups
from weatherlake.llm.textarrays import U

BLOCKS, BLOCK_BITS = 8, 32  # wide blocks keep chance meetings rare in very many lines
SIMILARITY = 0.9
FEW = 16  # words of a line that has deletion keys
SHORT, LONG, END = 20, 40, 16  # code points: lines with keys by code point, and how they get them
TILE = 4096  # lines of a key compared in one place
SMALL = 50_000  # pairs of lines looked at a time
BUCKETS, WIDTH = 32, 33  # letter counts, and with one place for bytes that are not counted
PAIRS, BANDS = 1024, 8  # pairs of lines, of one word of 64 diagonals, whose edit distances are computed at a time; most words
ROWS, BYTES = 1 << 15, 1 << 25  # lines that a task compares at a time, and their bytes, besides those of a last group
PACK, _BUCKET_BITS = 1 << 19, 16  # keys packed at a time, bits of a key that name its bucket
SLICE = 1 << 18  # bytes of text at a time: what is computed of them stays in the processor's cache


def normalised_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lines with a word: folded bytes, word starts, ends and hashes, the word
    range of each line, its hash, its row and its number in the row (from 0)."""
    low = folded_tokens(data)
    line_start = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1)))
    line_start = line_start[line_start < len(data)]
    starts, ends, _ = ta.spans((low != 0x20) & (data != 10), np.append(line_start, len(data)))
    h = ta.hashes(low, starts, ends)
    first = np.searchsorted(starts, np.append(line_start, len(data)))
    row = np.searchsorted(offsets, line_start, "right") - 1
    number = np.arange(len(line_start)) - np.searchsorted(line_start, offsets[:-1][row])
    full = np.flatnonzero(np.diff(first))
    at = np.append(first[full], len(starts))
    if len(full) == 0:
        return low, starts, ends, h, at, np.zeros(0, U), row[full], number[full]
    place = np.arange(len(h)) - np.repeat(at[:-1], np.diff(at))
    powers = ta.constants(21, int(place.max()) + 1) | U(1)
    line_hash = ta.mix(np.add.reduceat(ta.mix(h * powers[place]), at[:-1]) + np.diff(at).astype(U))
    return low, starts, ends, h, at, line_hash, row[full], number[full]


# four bits, times the first, masked by the second: each in a 16-bit counter of its own
_SPREAD, _COUNTERS = U(1 | 1 << 15 | 1 << 30 | 1 << 45), U(1 | 1 << 16 | 1 << 32 | 1 << 48)
_SHIFT = np.array([sum(luck < (256 >> level) for level in range(1, 7)) for luck in range(256)], U)
_PIECE = 63  # words summed at a time: 63 weights of at most 1024 fit a 16-bit counter


def _mix_in_place(x: np.ndarray) -> None:
    """``ta.mix`` without arrays of its own but one."""
    y = x >> U(30)
    x ^= y
    x *= U(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, U(27), out=y)
    x *= U(0x94D049BB133111EB)
    x ^= np.right_shift(x, U(31), out=y)


def simhash(h: np.ndarray, length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SimHash blocks (BLOCKS x lines, uint32) of words with hashes ``h`` and
    byte lengths; words ``at[i]:at[i + 1]`` are line i.

    Longer words weigh more, and each half block of 16 bits raises some words
    further (by a hash of word and half), so that half depends mostly on a few
    long words: an edit elsewhere leaves it as it was, other halves depend on
    other words, and two halves together keep unrelated lines apart.  In lines
    of many words a half reads those it raises most only.
    """
    counts = np.diff(at)
    line = np.repeat(np.arange(len(counts)), counts)
    base = np.maximum(1, np.minimum(length, 12) // 3).astype(U) ** U(2)
    raised = None if (length > 3).all() else np.where(length > 3, U(6), U(0))
    # the first bits of a hash are a word's luck
    read = (np.select([counts <= 24, counts <= 96], [U(2**64 - 1), U((64 << 56) - 1)], U((16 << 56) - 1)))[line]
    halves = np.zeros((2 * BLOCKS, len(counts)), np.uint16)
    for k, salt in enumerate(ta.constants(31, 2 * BLOCKS)):
        x = h ^ salt
        _mix_in_place(x)
        at_work = np.flatnonzero(x <= read)
        if not len(at_work):
            continue
        of, x = line.take(at_work), x.take(at_work)
        here = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        size = np.diff(np.append(here, len(of)))
        whole = int(size.max()) <= _PIECE
        start = here if whole else np.flatnonzero((np.arange(len(of)) - np.repeat(here, size)) % _PIECE == 0)
        shift = _SHIFT.take((x >> U(56)).astype(np.intp))
        weight = base.take(at_work) << (shift if raised is None else np.minimum(shift, raised[at_work]))
        counters = []
        for n in range(4):
            bits = (x >> U(4 * n)) & U(15)
            bits *= _SPREAD
            bits &= _COUNTERS
            bits *= weight
            counters.append(np.add.reduceat(bits, start))
        sums = np.stack(counters, 1).view(np.uint16).astype(np.int64)
        total = np.add.reduceat(weight, start).astype(np.int64)
        if not whole:
            piece = np.searchsorted(start, here)
            sums, total = np.add.reduceat(sums, piece, axis=0), np.add.reduceat(total, piece)
        halves[k, of[here]] = np.packbits(2 * sums > total[:, None], axis=1, bitorder="little").view(np.uint16)[:, 0]
    return (halves[0::2].astype(np.uint32) << np.uint32(16)) | halves[1::2]


def _long_words(h: np.ndarray, length: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of more than three bytes of each line, or all of a line that
    has none: what the SimHash reads."""
    keep = length > 3
    line = np.repeat(np.arange(len(at) - 1), np.diff(at))
    keep |= (np.add.reduceat(keep.astype(np.int64), at[:-1]) == 0)[line]
    return h[keep], length[keep], np.searchsorted(line[keep], np.arange(len(at)))


_ODD = 0xD1342543DE82EF95
_KINDS = ta.constants(41, 4)


class _Sequence:
    """Hashes of pieces of sequences: ``m`` are hashed tokens, of which
    ``at[i]:at[i + 1]`` are sequence i."""

    def __init__(self, m: np.ndarray, at: np.ndarray):
        self.at, self.count = at, np.diff(at)
        place = np.arange(len(m)) - np.repeat(at[:-1], self.count)
        n = int(self.count.max()) + 2 if len(self.count) else 2
        powers, back = np.full(n, _ODD, U), np.full(n, pow(_ODD, -1, 2**64), U)
        powers[0] = back[0] = 1
        self.powers, self.back = np.cumprod(powers), np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(m * self.powers[place], dtype=U)])

    def lacking_one(self, salt: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Every sequence without each one of its tokens, and as a whole:
        hashes, and where those of each sequence start."""
        a, b = self.at[:-1], self.at[1:]
        whole = ta.mix((self.sums[b] - self.sums[a]) + self.count.astype(U) * salt)
        one = np.arange(self.at[0], self.at[-1])
        of = np.repeat(np.arange(len(self.count)), self.count)
        rest = (self.sums[one] - self.sums[a][of]) + (self.sums[b][of] - self.sums[one + 1]) * self.back[1]
        lacking = ta.mix(rest + (self.count[of] - 1).astype(U) * salt)
        start = np.concatenate([[0], np.cumsum(self.count + 1)])
        out = np.zeros(start[-1], U)
        out[start[:-1]] = whole
        out[np.arange(len(one)) + of + 1] = lacking
        return out, start

    def ends(self, n: int, salt: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last ``n`` tokens (of sequences that have them)."""
        a, b = self.at[:-1], self.at[1:]
        first = ta.mix(self.sums[a + n] - self.sums[a] + salt)
        last = ta.mix((self.sums[b] - self.sums[b - n]) * self.back[self.count - n] + salt * U(3))
        return np.stack([first, last], 1).ravel(), 2 * np.arange(len(a) + 1)


def _merge(n: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of some of ``n`` lines, as (lines, values, starts) each, behind
    one another: values and starts of all lines."""
    count = np.zeros(n, np.int64)
    for lines, _, start in parts:
        count[lines] += np.diff(start)
    where = np.concatenate([[0], np.cumsum(count)])
    out, done = np.zeros(where[-1], U), where[:-1].copy()
    for lines, values, start in parts:
        size = np.diff(start)
        out[np.repeat(done[lines] - start[:-1], size) + np.arange(len(values))] = values
        done[lines] += size
    return out, where


class Lines:
    """The lines with a word of some texts, and what is known of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low, self.starts, self.ends, self.h, self.at, self.hash, self.row, self.number = normalised_lines(data, offsets)
        self.words = np.diff(self.at)
        self.length = np.zeros(0, np.int64)
        if len(self.words):
            # code points: bytes of words but further ones of a character, and a blank between words
            further = np.flatnonzero((self.low & 0xC0) == 0x80)
            points = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
            first, last = self.starts[self.at[:-1]], self.ends[self.at[1:] - 1]
            self.length = np.diff(points[self.at]) + self.words - 1 - (np.searchsorted(further, last) - np.searchsorted(further, first))

    def text(self, k: int) -> bytes:
        return b" ".join(self.low[self.starts[self.at[k]]:self.ends[self.at[k + 1] - 1]].tobytes().split())

    def _part(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of some lines, and where those of each start."""
        size = self.words[lines]
        at = np.concatenate([[0], np.cumsum(size)])
        return np.repeat(self.at[lines] - at[:-1], size) + np.arange(at[-1]), at

    def blocks(self, lines: np.ndarray) -> np.ndarray:
        """The SimHash blocks (lines x BLOCKS) of some lines."""
        if not len(lines):
            return np.zeros((0, BLOCKS), np.uint32)
        word, at = self._part(lines)
        return np.ascontiguousarray(simhash(*_long_words(self.h[word], (self.ends - self.starts)[word], at)).T)

    def has_blocks(self) -> np.ndarray:
        return (self.words >= 3) & (self.length >= SHORT)

    def keys(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All keys of the wanted lines, those of the SimHash first: values, and where those of each line start."""
        hashed = self.has_blocks()
        by_point = wanted & ~hashed & (self.length >= 10)
        parts = []
        if len(some := np.flatnonzero(wanted & hashed)):
            blocks = ta.mix(self.blocks(some).astype(U) | (np.arange(1, BLOCKS + 1, dtype=U) << U(BLOCK_BITS)))
            parts.append((some, blocks.ravel(), BLOCKS * np.arange(len(some) + 1)))
        if len(some := np.flatnonzero(wanted & hashed & (self.words <= FEW))):
            word, at = self._part(some)
            parts.append((some, *_Sequence(ta.mix(self.h[word]), at).lacking_one(_KINDS[0])))
        for few, some in ((True, np.flatnonzero(by_point & (self.length <= LONG))), (False, np.flatnonzero(by_point & (self.length > LONG)))):
            if len(some):
                texts = [self.text(k).decode("utf-8", "replace") for k in some.tolist()]
                points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
                seq = _Sequence(ta.mix(points + _KINDS[1]), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
                parts.append((some, *(seq.lacking_one(_KINDS[2]) if few else seq.ends(END, _KINDS[3]))))
        return _merge(len(self.hash), parts)


def letter_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the code points of each text by bucket (of their first byte)."""
    out = np.zeros((len(offsets) - 1, BUCKETS), np.int32)
    for i, j in ta.slices(offsets, SLICE >> 3):
        row = np.repeat(np.arange(0, (j - i) * WIDTH, WIDTH), np.diff(offsets[i:j + 1]))
        out[i:j] = np.bincount(row + _BUCKET.take(data[offsets[i]:offsets[j]]), minlength=WIDTH * (j - i)).reshape(-1, WIDTH)[:, :BUCKETS]
    return out


def _buckets() -> np.ndarray:
    """Letters a to z have a bucket each, blanks one, all other first bytes the last five; further bytes none."""
    t = (np.arange(256) % 5 + BUCKETS - 5).astype(np.int64)
    t[ord("a"):ord("z") + 1] = np.arange(26)
    t[0x20] = 26
    t[0x80:0xC0] = BUCKETS
    return t


_BUCKET = _buckets()
OCCURRENCES = "id long, version long, number int, node long, hashed boolean, keys array<long>"


def _lists(values: np.ndarray, start: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(start, pa.int32()), ta.longs(values))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, version, text) -> every line with a word; the first of equal ones with its keys."""
    for batch in batches:
        data, offsets = ta.buffers(batch.column(2))
        for i, j in ta.slices(offsets, SLICE):
            x = Lines(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            if len(x.hash) == 0:
                continue
            new = np.zeros(len(x.hash), bool)
            new[np.unique(x.hash, return_index=True)[1]] = True
            take = pa.array(x.row + i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(x.number.astype(np.int32)), ta.longs(x.hash),
                 pa.array(x.has_blocks()), _lists(*x.keys(new))], names=[f.split()[0] for f in OCCURRENCES.split(", ")])


def _packed(buckets: int) -> Callable:
    """(node, keys) -> (bucket, pairs): keys and their nodes by the hash range of the key, packed
    as longs, so that a row is many of them."""
    def pack(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, node = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key)
        key, node = key.take(order), node.take(order)
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        pairs = np.stack([key[new], node[new]], 1)
        bucket = (pairs[:, 0] >> U(64 - _BUCKET_BITS)).astype(np.int64) * buckets >> _BUCKET_BITS
        start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        where = pa.py_buffer((16 * np.r_[start, len(pairs)]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(bucket[start]), pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, where, pa.py_buffer(pairs)])],
                                          names=["bucket", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            lists = batch.column(1)
            key = lists.flatten().to_numpy(zero_copy_only=False).view(U)
            node = np.repeat(batch.column(0).to_numpy().view(U), np.diff(lists.offsets.to_numpy()))
            if len(key):
                held.append((key, node))
                size += len(key)
            if size >= PACK:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)
    return run


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, pairs), sorted -> keys that more than one node has."""
    for t in whole_groups(batches, ("bucket",), 1):
        pairs = np.frombuffer(b"".join(t.column("pairs").to_pylist()), U).reshape(-1, 2)
        key = np.ascontiguousarray(pairs[:, 0])
        order = np.argsort(key)
        key = key.take(order)
        again = key[1:] == key[:-1]
        twice = np.flatnonzero(np.r_[again, False] | np.r_[False, again])
        if not len(twice):
            continue
        key, node = key.take(twice), pairs[order.take(twice), 1]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        yield pa.RecordBatch.from_arrays([ta.longs(key[start][np.minimum.reduceat(node, start) != np.maximum.reduceat(node, start)])], names=["key"])


def _likely(bloom: Bloom) -> Callable:
    """(node, hashed, keys) -> (key, place, node) of keys that the filter lets
    pass.  ``place``: which block of the SimHash, or BLOCKS for other keys."""
    passes = bloom.test()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            key = lists.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
            place = np.where(batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[row], np.minimum(at, BLOCKS), BLOCKS)
            ok = passes(key)
            yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(place[ok].astype(np.int32)), batch.column(0).take(pa.array(row[ok]))],
                                             names=["key", "place", "node"])
    return run


INFO = "node long, line string"
EARLIER = [f"block{p}" for p in range(BLOCKS - 1)]


def _info(bloom: Bloom) -> Callable:
    """(text) -> what a comparison reads of lines that the filter lets pass, once per slice."""
    passes = bloom.test()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ta.buffers(batch.column(0))
            for i, j in ta.slices(offsets, SLICE):
                x = Lines(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                node, one_of = np.unique(x.hash.view(np.int64), return_index=True)
                some = one_of[passes(node)]
                texts = [x.text(k).decode("utf-8", "replace") for k in some.tolist()]
                yield pa.RecordBatch.from_arrays([ta.longs(x.hash[some]), pa.array(texts, pa.string())], names=["node", "line"])
    return run


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance of two strings, or more than ``most``: common ends
    are cut off, the rest is compared bit-parallel (as in ``within``)."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if len(a) > len(b):
        a, b = b, a
    lo, hi = 0, len(a)  # longest common prefix, by halving
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(a)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid:] == b[len(b) - mid:] else (lo, mid - 1)
    a, b = a[:len(a) - lo], b[:len(b) - lo]
    if not a:
        return len(b)
    # an alignment of at most ``most`` edits stays on as many diagonals and one: bit t
    # of column k (from 0) belongs to row k - off + t
    bit = (most - (len(b) - len(a))) // 2
    off = len(b) - len(a) + bit
    full = (1 << (off + bit + 1)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a, off):
        where[c] = where.get(c, 0) | 1 << i
    up, down, edits = full >> off << off, 0, 0
    for k, c in enumerate(b):
        same = (where.get(c, 0) >> k) & full
        level = ((((same & up) + up) ^ up) | same | down) & full
        if not level >> bit & 1:
            edits += 1
            if edits > most:
                return edits
        plus, minus = down | (full & ~(level | up)), up & level
        level >>= 1
        up, down = minus | (full & ~(level | plus)), level & plus
    return edits


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of lines, numbered from 1 in one byte if that holds them, and where those of each line start."""
    at, text = np.concatenate([[0], np.cumsum([len(x) for x in lines])]), "".join(lines)
    with contextlib.suppress(UnicodeEncodeError):
        narrow = text.encode("latin-1")
        if b"\0" not in narrow and b"\xff" not in narrow:
            return np.frombuffer(narrow, np.uint8), at
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(int(points.max(initial=0)) + 1, bool)
    seen[points] = True
    kinds = int(seen.sum())
    return np.cumsum(seen)[points].astype(np.uint8 if kinds < 255 else np.uint16 if kinds < 65535 else np.uint32), at


def _matrix(codes: np.ndarray, start: np.ndarray, size: np.ndarray, left: np.ndarray, width: int, blank: int) -> np.ndarray:
    """A row per sequence, which begins at column ``left``; ``blank`` elsewhere."""
    out = np.full((len(start), width), blank, codes.dtype)
    before = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(before, size)
    out.ravel()[np.repeat(np.arange(len(start)) * width + left, size) + place] = codes[np.repeat(start, size) + place]
    return out


def within(codes: np.ndarray, at: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which pairs of lines have a Levenshtein distance of at most ``most``, all pairs at a time.

    An alignment of at most k edits stays on k + 1 diagonals.  The differences
    between neighbours of a column are bits of ``bands`` words (Hyyro), of which bit t
    of column c belongs to row c - off + t; the distance is read along the last diagonal.
    """
    size = np.diff(at)
    swap = size[i] > size[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    out = np.zeros(len(i), bool)
    rest = np.flatnonzero(size[j] - size[i] <= most)
    rest = rest[np.argsort(-size[j[rest]], kind="stable")]
    if not len(rest):
        return out
    n, least = size[j[rest]], size[j[rest]] - size[i[rest]]
    bit = (most[rest] - least) // 2
    off = least + bit
    bands = int(most[rest].max()) // 64 + 1
    longest = -(-int(n[0]) // 64) * 64
    a = _matrix(codes, at[i[rest]], size[i[rest]], off, longest + 64 * bands, 0)
    b = _matrix(codes, at[j[rest]], n, np.zeros(len(n), np.int64), longest, np.iinfo(codes.dtype).max)
    ones = ~U(0)
    up = ~U(0) << np.clip(off - 64 * np.arange(bands)[:, None], 0, 63).astype(U)
    up[off >= 64 * np.arange(1, bands + 1)[:, None]] = 0
    down = np.zeros_like(up)
    word, bit, kept, most = bit // 64, (bit % 64).astype(U), np.zeros(len(n), U), most[rest]
    column = np.arange(len(n))
    for lo in range(0, longest, 64):
        seen = np.lib.stride_tricks.sliding_window_view(a[:, lo:lo + 63 + 64 * bands], 64 * bands, axis=1)
        same = np.packbits(seen == b[:, lo:lo + 64, None], axis=2, bitorder="little").view(U)
        same = np.ascontiguousarray(same.transpose(1, 2, 0))
        for c, m in enumerate(np.searchsorted(-n, -np.arange(lo, min(lo + 64, n[0])), "left").tolist()):  # m lines are longer than lo + c
            x, v, w = same[c][:, :m], up[:, :m], down[:, :m]
            zero = x & v
            zero += v
            if bands > 1:
                over = zero < v
                for k in range(1, bands):
                    zero[k] += over[k - 1]
                    over[k] |= over[k - 1] & (zero[k] == 0)
            zero ^= v
            zero |= x
            zero |= w
            last = zero[0] if bands == 1 else zero[word[:m], column[:m]]
            kept[:m] += (last >> bit[:m]) & U(1)
            plus = zero | v
            np.invert(plus, out=plus)
            plus |= w
            minus = np.bitwise_and(zero, v, out=v)
            below = zero >> U(1)
            if bands > 1:
                below[:-1] |= zero[1:] << U(63)
            np.bitwise_and(below, plus, out=w)
            plus |= below
            minus |= np.invert(plus, out=plus)
        done, edits = n <= lo + 64, np.minimum(n, lo + 64) - kept.astype(np.int64)
        out[rest[done & (edits <= most)]] = True
        go = np.flatnonzero(~done & (edits <= most))
        if not len(go):
            break
        if len(go) < len(n):
            rest, n, most, kept, word, bit, a, b = (x[go] for x in (rest, n, most, kept, word, bit, a, b))
            up, down = up[:, go], down[:, go]
    return out


def _anchored(x: list[str], y: list[str], most: int) -> bool:
    """Whether keeping words that both lines have once, in order, and editing
    what lies between them takes at most ``most`` edits: never fewer than needed."""
    once = {w: k for k, w in enumerate(x)}
    seen = Counter(x), Counter(y)
    pairs = [(once[w], k) for k, w in enumerate(y) if w in once and seen[0][w] == seen[1][w] == 1]
    # the longest run of words in the same order in both
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (p, _) in enumerate(pairs):
        n = bisect_left(tails, p)
        back.append(at[n - 1] if n else -1)
        if n == len(tails):
            tails.append(p)
            at.append(i)
        else:
            tails[n], at[n] = p, i
    chain, i = [(len(x), len(y))], at[-1] if at else -1
    while i >= 0:
        chain.append(pairs[i])
        i = back[i]
    spent = a = b = 0
    for p, q in reversed(chain):
        if x[a:p] != y[b:q]:
            v, w = " ".join(x[a:p]), " ".join(y[b:q])
            longer = max(len(v), len(w))  # replaced as a whole, where a comparison would take long
            spent += longer if longer > 48 else edit_distance(v, w, most - spent)
            spent += abs((p == a) - (q == b))  # a blank, where one side has no words
            if spent > most:
                return False
        a, b = p + 1, q + 1
    return True


def _in_place(a: str, b: str, most: int) -> bool:
    """Whether replacing words in place takes at most ``most`` edits."""
    return a.count(" ") == b.count(" ") and sum(max(len(v), len(w)) for v, w in zip(a.split(" "), b.split(" "), strict=True) if v != w) <= most


def similar(a: str, b: str, similarity: float) -> bool:
    """Whether 1 - distance / longer length reaches ``similarity``."""
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if a == b or abs(len(a) - len(b)) > most:
        return a == b
    # words replaced in place, and words kept in order, bound the distance from above
    return _in_place(a, b, most) or _anchored(a.split(" "), b.split(" "), most) or edit_distance(a, b, most) <= most


class _Groups:
    """Union and find over numbers 0 to n - 1, with a label of each."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members: dict[int, list[int]] = {}

    def join(self, a: int, b: int) -> None:
        x, y = int(self.label[a]), int(self.label[b])
        mine, other = self.members.get(x) or [x], self.members.get(y) or [y]
        if len(mine) < len(other):
            x, y, mine, other = y, x, other, mine
        self.label[other] = x
        self.members[x] = mine + other
        self.members.pop(y, None)


class _Comparison:
    """Some whole groups of lines under a key: which of them are links."""

    def __init__(self, t: pa.Table, group: np.ndarray, similarity: float):
        self.group, self.similarity = group, similarity
        self.node, self.place = t.column("node").to_numpy(), t.column("place").to_numpy()
        self.side = t.column("side").to_numpy()
        self.line = t.column("line").to_pylist()
        self.codes, self.at = _codes(self.line)
        self.length = np.diff(self.at)
        self.letters = letter_counts(*ta.buffers(t.column("line")))
        self.blocks = np.stack([t.column(c).to_numpy() for c in EARLIER], 1)
        _, self.of = np.unique(t.column("component").to_numpy(), return_inverse=True)
        self.groups = _Groups(int(self.of.max()) + 1)
        self.links: list[tuple[int, int]] = []
        self.waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs that meet here first and that letter counts do not rule out."""
        longer = np.maximum(self.length[i], self.length[j])
        most = ((1 - self.similarity) * longer + 1e-9).astype(np.int64)
        ok = (self.node[i] != self.node[j]) & (2 * longer - self.length[i] - self.length[j] <= most) & ((self.side[i] == 0) | (self.side[i] != self.side[j]))
        ok &= self.groups.label[self.of[i]] != self.groups.label[self.of[j]]
        at = np.flatnonzero(ok)
        a, b = i[at], j[at]
        met = np.zeros(len(at), bool)
        for p in range(BLOCKS - 1):
            met |= (self.place[a] > p) & (self.blocks[a, p] == self.blocks[b, p]) & (self.blocks[a, p] != 0)
        at, a, b = at[~met], a[~met], b[~met]
        return at[np.abs(self.letters[a] - self.letters[b]).sum(1) <= 2 * most[at]]

    def compare(self, i: np.ndarray, j: np.ndarray) -> None:
        """Verifies pairs, but for those that earlier ones have connected; some of them wait for others."""
        for part in np.array_split(np.arange(len(i)), len(i) // SMALL + 1):
            a, b = i[part], j[part]
            ok = self.possible(a, b)
            a, b = a[ok], b[ok]
            most = ((1 - self.similarity) * np.maximum(self.length[a], self.length[b]) + 1e-9).astype(np.int64)
            a, b, most = self._link(a, b, most, lambda p, q, m: _in_place(self.line[p], self.line[q], m))
            bands = most // 64 + 1
            for n in np.unique(bands).tolist():
                here = bands == n
                if n > BANDS:
                    self._link(a[here], b[here], most[here], self._similar)
                else:
                    self.waiting.setdefault(n, []).append((a[here], b[here], most[here]))
                    self._settle(n, PAIRS // n)

    def _similar(self, p: int, q: int, most: int) -> bool:
        return similar(self.line[p], self.line[q], self.similarity)

    def _settle(self, bands: int, at_least: int) -> None:
        """Compares waiting pairs of one width, many at a time, while there are so many."""
        while sum(len(x[0]) for x in self.waiting[bands]) >= at_least:
            a, b, most = (np.concatenate(x) for x in zip(*self.waiting[bands], strict=True))
            apart = self._apart(a, b)
            a, b, most = a[apart], b[apart], most[apart]
            if len(a) < max(at_least, 16 * bands):
                if at_least > 1:
                    self.waiting[bands] = [(a, b, most)]
                else:
                    self._link(a, b, most, self._similar)  # so few that they are quicker one by one
                    del self.waiting[bands]
                return
            k = PAIRS // bands
            near = within(self.codes, self.at, a[:k], b[:k], most[:k])
            self._link(a[:k][near], b[:k][near], most[:k][near], lambda *_: True)
            self.waiting[bands] = [(a[k:], b[k:], most[k:])]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.groups.label[self.of[a]] != self.groups.label[self.of[b]]

    def _link(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, test: Callable[[int, int, int], bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links pairs that pass the test, one after the other; the pairs that did not."""
        label, left = self.groups.label, []
        for k, (p, q, x, y, m) in enumerate(zip(a.tolist(), b.tolist(), self.of[a].tolist(), self.of[b].tolist(), most.tolist(), strict=True)):
            if label[x] == label[y]:
                continue
            if test(p, q, m):
                self.groups.join(x, y)
                self.links.append((p, q))
            else:
                left.append(k)
        return a[left], b[left], most[left]

    def run(self) -> None:
        """Pairs of a group by how far they are apart in order of length: neighbours first, then
        up to twice as far at a time."""
        order = np.lexsort((self.length, self.group))
        group, length = self.group[order], self.length[order]
        # a line can only be similar to lines that are not much longer
        longest = length / self.similarity + 1e-6
        i, d, pairs, held = np.arange(len(order) - 1), 1, [], 0
        while len(i):
            i = i[i + d < len(order)]
            i = i[(group[i + d] == group[i]) & (length[i + d] <= longest[i])]
            pairs.append((order[i], order[i + d]))
            held += len(i)
            d += 1
            if held >= SMALL or not len(i) or d & (d - 1) == 0:
                self.compare(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
                pairs, held = [], 0
        for bands in list(self.waiting):
            self._settle(bands, 1)


def _linker(similarity: float, keys: tuple[str, ...]) -> Callable:
    """Rows sorted by key and part -> links, at most one fewer than there are lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys, ROWS, BYTES):
            k = np.stack([t.column(c).to_numpy() for c in keys], 1)
            x = _Comparison(t, np.cumsum(np.r_[False, (k[1:] != k[:-1]).any(1)]), similarity)
            x.run()
            a, b = (x.node[[p[e] for p in x.links]] if x.links else np.zeros(0, np.int64) for e in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["src", "dst"])
    return run


def _linked(live: DataFrame, info: DataFrame, similarity: float) -> DataFrame:
    """``live``: key, place, node; ``info`` of every node.  Connected lines:
    node, component."""
    large = cut(live.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > TILE))
    parts = F.coalesce(F.ceil(F.col("size") / TILE), F.lit(1))
    dealt = live.join(large, "key", "left").select("key", F.pmod(F.xxhash64("node"), parts).alias("part"), "place", "node",
                                                   F.lit(0).alias("side"), F.col("node").alias("component"))
    links = _links_of(dealt, info, similarity, ("key", "part"))
    groups = connected_components(links)
    if large.isEmpty():
        return groups

    # lines outside the largest component of a large key meet all lines of the key
    member = live.join(large, "key").join(groups, "node", "left").select("key", "place", "node", "size", F.coalesce("component", "node").alias("component"))
    main = (member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
            .groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.first("size").alias("size"))
            .select("key", F.col("m.component").alias("main"), (F.col("size") - F.col("m.n")).alias("outside")).filter("outside > 0"))
    member = cut(member.join(main, "key"))
    tiles = lambda n: F.ceil(F.col(n) / TILE)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), tiles(n) - 1))
    left = member.filter("component <> main").select("key", F.pmod(F.xxhash64("node"), tiles("outside")).alias("lt"), every("size").alias("rt"),
                                                     "place", "node", F.lit(1).alias("side"), "component")
    right = member.select("key", every("outside").alias("lt"), F.pmod(F.xxhash64("node"), tiles("size")).alias("rt"),
                          "place", "node", F.lit(2).alias("side"), "component")
    more = _links_of(left.unionByName(right), info, similarity, ("key", "lt", "rt"))
    return groups if more.isEmpty() else connected_components(links.unionByName(more))


def _links_of(dealt: DataFrame, info: DataFrame, similarity: float, keys: tuple[str, ...]) -> DataFrame:
    # hashed, the smaller side: the lines need no sorting
    rows = dealt.hint("shuffle_hash").join(info, "node").repartition(*keys).sortWithinPartitions(*keys)
    return cut(rows.mapInArrow(tidy(_linker(similarity, keys)), "src long, dst long").distinct())


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs``: id, version, text.  Lines that a group's first occurrence
    makes superfluous: id, version, numbers (array of line numbers)."""
    found = stored(docs.mapInArrow(tidy(_occurrences), OCCURRENCES))
    buckets = min(max(found.count() // 4096, 64), 1 << _BUCKET_BITS)
    several = cut(found.select("node", "keys").filter(F.size("keys") > 0).mapInArrow(tidy(_packed(buckets)), "bucket long, pairs binary")
                  .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_several), "key long"))
    likely = found.select("node", "hashed", "keys").filter(F.size("keys") > 0).mapInArrow(tidy(_likely(Bloom(several, "key"))), "key long, place int, node long")
    live = stored(likely.join(several.hint("shuffle_hash"), "key").select("key", "place", "node").distinct())
    # of two lines that share a block both have its key among the live ones; no such key is 0
    nodes = cut(live.groupBy("node").agg(*(F.coalesce(F.max(F.when(F.col("place") == p, F.col("key"))), F.lit(0)).alias(c) for p, c in enumerate(EARLIER))))
    info = stored(docs.select("text").mapInArrow(tidy(_info(Bloom(nodes, "node"))), INFO).dropDuplicates(["node"]).join(nodes, "node"))
    groups = _linked(live, info, similarity)

    member = (found.join(groups, "node", "left")
              .select("id", "version", "number", F.coalesce("component", "node").alias("line_group")))
    first = member.groupBy("line_group").agg(F.min(F.struct("id", "version", "number")).alias("first"), F.count(F.lit(1)).alias("n"))
    extra = (member.join(first.filter("n > 1"), "line_group")
             .filter(~F.struct("id", "version", "number").eqNullSafe(F.col("first"))))
    return extra.groupBy("id", "version").agg(F.sort_array(F.collect_list("number")).alias("numbers"))


def _without(texts: int, numbers: int, schema: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, count = [], []
            for text, drop in zip(batch.column(texts).to_pylist(), batch.column(numbers).to_pylist(), strict=True):
                if drop:
                    gone = set(drop)
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
                out.append(text)
                count.append(len(drop or ()))
            columns = [c for k, c in enumerate(batch.columns) if k != numbers]
            columns[texts] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count, pa.int32())], names=schema)
    return run


def dedup_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without lines that repeat another one, and ``lines_removed``.

    Lines are separated by \\n.  Of every connected group of lines whose edit
    similarity (on normalised text) reaches ``similarity`` only the first
    occurrence stays, by id, then by a hash of the text, then by line number;
    a null id comes first.  Lines without letter or digit are left alone.
    Rows that repeat both id and text are one document: they keep the same
    lines.  Null and empty texts stay as they are; an empty table gives no
    rows.  All rows, columns and their order are kept; an input column called
    ``lines_removed`` is replaced.
    """
    docs = docs.drop("lines_removed")
    own_id, version, losing, numbers = fresh(docs, "_id", "_version", "_losing", "_numbers")
    rows = docs.withColumn(version, F.xxhash64(text)).withColumn(own_id, F.col(id).cast("long"))
    gone = repeated_lines(rows.filter(F.col(text).isNotNull()).select(
        F.col(own_id).alias("id"), F.col(version).alias("version"), F.col(text).cast("string").alias("text")), similarity)
    other_id, other_version = fresh(rows, "_gid", "_gversion")
    gone = cut(gone.select(F.col("id").alias(other_id), F.col("version").alias(other_version), F.col("numbers").alias(numbers)))
    # only rows that may lose lines are shuffled to the numbers of those lines
    may = Bloom(gone.select(F.xxhash64(other_id, other_version).alias("h")), "h").condition(F.xxhash64(own_id, version))
    rows = rows.withColumn(losing, F.coalesce(may, F.lit(False)))
    joined = rows.filter(F.col(losing)).join(gone.hint("shuffle_hash"), F.col(own_id).eqNullSafe(F.col(other_id)) & (F.col(version) == F.col(other_version)), "left").select(
        *docs.columns, numbers)
    names = [*docs.columns, "lines_removed"]
    schema = extended(docs.schema, "lines_removed int")
    kept = rows.filter(~F.col(losing)).select(*docs.columns, F.lit(0).alias("lines_removed"))
    return joined.mapInArrow(tidy(_without(docs.columns.index(text), len(docs.columns), names)), schema).unionByName(kept)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
