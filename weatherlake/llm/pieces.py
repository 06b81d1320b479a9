"""Sampled SentencePiece segmentations without replacement, and decoding.

A segmentation of a text is a path through the lattice of vocabulary pieces.
Its probability is the product of its pieces' probabilities, which follow
Zipf's law in the rank that the model file gives them (a temperature flattens
or sharpens it), normalised over all paths by backward sums.

Gumbel top-k draws k distinct segmentations at once: every path's log
probability is perturbed by Gumbel noise and the k largest win.  A* search
finds them without listing paths: the noise of a whole subtree is known from
its total probability alone, so the frontier holds exact upper bounds.

The search tree branches by segment: the text is cut where no piece of the
vocabulary spans two neighbouring bytes, and segments are independent.  From a
frontier node the search goes straight down, one sampled alternative per
segment; what was not taken at a segment becomes one node (all alternatives
together), whose bound is a Gumbel variable truncated at its parent's value.
The segments of many documents go down together as arrays; lattices are built
once per distinct segment of a batch.

All noise comes from a hash of (seed, row key, sample, segment, step): a row
gives the same samples wherever and whenever it is computed.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm import textarrays as ta
from weatherlake.llm.shared import extended, modest_batches, table, tidy
from weatherlake.llm.textarrays import U

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁".encode()
SLICE = 1 << 18  # bytes of text that go down together


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as byte strings (the blank mark is a blank), their log
    probabilities, and the ids of the 256 byte pieces."""
    pieces: tuple[bytes, ...]
    log_prob: np.ndarray
    bytes_at: np.ndarray
    plain: np.ndarray  # which pieces match text; the others are control pieces and bytes

    @staticmethod
    def load(path: str, temperature: float = 1.0) -> Vocabulary:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        special = np.array([p.is_control(i) or p.is_unknown(i) or p.is_unused(i) for i in range(n)])
        byte = np.array([p.is_byte(i) for i in range(n)])
        names = [p.id_to_piece(i) for i in range(n)]
        pieces = tuple(bytes([int(x[3:5], 16)]) if b else b"" if s else x.encode().replace(MARK, b" ")
                       for x, b, s in zip(names, byte, special, strict=True))
        plain = ~special & ~byte
        rank = np.full(n, plain.sum() + 1.0)  # byte pieces are as rare as the last piece
        order = np.argsort([-p.get_score(i) if plain[i] else np.inf for i in range(n)], kind="stable")
        rank[order[:plain.sum()]] = np.arange(1, plain.sum() + 1)
        weight = np.where(special, 0.0, 1.0 / (rank + 2.7))
        with np.errstate(divide="ignore"):
            log_prob = np.log(weight / weight.sum()) / temperature
        bytes_at = np.zeros(256, np.int32)
        for i in np.flatnonzero(byte):
            bytes_at[pieces[i][0]] = i
        return Vocabulary(pieces, log_prob, bytes_at, plain)


class Trie:
    """Byte trie of the plain pieces as one sorted transition table, and which
    byte pairs occur within a piece."""

    def __init__(self, vocabulary: Vocabulary):
        at: dict[bytes, int] = {b"": 0}
        step: dict[int, int] = {}
        self.inside = np.zeros((256, 256), bool)
        ends: dict[int, int] = {}
        for i in np.flatnonzero(vocabulary.plain):
            piece = vocabulary.pieces[i]
            for k in range(1, len(piece) + 1):
                if piece[:k] not in at:
                    at[piece[:k]] = len(at)
                    step[at[piece[:k - 1]] << 8 | piece[k - 1]] = at[piece[:k]]
                if k > 1:
                    self.inside[piece[k - 2], piece[k - 1]] = True
            ends[at[piece]] = int(i)
        size = 1 << (2 * len(step) - 1).bit_length()
        self.mask = size - 1
        self.key, self.to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        for k, v in step.items():
            slot = self._slot(np.array([k]))[0]
            while self.key[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.key[slot], self.to[slot] = k, v
        self.piece = np.full(len(at), -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        # the nodes after one byte and after two, without a search
        self.one, self.two = np.full(256, -1, np.int32), np.full(1 << 16, -1, np.int32)
        for head, v in at.items():
            if len(head) == 1:
                self.one[head[0]] = v
            elif len(head) == 2:
                self.two[head[0] << 8 | head[1]] = v

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(U) * U(0x9E3779B97F4A7C15)) >> U(32)).astype(np.int64) & self.mask

    def follow(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node after a byte, -1 where no piece goes on."""
        key = node.astype(np.int64) << 8 | byte
        slot, out = self._slot(key), np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self.key[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.to[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out


_WIDTH = np.select([np.arange(256) < b for b in (0x80, 0xC0, 0xE0, 0xF0)], [1, 0, 2, 3], 4).astype(np.int8)  # bytes of a character, by its first


class Lattices:
    """Lattices of distinct segments.  Node i is a byte position; its edges
    ``first[i]:first[i + 1]`` are sorted by falling probability."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary, trie: Trie):
        length = ends - starts
        self.root = np.concatenate(([0], np.cumsum(length + 1)))[:-1]  # one node more per segment: its end
        n = int((length + 1).sum())
        place = np.arange(n)
        last = self.root + length  # the ends of the segments
        left = np.repeat(last, length + 1) - place  # bytes up to the end of the segment
        text = data[np.minimum(np.repeat(starts - self.root, length + 1) + place, len(data) - 1)]
        text[last] = 0
        inner = left > 0
        src, dst, piece = [], [], []
        live, node = place[inner], np.zeros(0, np.int32)
        covered = np.zeros(n + 4, bool)  # bytes of characters that are pieces themselves
        char = _WIDTH[text]
        depth = 0
        while len(live):
            if depth == 0:
                node = trie.one[text[live]]
            elif depth == 1:
                node = trie.two[text[live].astype(np.int32) << 8 | text[live + 1]]
            else:
                node = trie.follow(node, text[live + depth])
            depth += 1
            keep = node >= 0
            live, node = live[keep], node[keep]
            full = trie.piece[node] >= 0
            src.append(live[full])
            dst.append(live[full] + depth)
            piece.append(trie.piece[node[full]])
            if depth <= 4:
                one = src[-1][char[src[-1]] == depth]
                for b in range(depth):
                    covered[one + b] = True
            more = left[live] > depth
            live, node = live[more], node[more]
        bare = place[inner & ~covered[:n]]
        src.append(bare)
        dst.append(bare + 1)
        piece.append(vocabulary.bytes_at[text[bare]])
        # the edges of a node one after another, short ones first: a node has one edge of each length, and one byte
        degree = np.zeros(n, np.int64)
        for some in src:
            degree[some] += 1
        free = np.cumsum(degree) - degree
        to, edge = np.empty(int(degree.sum()), place.dtype), np.empty(int(degree.sum()), np.int32)
        for some, ends_at, kind in zip(src, dst, piece, strict=True):
            slot = free[some]
            to[slot], edge[slot] = ends_at, kind
            free[some] += 1
        src, dst, piece = np.repeat(place, degree), to, edge
        weight = vocabulary.log_prob[piece]
        # backward sums, from the ends of the segments
        total = np.where(inner, -np.inf, 0.0)
        level = left[src]
        most = int(left.max(initial=0))
        order = np.argsort(level.astype(np.uint16) if most < 1 << 16 else level, kind="stable")  # few bits are sorted faster
        by_src, by_dst, by_weight = src[order], dst[order], weight[order]
        cuts = np.concatenate(([0], np.cumsum(np.bincount(level, minlength=most + 1)[1:]))).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                own = by_src[a:b]
                value = by_weight[a:b] + total[by_dst[a:b]]
                head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                top = np.maximum.reduceat(value, head)
                size = np.diff(np.append(head, b - a))
                safe = np.where(np.isfinite(top), top, 0.0)
                with np.errstate(divide="ignore"):
                    total[own[head]] = safe + np.log(np.add.reduceat(np.exp(value - np.repeat(safe, size)), head))
        log_p = weight + total[dst] - total[src]
        good = np.isfinite(log_p)
        src, dst, piece, log_p = src[good], dst[good], piece[good], log_p[good]
        p = np.exp(log_p)
        order = np.argsort(src - 0.999 * p, kind="stable")
        self.to, self.piece, self.log_p = dst[order].astype(np.int32), piece[order], log_p[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(src, minlength=n)))).astype(np.int64)
        self.cum = p[order]
        degree, depth = np.diff(self.first), 1
        while True:  # edge by edge: the sums of a node do not depend on its neighbours
            here = self.first[:-1][degree > depth] + depth
            if not len(here):
                break
            self.cum[here] += self.cum[here - 1]
            depth += 1
        last = self.first[1:][np.diff(self.first) > 0] - 1
        self.cum[last] = 2.0  # rounding never runs past the last edge
        self.end = ~inner

    def joined(self, more: Lattices) -> Lattices:
        """Both sets of lattices as one; those of ``more`` come after ours."""
        both = object.__new__(Lattices)
        nodes, edges = len(self.end), len(self.to)
        both.root = np.concatenate((self.root, more.root + nodes))
        both.first = np.concatenate((self.first[:-1], more.first + edges))
        both.to = np.concatenate((self.to, more.to + np.int32(nodes)))
        for name in ("piece", "log_p", "cum", "end"):
            setattr(both, name, np.concatenate((getattr(self, name), getattr(more, name))))
        return both

    def descend(self, segment: np.ndarray, noise: Callable[[np.ndarray, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One sampled path per entry: log probabilities, piece counts, and
        the pieces of all entries one after another."""
        node = self.root[segment]
        log_p, count = np.zeros(len(segment)), np.zeros(len(segment), np.int64)
        live = np.arange(len(segment))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        depth = 0
        while len(live):
            edge = self.first[node]
            u = noise(live, depth)
            behind = np.flatnonzero(u >= self.cum[edge])
            while len(behind):
                edge[behind] += 1
                behind = behind[u[behind] >= self.cum[edge[behind]]]
            log_p[live] += self.log_p[edge]
            count[live] += 1
            steps.append((live, self.piece[edge]))
            node = self.to[edge]
            going = ~self.end[node]
            live, node = live[going], node[going]
            depth += 1
        at = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        for depth, (entries, pieces) in enumerate(steps):
            out[at[entries] + depth] = pieces
        return log_p, count, out

    def other(self, segment: int, taken: list[tuple[int, ...]], u: Callable[[int], float]) -> tuple[list[int], float, float]:
        """A path other than those in ``taken``, drawn from the rest, its log
        probability, and the probability that is left without it."""
        node, prefix, rest = int(self.root[segment]), 1.0, list(taken)
        share = [self.probability(segment, t) for t in taken]
        spent = sum(share)
        path: list[int] = []
        log_p, step = 0.0, 0
        while not self.end[node]:
            a, b = int(self.first[node]), int(self.first[node + 1])
            mass = []
            for e in range(a, b):
                m = prefix * float(np.exp(self.log_p[e]))
                m -= sum(s for t, s in zip(rest, share, strict=True) if t[len(path)] == self.piece[e])
                mass.append(max(m, 0.0) if m > 1e-12 * prefix else 0.0)
            if sum(mass) <= 0.0:  # rounding only: take the likeliest open edge
                mass = [float(np.exp(self.log_p[e])) if all(t[len(path)] != self.piece[e] for t in rest) else 0.0 for e in range(a, b)]
                if sum(mass) <= 0.0:
                    mass = [float(np.exp(self.log_p[e])) for e in range(a, b)]
            x = u(step) * sum(mass)
            k = 0
            while k < len(mass) - 1 and (x >= mass[k] or mass[k] == 0.0):
                x -= mass[k]
                k += 1
            e = a + k
            keep = [(t, s) for t, s in zip(rest, share, strict=True) if t[len(path)] == self.piece[e]]
            rest, share = [t for t, _ in keep], [s for _, s in keep]
            path.append(int(self.piece[e]))
            prefix *= float(np.exp(self.log_p[e]))
            log_p += float(self.log_p[e])
            node, step = int(self.to[e]), step + 1
        return path, log_p, max(0.0, 1.0 - spent - float(np.exp(log_p)))

    def probability(self, segment: int, path: tuple[int, ...]) -> float:
        node, total = int(self.root[segment]), 0.0
        for piece in path:
            a, b = int(self.first[node]), int(self.first[node + 1])
            e = a + int(np.flatnonzero(self.piece[a:b] == piece)[0])
            total += float(self.log_p[e])
            node = int(self.to[e])
        return float(np.exp(total))


_START = U(0x6A09E667F3BCC909)


def _state(x: np.ndarray | np.uint64, *parts: np.ndarray | int) -> np.ndarray:
    """A hash that goes on from ``x`` with the parts."""
    for p in parts:
        x = ta.mix(np.asarray(p).astype(U) * U(0x9E3779B97F4A7C15) + x)
    return x


def _number(x: np.ndarray) -> np.ndarray:
    """A hash as numbers in (0, 1)."""
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) from a hash of the parts."""
    return _number(_state(_START, *parts))


def _below(bound: np.ndarray, mass: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel variable of log mass ``mass`` that is at most ``bound``."""
    return -np.logaddexp(-bound, np.log(-np.log(u)) - mass)


def _uniform_one(*parts: int) -> float:
    """``_uniform`` of single numbers."""
    x, top = 0x6A09E667F3BCC909, 2**64 - 1
    for p in parts:
        x = (p * 0x9E3779B97F4A7C15 + x) & top
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & top
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & top
        x ^= x >> 31
    return ((x >> 11) + 0.5) * 2.0**-53


KEPT_NODES = 1 << 18  # lattices of frequent segments that are kept between batches


class Sampler:
    def __init__(self, vocabulary: Vocabulary, k: int, seed: int):
        self.kept: tuple[np.ndarray, np.ndarray, Lattices] | None = None
        self.vocabulary, self.trie, self.k, self.seed = vocabulary, Trie(vocabulary), k, seed
        self.names = np.array(vocabulary.pieces, object)

    def prepared(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Blank-prefixed bytes of non-empty texts, with marks as blanks."""
        parts = [b" " + t.encode().replace(MARK, b" ") if t else b"" for t in texts]
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = np.ones(len(data), bool)
        if len(data) > 1:
            new[1:] = ~self.trie.inside[data[:-1], data[1:]]
            # pieces of blanks and a word do not exist: a word starts at its last blank
            new[1:] |= (data[1:] == 32) & (data[:-1] != 32)
        rows = offsets[:-1][np.diff(offsets) > 0]
        new[rows] = True
        starts = np.flatnonzero(new)
        return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of some ids, with the blank prefix."""
        return b"".join(self.names[ids].tolist())

    def lattices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[Lattices, np.ndarray]:
        """Lattices for the distinct segments, and which one each segment has."""
        h, one, kind = np.unique(ta.hashes(data, starts, ends), return_index=True, return_inverse=True)
        if self.kept is None or len(h) == 0:
            known, number, lattice = np.zeros(0, U), np.zeros(0, np.int64), None
        else:
            known, number, lattice = self.kept
        at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
        fresh = known[at] != h if len(known) else np.ones(len(h), bool)
        which = np.zeros(len(h), np.int64)
        if len(known):
            which[~fresh] = number[at[~fresh]]
        which[fresh] = np.arange(int(fresh.sum())) + (len(lattice.root) if lattice else 0)
        if fresh.any():
            new = Lattices(data, starts[one[fresh]], ends[one[fresh]], self.vocabulary, self.trie)
            lattice = lattice.joined(new) if lattice else new
            if len(lattice.end) <= KEPT_NODES:
                merged = np.concatenate((known, h[fresh]))
                order = np.argsort(merged)
                self.kept = merged[order], np.concatenate((number, which[fresh]))[order], lattice
        return lattice, which[kind]

    def sample(self, data: np.ndarray, offsets: np.ndarray, key: np.ndarray) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Per row up to k of (ids, log probability, perturbed value, log inclusion)."""
        starts, ends, ranges = self.segments(data, offsets)
        rows = len(offsets) - 1
        if len(starts) == 0:
            return [[(np.zeros(0, np.int32), 0.0, float(g), 0.0)] for g in -np.log(-np.log(_uniform(ta.mix(key.astype(U) + U(self.seed)), 0, 0)))]
        lattice, kind = self.lattices(data, starts, ends)
        row = np.repeat(np.arange(rows), np.diff(ranges))
        place = np.arange(len(starts)) - ranges[row]
        key = ta.mix(key.astype(U) + U(self.seed))
        out: list[list] = [[] for _ in range(rows)]
        frontier: list[list[tuple]] = [[] for _ in range(rows)]
        root = -np.log(-np.log(_uniform(key, 0, 0)))
        base = {r: None for r in range(rows)}
        active = np.arange(rows)
        value, cut = root.copy(), np.full(rows, -1, np.int64)  # segments after ``cut`` are drawn anew
        for j in range(self.k):
            if len(active) == 0:
                break
            entry = np.concatenate([np.arange(ranges[r] + cut[r] + 1, ranges[r + 1]) for r in active]) if j else np.arange(len(starts))
            # what the hashes of all steps begin with, by row and then by segment
            begun = _state(_state(_START, ta.mix(key ^ U(j + 1)))[row[entry]], place[entry])
            log_p, count, pieces = lattice.descend(kind[entry], lambda live, step, s=begun: _number(_state(s[live], step)))
            piece_at = np.concatenate(([0], np.cumsum(count)))
            start = 0
            u = _number(_state(begun, 1 << 20))
            rest = np.log(np.maximum(-np.expm1(np.minimum(log_p, 0.0)), 1e-300))
            rest[log_p > -1e-13] = -np.inf  # the only path there is
            for r in active:
                n = int(ranges[r + 1] - ranges[r] - cut[r] - 1)
                a, b = start, start + n
                start = b
                if j == 0:
                    words, head_log = log_p[a:b], 0.0
                    path = (piece_at[a:b + 1] - piece_at[a], words)
                else:
                    parent, w, alternative, alt_log = base[r]
                    p_at, p_words = parent["path"]
                    head_ids = np.concatenate((parent["ids"][:p_at[w]], np.array(alternative, np.int32)))
                    words = np.concatenate((p_words[:w], [alt_log], log_p[a:b]))
                    head_log = float(words[:w + 1].sum())
                    head = np.append(p_at[:w + 1], p_at[w] + len(alternative))
                    path = (np.concatenate((head[:-1], head[-1] + piece_at[a:b + 1] - piece_at[a])), words)
                ids = np.concatenate((head_ids, pieces[piece_at[a]:piece_at[b]])) if j else pieces[piece_at[a]:piece_at[b]]
                before = head_log + np.concatenate(([0.0], np.cumsum(log_p[a:b])[:-1])) if n else np.zeros(0)
                bounds = _below(np.full(n, value[r]), before + rest[a:b], u[a:b])
                this = {"ids": ids, "path": path, "value": float(value[r]), "log": float(words.sum())}
                out[r].append(this)
                if n:
                    top = np.argpartition(-bounds, self.k)[:self.k + 1] if n > self.k + 1 else np.arange(n)
                    for t in top.tolist():
                        if bounds[t] > -np.inf and np.isfinite(rest[a + t]):
                            heapq.heappush(frontier[r], (-float(bounds[t]), len(out[r]) - 1, t + int(cut[r]) + 1, None))
            following = []
            for r in active.tolist():
                if j + 1 == self.k or not frontier[r]:
                    continue
                negative, which, w, taken = heapq.heappop(frontier[r])
                parent = out[r][which]
                segment = int(kind[ranges[r] + w])
                p_at, p_words = parent["path"]
                chosen = tuple(parent["ids"][p_at[w]:p_at[w + 1]].tolist())
                taken = [*(taken or []), *([chosen] if not taken else [])]
                alternative, alt_log, spare = lattice.other(
                    segment, taken, lambda step, r=r, w=w, j=j: _uniform_one(int(key[r]), j + 1, w, step, 77))
                value[r], cut[r] = -negative, w
                base[r] = (parent, w, alternative, alt_log)
                if spare > 1e-12:
                    mass = float(p_words[:w].sum()) + np.log(spare)
                    u1 = _uniform_one(int(key[r]), j + 1, w, 1 << 21)
                    more = -float(np.logaddexp(-value[r], np.log(-np.log(u1)) - mass))
                    heapq.heappush(frontier[r], (-more, which, w, [*taken, tuple(alternative)]))
                following.append(r)
            active = np.array(following, np.int64)
        result = []
        for r in range(rows):
            kappa = -frontier[r][0][0] if frontier[r] and len(out[r]) == self.k else -np.inf
            result.append([(s["ids"], s["log"], s["value"], _log_inclusion(s["log"] - kappa)) for s in out[r]])
        return result


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), the log probability that a path's perturbed value is above the threshold."""
    if x > 3:
        return 0.0 if x > 7 else float(np.log1p(-np.exp(-np.exp(x))))
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))


@lru_cache(maxsize=2)
def _sampler(model: str, temperature: float, k: int, seed: int) -> Sampler:
    """One sampler per Python worker."""
    return Sampler(Vocabulary.load(model, temperature), k, seed)


SAMPLES = "samples array<struct<ids: array<int>, log_prob: double, perturbed: double, log_inclusion: double>>, round_trip boolean"


def sample_segmentations(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = 2, seed: int = 0,
                         model: str = MODEL, temperature: float = 1.0) -> DataFrame:
    """``docs`` with ``samples``, up to ``k`` distinct segmentations of the
    whole text in falling order of their perturbed value, and ``round_trip``
    (whether each of them decodes to the text).

    Each sample holds the piece ids, the log probability of the segmentation,
    its perturbed value, and the log of its inclusion probability given the
    (k + 1)-th value (0 if all segmentations were listed).  Equal row keys and
    texts give equal samples.  The empty text has one segmentation without
    pieces; a null text has a null list and a null ``round_trip``; a null key
    counts as -1.  The blank mark U+2581 in a text is a blank, as in
    SentencePiece.  All rows and columns are kept; input columns with one of
    the two names are replaced.
    """
    docs = docs.drop("samples", "round_trip")
    where = docs.columns.index(text), docs.columns.index(id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(model, temperature, k, seed)
        for batch in batches:
            _, sizes = ta.buffers(batch.column(where[0]))
            for i, j in ta.slices(sizes, SLICE):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *_sampled(sampler, part.column(where[0]), part.column(where[1]))],
                                                 names=[*part.schema.names, "samples", "round_trip"])

    return docs.mapInArrow(tidy(run), extended(docs.schema, SAMPLES))


def _sampled(sampler: Sampler, texts: pa.Array, ids: pa.Array) -> tuple[pa.Array, pa.Array]:
    there = np.array([t is not None for t in texts.to_pylist()], bool)
    data, offsets = sampler.prepared(texts.fill_null("").to_pylist())
    key = ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(U)
    found = sampler.sample(data, offsets, key)
    trip = []
    for r, samples in enumerate(found):
        own = data[offsets[r]:offsets[r + 1]].tobytes()
        trip.append(all(sampler.decode(s[0]) == own for s in samples))
    flat = [s for r, samples in enumerate(found) if there[r] for s in samples]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(s[0]) for s in flat]))).astype(np.int32)),
                                     pa.array(np.concatenate([s[0] for s in flat]) if flat else np.zeros(0, np.int32)))
    struct = pa.StructArray.from_arrays([lists, *[pa.array([s[c] for s in flat], pa.float64()) for c in (1, 2, 3)]],
                                        names=["ids", "log_prob", "perturbed", "log_inclusion"])
    at = np.concatenate(([0], np.cumsum([len(s) if t else 0 for s, t in zip(found, there, strict=True)]))).astype(np.int32)
    samples = pa.ListArray.from_arrays(pa.array(at), struct, mask=pa.array(~there))
    return samples, pa.array([bool(x) if t else None for x, t in zip(trip, there, strict=True)], pa.bool_())


def decode_pieces(docs: DataFrame, ids: str = "ids", *, model: str = MODEL) -> DataFrame:
    """``docs`` with ``decoded``, the text of an id array: byte pieces become
    bytes (what is not UTF-8 becomes U+FFFD), marks become blanks and the
    blank before the text goes.  Control ids have no text; a null array gives
    null, an empty one the empty text; an id out of range is an error."""
    docs = docs.drop("decoded")
    column = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Vocabulary.load(model).pieces
        for batch in batches:
            texts = [None if x is None else b"".join([pieces[i] for i in x]).removeprefix(b" ").decode("utf-8", "replace")
                     for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return docs.mapInArrow(tidy(run), extended(docs.schema, "decoded string"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return sample_segmentations(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.size("samples").alias("n_samples"), "samples", "round_trip")
