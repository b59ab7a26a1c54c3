"""SentencePiece encoding and decoding with Gumbel top-k sampling without replacement.

The pieces of a published vocabulary span a lattice over a text (a space is
``▁``, one ``▁`` stands in front, characters without a piece become byte
pieces).  A path's probability is proportional to the product of its pieces'
``(1 + rank) ** -alpha``, rank being the negated score of the vocabulary file.

The ``k`` distinct segmentations with the largest Gumbel-perturbed log
probabilities are found by an A* search: each agenda entry is a set of paths
(those that agree with an emitted path up to a piece and differ there, or
somewhere in a stretch behind it) keyed by the exact maximum of its perturbed
values, a Gumbel variate at the set's log mass, truncated at its parent's key.
The best entry yields its best path (a draw from the set) and is split into the
sets that remain.  Keys come out in falling order, so no path comes twice and
the result is a sample without replacement in Plackett-Luce order.  The key that would
come next, kappa, gives the inclusion score log(1 - exp(-exp(log p - kappa))).

Exact backward sums over the lattice make all draws and masses exact.  No piece
reaches across the start of a run of ``▁`` (checked when the vocabulary is
loaded), so the lattice is a chain of independent units; sums are computed once
for the distinct units of a batch, and the free part of every draw runs over
all units of a batch at once.  All randomness is a function of the row key and the place
in the text: results depend neither on partitions nor on retries.

Defined cases: a null or empty text has one segmentation, without pieces, of
probability 1; ``▁`` in a text is taken as a space, by ``round_trip`` too, and
decodes to one; a text with fewer than ``k`` segmentations yields all of them,
with inclusion score 0; equal keys give equal draws; a null key is a key of its
own; a very long text comes alone in its batch and is read whole (a long stretch
without a space is one unit, summed and walked position by
position in time linear in its length); an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import table

MODEL = "piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 0.5
SEED = 17
BATCH_CHARS = 3 << 19
LONG_UNIT = 512  # longer units are summed position by position
BLOCK = 1 << 16  # positions of a long unit at a time
PART = 1 << 16  # positions of units that are built at a time
FEW = 4  # so few draws that go on are walked one by one
MASK = (1 << 64) - 1
DENSE = 3  # prefixes shorter than this are looked up in a dense table
SPACE = "▁"
UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
SCHEMA = ("doc_id bigint, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, "
          "round_trip boolean")


def model_path(name: str = MODEL) -> str:
    """The installed file of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces as a trie in sorted arrays: (state << 21 | code point) -> state."""

    def __init__(self, path: str, alpha: float = ALPHA):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, model.unk_id(), dtype=np.int32)
        self.bytes_of: dict[int, int] = {}
        child: dict[int, int] = {}
        piece_of, score_of = [-1], [0.0]
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, value
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                raise ValueError(f"piece {i} reaches across units")
            state = 0
            for c in piece:
                key = state << 21 | ord(c)
                if key not in child:
                    child[key] = len(piece_of)
                    piece_of.append(-1)
                    score_of.append(0.0)
                state = child[key]
            piece_of[state] = i
            score_of[state] = -alpha * math.log1p(min(max(-model.get_score(i), 0.0), n))
        self._number(child, piece_of, score_of, n, alpha)
        self.control = {i for i in range(n) if model.is_control(i)}
        # what each piece stands for in a decoded text, in UTF-8
        self.spelt = np.array([bytes([self.bytes_of[i]]) if i in self.bytes_of else b"" if i in self.control else
                               piece.replace(SPACE, " ").encode() for i, piece in enumerate(self.pieces)], dtype=object)

    def _number(self, child: dict[int, int], piece_of: list, score_of: list, n: int, alpha: float) -> None:
        """Arrays of the trie; states of prefixes shorter than ``DENSE`` come first and have rows of a
        dense table over the commonest characters, the others are found by binary search."""
        depth = [0] * len(piece_of)
        for key, state in child.items():  # parents come before their children
            depth[state] = depth[key >> 21] + 1
        order = sorted(range(len(depth)), key=lambda s: (depth[s] >= DENSE, s))
        new = {s: k for k, s in enumerate(order)}
        child = {new[key >> 21] << 21 | key & 0x1FFFFF: new[state] for key, state in child.items()}
        piece_of, score_of = [piece_of[s] for s in order], [score_of[s] for s in order]
        self.keys = np.array(sorted(child), dtype=np.int64)
        self.next = np.array([child[k] for k in sorted(child)], dtype=np.int32)
        self.piece_of = np.array(piece_of, dtype=np.int32)
        self.score_of = np.array(score_of)
        self.byte_score = -alpha * math.log1p(n)
        common = [c for c in range(0x250) if c != 0x24F] + [ord(SPACE)]
        self.column = np.full(0x110000, len(common), dtype=np.int16)
        self.column[common] = np.arange(len(common))
        self.dense = np.full((sum(d < DENSE for d in depth), len(common) + 1), -1, dtype=np.int32)
        for key, state in child.items():
            if key >> 21 < len(self.dense) and self.column[key & 0x1FFFFF] < len(common):
                self.dense[key >> 21, self.column[key & 0x1FFFFF]] = state
        self.common = len(common)

    def step(self, state: np.ndarray, codes: np.ndarray, columns: np.ndarray, size: int) -> np.ndarray:
        """The next states after one more character; -1 where there is none.  All
        states belong to prefixes of ``size`` characters."""
        if size >= DENSE:
            return self._search(state, codes)
        out = self.dense[state, columns]
        rare = np.flatnonzero(columns == self.common)
        out[rare] = self._search(state[rare], codes[rare])
        return out

    def _search(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) << 21 | codes
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[found] == key, self.next[found], -1)

    def decode(self, ids) -> str:
        """The text of piece ids; bytes that are no UTF-8 become U+FFFD."""
        # a piece begins and ends with whole characters, so bytes beside it stay as wrong as they were alone
        text = b"".join([self.spelt[int(i)] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    def spells(self, ids: np.ndarray, text: str) -> bool:
        """Whether the ids decode to a text."""
        return b"".join(self.spelt[ids].tolist()) == b" " + text.encode() or self.decode(ids) == text


@lru_cache(maxsize=4)
def vocabulary(path: str, alpha: float) -> Vocabulary:
    return Vocabulary(path, alpha)


def units(text: str) -> list[str]:
    return UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _salt(step: int) -> int:
    return (step * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & MASK


class Lattice:
    """Edges and exact backward sums of many distinct units, laid end to end."""

    def __init__(self, words: list[str], vocab: Vocabulary):
        """Built for some units at a time, whose arrays stay in the processor's cache."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        cuts = np.searchsorted(np.cumsum(lengths), np.arange(PART, int(lengths.sum()), PART), side="right").tolist()
        bounds = sorted({0, *cuts, len(words)})
        parts, codes, edges = [], 0, 0
        for a, b in zip(bounds, bounds[1:] or [0]):
            part = _Part(words[a:b], lengths[a:b], vocab)
            parts.append((part.codes, part.start_of + codes, part.first[:-1] + edges, part.target + codes, part.piece,
                          part.last_piece, part.log_share, part.reach))
            codes, edges = codes + len(part.codes), edges + len(part.target)
        (self.codes, self.start_of, first, self.target, self.piece, self.last_piece, self.log_share,
         self.reach) = (np.concatenate(arrays) for arrays in zip(*parts))
        self.first = np.r_[first, edges]

    def walk(self, of: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A free draw for each occurrence (``of``: its unit, ``key``: its random
        key): the edges of all, end to end, and the offsets of the occurrences."""
        at = self.start_of[of]
        alive = np.arange(len(of))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(of), dtype=np.int64)
        while len(alive) > FEW:
            salt = np.uint64(_salt(len(steps)))
            u = (_mix(key[alive] + salt) >> np.uint64(11)) * (1.0 / (1 << 53))
            edge, last = self.first[at], self.first[at + 1] - 1
            todo = np.flatnonzero((self.reach[edge] <= u) & (edge < last))
            while len(todo):
                edge[todo] += 1
                e = edge[todo]
                todo = todo[(self.reach[e] <= u[todo]) & (e < last[todo])]
            steps.append((alive, edge))
            count[alive] += 1
            more = ~self.last_piece[edge]
            at, alive = self.target[edge[more]], alive[more]
        # the few that go on are walked one by one, to the same edges
        rest = {int(row): self._walk_on(int(a), int(key[row]), len(steps)) for row, a in zip(alive, at)}
        for row, edges in rest.items():
            count[row] += len(edges)
        offset = np.r_[0, np.cumsum(count)]
        path = np.empty(offset[-1], dtype=np.int64)
        for row, edges in rest.items():
            path[offset[row + 1] - len(edges):offset[row + 1]] = edges
        for t, (rows, edge) in enumerate(steps):
            path[offset[rows] + t] = edge
        return path, offset

    def _walk_on(self, at: int, key: int, step: int) -> list[int]:
        """One occurrence's draw from a position to its unit's end, as ``walk`` makes it."""
        first, reach, target, last_piece = self.first, self.reach, self.target, self.last_piece
        path = []
        while True:
            x = (key + _salt(step)) & MASK
            x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
            x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
            u = ((x ^ x >> 31) >> 11) * (1.0 / (1 << 53))
            edge, last = int(first[at]), int(first[at + 1]) - 1
            while edge < last and reach[edge] <= u:
                edge += 1
            path.append(edge)
            if last_piece[edge]:
                return path
            at = int(target[edge])
            step += 1

    def finish(self, at: int, rng: random.Random) -> list[int]:
        """A free draw from a position to the end of its unit."""
        path = []
        while True:
            u, a, b = rng.random(), int(self.first[at]), int(self.first[at + 1])
            edge = a
            while edge < b - 1 and self.reach[edge] <= u:
                edge += 1
            path.append(edge)
            if self.last_piece[edge]:
                return path
            at = int(self.target[edge])

    def ids(self, path: np.ndarray, vocab: Vocabulary) -> np.ndarray:
        ids = self.piece[path]
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids
        spelt = [vocab.byte_ids[list(chr(self.codes[self.target[e] - 1]).encode("utf-8", "replace"))] for e in path[bare]]
        widths = np.ones(len(ids), dtype=np.int64)
        widths[bare] = [len(s) for s in spelt]
        out = np.repeat(ids, widths)
        out[out < 0] = np.concatenate(spelt)
        return out


class _Part:
    """The lattice of some units."""

    def __init__(self, words: list[str], lengths: np.ndarray, vocab: Vocabulary):
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)
        ends = np.cumsum(lengths)
        self.codes, self.start_of = codes, ends - lengths
        self.end = np.repeat(ends.astype(np.int32), lengths)  # of the unit of each position
        columns = vocab.column[codes]
        starts, sizes, pieces, scores = [], [], [], []
        at, state = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), dtype=np.int32)
        bare = np.ones(len(codes), dtype=bool)
        size = 0
        while len(at):
            state = vocab.step(state, codes[at + size], columns[at + size], size)
            ok = np.flatnonzero(state >= 0)
            at, state = at[ok], state[ok]
            size += 1
            piece = vocab.piece_of[state]
            has = piece >= 0
            starts.append(at[has])
            sizes.append(np.full(len(starts[-1]), size, dtype=np.int16))
            pieces.append(piece[has])
            scores.append(vocab.score_of[state[has]])
            if size == 1:
                bare[starts[-1]] = False
            more = at + size < self.end[at]
            at, state = at[more], state[more]
        alone = np.flatnonzero(bare)
        width = 1 + (codes[alone] > 0x7F) + (codes[alone] > 0x7FF) + (codes[alone] > 0xFFFF)
        starts.append(alone.astype(np.int32))
        sizes.append(np.ones(len(alone), dtype=np.int16))
        pieces.append(np.full(len(alone), -1, dtype=np.int32))
        scores.append(vocab.byte_score * width)
        # longest first: the first edge of a position is mostly the one drawn
        # (a position has one edge of each size: each is put straight into its place)
        counts = np.zeros(len(codes), dtype=np.int64)
        for at in starts:
            counts[at] += 1
        self.first = np.r_[0, np.cumsum(counts)]
        free, total = self.first[:-1].copy(), int(self.first[-1])
        start, self.target = np.empty(total, dtype=np.int32), np.empty(total, dtype=np.int32)
        self.piece, score = np.empty(total, dtype=np.int32), np.empty(total)
        while starts:
            at = starts.pop()
            place = free[at]
            free[at] += 1
            start[place], self.target[place] = at, at + sizes.pop()
            self.piece[place], score[place] = pieces.pop(), scores.pop()
        del free, counts, at, state
        self.last_piece = self.target == self.end[start]
        self._sums(start, score, np.flatnonzero(lengths > LONG_UNIT))

    def _long_sums(self, unit: int, score: np.ndarray, beta: np.ndarray) -> None:
        """The sums of one long unit, position by position from its end, in blocks."""
        start = int(self.start_of[unit])
        end = int(self.end[start])
        sums = [0.0] * (end - start + 1)
        for high in range(end, start, -BLOCK):
            low = max(start, high - BLOCK)
            a, b = int(self.first[low]), int(self.first[high])
            scores, targets = score[a:b].tolist(), (self.target[a:b] - start).tolist()
            first = (self.first[low:high + 1] - a).tolist()
            for at in range(high - low - 1, -1, -1):
                values = [scores[k] + sums[targets[k]] for k in range(first[at], first[at + 1])]
                top = max(values)
                sums[low - start + at] = top + math.log(sum([math.exp(v - top) for v in values]))
        beta[start:end] = sums[:-1]

    def _sums(self, start: np.ndarray, score: np.ndarray, long: np.ndarray) -> None:
        beta = np.zeros(len(self.codes) + 1)  # log sum of the paths from a position to its unit's end
        away = self.end[start] - start
        for unit in long:  # else a step of the loop below would hold a few edges of it only
            self._long_sums(int(unit), score, beta)
            a = int(self.start_of[unit])
            away[self.first[a]:self.first[self.end[a]]] = 0  # their sums are known
        order = np.argsort(away.astype(np.uint16) if len(away) and away.max() < 1 << 16 else away, kind="stable").astype(np.int32)
        away, by = away[order], start[order]
        fresh = np.r_[True, by[1:] != by[:-1]] if len(by) else np.zeros(0, dtype=bool)
        cuts = np.flatnonzero(np.r_[True, away[1:] != away[:-1]]) if len(by) else np.zeros(0, dtype=np.int64)
        for a, b in zip(cuts, np.r_[cuts[1:], len(by)]):
            if not away[a]:
                continue
            edges = order[a:b]
            value = score[edges] + np.where(self.last_piece[edges], 0.0, beta[self.target[edges]])
            heads = np.flatnonzero(fresh[a:b])
            top = np.maximum.reduceat(value, heads)
            widths = np.diff(np.r_[heads, b - a])
            total = np.add.reduceat(np.exp(value - np.repeat(top, widths)), heads)
            beta[by[a:b][heads]] = top + np.log(total)
        del order, away, by, fresh
        score += np.where(self.last_piece, 0.0, beta[self.target])
        score -= beta[start]
        self.log_share = np.minimum(score, 0.0, out=score)  # of an edge among its position's
        self.reach = np.cumsum(np.exp(self.log_share))
        base = np.r_[0.0, self.reach][self.first[:-1]]
        if len(start):
            self.reach -= base[start]


class _Path:
    """An emitted path: edges, offsets of its units, running log probability."""

    def __init__(self, edges: np.ndarray, offsets: np.ndarray, lattice: Lattice):
        self.edges, self.offsets = edges, offsets
        self.log_prob = np.cumsum(lattice.log_share[edges])

    def before(self, j: int) -> float:
        return float(self.log_prob[j - 1]) if j else 0.0


def _log1mexp(x: float) -> float:
    """log(1 - exp(x)) for x <= 0."""
    if x >= 0:
        return -math.inf
    return math.log(-math.expm1(x)) if x > -0.693 else math.log1p(-math.exp(x))


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), which is x to double precision where exp(x) is tiny (and may underflow)."""
    return x if x < -40 else _log1mexp(-math.exp(min(x, 700.0)))


def top_samples(lattice: Lattice, free: list[tuple[np.ndarray, np.ndarray]], rng: random.Random) -> list[tuple]:
    """(edges, log p, perturbed, log inclusion) of at most len(free) distinct
    paths; ``free``: independent draws (edges, unit offsets) of the whole text."""
    agenda: list[tuple] = []

    def gumbel(mass: float) -> float:
        return mass - math.log(rng.expovariate(1.0) or 5e-324)

    def push(mass: float, below: float, *entry) -> None:
        if mass > -math.inf:
            g = gumbel(mass)
            key = -(max(-below, -g) + math.log1p(math.exp(-abs(below - g))))  # truncated at below
            heapq.heappush(agenda, (-key, len(found), len(agenda), rng.random(), entry))

    def push_stretch(path: _Path, low: int, high: int, below: float) -> None:
        """The paths whose first difference from ``path`` lies in low..high."""
        if low <= high:
            base = path.before(low)
            push(base + _log1mexp(float(path.log_prob[high]) - base), below, path, low, high, None)

    def push_fork(path: _Path, j: int, taken: frozenset, below: float) -> None:
        """The paths that agree with ``path`` before j and take none of ``taken`` there."""
        at = int(path.edges[j])
        start = int(np.searchsorted(lattice.first, at, side="right")) - 1
        left = [e for e in range(lattice.first[start], lattice.first[start + 1]) if e not in taken]
        share = math.fsum(math.exp(lattice.log_share[e]) for e in left)
        if left and share > 0:
            push(path.before(j) + math.log(share), below, path, j, j, (taken, left))

    found: list[tuple] = []
    first = _Path(*free[0], lattice)
    key = gumbel(0.0)
    found.append((first, key))
    push_stretch(first, 0, len(first.edges) - 1, key)
    while agenda and len(found) < len(free):
        minus, _, _, _, (path, low, high, fork) = heapq.heappop(agenda)
        key = -minus
        if fork is None:
            base = path.before(low)
            part = -math.expm1(float(path.log_prob[high]) - base) * rng.random()
            falls = -path.log_prob[low:high + 1]
            j = low + min(int(np.searchsorted(falls, -(base + math.log1p(-part)), side="right")), high - low)
            taken = frozenset((int(path.edges[j]),))
            start = int(np.searchsorted(lattice.first, int(path.edges[j]), side="right")) - 1
            left = [e for e in range(lattice.first[start], lattice.first[start + 1]) if e not in taken]
            push_stretch(path, low, j - 1, key)
            push_stretch(path, j + 1, high, key)
            if not left:  # a rounding error chose a place without choice; the rest stays on the agenda
                continue
        else:
            j, (taken, left) = low, fork
        edge = rng.choices(left, [math.exp(lattice.log_share[e]) for e in left])[0]
        edges, offsets = free[len(found)]
        unit = int(np.searchsorted(path.offsets, j, side="right")) - 1
        head = [*path.edges[path.offsets[unit]:j], edge]
        if not lattice.last_piece[edge]:
            head += lattice.finish(int(lattice.target[edge]), rng)
        tail = offsets[unit + 1]
        to = int(path.offsets[unit]) + len(head)
        new = _Path(np.concatenate([path.edges[:path.offsets[unit]], np.array(head, dtype=np.int64), edges[tail:]]),
                    np.concatenate([path.offsets[:unit + 1], offsets[unit + 1:] - tail + to]), lattice)
        found.append((new, key))
        push_fork(path, j, taken | {edge}, key)
        push_stretch(new, j + 1, len(new.edges) - 1, key)
    kappa = -agenda[0][0] if agenda else -math.inf
    out = []
    for path, key in found:
        log_p = path.before(len(path.edges))
        log_inclusion = _log_inclusion(log_p - kappa) if kappa > -math.inf else 0.0
        out.append((path.edges, log_p, key, log_inclusion))
    return out


def row_key(value, seed: int = SEED) -> int:
    return xxhash.xxh64_intdigest("null" if value is None else f"k{value}", seed)


def sample_batch(keys: list, texts: list[str | None], vocab: Vocabulary, k: int, seed: int = SEED) -> Iterator[tuple]:
    """(row, sample, ids, log p, perturbed, log inclusion) of each text, by A* over shared lattices."""
    number: dict[str, int] = {}
    of, ends = [], [0]
    for text in texts:
        of.extend([number.setdefault(u, len(number)) for u in units(text or "")])
        ends.append(len(of))
    lattice = Lattice(list(number), vocab)
    of = np.array(of, dtype=np.int64)
    seeds = [row_key(key, seed) for key in keys]
    place = np.arange(len(of), dtype=np.uint64) - np.repeat(np.array(ends[:-1], dtype=np.uint64), np.diff(ends))
    base = np.repeat(np.array(seeds, dtype=np.uint64), np.diff(ends)) + place * np.uint64(0xD1342543DE82EF95)
    walks = [lattice.walk(of, _mix(base + np.uint64(draw * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))) for draw in range(k)]
    for row, (a, b) in enumerate(zip(ends, ends[1:])):
        if a == b:
            yield row, 0, np.zeros(0, dtype=np.int32), 0.0, 0.0, 0.0
            continue
        free = [(path[offset[a]:offset[b]], offset[a:b + 1] - offset[a]) for path, offset in walks]
        for sample, (edges, *numbers) in enumerate(top_samples(lattice, free, random.Random(seeds[row]))):
            yield row, sample, lattice.ids(edges, vocab), *numbers


def _groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    """Rows of about ``limit`` characters at a time; a longer text comes alone."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            if texts and held + len(text or "") > limit:
                yield keys, texts
                keys, texts, held = [], [], 0
            keys.append(key.as_py())
            texts.append(text)
            held += len(text or "")
    if texts:
        yield keys, texts


def encode_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES,
                   alpha: float = ALPHA, seed: int = SEED, path: str | None = None) -> DataFrame:
    """One row per sampled segmentation: doc_id, sample (0..), ids, log_prob,
    perturbed, log_inclusion, and whether decoding the ids gave the text back
    (``▁`` in it taken as a space)."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, alpha)
        for keys, texts in _groups(batches, BATCH_CHARS):
            rows = list(sample_batch(keys, texts, vocab, k, seed))
            whole = []
            for row, _, ids, *_ in rows:
                whole.append(vocab.spells(ids, (texts[row] or "").replace(SPACE, " ")))
            sizes = np.r_[0, np.cumsum([len(r[2]) for r in rows])].astype(np.int32)
            flat = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, dtype=np.int32)
            yield pa.record_batch(
                [pa.array([keys[r[0]] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat, pa.int32())),
                 *[pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)], pa.array(whole, pa.bool_())],
                names=["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "round_trip"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, ids_col: str = "ids", alpha: float = ALPHA, path: str | None = None) -> DataFrame:
    """``encoded`` with a column ``decoded`` (null where the ids are null)."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, alpha)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = [None if x.as_py() is None else vocab.decode(x.as_py()) for x in ids]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(run, encoded.select("*", F.lit("").alias("decoded")).schema)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_samples(table(spark, sf_dir, "documents"))
