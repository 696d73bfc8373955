"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text's segmentations into pieces of a vocabulary are the paths of a lattice; a path's probability is the product of its
pieces' weights, normalised. Adding Gumbel noise to the log probabilities of all paths and taking the k greatest samples k
distinct segmentations. The noise is never drawn for all: a perturbed A-star search splits the set of paths. The greatest
value of a set is drawn first; then a path below it, piece by piece; and each step leaves the set of paths that take another
piece there, whose greatest value is drawn below its parent's bound. The next sample comes from the left set with the
greatest value. The value of the set after the k-th gives each sample its inclusion score.

The lattice never links across the start of a run of spaces or a character outside the vocabulary, so it falls apart into
units; equal units share their edges and backward sums, and all units of a megabyte of text are walked together in numpy.

The model file's pieces are taken as they are. It holds a BPE order rather than probabilities, so a piece weighs
1 / (RANK_SHIFT + order), and a byte 1 / vocabulary. Encoding is exact: spaces become U+2581 behind one added in front,
and what the vocabulary lacks, a literal U+2581 included, becomes bytes. Random numbers come from hashes of row key, sample
and place; draws have 24 bits, so chances below 2^-24 are met only in what is split off. Null and empty texts have one segmentation, without pieces. A text with fewer than k segmentations gives them
all, each with inclusion 1. Repeated rows give equal samples.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tidewire.llm.arrow_slices import leaving_nothing, slices
from tidewire.session import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The public tokenizer's file, a parameter of load_vocabulary.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
RANK_SHIFT = 3.0
#: Places of remembered units, and bytes of text of a slice.
REMEMBERED, SLICE_BYTES = 250_000, 1 << 18
#: Places whose edges are worked out together, unless one unit alone has more.
EDGE_PLACES = 1 << 16
SPACE, SPACE_MARK = 0x20, 0x2581
#: Codes that stand for bytes, beyond those of characters; a literal space mark is coded as its bytes.
BYTE_CODE = 0x110000
_MULTIPLIER = 0x9E3779B97F4A7C15
_TABLE_BITS = 19
#: Most pieces from a place have so few characters.
FEW_LENGTHS = 6
_BELOW_ONE = np.float32(1 - 2**-24)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as arrays: their codes one after another, ends, log weights, and id by kind."""

    codes: np.ndarray
    ends: np.ndarray
    log_weights: np.ndarray
    ids: np.ndarray


def load_vocabulary(model_file: str = MODEL_FILE) -> Vocabulary:
    """Pieces of a SentencePiece model; read on the driver, as the vocabulary is small and its file may be there alone."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    size = model.vocab_size()
    codes, ends, weights, ids = [], [], [], []
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            codes.append(BYTE_CODE + int(piece[3:5], 16))
            weights.append(-np.log(size))
        else:
            codes.extend(map(ord, piece))
            weights.append(-np.log(RANK_SHIFT - model.get_score(i)))
        ends.append(len(codes))
        ids.append(i)
    return Vocabulary(np.array(codes, np.uint32), np.array(ends), np.array(weights), np.array(ids, np.int32))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 from hashes."""
    return ((_mixed(x) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _gumbel(x: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(_uniform(x)))


class Lattice:
    """Edges of a vocabulary, found by hashes of codes."""

    def __init__(self, vocabulary: Vocabulary):
        starts = np.concatenate(([0], vocabulary.ends[:-1]))
        self.vocabulary, self.starts, self.sizes = vocabulary, starts, vocabulary.ends - starts
        self.longest = -(-int(self.sizes.max()) // 8) * 8  # rows of edges are whole words of bytes
        known: dict[int, int] = {}
        for n, (start, size) in enumerate(zip(starts.tolist(), self.sizes.tolist())):
            key = 0
            for k in range(size):
                key = (key * _MULTIPLIER + int(vocabulary.codes[start + k]) + 1) & (2**64 - 1)
                known.setdefault(key, -1)
            known[key] = n
        self.keys, self.values = np.zeros(1 << _TABLE_BITS, np.uint64), np.full(1 << _TABLE_BITS, -2, np.int32)
        for key, value in known.items():
            at = self._home(np.array([key], np.uint64))[0]
            while self.values[at] != -2:
                at = (at + 1) % (1 << _TABLE_BITS)
            self.keys[at], self.values[at] = key, value
        self.weights = np.append(vocabulary.log_weights, -np.inf)
        self.first = self._find(np.arange(1, BYTE_CODE + 257, dtype=np.uint64)).astype(np.int16)  # of each code by itself
        self.single = np.zeros(BYTE_CODE + 256, bool)
        self.single[vocabulary.codes[starts[self.sizes == 1]]] = True
        self.single[BYTE_CODE:] = False
        self.single[SPACE_MARK] = True

    @staticmethod
    def _home(keys: np.ndarray) -> np.ndarray:
        return (_mixed(keys) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the piece, -1 for a mere prefix, -2 for none."""
        at = self._home(keys)
        found = self.values[at]
        open_ = np.flatnonzero((found != -2) & (self.keys[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) % (1 << _TABLE_BITS)
            found[open_] = self.values[at[open_]]
            open_ = open_[(found[open_] != -2) & (self.keys[at[open_]] != keys[open_])]
        return found

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(codes of all texts, their ends): spaces marked, one in front, unknown characters as bytes."""
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        codes = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(sizes)
        literal = codes == SPACE_MARK
        codes = np.where(codes == SPACE, np.uint32(SPACE_MARK), codes)
        strange = ~self.single[codes] | literal
        if strange.any():
            width = np.where(strange, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), 1)
            if width.max() == 1:
                return np.where(strange, BYTE_CODE + codes, codes).astype(np.uint32), ends
            origin = np.repeat(np.arange(len(codes)), width)
            last = np.cumsum(width)
            rest = (last[origin] - 1 - np.arange(len(origin))).astype(np.uint32)  # bytes that follow in the character
            wide, own = width[origin], codes[origin]
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[wide]
            part = own >> (np.uint32(6) * rest)
            value = np.where(rest == wide - 1, np.where(wide == 1, own, lead | part), 0x80 | (part & np.uint32(0x3F)))
            codes = np.where(strange[origin], BYTE_CODE + value, own).astype(np.uint32)
            ends = np.concatenate(([0], last))[ends]
        return codes, ends

    def units(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts of the units: of texts, of runs of spaces, of bytes and of what follows one."""
        mark, byte = codes == SPACE_MARK, codes >= BYTE_CODE
        start = byte.copy()
        start[1:] |= byte[:-1] | (mark[1:] & ~mark[:-1])
        firsts = np.concatenate(([0], ends[:-1]))
        start[firsts[firsts < len(codes)]] = True
        return np.flatnonzero(start)

    def edges(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of units that lie one after another, at each place: pieces by length, chances added up by length, backward sum."""
        n, total = self.longest, len(codes)
        pieces, longest = np.full((total, n), -1, np.int16), np.zeros(total, np.uint8)
        left = np.repeat(starts + sizes, sizes) - np.arange(total)
        alive, key, rest, found = np.arange(total), codes + np.uint64(1), left, self.first.take(codes)
        for k in range(n):
            if k:
                key = key * np.uint64(_MULTIPLIER) + codes.take(alive + k) + np.uint64(1)
                found = self._find(key)
            whole = np.flatnonzero(found >= 0)
            at = alive.take(whole)
            pieces[at, k] = found.take(whole)
            longest[at] = k + 1
            going = np.flatnonzero((found != -2) & (rest > k + 1))
            if not len(going):
                break
            alive, key, rest = alive.take(going), key.take(going), rest.take(going)
        # Backward sums: all places at one distance from their unit's end at once, those without long pieces apart.
        group = 2 * left + (longest > FEW_LENGTHS)
        if total and group.max() < 1 << 16:
            group = group.astype(np.uint16)  # which numpy sorts by radix
        order = np.argsort(group, kind="stable")
        bounds = np.append(np.flatnonzero(np.diff(group[order].astype(np.int64), prepend=-1)), total)
        by_length, ladder = np.ascontiguousarray(pieces.take(order, axis=0).T), np.ones((n, total), np.float32)
        beta, lengths = np.zeros(total + n + 1), np.arange(1, n + 1)[:, None]
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            at = order[first:last]
            wide = int(longest.take(at).max())
            score = self.weights.take(by_length[:wide, first:last], mode="wrap")
            whole = score[-1].copy()
            score += beta.take(at + lengths[:wide])
            if wide == left[at[0]]:  # these pieces end their units
                score[-1] = whole
            top = score.max(axis=0)
            score -= top
            sums = np.exp(score, out=score)
            for k in range(1, wide):
                sums[k] += sums[k - 1]
            beta[at] = top + np.log(sums[-1])
            sums /= sums[-1].copy()
            ladder[:wide, first:last] = sums
        chances = np.empty((total, n), np.float32)
        chances[order] = ladder.T
        return pieces, chances, beta[:total]


class Sampler:
    """The k samples of each text of a slice."""

    def __init__(self, vocabulary: Vocabulary | Lattice, samples: int):
        self.lattice, self.samples = vocabulary if isinstance(vocabulary, Lattice) else Lattice(vocabulary), samples
        # Edges of kinds of units: those that recur are remembered up to a bound, those of the slice come behind them.
        self.lengths = np.arange(1, self.lattice.longest + 1)
        self._hold(0)
        self.remembered, self.names, self.name_codes = 0, np.empty(0, np.uint64), np.empty(0, np.int64)

    def _hold(self, room: int) -> None:
        """Room for the edges of so many places; those that are remembered are copied, an array at a time."""
        wide = self.lattice.longest
        for name, shape, kind in (("pieces", (room, wide), np.int16), ("ladder", (room, wide), np.float32), ("beta", (room,), np.float64)):
            held = np.empty(shape, kind)  # takes memory where it is written only
            if room and self.remembered:
                held[: self.remembered] = getattr(self, name)[: self.remembered]
            setattr(self, name, held)

    def _edges_of(self, names: np.ndarray, counts: np.ndarray, like: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where the edges of each kind of unit start; like: where the kind's codes start."""
        found = np.searchsorted(self.names, names)
        found[found == len(self.names)] = 0
        known = self.names[found] == names if len(self.names) else np.zeros(len(names), bool)
        begins = np.zeros(len(names), np.int64)
        begins[known] = self.name_codes[found[known]]
        new = np.flatnonzero(~known)
        new = new[np.argsort(-counts[new], kind="stable")]
        own = np.cumsum(sizes[new]) - sizes[new]
        total = int(sizes[new].sum())
        begins[new] = self.remembered + own
        if len(self.pieces) < self.remembered + total:
            self._hold(REMEMBERED + max(total, 2 * SLICE_BYTES))
        parts = np.flatnonzero(np.diff(own // EDGE_PLACES, prepend=-1))
        for first, last in zip(parts.tolist(), [*parts[1:].tolist(), len(new)]):
            part, start = new[first:last], int(own[first])
            ends = own[first:last] - start + sizes[part]
            places = np.repeat(like[part] - (own[first:last] - start), sizes[part]) + np.arange(ends[-1])
            at = slice(self.remembered + start, self.remembered + start + int(ends[-1]))
            self.pieces[at], self.ladder[at], self.beta[at] = self.lattice.edges(self.codes[places], ends - sizes[part], sizes[part])
        fits = (counts[new] >= 2) & (self.remembered + own + sizes[new] <= REMEMBERED)
        again = new[: int(fits.argmin()) if not fits.all() else len(new)]  # the most frequent ones lie first
        self.remembered += int(sizes[again].sum())
        names_, starts = np.concatenate((self.names, names[again])), np.concatenate((self.name_codes, begins[again]))
        order = np.argsort(names_)
        self.names, self.name_codes = names_[order], starts[order]
        return begins

    def _prepare(self, texts: list[str]) -> None:
        lattice = self.lattice
        self.codes, self.ends = lattice.coded(texts)
        self.firsts = np.concatenate(([0], self.ends[:-1]))
        n = len(self.codes)
        starts = lattice.units(self.codes, self.ends)
        sizes = np.diff(np.append(starts, n))
        # Equal units by hash; one that differs from its like in spite of it is a kind of its own.
        power = np.cumprod(np.full(max(n, 1), 0xD1342543DE82EF95, np.uint64))
        back = np.cumprod(np.full(max(n, 1), pow(0xD1342543DE82EF95, -1, 1 << 64), np.uint64))
        sums = np.concatenate(([np.uint64(0)], np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * power[:n])))
        name = _mixed((sums[starts + sizes] - sums[starts]) * back[starts] + sizes.astype(np.uint64)) if n else np.empty(0, np.uint64)
        names, like, kind, counts = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
        shift = np.repeat(starts[like[kind]] - starts, sizes)
        if n:
            other = self.codes[np.clip(np.arange(n) + shift, 0, n - 1)] != self.codes
            differs = np.flatnonzero((sizes != sizes[like[kind]]) | np.logical_or.reduceat(other, starts))
            kind[differs] = len(like) + np.arange(len(differs))
            like, counts = np.concatenate((like, differs)), np.concatenate((counts, np.zeros(len(differs), np.int64)))
            names = np.concatenate((names, np.full(len(differs), np.uint64(2**64 - 1))))  # a name that none is remembered under
        begins = self._edges_of(names, counts, starts[like], sizes[like])
        self.edge_at = np.repeat(begins[kind] - starts, sizes) + np.arange(n)  # place among the kinds' edges
        self.unit_ends = np.repeat(starts + sizes, sizes)
        self.starts = starts
        self.places = self.ends - self.firsts  # of each text
        self.owner = np.repeat(np.arange(len(texts)), self.places)

    def _walk(self, at: np.ndarray, salt: np.ndarray, tokens: np.ndarray, logs: np.ndarray) -> None:
        """Samples from places to the ends of their units; fills pieces and log chances at the places passed."""
        pieces, lengths, weights = self.pieces.ravel(), self.pieces.shape[1], self.lattice.weights
        salt = salt - self.firsts.astype(np.uint64)
        while len(at):
            edge = self.edge_at.take(at)
            draw = _uniform(salt.take(self.owner.take(at)) + at.astype(np.uint64)).astype(np.float32)
            # Edges whose chances end at or below the draw, counted eight bytes at a time.
            passed = (self.ladder.take(edge, axis=0) <= np.minimum(draw, _BELOW_ONE)[:, None]).view(np.uint64)
            counted = (passed * np.uint64(0x0101010101010101)) >> np.uint64(56)
            step = counted[:, 0].astype(np.int64)
            for column in range(1, counted.shape[1]):
                step += counted[:, column].astype(np.int64)
            taken = pieces.take(edge * lengths + step)
            ends = self.unit_ends.take(at)
            after = at + step + 1
            inside = after < ends
            tokens[at] = taken
            gone = np.where(inside, self.beta.take(edge + step + 1, mode="clip"), 0.0)
            logs[at] = np.minimum(weights.take(taken, mode="wrap") + gone - self.beta.take(edge), 0.0)
            at = after[inside]

    def _regions(self, logs: np.ndarray, taken: np.ndarray, bound: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log mass of the prefix, greatest value of the paths that leave) at each place of a path."""
        sums = np.cumsum(logs)
        before = sums - logs
        before -= np.repeat(np.where(self.firsts > 0, sums[self.firsts - 1], 0.0), self.places) if len(sums) else 0.0
        value = np.full(len(logs), -np.inf)
        free = np.flatnonzero(taken & (logs < -1e-12))
        own = self.owner[free]
        mass = before[free] + np.log(-np.expm1(logs[free]))
        value[free] = self._below(mass, bound[own], salt[own] + (free - self.firsts[own]).astype(np.uint64))
        return before, value

    def _other_edges(
        self, paths: list[dict], splits: list[tuple], moved: np.ndarray, source: np.ndarray, split: np.ndarray, top: np.ndarray, salt: np.ndarray,
        tokens: np.ndarray, logs: np.ndarray
    ) -> np.ndarray:
        """Of each moved text, the edge drawn where its path splits, less 1, among those that neither the path nor an earlier split
        took there. Fills pieces and log chances at these places, and the value of what is left in the path's set.

        splits: (source, split, edge) of all texts for each earlier sample.
        """
        at, path_of, rows = split[moved], source[moved], np.arange(len(moved))
        edge, reach, weights = self.edge_at[at], self.unit_ends[at] - at, self.lattice.weights
        pieces, whole = self.pieces[edge], self.beta[edge]
        after = np.where(self.lengths == reach[:, None], 0.0, self.beta.take(edge[:, None] + self.lengths, mode="clip"))
        with np.errstate(over="ignore", invalid="ignore"):  # what lies beyond the unit's end
            odds = np.where(self.lengths <= reach[:, None], np.exp(weights[pieces] + after - whole[:, None]), 0.0)
        for i, path in enumerate(paths):
            own = np.flatnonzero(path_of == i)
            odds[own, self.lattice.sizes[path["tokens"][at[own]]] - 1] = 0.0
        for earlier, place, gone in splits:
            again = np.flatnonzero((earlier[moved] == path_of) & (place[moved] == at))
            odds[again, gone[moved[again]]] = 0.0
        ladder = odds.cumsum(axis=1)
        draw = _uniform(salt[moved] + np.uint64(3 << 40)) * ladder[:, -1]
        last = odds.shape[1] - 1 - (odds[:, ::-1] != 0).argmax(axis=1)
        step = np.minimum((ladder <= draw[:, None]).sum(axis=1), last)
        rest = ladder[:, -1] - odds[rows, step]
        for i, path in enumerate(paths):
            own = np.flatnonzero(path_of == i)
            path["value"][at[own]] = -np.inf
            own = own[rest[own] > 1e-12]
            path["value"][at[own]] = self._below(path["before"][at[own]] + np.log(rest[own]), top[moved[own]], salt[moved[own]] + np.uint64(5 << 40))
        tokens[at] = pieces[rows, step]
        gone = np.where(step + 1 == reach, 0.0, self.beta.take(edge + step + 1, mode="clip"))
        logs[at] = np.minimum(weights[tokens[at]] + gone - whole, 0.0)
        return step

    @staticmethod
    def _below(mass: np.ndarray, bound: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Gumbel values of log masses, below their bounds."""
        return -np.logaddexp(-bound, -(mass + _gumbel(salt ^ np.uint64(0x5851F42D4C957F2D))))

    def draw(self, texts: list[str], seeds: np.ndarray) -> list[dict]:
        """By sample: ids, their number per text, log_prob, value, exists; and the value left after the last."""
        self._prepare(texts)
        n, docs = len(self.codes), len(texts)
        salt = lambda number: _mixed(seeds.astype(np.uint64) + np.uint64(number * _MULTIPLIER % 2**64))
        full = np.flatnonzero(self.ends > self.firsts)
        heads = self.firsts[full]
        tokens, logs = np.full(n, -1, np.int32), np.zeros(n)
        self._walk(self.starts, salt(0), tokens, logs)
        top = _gumbel(salt(0) + np.uint64(1 << 40))
        before, value = self._regions(logs, tokens >= 0, top, salt(0))
        paths = [{"tokens": tokens, "logs": logs, "before": before, "value": value, "top": top, "exists": np.ones(docs, bool)}]
        splits: list = []

        def best() -> tuple[np.ndarray, np.ndarray]:
            """(path, greatest value) of the sets left of each text."""
            tops = np.full((len(paths), docs), -np.inf)
            for i, path in enumerate(paths):
                if len(heads):
                    tops[i, full] = np.maximum.reduceat(path["value"], heads)
            return tops.argmax(axis=0), tops.max(axis=0)

        for number in range(1, self.samples):
            source, top = best()
            exists = top > -np.inf
            tokens, logs, own = np.full(n, -1, np.int32), np.zeros(n), salt(number)
            split = np.full(docs, -1)
            for i, path in enumerate(paths):
                from_here = exists & (source == i)
                hit = np.flatnonzero(path["value"] == np.repeat(np.where(from_here, top, np.nan), self.places))
                split[self.owner[hit]] = hit
                here = np.arange(n) <= np.repeat(np.where(from_here, split, -1), self.places)
                tokens, logs = np.where(here, path["tokens"], tokens), np.where(here, path["logs"], logs)
            moved = np.flatnonzero(exists)
            begin, step = split[moved], self._other_edges(paths, splits, moved, source, split, top, own, tokens, logs)
            restart = begin + step + 1
            taken = np.full(docs, -1)
            taken[moved] = step
            splits.append((source, split, taken))
            # The rest of the unit that was split, and all later units of the text.
            inside = restart[restart < np.where(begin >= 0, self.unit_ends[begin], 0)] if n else restart
            owners = self.owner[self.starts]
            units = self.starts[(self.starts > split[owners]) & exists[owners]]
            self._walk(np.concatenate((inside, units)), own, tokens, logs)
            fresh = (tokens >= 0) & (np.arange(n) > np.repeat(split, self.places))
            before, value = self._regions(logs, fresh, top, own)
            paths.append({"tokens": tokens, "logs": logs, "before": before, "value": value, "top": top, "exists": exists})
        _, left = best()
        for path in paths:
            taken = path["tokens"] >= 0
            path["ids"] = self.lattice.vocabulary.ids[path["tokens"][taken]]
            path["counts"] = np.bincount(self.owner[taken], minlength=docs)
            path["log_prob"] = np.bincount(self.owner, path["logs"], minlength=docs).astype(np.float64)
            odds = path["log_prob"] - left
            with np.errstate(over="ignore"):
                path["log_inclusion"] = np.where(odds < -30, odds, np.log(-np.expm1(-np.exp(np.maximum(odds, -30)))))
        return paths


class Decoder:
    """Ids back to texts."""

    def __init__(self, vocabulary: Vocabulary):
        starts = np.concatenate(([0], vocabulary.ends[:-1]))
        size = int(vocabulary.ids.max()) + 1
        self.codes, self.starts, self.sizes = vocabulary.codes, np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.starts[vocabulary.ids], self.sizes[vocabulary.ids] = starts, vocabulary.ends - starts

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """One text for each run of ids."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        codes = self.codes[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        codes = np.where(codes == SPACE_MARK, np.uint32(SPACE), codes)
        plain = np.where((codes >= BYTE_CODE) & (codes < BYTE_CODE + 0x80), codes - np.uint32(BYTE_CODE), codes)
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        whole = np.where(plain < BYTE_CODE, plain, 0).astype("<u4").tobytes().decode("utf-32-le")
        high = np.concatenate(([0], np.cumsum(plain >= BYTE_CODE)))
        found = []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high[end] == high[start]:
                text = whole[start:end]
            else:
                text = b"".join(bytes([c - BYTE_CODE]) if c >= BYTE_CODE else chr(c).encode() for c in plain[start:end].tolist()).decode("utf-8", "replace")
            found.append(text[1:])  # without the space that was added in front
        return found


_OUT = pa.schema([
    ("sample", pa.int32()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("log_prob", pa.float64()), ("perturbed", pa.float64()),
    ("log_inclusion", pa.float64()), ("round_trip", pa.bool_())])


def _encoder(vocabulary: Vocabulary, samples: int) -> Callable:
    lattice = Lattice(vocabulary)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, decoder = Sampler(lattice, samples), Decoder(lattice.vocabulary)
        for batch in slices(batches, limit=SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for number, path in enumerate(sampler.draw(texts, batch.column("seed").to_numpy())):
                counts = path["counts"]
                back = decoder.texts(path["ids"], counts)
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                columns = [
                    pa.array(np.full(len(texts), number, np.int32)), pa.ListArray.from_arrays(offsets, pa.array(path["ids"])), pa.array(counts),
                    pa.array(path["log_prob"]), pa.array(path["top"]), pa.array(path["log_inclusion"]), pa.array([a == b for a, b in zip(texts, back)])]
                names = [x for x in batch.schema.names if x not in ("text", "seed")]
                whole = pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *columns], [*names, *_OUT.names])
                yield whole.filter(pa.array(path["exists"]))

    return encode


def sample_segmentations(
    docs: DataFrame, vocabulary: Vocabulary | None = None, samples: int = SAMPLES, key: str = "doc_id", text: str = "text", carried: tuple[str, ...] = ()
) -> DataFrame:
    """Up to `samples` rows per input row, in falling order of value: doc_id, sample, ids, n_tokens, log_prob, perturbed,
    log_inclusion (log of the chance to be among the samples, given the value left), round_trip (decoding gives the text). The carried columns follow doc_id."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), *carried, F.xxhash64(key).alias("seed"), F.col(text).alias("text"))
    own = "".join(f"`{x}` {dict(docs.dtypes)[x]}, " for x in carried)
    kinds = f"doc_id {dict(docs.dtypes)[key]}, {own}sample int, ids array<int>, n_tokens long, log_prob double, perturbed double, log_inclusion double, round_trip boolean"
    return rows.mapInArrow(leaving_nothing(_encoder(vocabulary or load_vocabulary(), samples)), kinds)


def decode(rows: DataFrame, vocabulary: Vocabulary | None = None, ids: str = "ids") -> DataFrame:
    """rows with the column "decoded", the text of their ids."""
    decoder = Decoder(vocabulary or load_vocabulary())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            counts = np.array([len(x) if x is not None else 0 for x in lists])
            texts = decoder.texts(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts)], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(leaving_nothing(run), f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, decoded string")
