"""Personal data in texts: fixed patterns, and a character-level BiLSTM with CRF transitions that adds what they miss.

The patterns label every document. From their spans a bounded sample of windows is taken, some rewritten into forms that the
patterns do not cover (bracketed or spoken addresses, phone numbers without a plus, cards with dots); on these labelled
spans the network is trained in numpy. Every text is then cut into overlapping windows, all windows are tagged by Viterbi
decoding, and the tags of a document are reconciled: each place takes the tag of the window in which it lies farthest from
an edge, runs of a tag join across windows, and a run that overlaps a pattern's span or fails its kind's check is dropped.
A window whose tag scores prove that no path beats "nothing here" needs no decoding.

Null texts count as empty and have no spans. Repeated rows have equal spans. An empty table trains on nothing, and a table
without any personal data gives a network that has seen only its absence.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from tidewire.llm.arrow_slices import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
#: Windows of each kind, and without any, that the network is trained on at most.
TRAIN_WINDOWS = 400
TRAIN_CHARS, TRAIN_STEPS, BATCH = 96, 150, 128
#: Cells of each direction, characters of a window, and characters that neighbouring windows share.
CELLS, WINDOW_CHARS, SHARED_CHARS = 8, 256, 32
_AT_ONCE = 1024
_TAGS = len(KINDS) + 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is taken from its start: what fails there fails within it too, and no match ends inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind, then place; linear in the text."""
    found = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            floor = match.end()
        at = text.find("@", max(at + 1, floor))
    first = _DIGIT.search(text)
    if first is None:
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text, first.start()) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text, first.start()):
        if m.end() - m.start() >= 16 and 16 <= len(own := _digits(m.group())) <= 19 and luhn(own):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return found


def rewritten(kind: str, text: str, choice: int) -> str:
    """A form of the same data that the patterns may not know; half of the choices keep the text."""
    if choice % 2 == 0:
        return text
    form = choice // 2 % 3
    if kind == "email":
        name, host = text.split("@", 1)
        return (f"{name} (at) {host}", f"{name}[at]{host}", f"{name} at {host.replace('.', ' dot ')}")[form]
    digits = _digits(text)
    if kind == "card":
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)) if form else "/".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == "phone" and len(digits) >= 10:
        end = digits[-10:]
        return (f"({end[:3]}) {end[3:6]}-{end[6:]}", f"{end[:3]}-{end[3:6]}-{end[6:]}", f"00{digits[:-10]} {end[:3]} {end[3:6]} {end[6:]}")[form]
    return text


def passes(kind: str, text: str) -> bool:
    """Whether a tagged run can be of its kind."""
    digits = _digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[\w.%+-]+(?: ?[\[(]at[\])] ?|@| at )[\w-]+(?:(?:\.| dot )[\w-]+)+", text, re.I))
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and len(text) <= 23 and all(int(p[:4]) <= 255 and len(p) <= 3 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and len(text) <= 30 and luhn(digits)
    return 10 <= len(digits) <= 15 and len(text) <= 28 and bool(re.fullmatch(r"[0-9(][ ().0-9/-]+[0-9]", text))


# The network.

def classes(codes: np.ndarray) -> np.ndarray:
    """Class of each code point: printable ASCII by itself, then white space, further letters and signs, and padding (0)."""
    return _CLASS_OF[np.minimum(codes, len(_CLASS_OF) - 1)]


def _class_table() -> np.ndarray:
    table = np.full(0x3001, 98, np.uint8)
    table[[c for c in range(0x3000) if chr(c).isalpha()]] = 97
    table[[c for c in range(0x3000) if chr(c).isspace()]] = 96
    table[32:127] = np.arange(1, 96)
    return table


_CLASS_OF, _CLASSES = _class_table(), 99


def _sigmoid_tanh(z: np.ndarray, cells: int) -> np.ndarray:
    """In place: three gates as sigmoids, by tanh of the half, and the candidate as tanh."""
    z[..., : 3 * cells] *= 0.5
    np.tanh(z, out=z)
    z[..., : 3 * cells] *= 0.5
    z[..., : 3 * cells] += 0.5
    return z


class Lstm:
    """One direction: table (class -> gates) and recurrent weights. Gates: in, forget, out, candidate."""

    def __init__(self, draw: np.random.Generator, cells: int):
        self.cells = cells
        self.params = {"table": draw.normal(0, 0.3, (_CLASSES, 4 * cells)), "loop": draw.normal(0, 0.3, (cells, 4 * cells))}
        self.params["table"][:, cells : 2 * cells] += 1.0

    def forward(self, x: np.ndarray) -> np.ndarray:
        """States of x (places, windows), keeping what backward needs."""
        n, cells = x.shape[1], self.cells
        self.x, self.gates = x, np.empty((len(x), n, 4 * cells))
        self.c, self.h = np.zeros((len(x) + 1, n, cells)), np.zeros((len(x) + 1, n, cells))
        for t in range(len(x)):
            z = _sigmoid_tanh(self.params["table"][x[t]] + self.h[t] @ self.params["loop"], cells)
            i, f, o, g = np.split(z, 4, axis=1)
            self.gates[t], self.c[t + 1] = z, f * self.c[t] + i * g
            self.h[t + 1] = o * np.tanh(self.c[t + 1])
        return self.h[1:]

    def backward(self, dh: np.ndarray) -> dict[str, np.ndarray]:
        cells = self.cells
        table, loop = np.zeros_like(self.params["table"]), np.zeros_like(self.params["loop"])
        later_h = later_c = np.zeros(dh.shape[1:])
        for t in range(len(dh) - 1, -1, -1):
            i, f, o, g = np.split(self.gates[t], 4, axis=1)
            tanh_c, own = np.tanh(self.c[t + 1]), dh[t] + later_h
            dc = own * o * (1 - tanh_c**2) + later_c
            dz = np.concatenate((dc * g * i * (1 - i), dc * self.c[t] * f * (1 - f), own * tanh_c * o * (1 - o), dc * i * (1 - g**2)), axis=1)
            loop += self.h[t].T @ dz
            np.add.at(table, self.x[t], dz)
            later_h, later_c = dz @ self.params["loop"].T, dc * f
        return {"table": table, "loop": loop}


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Two LSTMs, tag scores from both, and a CRF over the tags (0: nothing)."""

    def __init__(self, cells: int = CELLS, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.ahead, self.back = Lstm(draw, cells), Lstm(draw, cells)
        self.head = {"ahead": draw.normal(0, 0.3, (cells, _TAGS)), "back": draw.normal(0, 0.3, (cells, _TAGS)), "bias": np.zeros(_TAGS), "moves": np.zeros((_TAGS, _TAGS))}
        self.head["bias"][0] = 1.0

    def _groups(self) -> list[dict[str, np.ndarray]]:
        return [self.ahead.params, self.back.params, self.head]

    def step_gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, list[dict[str, np.ndarray]]]:
        """(negative log likelihood per window, gradients) of x and tags (places, windows)."""
        places, n = x.shape
        h1, h2 = self.ahead.forward(x), self.back.forward(x[::-1])[::-1]
        score = h1 @ self.head["ahead"] + h2 @ self.head["back"] + self.head["bias"]
        moves = self.head["moves"]
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[0] = score[0]
        for t in range(1, places):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + moves, 1) + score[t]
        for t in range(places - 2, -1, -1):
            beta[t] = _log_sum(moves + (score[t + 1] + beta[t + 1])[:, None, :], 2)
        whole = _log_sum(alpha[-1], 1)
        d_score = np.exp(alpha + beta - whole[:, None])
        pairs = np.exp(alpha[:-1, :, :, None] + moves + (score[1:] + beta[1:])[:, :, None, :] - whole[:, None, None]).sum(axis=(0, 1))
        at = np.arange(n)
        told = sum(score[t, at, tags[t]] for t in range(places)) + sum(moves[tags[t - 1], tags[t]] for t in range(1, places))
        for t in range(places):
            d_score[t, at, tags[t]] -= 1
        np.subtract.at(pairs, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        d_score, pairs = d_score / n, pairs / n
        flat = d_score.reshape(-1, _TAGS)
        head = {"ahead": h1.reshape(len(flat), -1).T @ flat, "back": h2.reshape(len(flat), -1).T @ flat, "bias": flat.sum(axis=0), "moves": pairs}
        one = self.ahead.backward(d_score @ self.head["ahead"].T)
        two = self.back.backward((d_score @ self.head["back"].T)[::-1])
        return float((whole - told).mean()), [one, two, head]

    def fit(self, x: np.ndarray, tags: np.ndarray, steps: int = TRAIN_STEPS, rate: float = 0.03, seed: int = 5) -> list[float]:
        """Adam over batches of windows (windows, places); losses by step."""
        draw, losses = np.random.default_rng(seed), []
        first = [{k: np.zeros_like(v) for k, v in g.items()} for g in self._groups()]
        second = [{k: np.zeros_like(v) for k, v in g.items()} for g in self._groups()]
        for step in range(1, steps + 1 if len(x) else 1):
            pick = draw.integers(0, len(x), min(BATCH, len(x)))
            loss, gradients = self.step_gradients(x[pick].T, tags[pick].T)
            losses.append(loss)
            for params, own, m, v in zip(self._groups(), gradients, first, second):
                for k, g in own.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    params[k] -= rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return losses

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (places, windows, tags) of class ids (places, windows); single precision, nothing kept."""
        score = np.empty((*x.shape, _TAGS), np.float32)
        score[:] = self.head["bias"].astype(np.float32)
        for lstm, out, places in ((self.ahead, self.head["ahead"], range(len(x))), (self.back, self.head["back"], range(len(x) - 1, -1, -1))):
            cells, n = lstm.cells, x.shape[1]
            table, loop, out = (a.astype(np.float32) for a in (lstm.params["table"], lstm.params["loop"], out))
            # Gates that are sigmoids are scaled beforehand: sigmoid(z) = tanh(z / 2) / 2 + 1 / 2.
            table[:, : 3 * cells] *= 0.5
            loop[:, : 3 * cells] *= 0.5
            h, c = np.zeros((n, cells), np.float32), np.zeros((cells, n), np.float32)
            z, move = np.empty((n, 4 * cells), np.float32), np.empty((n, 4 * cells), np.float32)
            gates, part = np.empty((4 * cells, n), np.float32), np.empty((cells, n), np.float32)
            for t in places:
                np.take(table, x[t], axis=0, out=z, mode="clip")
                np.dot(h, loop, out=move)
                np.add(z, move, out=z)
                np.tanh(z.T, out=gates)
                sig = gates[: 3 * cells]
                sig *= 0.5
                sig += 0.5
                np.multiply(c, gates[cells : 2 * cells], out=c)
                np.multiply(gates[:cells], gates[3 * cells :], out=part)
                np.add(c, part, out=c)
                np.tanh(c, out=part)
                np.multiply(gates[2 * cells : 3 * cells].T, part.T, out=h)
                score[t] += h @ out
        return score

    def decode(self, score: np.ndarray) -> np.ndarray:
        """Best tags (places, windows)."""
        moves = self.head["moves"]
        best, came = score[0].astype(np.float64), np.empty(score.shape, np.int8)
        for t in range(1, len(score)):
            paths = best[:, :, None] + moves
            came[t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + score[t]
        tags = np.empty(score.shape[:2], np.int8)
        tags[-1] = best.argmax(axis=1)
        at = np.arange(score.shape[1])
        for t in range(len(score) - 1, 0, -1):
            tags[t - 1] = came[t][at, tags[t]]
        return tags

    def tag(self, x: np.ndarray) -> np.ndarray:
        """Best tags; windows in which tag 0 everywhere is provably best are not decoded."""
        score = self.scores(x)
        moves = self.head["moves"]
        # A place off tag 0 changes two moves at most, each by no more than the best move beats the move 0 -> 0.
        gain = 2 * max(float(moves.max() - moves[0, 0]), 0.0)
        open_ = np.flatnonzero(((score[:, :, 1:].max(axis=2) - score[:, :, 0]) >= -gain).any(axis=0))
        tags = np.zeros(x.shape, np.int8)
        if len(open_):
            tags[:, open_] = self.decode(score[:, open_])
        return tags


# Windows of texts.

def _window_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled windows of each text: one for each span, and one without a span for each text."""
    half = TRAIN_CHARS // 2
    for batch in batches:
        rows = []
        for order, text in zip(batch.column("seed").to_pylist(), batch.column("text").to_pylist()):
            spans = base_spans(text or "")
            for number, (kind, start, end) in enumerate(spans):
                if end - start < half:
                    new = rewritten(kind, text[start:end], (order >> 8) + number)
                    skip = (order >> 20) % (half // 2)
                    before = text[max(0, start - half + skip) : start]
                    row = f"{before}{new}{text[end : end + half]}"[:TRAIN_CHARS]
                    around = [s for s in spans if s[0] != kind or s[1] != start]
                    if not any(s[1] < end + half and s[2] > start - half for s in around):
                        rows.append((kind, order + number, row, len(before), len(before) + len(new)))
            if text:
                start = order % len(text)
                if not any(s[1] < start + TRAIN_CHARS and s[2] > start for s in spans):
                    # Windows with digits teach most of what is no personal data, so they come first.
                    own = text[start : start + TRAIN_CHARS]
                    rows.append(("none", order if _DIGIT.search(own) else order | (1 << 62), own, 0, 0))
        names = ["kind", "rank", "window", "start", "stop"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_WINDOW_SCHEMA)


_WINDOW_SCHEMA = pa.schema([("kind", pa.string()), ("rank", pa.int64()), ("window", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])


def training_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[tuple]:
    """(kind, window, start, end) of at most TRAIN_WINDOWS windows of each kind, those of smallest hashes."""
    rows = docs.select(F.shiftright(F.xxhash64(key, text).bitwiseAND(F.lit((1 << 62) - 1)), 1).alias("seed"), F.col(text).alias("text"))
    found = rows.mapInArrow(_window_rows, "kind string, rank long, window string, start int, stop int")
    place = F.row_number().over(Window.partitionBy("kind").orderBy("rank", "window"))
    kept = found.withColumn("place", place).where(F.col("place") <= TRAIN_WINDOWS)
    return sorted(tuple(r) for r in kept.select("kind", "place", "window", "start", "stop").collect())


def train(windows: list[tuple], steps: int = TRAIN_STEPS) -> Tagger:
    """A network for (kind, place, window, start, end)."""
    x, tags = np.zeros((len(windows), TRAIN_CHARS), np.int64), np.zeros((len(windows), TRAIN_CHARS), np.int64)
    for row, (kind, _, window, start, end) in enumerate(windows):
        codes = np.frombuffer(window.encode("utf-32-le"), np.uint32)
        x[row, : len(codes)] = classes(codes)
        if kind in KINDS:
            tags[row, start:end] = KINDS.index(kind) + 1
    tagger = Tagger()
    tagger.fit(x, tags, steps)
    return tagger


def tag_texts(tagger: Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of the runs of tags of each text, reconciled over its windows."""
    codes = classes(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32))
    sizes = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(sizes) - sizes
    stride = WINDOW_CHARS - SHARED_CHARS
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - SHARED_CHARS) // stride)), 0)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = number * stride
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    runs: dict[int, list[tuple[int, np.ndarray]]] = {}
    for at in range(0, len(owner), _AT_ONCE):
        own, start = owner[at : at + _AT_ONCE], begin[at : at + _AT_ONCE]
        place = start[None, :] + np.arange(WINDOW_CHARS)[:, None]
        inside = place < sizes[own]
        x = np.where(inside, codes[np.minimum(firsts[own] + place, len(codes) - 1)], 0)
        tags = np.where(inside, tagger.tag(x), 0)
        for w in np.flatnonzero(tags.any(axis=0)):
            # The half of a shared part that is nearer to this window's middle is its own.
            low = SHARED_CHARS // 2 if start[w] else 0
            high = WINDOW_CHARS if number[at + w] == counts[own[w]] - 1 else WINDOW_CHARS - SHARED_CHARS // 2
            runs.setdefault(int(own[w]), []).append((int(start[w]) + low, tags[low:high, w]))
    for doc, parts in runs.items():
        whole = np.zeros(sizes[doc] + 2, np.int8)
        for start, tags in parts:
            tags = tags[: sizes[doc] - start]
            whole[start + 1 : start + 1 + len(tags)] = tags
        edges = np.flatnonzero(whole[1:] != whole[:-1])
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if whole[start + 1]:
                found[doc].append((KINDS[whole[start + 1] - 1], start, end))
    return found


def all_spans(tagger: Tagger, texts: list[str]) -> Iterator[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """(spans of the patterns, spans that the network adds) of each text."""
    for text, runs in zip(texts, tag_texts(tagger, texts)):
        base = base_spans(text)
        added = []
        for kind, start, end in runs:
            while start < end and not (text[start].isalnum() or text[start] == "("):
                start += 1
            while end > start and not text[end - 1].isalnum():
                end -= 1
            if not any(s < end and start < e for _, s, e in base) and passes(kind, text[start:end]):
                added.append((kind, start, end))
        yield base, added


def _finder(tagger: Tagger) -> Callable:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_())]))
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = [[{"kind": k, "start": s, "stop": e, "base": own} for own, spans in ((True, base), (False, added)) for k, s, e in spans] for base, added in all_spans(tagger, texts)]
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(rows, listed)], [*names, "spans"])

    return find


def find_personal_data(docs: DataFrame, tagger: Tagger, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, spans (kind, start, stop, base: found by a pattern), in code points."""
    kinds = f"doc_id {dict(docs.dtypes)[key]}, spans array<struct<kind:string,start:int,stop:int,base:boolean>>"
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_finder(tagger), kinds)
