"""Language-model scoring with a gated recurrent network and a softmax factored by groups and classes.

Every word belongs to a class: frequent words to classes of neighbours in frequency, the rarer the
larger (see ``layout``), the others (unseen ones too) to one of
``TAIL_CLASSES`` classes by a hash of their first bytes, and the end of a text to a class of its
own; neighbouring classes belong to a group, whose classes are as many as the groups. Frequent are
the ``NEURAL`` first words and all that occur ``softmax_count`` times in training; their number grows
with the corpus. A word's probability is that of its group times that of its class in the group
times that of the word in its class; the network gives the first two, and for frequent classes the
third; in a tail class the third is the smoothed count (c + 0.5) / (N + 0.5 (V + 1)) over the class's
training tokens N and distinct words V, with one unseen word.

The network is a gated recurrent unit whose input weights are a table over word slots. A step of
training changes the slots and classes that occur in its window, and the recurrent part. Training
runs through all training documents: each partition trains its own copy on its documents, in
parallel lanes, with backpropagation truncated to ``STEPS`` words and the state carried on (for
``SEGMENT`` words, where a long text is cut for training), and the copies are averaged by words
seen, group after group, in ``ROUNDS`` rounds over disjoint parts of the documents. Scoring
carries the state across all windows (of ``SCORED_STEPS`` words) of a document, so it is scored
whole.

Counts cover all training tokens. Counts of tail words, whose number grows with the corpus, are
joined in by a shuffle; only the ``FREQUENT`` most frequent words (or all that have slots) are
broadcast.

Defined results: a null text is empty and scores its end alone; repeated rows are rows; with no
training document the network keeps its first small weights and the counts are zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, log10, sqrt
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import Shared, held_out, remainder, small_batches, staged

HELD_OUT_PARTS = 5
#: Words whose counts are broadcast; the first ``NEURAL`` of them, at least, have slots of their own.
FREQUENT = 100_000
NEURAL = 1_024
#: A word has a slot if it occurs so often, and more than this share of the root of all tokens.
SLOT_COUNT = 10
SLOT_ROOT_SHARE = 1 / 64
#: Words of a class, at least.
CLASS_WORDS = 16
TAIL_CLASSES = 63
HIDDEN = 16
STEPS = 24
SCORED_STEPS = 48
LANES = 512
SEGMENT = 960
ROUNDS = 2
RATE = 0.02
#: Of the tables of words.
TABLE_RATE = 0.1
CLIP = 1.0
#: No parameter exceeds this, so nothing exceeds (HIDDEN + 2) times it and exp can't overflow.
MOST = 4.0
#: Tokens that a task holds at once, beside one batch.
CHUNK_TOKENS = 2_000_000
#: Bytes of text that a task counts at once.
COUNTED_BYTES = 32_000_000
#: Numbers of a block in a softmax, which stays in the processor's cache.
_BLOCK = 1 << 16
#: Rows of a slot in a window that are added up side by side; those beyond, slot by slot.
_FEW = 24
#: Columns of the table of words that are updated at once.
_COLUMNS = 4_096
_FAN_IN = 16
#: Parameters in a row of a copy.
_SLICE = 1 << 18


def tail_class(word: bytes) -> int:
    return crc32(word[:2]) % TAIL_CLASSES


def softmax_count(tokens: int) -> int:
    """How often a word has to occur among ``tokens`` for a slot of its own."""
    return max(SLOT_COUNT, ceil(sqrt(tokens) * SLOT_ROOT_SHARE))


def layout(counts: list[int], tokens: int) -> list[int]:
    """Where classes of words with slots start, and where the last one ends, for the counts of the most
    frequent words, falling. A class is closed once it has ``CLASS_WORDS`` words and the share of the
    tokens that it has, times its words, reaches one: so all classes cost about the same, and as much as a
    class costs in the softmax over classes."""
    bar = softmax_count(tokens)
    n = min(max(NEURAL, sum(c >= bar for c in counts)), len(counts))
    bounds, held = [0], 0
    for k in range(n):
        held += counts[k]
        words = k + 1 - bounds[-1]
        if words >= CLASS_WORDS and held * words >= tokens:
            bounds.append(k + 1)
            held = 0
    return bounds if bounds[-1] == n else [*bounds, n]


class Vocabulary:
    """Counts of frequent words, and classes. Slots: frequent words, then tail classes, then the end.
    Classes: frequency classes, then tail classes, then the end."""

    def __init__(self, words: list[tuple[bytes, int]], tail: dict[int, tuple[int, int]], ends: int,
                 tokens: int, distinct: int):
        self.counts = dict(words)
        self.tokens, self.distinct, self.ends = tokens, distinct, ends
        self.bounds = layout([c for _, c in words], tokens)
        self.neural, self.frequent_classes = self.bounds[-1], len(self.bounds) - 1
        self.slot = {w: k for k, (w, _) in enumerate(words[:self.neural])}
        self.slots = self.neural + TAIL_CLASSES + 1
        self.classes = self.frequent_classes + TAIL_CLASSES + 1
        #: where groups of classes start, and where the last one ends
        self.groups = np.linspace(0, self.classes, ceil(sqrt(self.classes)) + 1).astype(int).tolist()
        self.end_slot = self.slots - 1
        rest = {k: list(tail.get(k, (0, 0))) for k in range(TAIL_CLASSES)}  # N, V beyond slots
        #: of a word of a tail class, less log10(c + 0.5)
        self.tail_log = np.array([-log10(n + 0.5 * (v + 1)) for n, v in rest.values()])
        self.base_log = -log10(tokens + 0.5 * (distinct + 1))
        self.frequent = [w for w, _ in words]
        #: by position among the frequent words, then of the end
        self.logs = np.array([log10(c + 0.5) for _, c in words] + [log10(ends + 0.5)])


class _Numbers:
    """How many words have numbers: the frequent ones, then the others of the texts coded last, ``new``."""

    def __init__(self, frequent: int):
        self.first, self.new = frequent, []

    def __len__(self) -> int:
        return self.first + len(self.new)

    def forget(self) -> None:
        self.new = []


def _words(texts: pa.Array | list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """All words, text after text, with A-Z in lower case, and how many words each text has."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
    texts = texts.cast(pa.binary()).fill_null(b"").view(pa.string())  # any bytes: only ASCII is looked at
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, sizes = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    some = pc.not_equal(pc.binary_length(words), 0)
    if not pc.all(some, min_count=0).as_py():  # white space at an end of a text leaves an empty word
        text_of = np.repeat(np.arange(len(sizes)), sizes)[some.to_numpy(zero_copy_only=False)]
        words, sizes = words.filter(some), np.bincount(text_of, minlength=len(sizes))
    return words.view(pa.binary()), sizes


def _tail_classes(words: pa.Array) -> np.ndarray:
    starts = pc.binary_slice(words, 0, 2).dictionary_encode()
    known = np.fromiter(map(tail_class, starts.dictionary.to_pylist()), np.int32, len(starts.dictionary))
    return known[starts.indices.to_numpy()]


class Coder:
    """Texts as numbers of words or as slots, and numbers as slots."""

    def __init__(self, vocabulary: Vocabulary):
        self.numbers, self.neural, self.end = _Numbers(len(vocabulary.frequent)), vocabulary.neural, vocabulary.end_slot
        self._words = pa.array(vocabulary.frequent, pa.binary())
        self._frequent = self._slots_of(self._words)
        self._frequent[:self.neural] = np.arange(self.neural)

    def _slots_of(self, words: pa.Array) -> np.ndarray:
        return self.neural + _tail_classes(words)

    def _found(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Numbers of all words, -1 for those that aren't frequent; where these are, and which; words of each text."""
        words, sizes = _words(texts)
        numbers = np.array(pc.index_in(words, value_set=self._words).fill_null(-1), np.int32)
        rare = np.flatnonzero(numbers < 0)
        return numbers, rare, words.take(pa.array(rare)), sizes

    def code(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, text after text, and how many each text has."""
        numbers, rare, words, sizes = self._found(texts)
        once = words.dictionary_encode()
        self.numbers.new = once.dictionary
        numbers[rare] = self.numbers.first + once.indices.to_numpy()
        return numbers, sizes

    def code_slots(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """As ``code``, straight to slots: words that aren't frequent get no numbers."""
        numbers, rare, words, sizes = self._found(texts)
        slots = self._frequent[numbers] if len(self._frequent) else numbers
        slots[rare] = self._slots_of(words)
        return slots, sizes

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return np.concatenate([self._frequent, self._slots_of(pa.array(self.numbers.new, pa.binary()))])[numbers]

    def flat(self, slots: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots with an end before, between and after the texts, and where each text's end before
        it is; a text's inputs run from there, its targets one further, to the next end."""
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.full(starts[-1] + 1, self.end, np.int32)
        is_word = np.ones(len(out), bool)
        is_word[starts] = False
        out[is_word] = slots
        return out, starts


def _sums_by(rows: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``rows``, taken in ``order``, of the runs of it that start at ``starts``; no run is empty."""
    sizes = np.diff(starts, append=len(order))
    out = rows[order[starts]]
    for k in range(1, min(_FEW, sizes.max())):
        more = np.flatnonzero(sizes > k)
        out[more] += rows[order[starts[more] + k]]
    ones = np.ones(sizes.max(), np.float32)
    for i in np.flatnonzero(sizes > _FEW).tolist():
        own = order[starts[i] + _FEW:starts[i] + sizes[i]]
        out[i] += ones[:len(own)] @ rows[own]
    return out


class Network:
    """Parameters are one float32 vector; the arrays are views into it."""

    def __init__(self, vocabulary: Vocabulary, theta: np.ndarray | None = None, seed: int = 7):
        v, h, self.bounds = vocabulary, HIDDEN, vocabulary.bounds
        self.group_bounds = v.groups
        groups = len(v.groups) - 1
        shapes = {"inp": (v.slots, 3 * h), "rec": (h, 3 * h), "rec_b": (3 * h,), "grp": (h + 1, groups),
                  "cls": (h + 1, v.classes), "word": (h + 1, v.neural)}
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.frequent_classes = v.frequent_classes
        if theta is None:
            rng = np.random.default_rng(seed)
            theta = rng.normal(0, 0.1, size).astype(np.float32)
        self.theta, self.shapes, self.views, at = theta.copy(), shapes, {}, 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            self.views[name] = (at, at + n)
            setattr(self, name, self.theta[at:at + n].reshape(shape))
            at += n
        # a slot's class: frequency class, tail class or end
        widths = np.diff(v.bounds)
        self.slot_class = np.concatenate([np.repeat(np.arange(len(widths)), widths),
                                          v.frequent_classes + np.arange(TAIL_CLASSES + 1)]).astype(np.int32)
        self.class_group = np.repeat(np.arange(groups), np.diff(v.groups)).astype(np.int32)

    def parts(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        return {n: flat[a:b].reshape(self.shapes[n]) for n, (a, b) in self.views.items()}

    def forward(self, x: np.ndarray, state: np.ndarray, keep: bool = False):
        """States after each step for slots ``x`` (steps, lanes); with ``keep``, what training needs. Lanes
        are innermost in memory."""
        h, (steps, lanes) = HIDDEN, x.shape
        with_one = np.empty((h + 1, steps + 1, lanes), np.float32)
        states, with_one[h] = with_one[:h], 1
        states[:, 0] = state.T
        sign = np.repeat(np.float32([-1, 1]), [2 * h, h])[:, None]  # gates are 1 / (1 + exp(-x))
        rec, kept = np.concatenate([self.rec.T, self.rec_b[:, None]], axis=1) * sign, []
        inp = np.empty((3 * h, lanes), np.float32)
        for t in range(steps):
            before, after = states[:, t], states[:, t + 1]
            inp[:] = self.inp.take(x[t], axis=0).T
            a = rec @ with_one[:, t]
            g, c = a[:2 * h], a[2 * h:]
            g -= inp[:2 * h]
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            z, r = g[:h], g[h:]
            n = r * c
            n += inp[2 * h:]
            np.tanh(n, out=n)
            np.subtract(before, n, out=after)
            after *= z
            after += n
            if keep:
                kept.append((z, r, c, n))
        return states.transpose(1, 2, 0), kept

    def log_probabilities(self, s: np.ndarray, y: np.ndarray, grads: dict | None = None, weight=None):
        """Natural logs of the group, the class (and, for frequent words, the word) of slots ``y`` given
        states ``s``; with ``grads``, sets the gradients and returns that of the states too. All are gone
        through in blocks that stay in the processor's cache."""
        n, h = s.shape
        order = np.argsort(y)  # rows of a group, a class and a word together
        y = y[order]
        rows = np.empty((n, h + 1), np.float32)
        rows[:, :h], rows[:, h] = s, 1  # the last parameter is the bias
        rows = rows[order]
        weight = None if grads is None else weight[order]
        out, back = np.zeros(n, np.float32), None if grads is None else np.zeros((n, h), np.float32)

        def level(name: str, bounds: list[int], goals: np.ndarray) -> None:
            """A softmax for every two neighbours of ``bounds``, over the outputs between them."""
            ends = np.searchsorted(goals, bounds).tolist()
            done, table, grad = ends[-1], getattr(self, name), grads and grads[name]
            blocks = []  # from which row to which, of which outputs, and whether it is their first
            for low, high, start, end in zip(bounds[:-1], bounds[1:], ends[:-1], ends[1:], strict=True):
                step = max(64, _BLOCK // (high - low))
                blocks += [(i, min(i + step, end), low, high, i == start) for i in range(start, end, step)]
                if grads is not None and start == end:
                    grad[:, low:high] = 0
            if not blocks:
                return
            first, last, lows, highs, _ = np.array(blocks).T
            each = last - first
            at = (np.arange(done) - np.repeat(first, each)) * np.repeat(highs - lows, each) + goals[:done] - np.repeat(lows, each)
            chosen, total = np.empty(done, np.float32), np.empty(done, np.float32)
            d = None if grads is None else np.empty((done, h), np.float32)
            room, ones = np.empty((each * (highs - lows)).max(), np.float32), np.ones((highs - lows).max(), np.float32)
            for i, j, low, high, new in blocks:
                flat, mine, goal = room[:(j - i) * (high - low)], rows[i:j], at[i:j]
                z, own = flat.reshape(j - i, high - low), table[:, low:high]
                np.matmul(mine, own, out=z)
                chosen[i:j] = flat.take(goal)
                np.exp(flat, out=flat)
                sums = np.matmul(z, ones[:high - low], out=total[i:j])
                if grads is not None:
                    flat[goal] -= sums
                    mine = (mine * (weight[i:j] / sums)[:, None]).T
                    if new:
                        np.matmul(mine, z, out=grad[:, low:high])
                    else:
                        grad[:, low:high] += mine @ z
                    np.matmul(z, own[:-1].T, out=d[i:j])
            out[:done] += chosen - np.log(total)
            if grads is not None:
                d *= (weight[:done] / total)[:, None]
                back[:done] += d

        classes = self.slot_class[y]
        level("grp", [0, len(self.group_bounds) - 1], self.class_group[classes])
        level("cls", self.group_bounds, classes)
        level("word", self.bounds, y)
        logs = np.empty_like(out)
        logs[order] = out
        if back is None:
            return logs, None
        unsorted = np.empty_like(back)
        unsorted[order] = back
        return logs, unsorted

    def gradients(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, state: np.ndarray, grads: dict):
        """Backpropagation through a window (steps, lanes): the state after it, and the slots it read.
        ``grads`` gets the gradients; of the input table only the rows of those slots."""
        h, (steps, lanes) = HIDDEN, x.shape
        states, kept = self.forward(x, state, keep=True)
        weight = (live / max(1, live.sum())).astype(np.float32).ravel()
        _, back = self.log_probabilities(states[1:].reshape(-1, h), y.ravel(), grads, weight)
        back = np.ascontiguousarray(back.T).reshape(h, steps, lanes)
        held = states.transpose(2, 0, 1)
        da = np.empty((3 * h, steps, lanes), np.float32)  # of what the recurrent weights give
        dn = np.empty((h, steps, lanes), np.float32)
        d = np.zeros((h, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            z, r, c, n = kept[t]
            d += back[:, t]
            through = d * z
            d -= through
            np.multiply(d, 1 - n * n, out=dn[:, t])
            through_z = through * (1 - z)
            np.multiply(held[:, t] - n, through_z, out=da[:h, t])
            np.multiply(dn[:, t], r, out=da[2 * h:, t])
            np.multiply(da[2 * h:, t], c * (1 - r), out=da[h:2 * h, t])
            d = self.rec @ da[:, t]
            d += through
        flat_da = da.reshape(3 * h, -1)
        grads["rec"] = held[:, :-1].reshape(h, -1) @ flat_da.T
        grads["rec_b"] = flat_da @ np.ones(flat_da.shape[1], np.float32)
        da[2 * h:] = dn  # the inputs reach the candidate past the reset gate
        order = np.argsort(x.ravel())
        read = x.ravel()[order]
        starts = np.flatnonzero(np.concatenate([[True], read[1:] != read[:-1]]))
        grads["inp"] = _sums_by(np.ascontiguousarray(flat_da.T), order, starts)
        return states[-1], read[starts]

    def learn(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, state: np.ndarray, opt: dict) -> np.ndarray:
        """One step of truncated backpropagation over a window (steps, lanes); the state after it. The
        recurrent part, the groups and the classes take steps of Adam; the tables of words, of which a
        window sees a part, have one sum of squares a word."""
        if not opt:
            small = ("rec", "rec_b", "grp", "cls")
            opt["grads"] = {n: np.zeros_like(getattr(self, n)) for n in (*small, "word")}
            opt["small"] = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in small}
            opt["inp"] = np.zeros(len(self.inp), np.float32)
            opt["word"] = np.zeros(self.word.shape[1], np.float32)
            opt["t"] = 0
        grads = opt["grads"]
        last, slots = self.gradients(x, y, live, state, grads)
        opt["t"] = t = opt["t"] + 1
        norm = sqrt(sum(float(grads[n].ravel() @ grads[n].ravel()) for n in opt["small"]))
        rate, root = RATE / (1 + t / 2000) / (1 - 0.9**t), 1 / sqrt(1 - 0.99**t)
        for n, (m, v) in opt["small"].items():
            g, p = grads[n], getattr(self, n)
            if norm > CLIP:
                g *= np.float32(CLIP / norm)
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g * g - v)
            p -= np.float32(rate) * m / (np.sqrt(v) * np.float32(root) + np.float32(1e-8))
            np.clip(p, -MOST, MOST, out=p)
        g, squares = grads["inp"], opt["inp"]
        total = squares[slots] + np.einsum("ij,ij->i", g, g) / g.shape[1]
        squares[slots] = total
        rows = self.inp[slots]
        rows -= g * (np.float32(TABLE_RATE) / (np.sqrt(total) + np.float32(1e-10)))[:, None]
        self.inp[slots] = np.clip(rows, -MOST, MOST, out=rows)
        mean = np.full(len(self.word), 1 / len(self.word), np.float32)
        for i in range(0, self.word.shape[1], _COLUMNS):
            own = slice(i, i + _COLUMNS)
            g, squares, table = grads["word"][:, own], opt["word"][own], self.word[:, own]
            squares += mean @ (g * g)
            g *= np.float32(TABLE_RATE) / (np.sqrt(squares) + np.float32(1e-10))
            table -= g
            np.clip(table, -MOST, MOST, out=table)
        return last


def windows(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = LANES, steps: int = STEPS):
    """Windows over spans of ``flat``, each span in one lane from its first to its last window, in
    order of the spans: (inputs, targets, live, carry, who). ``who`` is the span of each lane,
    ``carry`` the lane of the window before whose state it goes on with, or -1 for a new span; what
    is left of a span's last window is not live."""
    n = min(lanes, len(starts))
    who, queue = np.arange(n), n
    at, carry = starts[:n].copy(), np.full(n, -1)
    step = np.arange(steps)[:, None]
    while len(who):
        here = at + step
        live = here < ends[who]
        np.minimum(here, len(flat) - 2, out=here)
        yield flat[here], flat[here + 1], live, carry, who
        at = at + steps
        carry = np.arange(len(who))
        done = np.flatnonzero(at >= ends[who])
        take = min(len(done), len(starts) - queue)
        new = done[:take]
        who, queue = who.copy(), queue + take
        who[new] = np.arange(queue - take, queue)
        at[new], carry[new] = starts[who[new]], -1
        if take < len(done):
            kept = np.ones(len(who), bool)
            kept[done[take:]] = False
            who, at, carry = who[kept], at[kept], carry[kept]


def shuffled(lengths: np.ndarray, seed: int) -> np.ndarray:
    """A random order of spans, but for the last ones: these go from long to short, so that lanes end together."""
    order = np.random.default_rng(seed).permutation(len(lengths))
    last = order[-2 * LANES:]
    order[-2 * LANES:] = last[np.argsort(-lengths[last], kind="stable")]
    return order


def carried(state: np.ndarray | None, carry: np.ndarray) -> np.ndarray:
    out = np.zeros((len(carry), HIDDEN), np.float32)
    if state is not None:
        out[carry >= 0] = state[carry[carry >= 0]]
    return out


def _chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = 6 * CHUNK_TOKENS):
    """Batches gathered to about ``most`` bytes of text: (batches, texts)."""
    held, size = [], 0
    texts = lambda: pa.concat_arrays([b.column(column) for b in held])
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if size > most:
            yield held, texts()
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield held, texts()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all tokens of ``docs`` (text); ends are not among them. Staged."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches, 0, COUNTED_BYTES):
            counted = _words(texts)[0].value_counts()
            yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "c"])

    return staged(docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, c long")
                  .groupBy("word").agg(F.sum("c").alias("c")), "word_counts")


def vocabulary_of(counts: DataFrame, ends: int) -> Vocabulary:
    """Bounded: the frequent words, and totals for each tail class."""
    powers = [1 << k for k in range(48)]
    at_least = counts.agg(*(F.count_if(F.col("c") >= p).alias(f"p{p}") for p in powers)).first()
    bound = next(p for p in powers if at_least[f"p{p}"] <= 8 * FREQUENT)  # few rows left to order
    sums = counts.agg(F.sum("c").alias("n")).first()
    tokens = (sums["n"] or 0) + ends
    bar = softmax_count(tokens)
    above = counts.where(F.col("c") >= bar).count()
    most = max(FREQUENT, above) if above > NEURAL else FREQUENT
    top = counts.where(F.col("c") >= min(bound, bar)).orderBy(F.desc("c"), "word").limit(most).collect()
    words = [(bytes(r["word"]), r["c"]) for r in top]
    neural = {w for w, _ in words[:layout([c for _, c in words], tokens)[-1]]}
    cls = F.crc32(F.substring("word", 1, 2)) % TAIL_CLASSES
    tail = {r["k"]: [r["n"], r["v"]] for r in counts.groupBy(cls.alias("k")).agg(
        F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = sum(n for n, _ in tail.values()), sum(v for _, v in tail.values())
    for w, c in words:
        if w in neural:
            k = tail_class(w)
            tail[k] = [tail[k][0] - c, tail[k][1] - 1]
    return Vocabulary(words, tail, ends, total + ends, distinct + (ends > 0))


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    n = pdf["n"].to_numpy(float)
    change = reduce(np.add, (np.frombuffer(t, np.float16) * np.float32(k / n.sum()) for t, k in zip(pdf["change"], n, strict=True)))
    return pd.DataFrame({"part": [0], "slice": [pdf["slice"].iloc[0]], "n": [int(n.sum())],
                         "change": [change.astype(np.float16).tobytes()]})


def train(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Parameters after all of ``docs`` (doc_id, text), partition by partition, averaged by rounds. What
    a copy changed travels in half precision."""
    spark = docs.sparkSession
    theta = Network(vocabulary).theta
    for turn in range(ROUNDS):
        shared = Shared(spark, (vocabulary, theta))
        rows = docs.where(F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(ROUNDS)) == turn)

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, theta = shared.value()  # noqa: B023
            net, coder, opt, seen = Network(vocabulary, theta), Coder(vocabulary), {}, 0
            for _, texts in _chunks(batches, 0):
                flat, starts = coder.flat(*coder.code_slots(texts))
                sizes = np.diff(starts) - 1
                cuts = -(-(sizes + 1) // SEGMENT)  # segments of each text
                first = np.repeat(starts[:-1], cuts) + SEGMENT * (
                    np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
                last = np.minimum(first + SEGMENT, np.repeat(starts[1:], cuts))
                order = shuffled(last - first, len(flat))
                state = None
                for x, y, live, carry, _who in windows(flat, first[order], last[order]):
                    state = net.learn(x, y, live, carried(state, carry), opt)
                seen += int((sizes + 1).sum())
            if seen:
                change = (net.theta - theta).astype(np.float16)
                part = crc32(change.tobytes()) & 0xFFFF
                for k, at in enumerate(range(0, len(change), _SLICE)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([seen], pa.int64()),
                         pa.array([change[at:at + _SLICE].tobytes()], pa.binary())], ["part", "slice", "n", "change"])

        schema, slices = "part int, slice int, n long, change binary", -(-len(theta) // _SLICE)
        texts = rows.select(F.col("text").cast("binary"))
        groups = texts.rdd.getNumPartitions()  # the copies go straight to their first averages
        copies = texts.mapInArrow(fit, schema)
        while groups > 1:  # a tree of averages of each slice, ``_FAN_IN`` copies a group
            groups = -(-groups // _FAN_IN)
            copies = staged(copies.withColumn("part", F.col("part") % groups).groupBy("part", "slice")
                            .applyInPandas(_average, schema)
                            .withColumn("part", (F.rand(1) * 65536).cast("int")), "lm_copies")
            groups = -(-copies.count() // slices)
        whole = sorted(copies.collect(), key=lambda r: r["slice"])
        if whole:
            theta = theta + np.concatenate([np.frombuffer(r["change"], np.float16) for r in whole])
    return theta


def _network_logs(net: Network, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text: the log10 probability of its classes, and of its frequent words in theirs."""
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")  # the longest first, so that lanes end together
    out, state = np.zeros(len(sizes)), None
    for x, y, live, carry, who in windows(flat, starts[:-1][order], starts[1:][order], steps=SCORED_STEPS):
        states, _ = net.forward(x, carried(state, carry))
        state = states[-1]
        logs, _ = net.log_probabilities(states[1:].reshape(-1, HIDDEN), y.ravel())
        out[order[who]] += np.where(live, logs.reshape(live.shape), 0).sum(axis=0, dtype=np.float64)
    return out / np.log(10)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run may be empty."""
    upto = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


def _scored(vocabulary: Vocabulary, net: Network, coder: Coder, texts: pa.Array | list[bytes | None]):
    """Columns of a chunk: tokens, known frequent words, base and model logs without the shares of
    words whose counts are not broadcast, and those words with how often they occur."""
    v = vocabulary
    numbers, sizes = coder.code(texts)
    slots, rare_words = coder.slots(numbers), coder.numbers.new
    coder.numbers.forget()
    frequent = len(v.frequent)
    is_rare, tail = numbers >= frequent, slots >= v.neural
    logs = np.append(v.logs[:frequent], 0.0)[np.minimum(numbers, frequent)]
    rare_text = np.repeat(np.arange(len(sizes)), sizes)[is_rare]
    known = sizes - np.bincount(rare_text, minlength=len(sizes)) + (v.ends > 0)
    base = _sums(logs, sizes) + v.logs[-1] + (sizes + 1) * v.base_log
    beyond = np.where(tail, logs, 0.0) + np.concatenate([np.zeros(v.neural), v.tail_log])[slots]
    flat, starts = coder.flat(slots, sizes)
    model = _sums(beyond, sizes) + _network_logs(net, flat, starts)
    # rare words of each text, once each
    key, n = np.unique(rare_text * (len(rare_words) + 1) + (numbers[is_rare] - frequent), return_counts=True)
    offsets = np.searchsorted(key // (len(rare_words) + 1), np.arange(len(sizes) + 1))
    words = pa.array(rare_words, pa.binary()).take(pa.array(key % (len(rare_words) + 1)))
    rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [words, pa.array(n, pa.int64())], ["word", "n"]))
    return pa.array(sizes + 1), pa.array(known), pa.array(base), pa.array(model), rare


def score(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    learned = docs.where(remainder(F.col("doc_id"), HELD_OUT_PARTS) != 1).select("doc_id", "text")
    counts = count_words(learned)
    vocabulary = vocabulary_of(counts, learned.select("doc_id").count())
    theta = train(learned, vocabulary)
    shared = Shared(spark, (vocabulary, theta))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), HELD_OUT_PARTS).alias("held_out"),
                       F.col("text").cast("binary").alias("text"))
    schema = rows.select("doc_id", "held_out", *(F.lit(0).cast(kind).alias(name) for name, kind in (
        ("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double"))),
        F.array().cast("array<struct<word:binary,n:bigint>>").alias("rare")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, theta = shared.value()
        net, coder = Network(vocabulary, theta), Coder(vocabulary)
        for held, texts in _chunks(batches, 2):
            columns, at = _scored(vocabulary, net, coder, texts), 0
            for b in held:
                yield pa.RecordBatch.from_arrays([*b.columns[:2], *(c.slice(at, b.num_rows) for c in columns)],
                                                 ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])
                at += b.num_rows

    small_batches(spark)
    scored = staged(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm_scores")
    # words beyond the broadcast ones: their counts come by a shuffle; a missing count is zero
    rare = scored.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.n")
    seen = F.coalesce("c", F.lit(0))
    tail = (rare.join(counts, "word", "left").groupBy("row")
            .agg(F.sum(F.col("n") * F.log10(seen + 0.5)).alias("logs"),
                 F.sum(F.when(seen > 0, F.col("n")).otherwise(0)).alias("known")))
    return scored.drop("rare").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("logs", F.lit(0.0))).alias("score"))
