"""A bidirectional gated recurrent network over bytes, in numpy.

One network reads a window forwards and one backwards; at every byte the two
states give a distribution over the labels. Training is by backpropagation
through time with Adam on windows of a labelled sample. A text is scored in
windows that overlap by a context on both sides, so its length is not limited,
and its distribution is the mean over all of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Training:
    hidden: int = 8
    window: int = 64
    batch: int = 128
    steps: int = 240
    rate: float = 0.02
    seed: int = 11


@dataclass
class Network:
    """Per direction: `table` (byte to gates), `recur` (state to gates); `out`, `bias`.

    Gates are update, reset and candidate, in this order. Update and reset are
    piecewise linear sigmoids (x / 4 + 1 / 2 within 0 and 1) and the candidate is cut
    at -1 and 1, which costs a tenth of the transcendental forms.
    """

    labels: list[str]
    table: list[np.ndarray]
    recur: list[np.ndarray]
    out: list[np.ndarray]
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.table, *self.recur, *self.out, self.bias]


def _new(labels: list[str], hidden: int, seed: int) -> Network:
    random = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        labels,
        [draw(256, 3 * hidden, scale=0.3) for _ in range(2)],
        [draw(hidden, 3 * hidden, scale=hidden**-0.5) for _ in range(2)],
        [draw(hidden, len(labels), scale=0.1) for _ in range(2)],
        np.zeros(len(labels), np.float32),
    )


def _gate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The piecewise linear sigmoid and its slope."""
    y = x * 0.25 + 0.5
    return np.clip(y, 0, 1), 0.25 * ((y > 0) & (y < 1))


def _backwards(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each window and place, the place that mirrors it (its own beyond the end)."""
    places = np.arange(ids.shape[1])
    mirrored = lengths[:, None] - 1 - places
    return np.where(mirrored >= 0, mirrored, places)


def _train_direction(ids, table, recur):
    """States (T + 1, B, H) and what the backward pass needs."""
    steps, hidden = ids.shape[1], recur.shape[0]
    states = np.zeros((steps + 1, len(ids), hidden), np.float32)
    kept = []
    for t in range(steps):
        x, a = table[ids[:, t]], states[t] @ recur
        gates, slopes = _gate(x[:, : 2 * hidden] + a[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = x[:, 2 * hidden :] + r * a[:, 2 * hidden :]
        inside = np.abs(n) < 1
        n = np.clip(n, -1, 1)
        states[t + 1] = n + z * (states[t] - n)
        kept.append((z, r, n, a[:, 2 * hidden :], slopes, inside))
    return states, kept


def _through_time(ids, recur, states, kept, upstream):
    """Gradients of table and recur from those of the states (T, B, H)."""
    hidden = recur.shape[0]
    d_table, d_recur = np.zeros((256, 3 * hidden), np.float32), np.zeros_like(recur)
    d_h = np.zeros_like(states[0])
    for t in reversed(range(len(kept))):
        z, r, n, a_n, slopes, inside = kept[t]
        d_h = d_h + upstream[t]
        d_n = d_h * (1 - z) * inside
        d_z = d_h * (states[t] - n) * slopes[:, :hidden]
        d_r = d_n * a_n * slopes[:, hidden:]
        d_x = np.concatenate([d_z, d_r, d_n], axis=1)
        d_a = np.concatenate([d_z, d_r, d_n * r], axis=1)
        np.add.at(d_table, ids[:, t], d_x)
        d_recur += states[t].T @ d_a
        d_h = d_h * z + d_a @ recur.T
    return d_table, d_recur


def _gradients(net: Network, ids: np.ndarray, lengths: np.ndarray, wanted: np.ndarray):
    """Loss and gradients, in the order of `parameters`."""
    rows = np.arange(len(ids))[:, None]
    mirror = _backwards(ids, lengths)
    read = [ids, ids[rows, mirror]]
    runs = [_train_direction(read[d], net.table[d], net.recur[d]) for d in range(2)]
    forward = runs[0][0][1:].transpose(1, 0, 2)
    backward = runs[1][0][1:].transpose(1, 0, 2)[rows, mirror]
    logits = forward @ net.out[0] + backward @ net.out[1] + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    share = np.exp(logits)
    share /= share.sum(axis=2, keepdims=True)
    mask = (np.arange(ids.shape[1]) < lengths[:, None]).astype(np.float32)
    mask /= mask.sum()
    loss = -(np.log(share[rows[:, 0], :, wanted] + 1e-9) * mask).sum()
    d_logits = share
    d_logits[rows[:, 0], :, wanted] -= 1
    d_logits *= mask[:, :, None]
    d_out = [np.einsum("bth,btc->hc", s, d_logits) for s in (forward, backward)]
    ups = [d_logits @ net.out[0].T, (d_logits @ net.out[1].T)[rows, mirror]]
    # the mirror is its own inverse, so it also brings gradients to their places
    grads = [
        _through_time(read[d], net.recur[d], *runs[d], ups[d].transpose(1, 0, 2)) for d in range(2)
    ]
    return loss, [*(g[0] for g in grads), *(g[1] for g in grads), *d_out, d_logits.sum((0, 1))]


def train(windows: list[bytes], wanted: list[str], how: Training = Training()) -> Network | None:
    """The network for labelled windows; None without any."""
    labels = sorted(set(wanted))
    if not labels:
        return None
    number = {x: i for i, x in enumerate(labels)}
    lengths = np.array([min(len(w), how.window) for w in windows])
    ids = np.zeros((len(windows), how.window), np.uint8)
    for row, w in zip(ids, windows, strict=True):
        row[: min(len(w), how.window)] = np.frombuffer(w[: how.window], np.uint8)
    classes = np.array([number[x] for x in wanted])
    members = [np.flatnonzero(classes == c) for c in range(len(labels))]
    net = _new(labels, how.hidden, how.seed)
    random = np.random.default_rng(how.seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, how.steps + 1):
        # each label is drawn alike
        chosen = np.array([random.choice(members[i % len(labels)]) for i in range(how.batch)])
        _, grads = _gradients(net, ids[chosen], lengths[chosen], classes[chosen])
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        rate = how.rate * min(1.0, 2 * (1 - (step - 1) / how.steps))
        for p, g, m, v in zip(net.parameters(), grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


#: Bytes of a window that it answers for, and bytes it reads on either side of them.
CORE, CONTEXT = 480, 16
#: Windows that are read together, and bytes of texts.
TOGETHER, BUFFER = 1024, 1 << 23


def _parts(net: Network, direction: int) -> list[np.ndarray]:
    """Tables and recurrent weights by gate, gates already scaled and shifted."""
    hidden = net.recur[direction].shape[0]
    parts = []
    for i, (scale, shift) in enumerate(((0.25, 0.5), (0.25, 0.5), (1.0, 0.0))):
        columns = slice(i * hidden, (i + 1) * hidden)
        parts.append(np.ascontiguousarray(net.table[direction][:, columns] * np.float32(scale) + np.float32(shift)))
        parts.append(np.ascontiguousarray(net.recur[direction][:, columns] * np.float32(scale)))
    return parts


def _states(ids: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """States (T, B, H) of one direction for byte numbers (T, B)."""
    table_z, recur_z, table_r, recur_r, table_n, recur_n = parts
    hidden = recur_z.shape[0]
    states = np.empty((*ids.shape, hidden), np.float32)
    h = np.zeros((ids.shape[1], hidden), np.float32)
    z, r, n, x = (np.empty_like(h) for _ in range(4))
    for byte, state in zip(ids, states, strict=True):
        for gate, table, recur in ((z, table_z, recur_z), (r, table_r, recur_r)):
            np.dot(h, recur, out=gate)
            np.take(table, byte, axis=0, out=x, mode="clip")
            gate += x
            np.maximum(gate, 0, out=gate)
            np.minimum(gate, 1, out=gate)
        np.dot(h, recur_n, out=n)
        n *= r
        np.take(table_n, byte, axis=0, out=x, mode="clip")
        n += x
        np.maximum(n, -1, out=n)
        np.minimum(n, 1, out=n)
        h -= n
        h *= z
        h += n
        state[...] = h
    return states


def _windows(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
    """(document, ids, mirrored ids, lengths, core from, core to), windows of like length together."""
    counts = -(-(ends - starts) // CORE)
    document = np.repeat(np.arange(len(starts)), counts)
    number = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
    core = starts[document] + number * CORE
    core_end = np.minimum(core + CORE, ends[document])
    low = np.maximum(core - CONTEXT, starts[document])
    high = np.minimum(core_end + CONTEXT, ends[document])
    order = np.argsort(high - low, kind="stable")
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        lengths = high[some] - low[some]
        places = np.arange(int(lengths.max()))
        last = len(buffer) - 1
        ids = buffer[np.minimum(low[some, None] + places, last)]
        mirrored = buffer[np.maximum(high[some, None] - 1 - places, 0)]
        yield document[some], ids, mirrored, lengths, core[some] - low[some], core_end[some] - low[some]


def _score_buffer(net: Network, parts: list[list[np.ndarray]], texts: list[bytes]) -> np.ndarray:
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    total = np.zeros((len(texts), len(net.labels)))
    if not ends[-1]:
        return total
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    for document, ids, mirrored, lengths, begin, end in _windows(buffer, ends - sizes, ends):
        places = np.arange(ids.shape[1])[:, None]
        logits = _states(np.ascontiguousarray(ids.T, np.intp), parts[0]) @ net.out[0]
        back = _states(np.ascontiguousarray(mirrored.T, np.intp), parts[1]) @ net.out[1]
        logits += back[np.maximum(lengths - 1 - places, 0), np.arange(len(ids))]
        # by label, so that rows are long; the states are at most 1, so exp is safe
        shares = np.exp(np.moveaxis(logits, 2, 0) + net.bias[:, None, None])
        weight = ((places >= begin) & (places < end)) / shares.sum(axis=0)
        np.add.at(total, document, np.einsum("ctb,tb->bc", shares, weight, dtype=np.float64))
    return total / np.maximum(sizes, 1)[:, None]


def score(net: Network, texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """The mean distribution of each text, in order; memory is bounded by the longest."""
    parts = [_parts(net, d) for d in range(2)]
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= BUFFER:
            yield from _score_buffer(net, parts, held)
            held, size = [], 0
    if held:
        yield from _score_buffer(net, parts, held)
