"""A small character tagger in numpy: embedding, bidirectional LSTM, linear-chain CRF; trained with Adam.

Windows have one length, so a batch is one array and every step of the recurrence one matrix product.
"""

from __future__ import annotations

import numpy as np

FORBIDDEN = -1e4


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    high = x.max(axis=axis, keepdims=True)
    return (high + np.log(np.exp(x - high).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters and their use; ``allowed[i, j]`` says whether label j may follow label i, ``first[j]`` whether it may begin."""

    def __init__(self, symbols: int, labels: int, allowed: np.ndarray, first: np.ndarray, hidden: int = 16, seed: int = 3) -> None:
        random = np.random.default_rng(seed)
        wide = 4 * hidden
        self.hidden = hidden
        self.blocked, self.blocked_first = np.where(allowed, 0, FORBIDDEN), np.where(first, 0, FORBIDDEN)
        self.p = {
            # Of each direction: what a symbol adds to the four gates, what the last state adds.
            "x0": random.normal(0, 0.3, (symbols, wide)),
            "h0": random.normal(0, 1 / np.sqrt(hidden), (hidden, wide)),
            "x1": random.normal(0, 0.3, (symbols, wide)),
            "h1": random.normal(0, 1 / np.sqrt(hidden), (hidden, wide)),
            "out": random.normal(0, 0.3, (2 * hidden, labels)),
            "bias": np.zeros(labels),
            "move": np.zeros((labels, labels)),
            "begin": np.zeros(labels),
        }
        for name in ("x0", "x1"):
            self.p[name][:, hidden : 2 * hidden] += 1.0  # forget gates start open

    def _run(self, ids: np.ndarray, d: int, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction, by step, and what the backward pass needs."""
        steps = range(ids.shape[1]) if d == 0 else range(ids.shape[1] - 1, -1, -1)
        size = self.hidden
        h = np.zeros((len(ids), size), dtype=self.p["h0"].dtype)
        c = np.zeros_like(h)
        states = np.empty((ids.shape[1], len(ids), size), dtype=h.dtype)
        tape = []
        for t in steps:
            gates = self.p[f"x{d}"][ids[:, t]] + h @ self.p[f"h{d}"]
            gates[:, : 3 * size] = _sigmoid(gates[:, : 3 * size])
            gates[:, 3 * size :] = np.tanh(gates[:, 3 * size :])
            into, forget, out, new = np.split(gates, 4, axis=1)
            before, old = h, c
            c = forget * old + into * new
            squashed = np.tanh(c)
            h = out * squashed
            states[t] = h
            if keep:
                tape.append((t, gates, before, old, squashed))
        return states, tape

    def emissions(self, ids: np.ndarray, keep: bool = False):
        """(steps, windows, labels)."""
        (ahead, tape0), (behind, tape1) = self._run(ids, 0, keep), self._run(ids, 1, keep)
        states = np.concatenate([ahead, behind], axis=2)
        return states @ self.p["out"] + self.p["bias"], states, (tape0, tape1)

    def best_paths(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best label of each position; ``scores`` (positions, labels) holds sequences of these lengths one after the other.

        All sequences are walked side by side; those that have ended drop out, so the work is that of the positions.
        """
        move = (self.p["move"] + self.blocked).astype(scores.dtype)
        path = np.empty(len(scores), dtype=np.uint8)
        back = np.empty(scores.shape, dtype=np.uint8)
        order = np.argsort(-lengths, kind="stable")
        starts, left = (np.cumsum(lengths) - lengths)[order], lengths[order]
        longest = int(left[0]) if len(left) else 0
        # How many sequences have a position t.
        going = np.searchsorted(-left, -np.arange(longest), side="left")
        best = scores[starts[: going[0]]] + (self.p["begin"] + self.blocked_first).astype(scores.dtype) if longest else None
        label = np.zeros(len(left), dtype=np.uint8)
        for t in range(1, longest):
            n = going[t]
            label[n : len(best)] = best[n:].argmax(axis=1)
            through = best[:n, :, None] + move[None]
            places = starts[:n] + t
            back[places] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[places]
        if longest:
            label[: len(best)] = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            n = going[t]
            places = starts[:n] + t
            path[places] = label[:n]
            if t:
                label[:n] = back[places, label[:n]]
        return path

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best path of each window, (windows, steps)."""
        scores = self.emissions(ids)[0].transpose(1, 0, 2)
        lengths = np.full(len(ids), ids.shape[1])
        return self.best_paths(np.ascontiguousarray(scores).reshape(-1, scores.shape[2]), lengths).reshape(ids.shape)

    def decode_overlapping(self, ids: np.ndarray, follows: np.ndarray, batch: int) -> np.ndarray:
        """One best path for each stretch of windows that overlap by half: labels by half window, (halves, steps).

        ``follows`` says whether a window begins in the middle of the one before it; the first one doesn't. Where two
        windows meet, their scores are added up, each weighted by how far the position lies inside the window, and
        the weights of a position sum to one. A stretch has one half more than it has windows.
        """
        half = ids.shape[1] // 2
        first = np.cumsum(np.where(follows, 1, 2)) - 2
        followed = np.append(follows[1:], False)
        rise = ((np.arange(half) + 0.5) / half).astype(np.float32)[:, None]
        scores = np.zeros((len(ids) + int((~follows).sum()), half, self.p["out"].shape[1]), dtype=np.float32)
        for begin in range(0, len(ids), batch):
            part = slice(begin, begin + batch)
            found = self.emissions(ids[part])[0].transpose(1, 0, 2)
            scores[first[part]] += found[:, :half] * np.where(follows[part, None, None], rise, 1)
            scores[first[part] + 1] += found[:, half:] * np.where(followed[part, None, None], 1 - rise, 1)
        begins = first[~follows]
        lengths = np.diff(np.append(begins, len(scores))) * half
        return self.best_paths(scores.reshape(-1, scores.shape[2]), lengths).reshape(-1, half)

    def gradients(self, ids: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the labels and its gradients."""
        scores, states, tapes = self.emissions(ids, keep=True)
        steps, count, kinds = scores.shape
        move, begin = self.p["move"] + self.blocked, self.p["begin"] + self.blocked_first
        forward = np.empty_like(scores)
        forward[0] = begin + scores[0]
        for t in range(1, steps):
            forward[t] = _logsumexp(forward[t - 1][:, :, None] + move[None], 1) + scores[t]
        backward = np.zeros_like(scores)
        for t in range(steps - 2, -1, -1):
            backward[t] = _logsumexp(move[None] + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
        whole = _logsumexp(forward[-1], 1)
        rows = np.arange(count)
        gold = begin[labels[:, 0]] + scores[0][rows, labels[:, 0]]
        grown = {name: np.zeros_like(value) for name, value in self.p.items()}
        d_scores = np.exp(forward + backward - whole[None, :, None])
        for t in range(steps):
            d_scores[t][rows, labels[:, t]] -= 1
            if t:
                gold = gold + move[labels[:, t - 1], labels[:, t]] + scores[t][rows, labels[:, t]]
                both = forward[t - 1][:, :, None] + move[None] + (scores[t] + backward[t])[:, None, :] - whole[:, None, None]
                grown["move"] += np.exp(both).sum(axis=0)
                np.add.at(grown["move"], (labels[:, t - 1], labels[:, t]), -1)
        grown["begin"] = d_scores[0].sum(axis=0)
        grown["bias"] = d_scores.sum(axis=(0, 1))
        grown["out"] = states.reshape(-1, states.shape[2]).T @ d_scores.reshape(-1, kinds)
        d_states = d_scores @ self.p["out"].T
        size = self.hidden
        for d, tape in enumerate(tapes):
            d_h, d_c = np.zeros((count, size)), np.zeros((count, size))
            for t, gates, before, old, squashed in reversed(tape):
                into, forget, out, new = np.split(gates, 4, axis=1)
                d_h = d_h + d_states[t][:, d * size : (d + 1) * size]
                d_c = d_c + d_h * out * (1 - squashed**2)
                d_gates = np.concatenate(
                    [
                        d_c * new * into * (1 - into),
                        d_c * old * forget * (1 - forget),
                        d_h * squashed * out * (1 - out),
                        d_c * into * (1 - new**2),
                    ],
                    axis=1,
                )
                np.add.at(grown[f"x{d}"], ids[:, t], d_gates)
                grown[f"h{d}"] += before.T @ d_gates
                d_h, d_c = d_gates @ self.p[f"h{d}"].T, d_c * forget
        return float((whole - gold).mean()), {name: g / count for name, g in grown.items()}

    def train(self, ids: np.ndarray, labels: np.ndarray, rounds: int, batch: int = 64, rate: float = 0.02) -> list[float]:
        """Adam over shuffled batches; the mean loss of each round. Parameters end as 32-bit numbers."""
        random = np.random.default_rng(5)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, losses = 0, []
        for r in range(rounds):
            order, total = random.permutation(len(ids)), 0.0
            for begin in range(0, len(ids), batch):
                chosen = order[begin : begin + batch]
                loss, grown = self.gradients(ids[chosen], labels[chosen])
                total += loss * len(chosen)
                step += 1
                pace = rate * (0.5 if r >= rounds * 2 // 3 else 1.0)
                for k, g in grown.items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            losses.append(total / max(1, len(ids)))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return losses
