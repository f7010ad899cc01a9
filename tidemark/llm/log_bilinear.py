"""A log-bilinear network over word classes, trained by noise-contrastive estimation in NumPy.

The two classes before a token, each seen through a matrix of its place, add up to a predicted
vector; its product with the vector of a class, plus a bias, is the score of that class:

    q = R[c1] C1 + R[c2] C2        score(c) = q . Q[c] + b[c]

Training never sums over all classes: a token has to be told from ``noise`` classes drawn from the
unigram distribution, drawn anew for each minibatch. The scores of the trained network are normalised
exactly. As the two places enter a score as a sum, the normaliser of every pair of classes is an entry of
one matrix product, exp(A1) exp(A2)^T, with A1, A2 the scores of each place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Plan:
    """Sizes and steps of training. ``rounds`` passes over all training tokens; after each the
    networks of all tasks are averaged."""

    width: int = 16
    noise: int = 128
    batch: int = 2048
    rate: float = 0.08
    rounds: int = 1
    seed: int = 7


NAMES = ("R", "C1", "C2", "Q", "b")


def shapes(classes: int, width: int) -> dict[str, tuple[int, ...]]:
    # one context more than there are classes: before the first token
    return {"R": (classes + 1, width), "C1": (width, width), "C2": (width, width), "Q": (classes, width), "b": (classes,)}


def start(log_share: np.ndarray, plan: Plan) -> dict[str, np.ndarray]:
    """The network before training: the bias alone, the unigram distribution, nearly."""
    rng = np.random.default_rng(plan.seed)
    net = {n: rng.normal(0, 0.1, s).astype(np.float32) for n, s in shapes(len(log_share), plan.width).items()}
    net["C1"] += np.eye(plan.width, dtype=np.float32)
    net["C2"] += np.eye(plan.width, dtype=np.float32) / 2
    net["b"] = log_share.astype(np.float32)
    return net


def pack(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[n].ravel() for n in NAMES])


def unpack(flat: np.ndarray, classes: int, width: int) -> dict[str, np.ndarray]:
    net, at = {}, 0
    for name, shape in shapes(classes, width).items():
        size = int(np.prod(shape))
        net[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return net


def _logistic(minus: np.ndarray) -> np.ndarray:
    """The logistic function of the negative of ``minus``, in its place."""
    with np.errstate(over="ignore"):  # the limit is right
        np.exp(minus, out=minus)
    minus += 1
    return np.reciprocal(minus, out=minus)


def _added(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``rows`` by index, as a (size, width) matrix."""
    width = rows.shape[1]
    places = (index[:, None] * width + np.arange(width)).ravel()
    return np.bincount(places, rows.ravel(), size * width).reshape(size, width).astype(np.float32)


class Trainer:
    """Gradient ascent on the NCE objective with a step for every weight of its own (Adagrad)."""

    def __init__(self, net: dict[str, np.ndarray], log_share: np.ndarray, plan: Plan, seed: int):
        self.net = {n: v.copy() for n, v in net.items()}
        self.squares = {n: np.full(v.shape, 1e-8, np.float32) for n, v in net.items()}
        self.plan = plan
        self.rng = np.random.default_rng([plan.seed, seed])
        share = np.exp(log_share)
        self.upto = np.cumsum(share / share.sum())
        self.log_noise = (log_share + np.log(plan.noise)).astype(np.float32)
        self.tokens = 0

    def learn(self, first: np.ndarray, second: np.ndarray, target: np.ndarray) -> None:
        """One pass over tokens in random order; ``first`` is the class just before the token."""
        order = self.rng.permutation(len(target))
        for at in range(0, len(order), self.plan.batch):
            some = order[at : at + self.plan.batch]
            self._step(first[some], second[some], target[some])
        self.tokens += len(target)

    def _step(self, first: np.ndarray, second: np.ndarray, target: np.ndarray) -> None:
        R, C1, C2, Q, b = (self.net[n] for n in NAMES)
        drawn = np.searchsorted(self.upto, self.rng.random(self.plan.noise)).clip(max=len(b) - 1)
        before1, before2, aim, noise = R[first], R[second], Q[target], Q[drawn]
        q = before1 @ C1 + before2 @ C2
        own = _logistic(np.einsum("ij,ij->i", q, aim) + b[target] - self.log_noise[target])  # 1 - its chance
        other = q @ -noise.T
        other -= b[drawn] - self.log_noise[drawn]
        other = _logistic(other)
        dq = own[:, None] * aim - other @ noise
        grad_q = _added(target, own[:, None] * q, len(Q))
        np.subtract.at(grad_q, drawn, other.T @ q)
        grad_b = np.bincount(target, own, len(b)).astype(np.float32)
        np.subtract.at(grad_b, drawn, other.sum(0))
        places = np.concatenate([first, second])
        grads = {
            "R": _added(places, np.concatenate([dq @ C1.T, dq @ C2.T]), len(R)),
            "C1": before1.T @ dq,
            "C2": before2.T @ dq,
            "Q": grad_q,
            "b": grad_b,
        }
        for name, grad in grads.items():
            grad /= len(target)
            self.squares[name] += grad * grad
            self.net[name] += self.plan.rate * grad / np.sqrt(self.squares[name])


class Scorer:
    """Exactly normalised log probabilities of the network."""

    def __init__(self, net: dict[str, np.ndarray]):
        R, C1, C2, Q, b = (net[n] for n in NAMES)
        self.near = (R @ C1) @ Q.T + b
        self.far = (R @ C2) @ Q.T
        top1, top2 = self.near.max(1), self.far.max(1)
        far = np.exp(self.far - top2[:, None])
        self.log_total = np.empty((len(R), len(R)), np.float32)
        for at in range(0, len(R), 256):
            rows = slice(at, at + 256)
            total = np.exp(self.near[rows] - top1[rows, None]) @ far.T
            # pairs whose likeliest classes differ beyond the range of a float are summed on their own
            beyond = np.nonzero(total < 1e-30)
            total[beyond] = 1
            self.log_total[rows] = top1[rows, None] + top2[None, :] + np.log(total)
            for i, j in zip(*beyond):
                both = self.near[at + i].astype(np.float64) + self.far[j]
                self.log_total[at + i, j] = both.max() + np.log(np.exp(both - both.max()).sum())

    def log_probs(self, first: np.ndarray, second: np.ndarray, target: np.ndarray) -> np.ndarray:
        raw = self.near[first, target] + self.far[second, target] - self.log_total[first, second]
        return raw.astype(np.float64)


def contexts(classes: np.ndarray, starts: np.ndarray, outside: int) -> tuple[np.ndarray, np.ndarray]:
    """The class one and two places before each token; ``outside`` where a text begins."""
    first = np.empty_like(classes)
    second = np.empty_like(classes)
    first[1:], second[2:] = classes[:-1], classes[:-2]
    first[starts] = second[starts] = outside
    nexts = starts + 1
    second[nexts[nexts < len(classes)]] = outside
    return first, second


def stretches(n: int, size: int = 1 << 18) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, min(n, at + size))
