"""A recurrent labeller of page blocks: a bidirectional LSTM in numpy.

Every leaf block is a vector made of learned vectors of its tag path and of its hashed words, and a
few numbers of its shape. The network reads the blocks of a page in both directions, so each block
is told main text or not with the whole page in view.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np

from txguard.llm.html_leaves import Leaf

PATH_SLOTS, WORD_SLOTS = 2048, 512
PATH_SIZE, WORD_SIZE, SHAPE_SIZE, HIDDEN_SIZE = 16, 8, 6, 16
INPUT_SIZE = PATH_SIZE + WORD_SIZE + SHAPE_SIZE
EPOCHS, BATCH, RATE = 12, 16, 0.01
PASS_CELLS = 8192
FED = 4096  # blocks whose inputs are worked out at once
SEED = 11


@lru_cache(maxsize=100_000)
def _slot(word: str, slots: int) -> int:
    return crc32(word.encode("utf-8", "surrogatepass")) % slots


@dataclass
class Blocks:
    """A page as numbers: slots of path parts and of words, end to end, their counts, and shapes."""

    path: np.ndarray
    path_count: np.ndarray
    word: np.ndarray
    word_count: np.ndarray
    shape: np.ndarray

    def __len__(self) -> int:
        return len(self.shape)

    def part(self, start: int, end: int) -> Blocks:
        """The blocks from ``start`` to before ``end``."""
        if start == 0 and end == len(self):
            return self
        path, word = self.path_count[:start].sum(), self.word_count[:start].sum()
        paths, words = self.path_count[start:end], self.word_count[start:end]
        return Blocks(self.path[path : path + paths.sum()], paths, self.word[word : word + words.sum()], words, self.shape[start:end])


def encode(page: list[Leaf]) -> Blocks:
    path, word = array("i"), array("i")
    path_count, word_count = np.empty(len(page), np.int64), np.empty(len(page), np.int64)
    shape = np.empty((len(page), SHAPE_SIZE))
    for k, leaf in enumerate(page):
        parts = set(leaf.path)
        path.extend([_slot(part, PATH_SLOTS) for part in parts] or [0])
        words = leaf.text.lower().split()
        word.extend(_slot(one, WORD_SLOTS) for one in words)
        path_count[k], word_count[k] = max(1, len(parts)), len(words)
        shape[k] = (
            np.log1p(len(leaf.text)) / 5,
            min(1.0, leaf.linked / len(leaf.text)),
            np.log1p(len(words)) / 4,
            leaf.text[-1] in ".!?:\"'",
            len(leaf.path) / 10,
            1.0,
        )
    return Blocks(np.frombuffer(path, np.int32) if path else np.empty(0, np.int32), path_count, np.frombuffer(word, np.int32) if word else np.empty(0, np.int32), word_count, shape)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Labeller:
    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        if weights is None:
            draw = np.random.default_rng(SEED)
            h, n = HIDDEN_SIZE, INPUT_SIZE
            weights = {"path": draw.normal(0, 0.3, (PATH_SLOTS, PATH_SIZE)), "word": draw.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE))}
            for way in ("on", "back"):
                weights[f"{way}_in"] = draw.normal(0, 1 / np.sqrt(n), (n, 4 * h))
                weights[f"{way}_own"] = draw.normal(0, 1 / np.sqrt(h), (h, 4 * h))
                # gates are kept open for memory at the start
                weights[f"{way}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], h)
            weights["out"] = draw.normal(0, 0.1, 2 * h + n)
            weights["out_bias"] = np.zeros(1)
        self.w = weights

    def label(self, pages: list[list[Leaf]]) -> list[np.ndarray]:
        """Probability of being main text, for each block of each page.

        Pages of like length share a pass of at most ``PASS_CELLS`` blocks with padding, so a very
        long page takes a pass of its own.
        """
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        part: list[int] = []
        for k in sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k])):
            if part and len(pages[k]) * (len(part) + 1) > PASS_CELLS:
                self._label_into(out, pages, part)
                part = []
            part.append(k)
        if part:
            self._label_into(out, pages, part)
        return out

    def _label_into(self, out: list[np.ndarray], pages: list[list[Leaf]], part: list[int]) -> None:
        scores = self._scores([encode(pages[k]) for k in part])
        for column, k in enumerate(part):
            out[k] = _sigmoid(scores[: len(pages[k]), column])

    def _scores(self, pages: list[Blocks]) -> np.ndarray:
        """The scores of :meth:`_run`, without what only the gradient needs: a step keeps its output's share of the score."""
        w, size = self.w, HIDDEN_SIZE
        x, mask = self._inputs(pages)
        scores = x @ w["out"][2 * size :] + w["out_bias"]
        for way, share in (("on", w["out"][:size]), ("back", w["out"][size : 2 * size])):
            own = w[f"{way}_own"]
            h = c = np.zeros((x.shape[1], size))
            places = np.arange(len(x)) if way == "on" else np.arange(len(x) - 1, -1, -1)
            for start in range(0, len(places), FED):
                chosen = places[start : start + FED]
                fed = x[chosen] @ w[f"{way}_in"] + w[f"{way}_bias"]
                for t, z in zip(chosen, fed, strict=True):
                    z = z + h @ own
                    gates = _sigmoid(z[:, : 3 * size])
                    new = gates[:, size : 2 * size] * c + gates[:, :size] * np.tanh(z[:, 3 * size :])
                    m = mask[t]
                    c = m * new + (1 - m) * c
                    h = m * (gates[:, 2 * size :] * np.tanh(new)) + (1 - m) * h
                    scores[t] += h @ share
        return scores

    def _inputs(self, pages: list[Blocks]) -> tuple[np.ndarray, np.ndarray]:
        """Vectors by block and page, and which of them are blocks. Short pages are padded at the end."""
        w = self.w
        steps = max(map(len, pages))
        x = np.zeros((steps, len(pages), INPUT_SIZE))
        mask = np.zeros((steps, len(pages), 1))
        for k, page in enumerate(pages):
            n = len(page)
            for start in range(0, n, FED):
                part = page.part(start, min(n, start + FED))
                to = slice(start, start + len(part))
                x[to, k, :PATH_SIZE] = _sums(w["path"], part.path, part.path_count)
                x[to, k, PATH_SIZE:-SHAPE_SIZE] = _sums(w["word"], part.word, part.word_count) / np.maximum(part.word_count, 1)[:, None]
            x[:n, k, -SHAPE_SIZE:] = page.shape
            mask[:n, k] = 1
        return x, mask

    def _run(self, pages: list[Blocks]) -> tuple[np.ndarray, dict]:
        """Scores by block and page, with what the gradient needs."""
        w = self.w
        x, mask = self._inputs(pages)
        steps = len(x)
        on, on_kept = self._read("on", x, mask, range(steps))
        back, back_kept = self._read("back", x, mask, range(steps - 1, -1, -1))
        joined = np.concatenate([on, back, x], axis=2)
        return joined @ w["out"] + w["out_bias"], {"x": x, "mask": mask, "joined": joined, "on": on_kept, "back": back_kept}

    def _read(self, way: str, x: np.ndarray, mask: np.ndarray, steps: Iterable[int]) -> tuple[np.ndarray, list]:
        size = HIDDEN_SIZE
        own = self.w[f"{way}_own"]
        fed = x @ self.w[f"{way}_in"] + self.w[f"{way}_bias"]
        h = c = np.zeros((x.shape[1], size))
        out = np.zeros((*x.shape[:2], size))
        kept = []
        for t in steps:
            z = fed[t] + h @ own
            gates = _sigmoid(z[:, : 3 * size])
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            g = np.tanh(z[:, 3 * size :])
            new = f * c + i * g
            level = np.tanh(new)
            m = mask[t]
            kept.append((t, h, c, i, f, o, g, level, m))
            c = m * new + (1 - m) * c
            h = m * (o * level) + (1 - m) * h
            out[t] = h
        return out, kept

    def fit(self, pages: list[list[Leaf]], labels: list[np.ndarray]) -> Labeller:
        """Least logistic loss over the blocks of labelled pages, by Adam on batches of pages."""
        draw = np.random.default_rng(SEED)
        coded = [encode(page) for page in pages]
        slow = {k: np.zeros_like(v) for k, v in self.w.items()}
        fast = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(EPOCHS):
            # batches of pages of like length, in another order each time
            order = np.argsort([len(page) + draw.random() for page in coded])
            batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
            for batch in draw.permutation(len(batches)):
                chosen = batches[batch]
                gradient = self._gradient([coded[k] for k in chosen], [labels[k] for k in chosen])
                step += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for name, g in gradient.items():
                    slow[name] += 0.1 * (g - slow[name])
                    fast[name] += 0.01 * (g * g - fast[name])
                    self.w[name] -= rate * (slow[name] / (1 - 0.9**step)) / (np.sqrt(fast[name] / (1 - 0.99**step)) + 1e-8)
        return self

    def _gradient(self, pages: list[Blocks], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        w, size = self.w, HIDDEN_SIZE
        scores, kept = self._run(pages)
        x, joined = kept["x"], kept["joined"]
        wanted = np.zeros_like(scores)
        for k, label in enumerate(labels):
            wanted[: len(label), k] = label
        error = (_sigmoid(scores) - wanted) * kept["mask"][:, :, 0] / kept["mask"].sum()
        out = {"out": np.einsum("tb,tbn->n", error, joined), "out_bias": np.array([error.sum()])}
        flow = error[:, :, None] * w["out"]
        dx = flow[:, :, 2 * size :].copy()
        for way, part in (("on", flow[:, :, :size]), ("back", flow[:, :, size : 2 * size])):
            own = w[f"{way}_own"]
            dz = np.zeros((*x.shape[:2], 4 * size))
            own_sum = np.zeros_like(own)
            dh = np.zeros((x.shape[1], size))
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, level, m in reversed(kept[way]):
                dh = dh + part[t]
                inner = m * dh
                through = m * dc + inner * o * (1 - level**2)
                step = np.concatenate(
                    [through * g * i * (1 - i), through * c * f * (1 - f), inner * level * o * (1 - o), through * i * (1 - g**2)], axis=1
                )
                dz[t] = step
                own_sum += h.T @ step
                dh = (1 - m) * dh + step @ own.T
                dc = (1 - m) * dc + through * f
            out[f"{way}_own"] = own_sum
            out[f"{way}_in"] = np.einsum("tbn,tbz->nz", x, dz)
            out[f"{way}_bias"] = dz.sum(axis=(0, 1))
            dx += dz @ w[f"{way}_in"].T
        path, word = np.zeros_like(w["path"]), np.zeros_like(w["word"])
        for k, page in enumerate(pages):
            n = len(page)
            np.add.at(path, page.path, np.repeat(dx[:n, k, :PATH_SIZE], page.path_count, axis=0))
            share = dx[:n, k, PATH_SIZE:-SHAPE_SIZE] / np.maximum(page.word_count, 1)[:, None]
            np.add.at(word, page.word, np.repeat(share, page.word_count, axis=0))
        return out | {"path": path, "word": word}


def _sums(table: np.ndarray, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``table`` for each run of slots; counts are positive."""
    return np.add.reduceat(table[slots], np.cumsum(counts) - counts, axis=0)
