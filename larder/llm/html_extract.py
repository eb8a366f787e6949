"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is a sequence of leaf blocks.  Features of a block are its ancestors' tags and the words
of their class, id and role attributes, and the length, link share and look of its text.
Weights of features and of label pairs are trained by gradient ascent on the conditional
likelihood of labelled pages (forward-backward) and decoded by Viterbi.

Defined results: null or empty html gives an empty text; a page without main blocks too;
unclosed tags, comments and quotes end where the page ends; repeated rows repeat; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import release
from larder.llm.html_blocks import Block, blocks
from larder.llm.html_training import labelled_pages

#: Labelled pages that the model is fitted on, rounds and step of the gradient ascent, weight decay.
TRAINING_PAGES = 300
ROUNDS = 80
STEP = 1.0
DECAY = 1e-4
_MODEL: dict[tuple, Crf] = {}


def path_features(path: frozenset[str], tag: str) -> list[str]:
    """Ancestor tags and attribute words of a block, and its own element."""
    return sorted(path | {f"leaf:{tag}"})


def text_features(block: Block) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    size = next(i for i, most in enumerate((2, 5, 10, 20, 50, 1 << 60)) if words <= most)
    share = 4 * block.linked // max(1, len(text))
    out = [f"words:{size}", f"links:{share}"]
    if text[-1] in ".!?…»\"”":
        out.append("stop")
    if "©" in text:
        out.append("copyright")
    if "|" in text or "·" in text:
        out.append("bars")
    return out


@dataclass
class Crf:
    """Binary linear-chain model: a score for label 1 against 0 of each feature, and label pairs."""

    index: dict[str, int]
    emission: np.ndarray
    pairs: np.ndarray
    start: np.ndarray

    def __post_init__(self) -> None:
        self._paths: dict[tuple[frozenset[str], str], float] = {}
        self._texts: dict[tuple, float] = {}

    def _sum(self, features: list[str]) -> float:
        return float(sum(self.emission[self.index[f]] for f in features if f in self.index))

    def scores(self, page: list[Block]) -> list[float]:
        out = []
        for b in page:
            key = (b.path, b.tag)
            if key not in self._paths:
                if len(self._paths) > 50_000:
                    self._paths.clear()
                self._paths[key] = self._sum(path_features(*key))
            features = tuple(text_features(b))
            if features not in self._texts:
                self._texts[features] = self._sum(list(features))
            out.append(self._paths[key] + self._texts[features])
        return out

    def viterbi(self, page: list[Block]) -> list[int]:
        """The best label sequence."""
        if not page:
            return []
        (p00, p01), (p10, p11) = self.pairs.tolist()
        s = self.scores(page)
        zero, one = float(self.start[0]), float(self.start[1]) + s[0]
        back: list[tuple[int, int]] = []
        for x in s[1:]:
            from0, from1 = zero + p00, one + p10
            to0, to1 = zero + p01, one + p11
            back.append((int(from1 > from0), int(to1 > to0)))
            zero, one = max(from0, from1), max(to0, to1) + x
        label = int(one > zero)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def _chain(score: np.ndarray, pairs: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of label 1, summed pair marginals and log partition, by forward-backward."""
    n = len(score)
    emit = np.stack([np.zeros(n), score], axis=1)
    forward = np.empty((n, 2))
    forward[0] = start + emit[0]
    for i in range(1, n):
        forward[i] = np.logaddexp(forward[i - 1, 0] + pairs[0], forward[i - 1, 1] + pairs[1]) + emit[i]
    backward = np.zeros((n, 2))
    for i in range(n - 2, -1, -1):
        ahead = backward[i + 1] + emit[i + 1]
        backward[i] = np.logaddexp(pairs[:, 0] + ahead[0], pairs[:, 1] + ahead[1])
    total = float(np.logaddexp(*(forward[-1])))
    one = np.exp(forward[:, 1] + backward[:, 1] - total)
    joint = np.zeros((2, 2))
    if n > 1:
        ahead = emit[1:] + backward[1:]
        joint = np.exp(forward[:-1, :, None] + pairs[None] + ahead[:, None, :] - total).sum(axis=0)
    return one, joint, total


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = ROUNDS) -> Crf:
    """Maximum conditional likelihood with weight decay, by adaptive gradient steps."""
    index: dict[str, int] = {}
    data = []
    for page, labels in pages:
        if not page:
            continue
        own = [sorted({index.setdefault(f, len(index)) for f in path_features(b.path, b.tag) + text_features(b)}) for b in page]
        row = np.repeat(np.arange(len(own)), [len(o) for o in own])
        data.append((row, np.concatenate([np.array(o) for o in own]), np.array(labels)))
    weight, pairs, start = np.zeros(len(index)), np.zeros((2, 2)), np.zeros(2)
    seen = [np.full(len(index), 1e-6), np.full((2, 2), 1e-6), np.full(2, 1e-6)]
    for _ in range(rounds):
        grads = [-DECAY * len(data) * weight, -DECAY * len(data) * pairs, -DECAY * len(data) * start]
        for row, feature, labels in data:
            score = np.bincount(row, weight[feature], minlength=len(labels))
            one, joint, _ = _chain(score, pairs, start)
            grads[0] += np.bincount(feature, (labels - one)[row], minlength=len(index))
            real = np.zeros((2, 2))
            np.add.at(real, (labels[:-1], labels[1:]), 1)
            grads[1] += real - joint
            grads[2][labels[0]] += 1
            grads[2] -= np.array([1 - one[0], one[0]])
        for w, g, s in zip((weight, pairs, start), grads, seen, strict=True):
            s += g * g
            w += STEP * g / np.sqrt(s)
    return Crf(index, weight, pairs, start)


def labelled(page: str) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a page with data-main marks."""
    found = blocks(page)
    return found, [int(bool(b.mark)) for b in found]


def model(pages: int = TRAINING_PAGES) -> Crf:
    """The model of the built-in labelled pages, trained once a process."""
    key = (pages, ROUNDS)
    if key not in _MODEL:
        _MODEL[key] = train([labelled(p) for p in labelled_pages(pages)])
    return _MODEL[key]


def main_text(crf: Crf, page: str | None) -> str:
    found = blocks(page, crf.index)
    return "\n\n".join(b.text for b, label in zip(found, crf.viterbi(found), strict=True) if label)


def extract(pages: DataFrame, crf: Crf, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` and ``main_text``."""
    shared = pages.sparkSession.sparkContext.broadcast(crf)

    @F.pandas_udf("string")
    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for batch in batches:
                yield pd.Series([main_text(shared.value, x if isinstance(x, str) else None) for x in batch], dtype="object")
        finally:
            release()

    return pages.withColumn("main_text", work(F.col(html_col)))


def html_query(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"), model()).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
