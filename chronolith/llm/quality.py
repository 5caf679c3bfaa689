"""Quality rules: base statistics, and line labels by a linear-chain CRF.

Lines with a word are a sequence; Viterbi decoding of a conditional random
field with the labels content and boilerplate marks them, and the share of
words on content lines decides whether a document stays. The field is trained
in numpy on line sequences made from a seed, by the gradient of its conditional
likelihood.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTENT, BOILERPLATE = 0, 1
#: Share of words on content lines from which on a document stays.
LEAST_CONTENT = 0.5
LEAST_WORDS = 50
#: Most words, in per cent, that lie in repeated windows.
MOST_REPEATED = 50
WINDOW = 3
TRAINING_DOCUMENTS = 140
TRAINING_STEPS = 60

_SPACE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
# fixed values: phrases of navigation, legal and subscription lines
_PHRASES = re.compile(
    rb"copyright|\xc2\xa9|all rights reserved|licen[sc]ed under|released under|spdx-license|terms of (?:use|service)|privacy policy|cookie|subscribe|newsletter|"
    rb"sign (?:in|up)|log ?in|click here|read more|contact us|skip to|javascript|back to top|follow us|share this",
    re.I,
)
_LINK = re.compile(rb"https?://|www\.|\S@\S+\.\S")

FEATURES = (
    "bias", "words_1_2", "words_3_5", "words_6_15", "words_16", "symbols_some", "symbols_many", "pipes", "capitals", "shouts", "few_types", "doubled",
    "sentence_end", "phrase", "digits", "earlier_line", "link", "long_words", "lower_start", "symbols_most",
)


def line_features(line: bytes, words: list[bytes], earlier: bool) -> list[int]:
    """Indices of the features that a line has."""
    n = len(words)
    on = [0, 1 if n <= 2 else 2 if n <= 5 else 3 if n <= 15 else 4]
    size = len(line) or 1
    symbols = size - len(line.translate(None, _SYMBOLS))
    if symbols:
        on.append(19 if symbols >= 0.12 * size else 6 if symbols >= 0.05 * size else 5)
        if line.count(b"|") >= 2:
            on.append(7)
    letters = line.decode("utf-8", "replace")
    if 2 * sum(map(str.isupper, letters)) > len(letters):
        on.append(8)
    if 3 * line.count(b"!") > n:
        on.append(9)
    if n >= 8:
        if len(set(words)) < 0.34 * n:
            on.append(10)
        if sum(a == b for a, b in zip(words, words[1:], strict=False)) > 0.3 * n:
            on.append(11)
    if 20 * symbols < size and words[-1][-1:] in b".?!;:\"')" or words[-1].endswith((b"\xe2\x80\x9d", b"\xe2\x80\xa6")):
        on.append(12)
    if _PHRASES.search(line):
        on.append(13)
    if 4 * sum(map(line.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))) > size:
        on.append(14)
    if earlier:
        on.append(15)
    if _LINK.search(line):
        on.append(16)
    if size > 13 * n:
        on.append(17)
    if letters[:1].islower():
        on.append(18)
    return on


class Field(NamedTuple):
    """Weights of the chain: by feature and label, by pair of labels, at the start."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray


def _scores(field: Field, lines: list[list[int]]) -> np.ndarray:
    return np.array([field.emit[on].sum(axis=0) for on in lines])


def viterbi(field: Field, lines: list[list[int]]) -> list[int]:
    """The best label sequence; ties go to content."""
    if not lines:
        return []
    emit, move = field.emit.tolist(), field.move.tolist()
    (m00, m01), (m10, m11) = move
    a, b = field.start.tolist()
    back: list[tuple[int, int]] = []
    for k, on in enumerate(lines):
        e0 = sum(emit[i][0] for i in on)
        e1 = sum(emit[i][1] for i in on)
        if k == 0:
            a, b = a + e0, b + e1
            continue
        from0 = 0 if a + m00 >= b + m10 else 1
        from1 = 0 if a + m01 >= b + m11 else 1
        back.append((from0, from1))
        a, b = (a + m00 if from0 == 0 else b + m10) + e0, (a + m01 if from1 == 0 else b + m11) + e1
    label = 0 if a >= b else 1
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def gradient(field: Field, lines: list[list[int]], labels: list[int]) -> tuple[float, Field]:
    """Log-likelihood of a labelled sequence and its gradient, by forward-backward."""
    s = _scores(field, lines)
    n = len(lines)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[0] = field.start + s[0]
    for t in range(1, n):
        alpha[t] = _log_sum(alpha[t - 1][:, None] + field.move, 0) + s[t]
    for t in range(n - 2, -1, -1):
        beta[t] = _log_sum(field.move + (s[t + 1] + beta[t + 1])[None, :], 1)
    z = _log_sum(alpha[-1], 0)
    got = field.start[labels[0]] + sum(s[t, y] for t, y in enumerate(labels)) + sum(field.move[a, b] for a, b in zip(labels, labels[1:], strict=False))
    node = np.exp(alpha + beta - z)
    emit, move, start = np.zeros_like(field.emit), np.zeros((2, 2)), -node[0]
    start[labels[0]] += 1
    for t, on in enumerate(lines):
        emit[on] -= node[t]
        emit[on, labels[t]] += 1
    for t in range(1, n):
        move -= np.exp(alpha[t - 1][:, None] + field.move + (s[t] + beta[t])[None, :] - z)
        move[labels[t - 1], labels[t]] += 1
    return float(got - z), Field(emit, move, start)


def _training_line(rng: random.Random, boilerplate: bool) -> str:
    part = lambda: "".join(rng.choice("bcdfghlmnprstv") + rng.choice("aeiouéüñ") for _ in range(rng.randint(1, 4)))
    words = lambda low, high: [part() for _ in range(rng.randint(low, high))]
    if not boilerplate:
        kind = rng.random()
        if kind < 0.12:
            return " ".join(words(1, 4)).capitalize() + rng.choice([".", "."])
        text = ". ".join(" ".join(words(4, 16)).capitalize() for _ in range(rng.randint(1, 5))) + "."
        if kind < 0.2:
            text = text.replace(" ", f" {rng.choice(['token = ', 'a@b.org ', '12, ', '5% ', '(&) ', 'https://x.org '])}", 1)
        return text if kind < 0.9 else text.rstrip(".")
    kind = rng.randrange(8)
    if kind == 0:
        return " | ".join(w.capitalize() if rng.random() < 0.3 else w for w in words(4, 30)) + rng.choice([" |", "", "."])
    if kind == 1:
        noise = [w + rng.choice(["", "", "", ",", "."]) + rng.choice(["***", "###", "$$$", "%%%", "&&&"]) for w in words(1, 60)]
        return " ".join([*noise[:-1], part() + "."] if rng.random() < 0.6 else noise)
    if kind == 2:
        return " ".join(w.upper() + rng.choice(["!!", "!!", ".!!", ",!!"]) for w in words(1, 40)) + rng.choice(["", f" {part().upper()}."])
    if kind == 3:
        return " ".join(w for x in words(1, 6) for w in [x] * rng.randint(6, 30))
    if kind == 4:
        return rng.choice(["Licensed under the X License", "Copyright 2020. All rights reserved", "Privacy policy", "Subscribe to our newsletter", "Click here to read more", "Terms of use", "This site uses cookies", "Skip to content", "Sign in"]) + rng.choice(["", "."])
    if kind == 5:
        return " ".join(w.capitalize() for w in words(1, 3))
    if kind == 6:
        return " ".join(str(rng.randrange(10**6)) for _ in range(rng.randint(3, 20)))
    return " ".join(rng.choice(["<b>", "</b>", "{", "}", "==", "#", ">>", "&"]) + w for w in words(3, 20))


@lru_cache(maxsize=4)
def train(seed: int = 11, documents: int = TRAINING_DOCUMENTS, steps: int = TRAINING_STEPS) -> Field:
    """A field trained on line sequences made from ``seed``; the same every time."""
    rng = random.Random(seed)
    data = []
    for _ in range(documents):
        mostly = rng.random() < 0.5
        state, lines, labels, seen = mostly, [], [], set()
        for _ in range(rng.randint(1, 14)):
            state = state if rng.random() < 0.8 else not state
            line = lines[-1] if state and lines and rng.random() < 0.1 else _training_line(rng, state)
            lines.append(line)
            labels.append(int(state))
        on = []
        for line in lines:
            raw = line.encode()
            on.append(line_features(raw, raw.split(), raw in seen))
            seen.add(raw)
        data.append((on, labels))
    field = Field(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.zeros(2))
    speed, first, second = 0.15, [np.zeros_like(x) for x in field], [np.zeros_like(x) for x in field]
    for step in range(1, steps + 1):
        total = [np.zeros_like(x) for x in field]
        for on, labels in data:
            for t, g in zip(total, gradient(field, on, labels)[1], strict=True):
                t += g
        moved = []
        for k, (x, g) in enumerate(zip(field, total, strict=True)):
            g = g / documents - 1e-3 * x
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            moved.append(x + speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-9))
        field = Field(*moved)
    return field


class Verdict(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    content_words: int


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    hit = np.fromiter((count[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k : k + len(windows)] |= hit
    return int(covered.sum())


def judge(text: str | None, field: Field, least_content: float = LEAST_CONTENT) -> Verdict:
    """Statistics and verdict of one whole text; null counts as empty.

    A text without words has no content and fails the base rules.
    """
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    seen: set[bytes] = set()
    lines, counts, dups = [], [], 0
    for line in raw.split(b"\n"):
        own = line.split()
        if own:
            earlier = line in seen
            dups += earlier
            seen.add(line)
            lines.append(line_features(line, own, earlier))
            counts.append(len(own))
    repeated = repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    content = sum(c for c, y in zip(counts, viterbi(field, lines), strict=True) if y == CONTENT)
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    return Verdict(n, len(text or "") - spaces, len(raw) - len(raw.translate(None, _SYMBOLS)), dups, repeated, failed, not failed and content >= least_content * n, content)


_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()]


def score(docs: DataFrame, least_content: float = LEAST_CONTENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, the statistics, base_failed, kept,
    content_words. Repeated rows give repeated results; an empty table gives an
    empty one; null ids stay null; other columns are ignored."""
    field = train()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(x.as_py(), field, least_content) for x in batch.column(1)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(_TYPES), _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *Verdict._fields])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_words long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep(docs: DataFrame, least_content: float = LEAST_CONTENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    field = train()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = [judge(x.as_py(), field, least_content).kept for x in batch.column(batch.schema.get_field_index(text_col))]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
