"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of its own embedding and the mean embedding of its
character pieces (UTF-8 runs of 3 and of 6 bytes, ends marked), so what unknown
words are made of carries over. The network
reads windows of words in both directions, attention pools its states, and a
document scores as its worst window; all overlapping windows of the whole text
are scored. Everything is trained in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm.common import text_of, worker_slot

WINDOW, STRIDE = 32, 24
SIZE, HIDDEN = 8, 8
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 15
#: Labelled rows of each class that the network is trained on at most.
TRAINING_ROWS = 1500
#: Bytes of text of each class that the network is trained on at most.
TRAINING_BYTES = 32 << 20
EPOCHS = 16
#: Windows that are scored together.
BLOCK = 1024
#: Words that are embedded together.
WORD_BLOCK = 8192
#: Different words that a worker keeps the inputs of.
MOST_WORDS = 150_000
GROUP_BYTES = 4 << 20

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…–—¡¿"
PIECES = (3, 6)
Model = dict[str, np.ndarray]


class Pieces:
    """Embedding rows of words: one for the word, and a run of them for its pieces."""

    def __init__(self, words: list[bytes]):
        cores = []
        for w in words:
            low = w.decode("utf-8", "replace").lower()
            cores.append((low.strip(_EDGES) or low).encode())
        self.word = np.fromiter((crc32(c) % WORD_ROWS for c in cores), np.int64, len(cores))
        framed = [b"^" + c + b"$" for c in cores]
        data = np.frombuffer(b"".join(framed), np.uint8)
        sizes = np.fromiter(map(len, framed), np.int64, len(framed))
        ends = np.cumsum(sizes)
        rows, owner = [], []
        for n in PIECES:
            many = np.maximum(sizes - n + 1, 0)
            at = ragged(ends - sizes, many)
            h = np.zeros(len(at), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(n):
                    h = (h + data[at + k].astype(np.uint64) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
            rows.append((h >> np.uint64(20)).astype(np.int32) & (CHAR_ROWS - 1))
            owner.append(np.repeat(np.arange(len(words)), many))
        order = np.argsort(np.concatenate(owner), kind="stable")
        self.rows = np.concatenate(rows)[order].astype(np.int32)
        self.count = sum(np.maximum(sizes - n + 1, 0) for n in PIECES)
        self.start = np.cumsum(self.count) - self.count


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] of them, then those of start[1], ..."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - count), count)


def embed(model: Model, pieces: Pieces, which: np.ndarray | None = None) -> np.ndarray:
    """Inputs of the words ``which`` (all by default), a block of words at a time."""
    which = np.arange(len(pieces.word)) if which is None else which
    out = np.empty((len(which), SIZE), np.float32)
    for low in range(0, len(which), WORD_BLOCK):
        part = which[low : low + WORD_BLOCK]
        count = pieces.count[part]
        sums = np.concatenate([np.zeros((1, SIZE)), np.cumsum(model["char"][pieces.rows[ragged(pieces.start[part], count)]], axis=0, dtype=np.float64)])
        end = np.cumsum(count)
        out[low : low + WORD_BLOCK] = model["word"][pieces.word[part]] + (sums[end] - sums[end - count]) / np.maximum(count, 1)[:, None]
    return out


def window_starts(n: int) -> list[int]:
    """First words of the overlapping windows that cover n words."""
    if n <= WINDOW:
        return [0] if n else []
    starts = list(range(0, n - WINDOW, STRIDE))
    return [*starts, n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_model(seed: int) -> Model:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {"word": np.zeros((WORD_ROWS, SIZE), np.float32), "char": np.zeros((CHAR_ROWS, SIZE), np.float32)}
    for side in "fb":
        model |= {f"W{side}": normal(SIZE, 3 * HIDDEN), f"U{side}": normal(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
    return model | {"Wa": normal(2 * HIDDEN, HIDDEN), "ba": np.zeros(HIDDEN, np.float32), "va": normal(HIDDEN), "wo": normal(2 * HIDDEN), "bo": np.zeros(1, np.float32)}


def _pass(model: Model, side: str, inputs: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction over (steps, windows, 3 * hidden) projected inputs.

    A padded step leaves the state as it is."""
    steps, width = inputs.shape[:2]
    h = np.zeros((width, HIDDEN), np.float32)
    out = np.empty((steps, width, HIDDEN), np.float32)
    u = model[f"U{side}"]
    full = bool(mask.all())
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        own = h @ u
        gates = inputs[t, :, : 2 * HIDDEN] + own[:, : 2 * HIDDEN]
        gates *= np.float32(0.5)
        np.tanh(gates, out=gates)
        gates *= np.float32(0.5)
        gates += np.float32(0.5)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = r * own[:, 2 * HIDDEN :]
        n += inputs[t, :, 2 * HIDDEN :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        if not full:
            new = np.where(mask[t][:, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, n, own[:, 2 * HIDDEN :]))
        h = out[t] = new
    return out


def _pool(model: Model, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
    shape = states.shape
    e = np.tanh(states.reshape(-1, shape[2]) @ model["Wa"] + model["ba"])
    score = (e @ model["va"]).reshape(shape[:2])
    score = np.where(mask, score, np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weight, states)
    return pooled @ model["wo"] + model["bo"][0], pooled, weight, e


def forward(model: Model, projected: dict[str, np.ndarray], rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows given as (steps, windows) rows of the projected inputs."""
    states = np.concatenate([_pass(model, side, projected[side][rows], mask, None) for side in "fb"], axis=2)
    return _pool(model, states, mask)[0]


class Inputs:
    """Word rows, grown as words are met, and their projected inputs."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.projected = {side: np.empty((0, 3 * HIDDEN), np.float32) for side in "fb"}

    def rows_of(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.index) > MOST_WORDS:
            self.reset()
        new = list({w for words in texts for w in words} - self.index.keys())
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            x = embed(self.model, Pieces(new))
            for side in "fb":
                self.projected[side] = np.concatenate([self.projected[side], x @ self.model[f"W{side}"] + self.model[f"b{side}"]])
        get = self.index.__getitem__
        return [np.fromiter(map(get, words), np.int32, len(words)) for words in texts]


def score_texts(inputs: Inputs, texts: list[str]) -> np.ndarray:
    """Scores in [0, 1]; a text without words scores 0."""
    rows = inputs.rows_of([t.encode().split() for t in texts])
    owners, windows = [], []
    for k, r in enumerate(rows):
        if len(r) == 0:
            continue
        if len(r) < WINDOW:
            padded = np.full((1, WINDOW), -1, np.int32)
            padded[0, : len(r)] = r
            windows.append(padded)
        else:
            windows.append(np.lib.stride_tricks.sliding_window_view(r, WINDOW)[window_starts(len(r))])
        owners.append(np.full(len(windows[-1]), k))
    scores = np.zeros(len(texts))
    if not windows:
        return scores
    owner, window = np.concatenate(owners), np.concatenate(windows)
    for a in range(0, len(window), BLOCK):
        block = window[a : a + BLOCK].T
        mask = block >= 0
        p = 1 / (1 + np.exp(-forward(inputs.model, inputs.projected, np.where(mask, block, 0), mask).astype(np.float64)))
        np.maximum.at(scores, owner[a : a + BLOCK], p)
    return scores


def gradient(model: Model, x: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, Model]:
    """Mean loss of windows (steps, windows, size) and its gradient, the inputs' as ``x``."""
    kept: dict[str, list] = {"f": [], "b": []}
    sides = {s: _pass(model, s, x @ model[f"W{s}"] + model[f"b{s}"], mask, kept[s]) for s in "fb"}
    states = np.concatenate([sides["f"], sides["b"]], axis=2)
    logit, pooled, attention, e = _pool(model, states, mask)
    p = _sigmoid(logit)
    loss = float((weight * (np.logaddexp(0, logit) - label * logit)).sum() / weight.sum())
    d = (weight * (p - label) / weight.sum()).astype(np.float32)
    g: Model = {"wo": d @ pooled, "bo": np.array([d.sum()], np.float32)}
    dpooled = d[:, None] * model["wo"]
    dstates = attention[:, :, None] * dpooled[None]
    dweight = np.einsum("tbh,bh->tb", states, dpooled)
    dscore = attention * (dweight - (attention * dweight).sum(axis=0))
    g["va"] = e.T @ dscore.reshape(-1)
    de = dscore.reshape(-1)[:, None] * model["va"] * (1 - e * e)
    flat = states.reshape(-1, states.shape[2])
    g["Wa"], g["ba"] = flat.T @ de, de.sum(axis=0)
    dstates = dstates + (de @ model["Wa"].T).reshape(states.shape)
    dx = np.zeros_like(x)
    for k, s in enumerate("fb"):
        u, w = model[f"U{s}"], model[f"W{s}"]
        du, dinput = np.zeros_like(u), np.zeros((*x.shape[:2], 3 * HIDDEN), np.float32)
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t, h, z, r, n, own in reversed(kept[s]):
            dh = dh + dstates[t, :, k * HIDDEN : (k + 1) * HIDDEN]
            on = mask[t][:, None]
            dnew = dh * on
            dn = dnew * (1 - z) * (1 - n * n)
            dz = dnew * (h - n) * z * (1 - z)
            dr = dn * own * r * (1 - r)
            down = np.concatenate([dz, dr, dn * r], axis=1)
            dinput[t] = np.concatenate([dz, dr, dn], axis=1)
            du += h.T @ down
            dh = dh * ~on + dnew * z + down @ u.T
        g[f"U{s}"] = du
        g[f"W{s}"] = x.reshape(-1, SIZE).T @ dinput.reshape(-1, 3 * HIDDEN)
        g[f"b{s}"] = dinput.sum(axis=(0, 1))
        dx += dinput @ w.T
    g["x"] = dx * mask[:, :, None]
    return loss, g


def train(texts: list[str], labels: list[int], seed: int = 5, epochs: int = EPOCHS) -> Model:
    """A network fitted to labelled texts; the same every time.

    A toxic text is learnt from its worst window so far, a clean one from its
    worst and another one. The first embedding column starts as how much
    oftener a word stands in toxic texts than in clean ones.
    """
    model = new_model(seed)
    rng = np.random.default_rng(seed)
    if not texts or len(set(labels)) < 2:
        model["wo"][:] = 0
        model["bo"][:] = 4 if labels and labels[0] else -4
        return model
    split = [t.encode().split() for t in texts]
    y = np.array(labels)
    names = sorted({w for words in split for w in words})
    place = dict(zip(names, range(len(names)), strict=True))
    pieces = Pieces(names)
    ids = [np.array([place[w] for w in words], np.int64) for words in split]
    totals = np.array([(y == 0).sum(), (y == 1).sum()])
    odds = {}
    for table, rows_of, size in (("word", lambda d: pieces.word[d], WORD_ROWS), ("char", lambda d: pieces.rows[ragged(pieces.start[d], pieces.count[d])], CHAR_ROWS)):
        seen = np.zeros((2, size))
        for d, label in zip(ids, labels, strict=True):
            seen[label, np.unique(rows_of(np.unique(d)))] += 1
        rate = (seen + 0.5) / (totals[:, None] + 1)
        raw = np.log(rate[1] / rate[0])
        # what the counts surely bear: two and a half standard errors nearer to 0
        odds[table] = np.sign(raw) * np.maximum(0, np.abs(raw) - 2.5 * np.sqrt((1 / (seen + 0.5)).sum(axis=0)))
    model["word"][:, 0] = np.clip(odds["word"], -0.5, 3)
    model["char"][:, 1] = np.clip(odds["char"], -0.5, 3)
    windows = [(k, s) for k, words in enumerate(split) for s in window_starts(len(words))]
    owner = np.array([k for k, _ in windows])
    rows = np.full((len(windows), WINDOW), -1, np.int32)
    for i, (k, s) in enumerate(windows):
        part = ids[k][s : s + WINDOW]
        rows[i, : len(part)] = part
    x_all = embed(model, pieces)
    hint = x_all[:, :2].max(axis=1)
    worst = np.where(rows >= 0, hint[np.maximum(rows, 0)], -9).max(axis=1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items() if k not in ("word", "char")}
    spread = {k: np.full((len(model[k]), 1), 1e-4, np.float32) for k in ("word", "char")}
    balance = np.where(y == 1, 0.5 / max(1, totals[1]), 0.5 / max(1, totals[0]))
    step = 0
    for epoch in range(epochs):
        if epoch in (2, 5, 9, 13):
            x_all = embed(model, pieces)
            projected = {side: x_all @ model[f"W{side}"] + model[f"b{side}"] for side in "fb"}
            worst = np.concatenate([forward(model, projected, np.maximum(rows[a : a + BLOCK], 0).T, (rows[a : a + BLOCK] >= 0).T) for a in range(0, len(rows), BLOCK)])
        order = np.lexsort((-worst, owner))
        best = order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))]
        other = rng.integers(0, len(windows), len(best))
        chosen = np.concatenate([best, other[y[owner[other]] == 0]])
        rng.shuffle(chosen)
        for batch in np.array_split(chosen, max(1, len(chosen) // 128)):
            r = rows[batch].T
            mask = r >= 0
            own, back = np.unique(np.maximum(r, 0), return_inverse=True)
            back = back.ravel()
            x = embed(model, pieces, own)[back].reshape(*r.shape, SIZE)
            _, g = gradient(model, x, mask, y[owner[batch]].astype(np.float32), balance[owner[batch]])
            step += 1
            dx = g.pop("x").reshape(-1, SIZE)
            per_word = np.stack([np.bincount(back, dx[:, j], len(own)) for j in range(SIZE)], axis=1).astype(np.float32)
            count = pieces.count[own]
            for k, table_rows, d in (("word", pieces.word[own], per_word), ("char", pieces.rows[ragged(pieces.start[own], count)], np.repeat(per_word / np.maximum(count, 1)[:, None], count, axis=0))):
                touched, to = np.unique(table_rows, return_inverse=True)
                sums = np.stack([np.bincount(to, d[:, j], len(touched)) for j in range(SIZE)], axis=1).astype(np.float32)
                spread[k][touched] += (sums**2).mean(axis=1, keepdims=True)
                model[k][touched] -= 0.02 * sums / np.sqrt(spread[k][touched])
            for k, v in g.items():
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                model[k] -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, folds: int = 5, most_bytes: int = TRAINING_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``most`` rows of each class, chosen by a hash
    of the id among those whose ``crc32(id) mod folds`` is not 0.

    Rows without label or id are not used; of several labels of an id and of
    several texts of an id the least counts. Texts are whole; the sample of a
    class ends before the row with which its texts exceed ``most_bytes``.
    """
    of_id = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    usable = labelled.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (of_id % folds != 0)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    spread = F.xxhash64("doc_id")
    chosen = usable.filter("toxic = 1").orderBy(spread, "doc_id").limit(most).union(usable.filter("toxic = 0").orderBy(spread, "doc_id").limit(most))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    sized = texts.select("doc_id", F.octet_length("text").alias("bytes")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max("bytes").alias("bytes")).select("*", spread.alias("place")).collect()
    taken, held = {}, {0: 0, 1: 0}
    for r in sorted(sized, key=lambda r: (r["place"], r["doc_id"])):
        held[r["toxic"]] += r["bytes"]
        if held[r["toxic"]] <= most_bytes:
            taken[r["doc_id"]] = r["toxic"]
    if not taken:
        return [], []
    ids = docs.sparkSession.createDataFrame([(i,) for i in taken], "doc_id long")
    rows = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [taken[r["doc_id"]] for r in rows]


def fingerprint(model: Model) -> str:
    """A digest of all weights: workers know a model by it."""
    digest = hashlib.sha256()
    for k in sorted(model):
        digest.update(f"{k}{model[k].shape}{model[k].dtype}".encode())
        digest.update(np.ascontiguousarray(model[k]).tobytes())
    return digest.hexdigest()


def score(docs: DataFrame, model: Model, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts score 0; repeated rows give repeated results; a null id
    stays null and is not held out; an empty table gives an empty result; other
    columns are ignored.
    """
    name = fingerprint(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = worker_slot("toxicity", name, lambda: Inputs(shared.value))
        for batch in batches:
            at = 0
            texts = batch.column(1).to_pylist()
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) <= GROUP_BYTES):
                    held += len(texts[end])
                    end += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(score_texts(inputs, texts[at:end]), pa.float64())], names=["doc_id", "score"])
                at = end

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % folds == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
