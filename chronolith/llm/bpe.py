"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts every text into chunks whose borders depend on nearby bytes
only, so passages that documents share give equal chunks. The inside of a chunk,
from its first to its last white space, does not depend on what stands around
it; each worker encodes it once and reuses it. What crosses a border is encoded
again together with a word on either side, and wider until the words at both
ends come out with exactly the tokens they have by themselves.

The tokenizer must drop white space and never merge across it, as tokenizers
with word ends do; :func:`check_tokenizer` refuses others. The words of a chunk
are looked up in a memo before they are encoded. Reuse is per worker, within
bounds on memory, as moving all texts to meet their copies costs more than
encoding them.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm.common import text_of, worker_cache

#: A border falls where this many low bits of the rolling hash are 0.
CUT_BITS = 10
WINDOW = 32
LEAST_CHUNK, MOST_CHUNK = 128, 16384
#: Bounds of what a worker keeps: words, and bytes of chunks.
MOST_WORDS = 300_000
MOST_CHUNK_BYTES = 24 << 20
#: Bytes of text that are worked on at a time.
GROUP_BYTES = 2 << 20

_SPACE = b" \t\n\v\f\r"
_FIRST_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _gear() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return (x >> np.uint64(32)).astype(np.uint32)


def rolling_hash(data: bytes) -> np.ndarray:
    """At each byte, the hash of it and the bytes before it, ``WINDOW`` in all:
    the sum of their table entries, shifted left by their distance."""
    h = _gear()[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:
        h = h.copy()
        h[step:] += h[:-step] << np.uint32(step) if step < len(h) else np.uint32(0)
        step *= 2
    return h


def cut(data: bytes) -> list[bytes]:
    """The chunks of ``data``, in order; together they are ``data``."""
    n = len(data)
    if n <= LEAST_CHUNK:
        return [data] if data else []
    # the hash is taken from its high bits: the low ones see only few bytes
    places = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    chunks, at = [], 0
    while at < n:
        k = int(np.searchsorted(places, at + LEAST_CHUNK))
        end = min(int(places[k]) if k < len(places) else n, at + MOST_CHUNK, n)
        chunks.append(data[at:end])
        at = end
    return chunks


def check_tokenizer(tokenizer) -> None:
    """Raise where white space is part of tokens."""
    for a, b in (("ab", "cd"), ("x.", "'s"), ("1", "2")):
        apart = tokenizer.encode(a, add_special_tokens=False).ids + tokenizer.encode(b, add_special_tokens=False).ids
        for space in (" ", "\n", "\t \r\n"):
            if tokenizer.encode(a + space + b, add_special_tokens=False).ids != apart:
                raise ValueError("this tokenizer's tokens depend on white space around them")


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class ChunkEncoder:
    """Encodes texts to little-endian 32-bit ids, reusing words and chunks."""

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        check_tokenizer(self.tokenizer)
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes, bytes, bytes, bytes] | None] = {}
        self.chunk_bytes = 0
        self.encoded_chunks = self.reused_chunks = self.widened = 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[bytes]) -> None:
        """Tokens of the words that were not met before."""
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        self.words.update(zip(new, map(_packed, self._encode([w.decode() for w in new])), strict=True))

    def _encode_chunks(self, fresh: set[bytes]) -> dict[bytes, tuple[bytes, bytes, bytes, bytes, bytes] | None]:
        """Head before the first white space, tokens of the whole words inside,
        tail after the last white space, first and last whole word; None for a
        chunk without white space."""
        made: dict[bytes, tuple[bytes, bytes, bytes, bytes, bytes] | None] = {}
        insides: dict[bytes, bytes] = {}
        for c in fresh:
            found = _FIRST_SPACE.search(c)
            if found is None:
                made[c] = None
                continue
            words = c.rsplit(None, 1)
            tail = words[-1] if c[-1] not in _SPACE else b""
            head, inside = c[: found.start()], c[found.start() : len(c) - len(tail)].strip(_SPACE)
            first, last = (inside.split(None, 1)[0], inside.rsplit(None, 1)[-1]) if inside else (b"", b"")
            insides[c] = inside
            made[c] = (head, b"", tail, first, last)
        split = {c: inside.split() for c, inside in insides.items()}
        self._learn({w for words in split.values() for w in words})
        ids_of = self.words.__getitem__
        for c, words in split.items():
            head, _, tail, first, last = made[c]
            made[c] = (head, b"".join(map(ids_of, words)), tail, first, last)
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        cuts = [cut(t.encode()) for t in texts]
        fresh = {c for chunks in cuts for c in chunks if c not in self.chunks}
        self.encoded_chunks += len(fresh)
        self.reused_chunks += sum(map(len, cuts)) - len(fresh)
        self.chunks.update(self._encode_chunks(fresh))
        self.chunk_bytes += sum(map(len, fresh))
        plans: list[list[bytes | int]] = []
        joins: list[tuple[bytes, bytes, bytes]] = []
        for chunks in cuts:
            plan: list[bytes | int] = []
            across, before = b"", b""
            for c in chunks:
                found = self.chunks[c]
                if found is None:
                    across += c
                    continue
                head, ids, tail, first, last = found
                across += head
                if across:
                    plan.append(len(joins))
                    joins.append((before, across, first))
                    before = across
                plan.append(ids)
                across, before = tail, last or before
            if across:
                plan.append(len(joins))
                joins.append((before, across, b""))
            plans.append(plan)
        repaired, wrong = self._repair(joins)
        if self.chunk_bytes > MOST_CHUNK_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0
        out = []
        for text, chunks, plan in zip(texts, cuts, plans, strict=True):
            if wrong and any(isinstance(x, int) and x in wrong for x in plan):
                out.append(self._widen(text.encode(), list(accumulate(map(len, chunks)))[:-1]))
            else:
                out.append(b"".join([repaired[x] if isinstance(x, int) else x for x in plan]))
        return out

    def _repair(self, joins: list[tuple[bytes, bytes, bytes]]) -> tuple[list[bytes], set[int]]:
        """Tokens of the text across borders, encoded with the words next to it,
        and the joins where those words do not keep their own tokens."""
        self._learn({w for left, _, right in joins for w in (left, right) if w})
        found = self._encode([b" ".join([x for x in join if x]).decode() for join in joins])
        out, wrong = [], set()
        for k, ((left, _, right), ids) in enumerate(zip(joins, found, strict=True)):
            packed = _packed(ids)
            a = self.words[left] if left else b""
            b = self.words[right] if right else b""
            if not _agree(packed, a, b):
                wrong.add(k)
            out.append(packed[len(a) : len(packed) - len(b)])
        return out, wrong

    def _widen(self, data: bytes, borders: list[int]) -> bytes:
        """Tokens of a text with a join that did not agree. Each border is encoded
        again with 2, 4, 8, ... words on either side, until the outermost words
        come out with their own tokens; at last the text is encoded as a whole."""
        spans = [m.span() for m in _WORDS.finditer(data)]
        self._learn({data[a:b] for a, b in spans})
        own = [self.words[data[a:b]] for a, b in spans]
        starts = [a for a, _ in spans]
        done: list[tuple[int, int, bytes]] = []  # words from, to, and the tokens between
        for at in borders:
            low, high = max(0, bisect_right(starts, at) - 1), min(len(spans), bisect_right(starts, at) + 1)
            reach = 2
            while True:
                a, b = max(0, low - reach), min(len(spans), high + reach)
                while done and done[-1][1] >= a:  # one window with the border before
                    low, a = min(low, done[-1][0]), min(a, max(0, done[-1][0] - 1))
                    done.pop()
                self.widened += 1
                packed = _packed(self._encode([data[spans[a][0] : spans[b - 1][1]].decode()])[0])
                first, last = own[a] if a else b"", own[b - 1] if b < len(spans) else b""
                if _agree(packed, first, last):
                    done.append((a + (a > 0), b - (b < len(spans)), packed[len(first) : len(packed) - len(last)]))
                    break
                reach *= 2
        out, at = [], 0
        for a, b, packed in done:
            out += [*own[at:a], packed]
            at = b
        return b"".join(out + own[at:])


def _agree(packed: bytes, first: bytes, last: bytes) -> bool:
    return packed.startswith(first) and packed.endswith(last) and len(packed) >= len(first) + len(last)


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encoder(tokenizer_json: str) -> ChunkEncoder:
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    return worker_cache(f"bpe-{key}", lambda: ChunkEncoder(tokenizer_json))


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            keys.append(key.as_py())
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= GROUP_BYTES:
                yield keys, texts
                keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


class Decoder:
    """Texts of packed ids, special tokens included."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        # without a decoder, tokens stand apart by spaces
        self.plain = None if tokenizer.decoder is not None else [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        if self.plain is None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(map(self.plain.__getitem__, ids))


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every row.

    Null texts count as empty and have no ids; repeated rows give repeated
    results; null ids stay null; an empty table gives an empty result; other
    columns are ignored. The driver reads the vocabulary file; executors need
    no copy of it.
    """
    tokenizer_json = read_tokenizer(tokenizer_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_json)
        for keys, texts in _groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(encoder.encode(texts), pa.binary())], names=["doc_id", "ids"])

    return _input(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``, special tokens included.

    No ids are the empty text, and so are null ids; rows that repeat are decoded
    each; an empty table gives an empty result; ids that the vocabulary has not
    are left out by the library.
    """
    tokenizer_json = read_tokenizer(tokenizer_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_encoder(tokenizer_json).tokenizer)
        for batch in batches:
            texts = [decoder.decode(ids.as_py() or b"") for ids in batch.column(batch.schema.get_field_index("ids"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in encoded.dtypes)}, decoded string")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of :func:`encode` and :func:`decode` in one pass: doc_id,
    n_tokens, ids_sha256, decoded_sha256. Rows are treated as by ``encode``."""
    tokenizer_json = read_tokenizer(tokenizer_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_json)
        decoder = Decoder(encoder.tokenizer)
        for keys, texts in _groups(batches):
            packed = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([hashlib.sha256(decoder.decode(p).encode()).hexdigest() for p in packed], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _input(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def digest(decoded: DataFrame) -> DataFrame:
    """Counts and digests of :func:`decode`'s rows."""
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
