"""Nulls, empty and repeated rows, clashing columns and empty tables, for every
operator."""

import pytest

from chronolith.llm import bpe, chat, dedup, jaccard, mixing, quality, secrets, sharding, toxicity, warc
from chronolith.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, kept string, shard string, size string, n string, digest string, rep string, row_number string"
LONG = "word other thing " * 3000
ROWS = [(1, "same text here", "en", "a"), (2, "same text here", "en", None), (2, "same text here", "en", None), (3, None, "de", "b"), (4, "", None, "b"), (None, "no id but text", "en", "a"), (5, LONG, "en", "c"), (6, " \n\t ", "fr", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, s, 1, 2, "x", "y", "z", "w", "v", "u", "r") for i, t, lang, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_secrets(docs, none):
    out = secrets.digest(secrets.scan(docs)).collect()
    assert len(out) == len(ROWS) and all(r.n_assign == 0 and r.spans == "" for r in out)
    assert secrets.digest(secrets.scan(none)).collect() == []
    assert len(secrets.scan(docs.select("doc_id", "text")).collect()) == len(ROWS)  # without owners


def test_sharding(docs, none):
    out = sharding.shard_rows(docs, 3).collect()
    assert sorted((r.shard, r.slot) for r in out) == sorted((p % 3, p // 3) for p in range(len(ROWS)))
    assert sharding.shard_rows(none, 3).collect() == []


def test_quality(docs, none):
    out = {r.doc_id: r for r in quality.score(docs).collect()}
    assert out[3].n_words == 0 and out[3].base_failed and not out[3].kept
    assert out[5].n_words == 9000 and out[5].n_repeat_words == 9000
    assert quality.score(none).collect() == [] and quality.keep(none).collect() == []
    assert quality.keep(docs).columns == docs.columns


def test_bpe(docs, none):
    path = tokenizer_path()
    out = bpe.round_trip(docs, path).collect()
    assert len(out) == len(ROWS) and [r.n_tokens for r in out if r.doc_id in (3, 4, 6)] == [0, 0, 0]
    two = bpe.digest(bpe.decode(bpe.encode(docs, path), path)).collect()
    assert sorted(map(tuple, two), key=str) == sorted(map(tuple, out), key=str)
    assert bpe.round_trip(none, path).collect() == [] and bpe.decode(bpe.encode(none, path), path).collect() == []


def test_dedup(docs, none):
    out = dedup.deduplicate(docs).collect()
    assert len(out) == len(ROWS)
    same = [r for r in out if r.group_size == 3]
    assert {r.keep_id for r in same} == {2} and sum(r.kept for r in same) == 1
    assert {r.keep_id for r in out if r.doc_id in (3, 4)} == {4}
    assert dedup.deduplicate(none).collect() == []
    kept = dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "6", "None"]
    assert dedup.keep_one(none).collect() == []


def test_mixing(docs, none):
    rows = mixing.mix(mixing.measure(docs)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(mixing.measure(none)).collect() == []
    assert mixing.draw(docs).columns == docs.columns and mixing.draw(none).collect() == []


def test_jaccard(docs, none):
    out = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar(docs, 4, 85).collect()}
    assert {(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (6, 0, 6), (5, 3, 5)} <= out
    assert (None, 1, None) in out or any(d is None for d, _, _ in out)
    assert jaccard.similar(none, 4, 85).collect() == []
    assert sorted(str(r.doc_id) for r in jaccard.keep_one(docs, 4, 85).collect()) == ["1", "3", "4", "5", "6", "None"]


def test_toxicity(docs, none):
    model = toxicity.new_model(1)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out) and {r.score for r in out if r.doc_id in (3, 4, 6)} == {0.0}
    assert toxicity.score(none, model).collect() == []
    assert toxicity.train([], [])["wo"].any() == False  # noqa: E712


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, example string, trainable string, turns string"
    rows = [(1, 0, "user", None, "", "", ""), (1, 1, None, "x", "", "", ""), (2, None, "assistant", "a", "", "", ""), (2, 0, "assistant", "a", "", "", ""), (2, 0, "assistant", "a", "", "", ""), (None, 0, "user", "q", "", "", "")]
    out = {r.conv_id: r for r in chat.read_back(chat.expand(spark.createDataFrame(rows, schema))).collect()}
    assert (out[1].n_turns, out[1].loss_chars, out[1].n_examples) == (2, 0, 1)
    assert (out[2].n_turns, out[2].loss_chars, out[2].n_examples) == (3, 3, 3)
    assert out[None].n_turns == 1
    assert chat.read_back(chat.expand(spark.createDataFrame([], schema))).collect() == []


def test_warc(spark):
    schema = "page_id long, url string, html string, digest__ string, refers_to string"
    rows = [(3, "http://a.b/ c", "<p>é</p>", "", ""), (1, None, "<p>é</p>", "", ""), (2, "http://x", None, "", ""), (9, "http://x", "", "", ""), (None, "http://n", "solo", "", ""), (3, "http://a.b/ c", "<p>é</p>", "", "")]
    out = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.archive_round_trip(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert out == sorted([(1, "response", None, 9), (3, "revisit", 1, 9), (3, "revisit", 1, 9), (2, "response", None, 0), (9, "revisit", 2, 0), (None, "response", None, 4)], key=str)
    assert warc.archive_round_trip(spark.createDataFrame([], schema)).collect() == []


#: Names that the operators' own columns have had.
CLASHES = ["target", "source_size", "epochs", "epochs__", "bucket", "bucket__", "key", "key__", "copies", "taken", "size", "size__", "rest", "last", "row", "doc", "source__", "null__", "id__", "digest", "digest__", "rows__", "kept", "kept__", "of__", "run", "locator", "best", "keep_id", "group_size", "gone", "gone__", "nth__", "rep", "label", "id", "a", "b", "col", "text__", "row__"]


@pytest.mark.parametrize("stage", [lambda d: quality.keep(d, 0.0), dedup.keep_one, jaccard.keep_one, mixing.draw], ids=["quality", "dedup", "jaccard", "mixing"])
def test_stages_keep_clashing_columns(spark, stage):
    """Every value of every extra column comes back with its row."""
    text = [" ".join(f"w{(7 * k + j) % 90}x{k}" for j in range(60 + k)) + "." for k in range(12)]
    rows = [(k, text[k], "en", "ab"[k % 2], *[f"{c}-{k}" for c in CLASHES]) for k in range(12)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *CLASHES]).repartition(3)
    out = stage(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert got and all(tuple(r) == rows[r.doc_id] for r in got)
