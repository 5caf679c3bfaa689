"""The pipeline, stage by stage, against brute force on a small corpus."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from chronolith.llm import bpe, quality
from chronolith.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("thenorsialud") for _ in range(rng.randint(2, 7))) for _ in range(900)]

    def prose(n):
        return ". ".join(" ".join(rng.choice(vocabulary) for _ in range(10)).capitalize() for _ in range(n)) + "."

    rows = [(i, prose(rng.randint(7, 12)), "en", rng.choice(["a", "b", "c", None])) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "b") for i in range(8)]
    for i in range(8):
        words = rows[20 + i][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((200 + i, " ".join(words), "en", "c"))
    rows += [(300, None, "en", "a"), (301, "", "de", "a"), (302, " | ".join(["menu"] * 80), "en", "a"), (303, "short text", "en", "a")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def test_stages_equal_brute_force(spark, corpus, tmp_path):
    spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept, columns = [], docs.columns
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
    field = quality.train()
    want = {i: t for i, t, *_ in corpus if quality.judge(t, field).kept}
    assert kept[0] == want and len(want) == 76
    last = {t: max(i for i in want if want[i] == t) for t in want.values()}
    want = {i: t for t, i in last.items()}
    assert kept[1] == want
    near = {}
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.lower().split()) for i, t in want.items())}
    for i in sorted(want):
        near[i] = min((near[j] for j in near if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), default=i)
    want = {i: t for i, t in want.items() if near[i] == i}
    assert kept[2] == want and len(want) == 60
    assert set(kept[3]) <= set(want)
    mixed = spark.read.parquet(str(tmp_path / "mix_sources"))
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert max(times.values()) <= 3
    total = sum(len(t.split()) for t in want.values())
    assert abs(sum(n * len(want[i].split()) for i, n in times.items()) - total) <= 4 * 121
    out = docs.collect()
    assert Counter(r.doc_id for r in out) == times
    encoder = bpe.ChunkEncoder(bpe.read_tokenizer(tokenizer_path()))
    assert all(r.n_tokens == len(encoder.tokenizer.encode(want[r.doc_id], add_special_tokens=False).ids) for r in out)
