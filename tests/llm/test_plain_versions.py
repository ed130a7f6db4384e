"""Operators and the pipeline against plain loops over all rows, and on odd tables."""

import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard

from tremor.llm import ann_graph, compression, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spark_hash(*values) -> int:
    """Spark's xxhash64 of some columns: longs by default, ints as ("int", n), strings; nulls change nothing."""
    seed = 42
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[1]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_plan(rows, budget=None):
    rows = [(i, s, spark_hash(t or ""), len(WORD.findall(t or ""))) for i, s, t in rows]
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    tokens = [float(sum(r[3] for r in rows if r[1] == s)) for s in names]
    limit = float(sum(tokens) if budget is None else budget)
    out = []
    for s, t, w in zip(names, tokens, mixing.weights_at(tokens, mixing.bisect_exponent(tokens, limit)), strict=True):
        mine, room = [r for r in rows if r[1] == s], w * limit
        count = math.ceil(len(mine) / mixing.BLOCK_ROWS)
        blocks: dict = {}
        for r in mine:
            blocks.setdefault(spark_hash(r[0], r[2], ("int", mixing.SEED)) % count, []).append(r)
        for epoch in range(max(1, math.ceil(room / t - 1e-9)) if t else 1):
            at = epoch * t
            for b in sorted(blocks, key=lambda b: (spark_hash(s, b, ("int", epoch), ("int", mixing.SEED)), b)):
                if at < room or (at == 0 and t == 0):
                    x = at
                    for r in sorted(blocks[b], key=lambda r: (spark_hash(r[0], ("int", epoch), r[2]), r[0] is not None, r[0] or 0, r[2])):
                        if x < room or t == 0:
                            out.append((r[0], s, r[2], r[3], epoch, int(x)))
                        x += r[3]
                at += sum(r[3] for r in blocks[b])
    return Counter(out)


@pytest.mark.parametrize(("budget", "block_rows"), [(None, 7), (900, 256), (20_000, 7)])
def test_mixing_equals_a_plain_loop(spark, monkeypatch, budget, block_rows):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block_rows)
    rng = random.Random(2)
    rows = [(i, rng.choices(["big", "mid", "small", None], [20, 6, 2, 1])[0], " ".join(["w"] * rng.choice([0, 1, 5, 30]))) for i in range(260)]
    rows += [(None, "big", "no id"), (5, "mid", None), (7, "void", "  "), (8, "void", None)] + [rows[3]] * 4 + [(900, "small", "long " * 3000)]
    df = spark.createDataFrame([(a, b, c, 0, 1) for a, b, c in rows], "doc_id long, source string, text string, block long, epoch int").repartition(3)
    got = mixing.plan(df, budget).select("doc_id", "source", "h", "n_tokens", "epoch", "token_start").collect()
    assert Counter(tuple(r) for r in got) == plain_plan(rows, budget)


def test_compression_verdicts_equal_a_plain_loop(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    texts = [None, "", " ", "a"] + [" ".join(word() for _ in range(rng.choice([5, 30, 200, 900, 3000]))) for _ in range(40)]
    texts += [("the same words again " * rng.randint(1, 900)) for _ in range(10)] + ["".join(chr(rng.randint(33, 126)) for _ in range(rng.choice([100, 600, 5000, 20_000]))) for _ in range(12)]
    texts += [texts[10] + "".join(chr(rng.randint(33, 126)) for _ in range(n)) for n in (10, 3000, 9000)] + ["é" * 2_000_000]
    press = zstandard.ZstdCompressor(level=3)
    ratio = lambda raw: len(raw) / len(press.compress(raw))
    want = {}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        if not raw:
            want[i] = "empty"
            continue
        low, high = next((b.least, b.most) for b in compression.WHOLE if b.below is None or len(raw) < b.below)
        verdict = "incompressible" if ratio(raw) < low else "repetitive" if ratio(raw) > high else None
        chunks = [raw[k : k + 4096] for k in range(0, len(raw) - 4095, 4096)]
        chunks += [raw[-4096:]] if chunks and len(raw) % 4096 else []
        kinds = Counter("incompressible" if ratio(c) < 1.5 else "repetitive" for c in chunks if not 1.5 <= ratio(c) <= 3.5)
        if verdict is None and sum(kinds.values()) > 0.2 * len(chunks):
            verdict = f"{max(sorted(kinds), key=kinds.get)} chunks"
        want[i] = verdict or "fine"
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = compression.compression_rules(df).collect()
    assert {r.doc_id: r.verdict for r in rows} == want and len(set(want.values())) >= 4
    assert all(r.kept == (not r.base_failed and r.verdict == "fine") for r in rows)


def test_embeddings_with_ties_and_clashing_names(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(6, 16))
    rows = [(k, 0, base[k % 6].tolist(), 1, 2) for k in range(48)] + [(100, 0, None, 1, 2), (101, 0, [0.0] * 16, 1, 2), (102, None, base[0].tolist(), 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, shard long, key int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ann_graph.near_duplicates(df).collect()}
    assert got == {k: (7, k % 6, k < 6) for k in range(48)} | {k: (0, k, True) for k in (100, 101, 102)}


def test_pipeline_on_an_empty_table_and_without_ids(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = "The river runs along the old town and people walk there in the evening with their dogs and friends every day"
    tables = {
        "empty": [],
        "odd": [(None, good + f" number {k}", "en", None if k % 2 else "s", 1) for k in range(6)] + [(None, None, None, None, None), (1, "", "en", "s", 0), (2, good, "en", "s", 1), (2, good, "en", "s", 1)],
    }
    for name, rows in tables.items():
        d = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(2, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        out = corpus_pipeline.run(spark, d).collect()
        assert len(out) == 0 if name == "empty" else {r.doc_id for r in out} <= {None, 1, 2}
