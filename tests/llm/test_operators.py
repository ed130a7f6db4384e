"""The ten operators against brute force, the libraries, or held-out labels, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from tremor.llm import ann_graph, bpe, compression, line_dedup, mixing, ngram_join, piece_count, quality_lr, sharding, substring
from tremor.llm._text import mix

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{i}" for i in range(400)]
ODD = ["", " \n\t ", "a", "a b c", "é ü ñ  漢字 🙂\n\n x", "\x1c\x85 z", "<s> </s> <unk> <|endoftext|>", "ab" * 3000, "same line\n" * 30, "x " * 5000]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with exact and near copies, shared passages and lines, nulls, repeats and clashing column names."""
    rng = random.Random(11)
    passage, line = prose(rng, 60), prose(rng, 14)
    rows = []
    for i in range(120):
        t = "\n".join(prose(rng, rng.choice([3, 9, 12, 20, 40])) for _ in range(rng.randint(1, 6)))
        if i % 10 == 0:
            t += "\n" + passage
        if i % 7 == 0:
            t = line + "\n" + t
        rows.append((i, t))
    near = prose(rng, 200).split()
    for i in range(200, 240):
        w = list(near)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(w)))
    rows += [(300 + k, t) for k, t in enumerate(ODD)] + [(400, rows[3][1]), (401, rows[3][1].upper()), (402, None)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, "no id here"), (None, None)]
    rows = [(i, t, "en", f"src{(i or 0) % 3}" if i != 300 else None, 1, "k", 2, 0) for i, t in rows]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, doc long, n int").repartition(5)


@pytest.fixture(scope="module")
def rows(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]


def multiset(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def shingle_set(text):
    w = WORD.findall((text or "").encode().lower())
    return set(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else ({tuple(w)} if w else set())


class Forest(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 3000])
def test_jaccard_join_is_exact(corpus, rows, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = multiset(ngram_join.components(corpus), "doc_id", "n_shingles", "component_id")
    sets = [(i, shingle_set(t)) for i, t in rows]
    forest = Forest()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                forest.join(i, j)
    want = {(i, len(s), forest.find(i) if i is not None else None) for i, s in sets}
    assert set(got) == want
    kept = ngram_join.keep_one(corpus)
    assert kept.columns == corpus.columns and {r.doc_id for r in kept.collect()} == {i for i, _, c in want if i is None or i == c}


@pytest.mark.parametrize("kind", [None, 0, 1])
def test_signatures_lose_no_pair(kind):
    rng = np.random.default_rng(5)
    universe = rng.integers(0, 2**63, 200_000, dtype=np.uint64)
    plan = ngram_join.allocate(5000, {k: (1000, 0.3, 500.0) for k in range(3, 9)})
    if kind is not None:
        for k in range(1, len(plan.kind)):
            top = int(plan.bases[min(k + 1, len(plan.bases) - 1)]) - 1
            most = int(ngram_join.difference(top, top * 100 // 80))
            plan.kind[k], plan.segments[k] = kind, most // 2 + 1 if kind else int((most + 1) * 1.5)
    for n in [1, 2, 3, 4, 5, 7, 12, 13, 15, 16, 22, 28, 29, 35, 36, 60, 115, 116, 140, 463, 464, 600] * 12:
        a = np.unique(rng.choice(universe, n))
        drop, add = rng.integers(0, len(a) // 5 + 1), rng.integers(0, len(a) // 4 + 1)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.choice(universe, add)]))
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= 80 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            hot = np.sort(rng.choice(a, len(a) // 3 + 1)) & ~np.uint64(63)
            keys, of = ngram_join.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), plan, (hot, np.full(len(hot), 9)))
            assert len(np.intersect1d(keys[of == 0], keys[of == 1]))
            # A parity bitmap never differs in more bits than the sets do in elements.
            x, y = (np.frombuffer(m, np.uint64) for m in ngram_join.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
            w = min(len(x), len(y))
            assert np.bitwise_count(ngram_join.fold(x, w) ^ ngram_join.fold(y, w)).sum() <= len(a) + len(b) - 2 * both


def close(a, b):
    if a == b:
        return True
    if max(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(4)
    base = [prose(rng, rng.choice([3, 4, 5, 6, 9, 10, 11, 12, 13, 15, 16, 17, 31, 32, 33, 60])) for _ in range(40)]

    def edit(x):
        w, i = x.split(), rng.randrange(len(x.split()))
        kind = rng.randrange(4)
        if kind == 0:
            w[i] = rng.choice(VOCABULARY)
        elif kind == 1:
            w.insert(i, rng.choice(VOCABULARY))
        elif kind == 2 and len(w) > 1:
            del w[i]
        return " ".join(w)

    texts = []
    for d in range(80):
        lines = [edit(edit(rng.choice(base))) if rng.random() < 0.7 else " " + rng.choice(base).upper() for _ in range(rng.randint(0, 7))]
        texts.append((d, "\n".join(lines)))
    texts += [(90, None), (91, ""), (5, texts[5][1])]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("h", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))
    order = {r.text: r.h for r in df.collect()}
    items = sorted({(d, order[t], i, tuple(x.lower().split()), t) for d, t in texts for i, x in enumerate((t or "").split("\n")) if x.split()}, key=lambda x: x[:3])
    gone = {(d, t, i) for k, (d, _, i, w, t) in enumerate(items) if any(close(w, v[3]) for v in items[:k])}
    want = Counter((d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, t, i) not in gone)) for d, t in texts)
    got = line_dedup.dedup_lines(df)
    assert multiset(got, "row.doc_id", "kept") == want
    assert got.schema["row"].dataType.names == ["doc_id", "text", "h"]


def test_repeated_rows_count_their_lines_once(spark):
    rng = random.Random(9)
    old, new = [prose(rng, 12) for _ in range(3)], [prose(rng, 12) for _ in range(3)]
    rows = [(1, "\n".join(old))] + [(2, "\n".join(old + new))] * 2 + [(3, prose(rng, 15))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = multiset(line_dedup.dedup_lines(df), "row.doc_id", "n_lines", "n_exact", "n_near")
    assert got == {(1, 3, 0, 0): 1, (2, 6, 3, 0): 2, (3, 1, 0, 0): 1}
    kept = multiset(line_dedup.keep_first_lines(df), "doc_id", "text")
    assert kept == {rows[0]: 1, (2, "\n".join(new)): 2, rows[3]: 1}


def test_repeated_passages(spark):
    rng = random.Random(3)
    voc = [f"v{i}" for i in range(4000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    shared, phrase, docs, want = [words(n) for n in (51, 60, 90)], words(30), [], defaultdict(set)
    for d in range(120):
        w = words(rng.randint(20, 300))
        k = rng.randint(0, len(w))
        if d % 4 == 0:
            p = rng.randrange(3)
            w = w[:k] + shared[p] + w[k:]
            want[p].add(d)
        elif d % 4 == 1:
            w = w[:k] + phrase + w[k:]  # 30 words are no passage
        docs.append((d, " ".join(w)))
    docs += [(900, None), (901, ""), (902, "a b"), (None, " ".join(shared[0]))]
    got = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).toPandas()
    forest = Forest()
    for a, b in zip(got["rep_doc_id"], got["doc_id"], strict=True):
        forest.join(a, b)
    for members in want.values():
        assert len({forest.find(d) for d in members}) == 1
    assert set(forest) == set().union(*want.values()) and got["n_words"].min() >= 51 and not got.duplicated().any()


def test_passages_quoted_in_part_before_are_found(spark):
    rng = random.Random(12)
    voc = [f"v{i}" for i in range(4000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    docs, want = [], set()
    for k in range(30):
        p, quote = words(51), rng.choice([40, 45])
        whole, both = words(120) + p + words(80), words(100) + p[:quote] + words(1000) + p + words(60)
        # The text that quotes the passage in part is the representative of every other pair.
        a, b = (whole, both) if k % 2 else (both, whole)
        docs += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        want.add((2 * k, 2 * k + 1))
    got = {(r.rep_doc_id, r.doc_id) for r in substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_near_passages_are_found(spark):
    rng = random.Random(31)
    voc = [f"v{i}" for i in range(9000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    docs, want = [], set()
    for k in range(400):
        p = words(51)
        q = [*p[:25], "changed", *p[26:]]
        docs += [(2 * k, " ".join(words(70) + p + words(70))), (2 * k + 1, " ".join(words(70) + q + words(70)))]
        want.add((2 * k, 2 * k + 1))
    got = {(r.rep_doc_id, r.doc_id) for r in substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_places_are_the_wide_nodes_of_the_tree():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 2**62, n).astype(np.uint64) for n in (10, 46, 47, 0, 48, 60, 300)]
    edge = np.append(0, np.cumsum([len(x) for x in texts]))
    got = set(substring.places(np.concatenate(texts), edge).tolist())
    want = set()
    low = np.uint64((1 << 18) - 1)
    for start, s in zip(edge, texts, strict=False):
        for seed in substring._SEEDS:
            h = mix(s * seed) & ~low
            for c in range(len(s)):
                l = r = c
                while l > 0 and h[l - 1] > h[c]:
                    l -= 1
                while r < len(s) - 1 and h[r + 1] > h[c]:
                    r += 1
                if r - l + 1 >= substring.LENGTH:
                    want.add(int(start) + c)
    assert got == want


def linked(got):
    forest = Forest()
    for a, b in zip(got["rep_doc_id"], got["doc_id"], strict=True):
        forest.join(a, b)
    return forest


@pytest.mark.parametrize("reps", [substring.REPS, 2])
def test_near_passages_behind_other_texts_are_found(spark, monkeypatch, reps):
    """Pairs of near passages beside texts of smaller ids that hold both halves, against all pairs of texts."""
    monkeypatch.setattr(substring, "REPS", reps)
    rng = random.Random(77)
    voc = [f"v{i}" for i in range(9000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    docs, want = [], []
    for k in range(100):
        p = words(90)
        q = list(p)
        # One or two edits, from the last one: some 69 words hold one of them at most.
        for at in sorted(rng.sample([20, 45, 70], rng.randint(1, 2)), reverse=True):
            e = rng.choice(["swap", "add", "cut"])
            q[at : at + (e != "add")] = [] if e == "cut" else ["changed"]
        docs += [(k, " ".join(words(30) + p[:45] + words(40) + p[45:] + words(30))), (1000 + 2 * k, " ".join(words(70) + p + words(70))), (1001 + 2 * k, " ".join(words(70) + q + words(70)))]
        want.append((1000 + 2 * k, 1001 + 2 * k))
    # The same phrase of 40 words in many texts, and a passage that some of them share around it.
    phrase, passage = words(40), words(30)
    docs += [(3000 + k, " ".join(words(60) + (passage if k % 7 == 0 else words(30)) + phrase + words(60))) for k in range(70)]
    want += [(3000, 3000 + k) for k in range(7, 70, 7)]
    got = substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).toPandas()
    forest = linked(got)
    found = [forest.find(a) == forest.find(b) for a, b in want]
    assert sum(found) >= 0.95 * len(want) and all(found[100:])
    assert not {a for a in forest if a < 1000 or (a >= 3000 and a % 7 != 3000 % 7)}
    assert got["n_words"].min() >= 46 and (got["similarity"] >= 0.8).all() and (got["rep_doc_id"] < got["doc_id"]).all()


@pytest.mark.parametrize("decoys", [0, 5, 20, 40])
def test_near_passages_behind_many_texts_are_found(spark, decoys):
    """One swapped word in passages of 90, behind so many texts that hold both halves (44 words each), more than REPS among them."""
    rng = random.Random(78)
    voc = [f"v{i}" for i in range(9000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    docs, want = [], []
    for k in range(100):
        p = words(90)
        q = list(p)
        q[rng.randrange(10, 80)] = "changed"
        docs += [(100 * k + d, " ".join(words(20) + p[:44] + words(30) + p[46:] + words(20))) for d in range(decoys)]
        docs += [(100 * k + 98, " ".join(words(50) + p + words(50))), (100 * k + 99, " ".join(words(50) + q + words(50)))]
        want.append((100 * k + 98, 100 * k + 99))
    got = {(r.rep_doc_id, r.doc_id) for r in substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got.intersection(want)) >= 98 and got <= set(want)


@pytest.mark.parametrize("group", [substring.GROUP, 30])
def test_near_passages_around_one_phrase_are_all_found(spark, monkeypatch, group):
    """One phrase of 30 words in 200 texts; pairs of them share 60 words around it, one of which differs near either end."""
    monkeypatch.setattr(substring, "GROUP", group)
    rng = random.Random(79)
    voc = [f"v{i}" for i in range(9000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    phrase, docs, want = words(30), [], set()
    for k in range(100):
        before, after = words(30), words(30)
        near = ["changed" if i == 14 else w for i, w in enumerate(before)], ["changed" if i == 15 else w for i, w in enumerate(after)]
        docs += [(k, " ".join(words(50) + before + phrase + after + words(50))), (100 + k, " ".join(words(50) + near[0] + phrase + near[1] + words(50)))]
        want.add((k, 100 + k))
    got = {(r.rep_doc_id, r.doc_id) for r in substring.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_representatives_against_all_pairs(monkeypatch):
    monkeypatch.setattr(substring, "TRY", 16)
    monkeypatch.setattr(substring, "AGAINST", 50)
    rng = np.random.default_rng(5)
    sketch = rng.integers(1, 256, (60, substring._SPAN)).astype(np.uint8)
    sketch = sketch[rng.integers(0, 60, 400)]
    for row in sketch:  # edits, shifts and ends of texts
        at = rng.integers(0, 80, 2)
        row[at[0] : at[0] + 5] = rng.integers(1, 256, 5)
        if rng.random() < 0.4:
            row[at[1] :] = np.roll(row[at[1] :], 2)
        if rng.random() < 0.2:
            row[: rng.integers(0, 40)] = 0
    all_ = np.array([substring.fits(np.repeat(x[None], len(sketch), axis=0), sketch) for x in sketch])
    x, y = substring.meet(sketch, sketch)
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == set(map(tuple, np.argwhere(all_).tolist()))
    group = np.sort(rng.integers(0, 3, 400))
    lead, x, y = substring.represented(group, sketch)
    together = all_ & (group[:, None] == group[None])
    assert lead.sum() > 3 * substring.REPS and not (together[np.ix_(lead, lead)] & ~np.eye(lead.sum(), dtype=bool)).any()
    # Every other row goes by one, the first that it fits.
    by = dict(zip(y.tolist(), x.tolist(), strict=True))
    assert by == {b: np.flatnonzero(together[b] & lead)[0] for b in np.flatnonzero(~lead)} and len(x) == (~lead).sum()


def test_passages_of_copies_repeats_and_long_texts(spark):
    rng = random.Random(78)
    voc = [f"v{i}" for i in range(9000)]
    words = lambda n: [rng.choice(voc) for _ in range(n)]
    p, long = words(80), words(400_000)  # some 2 MB
    docs = [(k, " ".join(p)) for k in range(40)] + [(50, " ".join(long + p + words(9))), (51, " ".join(p + words(100) + p)), (51, " ".join(words(100) + p)), (52, " ".join(long[300_000:300_060]))]
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in docs], "doc_id long, text string, key int, `a.b` int").repartition(3)
    got = substring.repeated_passages(df).toPandas()
    forest = linked(got)
    assert len({forest.find(x) for x in [*range(40), 50, 51]}) == 1 and forest.find(52) == forest.find(50)
    at = {(r.start_word, r.n_words) for r in got[got["doc_id"] == 51].itertuples()}
    assert {(0, 80), (180, 80), (100, 80)} <= at
    assert substring.repeated_passages(df.limit(0)).count() == 0


def test_mixing_weights_and_budget(corpus):
    tokens = [1000.0, 100.0, 10.0, 0.0]
    a = mixing.bisect_exponent(tokens, 1110.0, 0.9, 1e9)
    assert abs(mixing.entropy(mixing.weights_at(tokens[:3], a)) - 0.9 * np.log(3)) < 1e-6
    b = mixing.bisect_exponent(tokens, 1110.0, 1.0, 4.0)
    assert max(w * 1110 / t for w, t in zip(mixing.weights_at(tokens[:3], b), tokens, strict=False)) <= 4.0001
    p = mixing.plan(corpus, share=0.999, max_epochs=3.0).toPandas()
    docs = corpus.select("doc_id", F.coalesce("source", F.lit("-")).alias("source"), mixing.word_count().alias("t")).toPandas()
    total = docs["t"].sum()
    for source, part in p.groupby(p["source"].fillna("-")):
        own = docs[docs["source"] == source]
        room = part["weight"].iloc[0] * total
        if own["t"].sum() == 0:
            continue
        order = part.sort_values(["token_start", "n_tokens"])
        assert (order["token_start"] < room).all()
        assert order["token_start"].tolist() == np.append(0, order["n_tokens"].cumsum()[:-1]).tolist()
        assert order["token_start"].iloc[-1] + order["n_tokens"].max() >= min(room, 3 * own["t"].sum()) - own["t"].max()
        for epoch in range(int(part["epoch"].max())):
            assert Counter(part[part["epoch"] == epoch]["doc_id"].fillna(-1)) == Counter(own["doc_id"].fillna(-1))
    mixed = mixing.mix(corpus)
    assert mixed.columns == corpus.columns and mixed.count() > 0


def test_classifier_holds_out_and_learns(spark):
    rng = random.Random(8)
    bad = lambda: " ".join(w + rng.choice(["***", "$$$"]) for w in prose(rng, 60).split())
    docs = [(i, prose(rng, 60) if i % 4 else bad()) for i in range(400)] + [(1000 + k, t) for k, t in enumerate([*ODD, None])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)] + [(3, 1), (None, 1), (7, None)], "doc_id long, quality int")
    out = quality_lr.classify(df, labels).toPandas()
    assert len(out) == len(docs) and out["score"].between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out["doc_id"], out["held_out"], strict=True))
    assert ((out["score"] >= 0.3) == (out["predicted"] == 1)).all()
    held = out[out["held_out"] & (out["doc_id"] < 400)]
    assert ((held["predicted"] == 1) == (held["doc_id"] % 4 != 0)).mean() > 0.95
    none = quality_lr.classify(df, labels.limit(0)).toPandas()
    assert (none["score"] == 0.5).all()
    assert quality_lr.keep_good(df, labels).columns == df.columns


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16))
    for k in range(0, 300, 10):
        x[k : k + 6] = x[k] + rng.normal(size=(6, 16)) * 0.06
    x[500:520] = x[500]
    label = rng.integers(0, 2, 900)
    label[:300:10] = 0
    for k in range(0, 300, 10):
        label[k : k + 6] = 0
    label[500:520] = 1
    rows = [(i, [float(v) for v in np.float32(x[i])], int(label[i])) for i in range(900)]
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, rows[0][1], None), (2004, [], 0), (2005, [None] * 16, 0), (2006, rows[0][1][:8], 0), rows[1]]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ann_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert len(got) == 907 and all(got[i] == (0, i, True) for i in range(2000, 2007))
    u = np.float32(x).astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(s, False)
    forest = Forest()
    for a, b in zip(*np.nonzero(s), strict=True):
        forest.join(int(a), int(b))
    want = {i: (int(s[i].sum()), forest.find(i), forest.find(i) == i) for i in range(900)}
    agree = sum(min(want[i][0], got[i][0]) for i in want) / sum(w[0] for w in want.values())
    assert agree >= 0.98 and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 890


def test_rows_of_one_vec_id_are_vectors_of_their_own(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (2, [0.999, 0.001, 0.0], 0), (3, [0.001, 0.999, 0.0], 0), (4, [0.002, 0.998, 0.0], 0), (4, a, 1)]
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in ann_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == Counter([(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False), (4, 0, 4, True)])


def test_dense_family_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(ann_graph, "BLOCK", 1000)
    monkeypatch.setattr(ann_graph, "SHARD_ROWS", 100)
    rng = np.random.default_rng(6)
    x = np.float32(np.concatenate([rng.normal(size=32) + rng.normal(size=(4000, 32)) * 0.1, rng.normal(size=(500, 32))]))
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    s = u @ u.T >= 0.98
    np.fill_diagonal(s, False)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in ann_graph.near_duplicates(df).collect()}
    assert s.sum() > 1_000_000
    assert sum(got[i][0] for i in range(4500)) >= 0.98 * s.sum() and all(got[i][0] <= s[i].sum() for i in range(4500))


def test_cells_hold_every_near_pair():
    rng = np.random.default_rng(4)
    p = ann_graph.thin(ann_graph.unit_rows(rng.normal(size=(300, 6))), 0.93)
    near = p @ p.T
    np.fill_diagonal(near, -1)
    assert near.max() < 0.93
    x = ann_graph.unit_rows(rng.normal(size=(1500, 6)))
    top, guest = ann_graph.cells(x, p, len(p), 0.98)
    members = [set(t[g]) for t, g in zip(top, guest, strict=True)]
    for i, j in zip(*np.nonzero(x @ x.T >= 0.98), strict=True):
        assert top[i, 0] in members[j]


def test_bpe_equals_the_library(corpus, rows):
    codec = bpe.codec(bpe.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(7)
    odd = ["".join(rng.choice("ab \n\té中🙂'sll.1\x1c\x85  ") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    odd += ["".join(rng.choice("eanorst") for _ in range(2000)), "a" * 5000, "ab" * 2500, "hahaha" * 99]
    assert codec.encode_batch(odd) == [",".join(map(str, library.encode_ordinary(t))) for t in odd]
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert multiset(bpe.round_trip(corpus), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    back = bpe.decode(bpe.encode(corpus.where("doc_id >= 300")))
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    assert all(bytes(r.decoded) == texts[r.doc_id] for r in back.collect())


def test_rank_queue_pops_in_order():
    q, rng = bpe.RankQueue(), random.Random(1)
    pushed = sorted(rng.sample(range(1 << 18), 500))
    for r in rng.sample(pushed, len(pushed)):
        q.push(r, np.array([r]))
    q.push(pushed[3], np.array([1]))
    got = []
    while (x := q.pop()) is not None:
        got.append(x[0])
    assert got == pushed


def test_token_counts_equal_the_library(corpus, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_count.MODEL))
    rng = random.Random(5)
    odd = ["".join(rng.choice("ab \n\t▁aeinrs   é̀中🙂<s>01.\x00") for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["a" * 4000, " " * 999, "ab" * 999, "▁" * 33]
    counter = piece_count.Counter(public_tokenizers.path(piece_count.MODEL))
    assert counter.count(odd) == [len(x) for x in library.encode(odd)]
    want = Counter((i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in rows)
    assert multiset(piece_count.token_counts(corpus), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_sharding(corpus, rows, monkeypatch):
    monkeypatch.setattr(sharding, "SECTION", 20)
    p = sharding.assign_shards(corpus).toPandas()
    assert len(p) == len(rows) and set(p["shard"]) <= set(range(8)) and p["grown_shard"].isna().all()
    for _, part in p.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter(zip(p["doc_id"].astype(object).where(p["doc_id"].notna(), None), p["size"], p["text_crc32"], strict=True)) == want
    assert p.groupby("text_crc32")["shard"].nunique().max() == 1
    weight, group = p.groupby("shard")["size"].sum(), p.groupby("text_crc32")["size"].sum()
    least = max(-(-int(p["size"].sum()) // 8), int(group.max()))
    assert weight.max() <= 1.01 * least


def test_shards_of_ties_copies_and_rounded_sizes(spark, monkeypatch):
    """Many groups of one size, a text that a third of the rows hold, nulls; bytes stay near equal where sizes are rounded too."""
    rng = random.Random(6)
    texts = ["tie %05d" % k for k in range(900)] + ["copy " * 5] * 700 + [None] * 20 + ["x" * rng.randint(1, 400) + str(k) for k in range(500)]
    df = spark.createDataFrame([(k % 1500, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, w int").repartition(4)
    for most in (10**6, 7):
        monkeypatch.setattr(sharding, "CLASSES", most)
        p = sharding.assign_shards(df).toPandas()
        weight = p.groupby("shard")["size"].sum()
        least = max(-(-int(p["size"].sum()) // 8), int(p.groupby("text_crc32")["size"].sum().max()))
        assert weight.max() <= 1.02 * least and len(p) == len(texts) and len(weight) == 8
        assert p[p["text_crc32"] == zlib.crc32(b"copy " * 5)]["shard"].nunique() == 1
        assert all(sorted(x["slot"]) == list(range(len(x))) for _, x in p.groupby("shard"))


def test_best_fit_decreasing_against_a_scan():
    rng = random.Random(2)
    for _ in range(30):
        items, capacity, bins = [rng.randint(1, 60) for _ in range(rng.randint(0, 80))], 100, []
        for size in sorted(items, reverse=True):
            fit = [(room, k) for k, (room, _) in enumerate(bins) if room >= size]
            if fit:
                room, k = min(fit)
                bins[k] = (room - size, [*bins[k][1], size])
            else:
                bins.append((capacity - size, [size]))
        classes = list(Counter(items).items())
        got = defaultdict(list)
        for (size, _), parts in zip(classes, sharding.best_fit_decreasing(classes, capacity), strict=True):
            for k, n in parts:
                got[k] += [size] * n
        assert [sorted(got[k]) for k in range(len(bins))] == [sorted(x) for _, x in bins] and len(got) == len(bins)
    packed = sharding.pack_into([(s, 1 + (s == 1)) for s in range(1, 10)], 4)
    room = Counter()
    for s, parts in zip(range(1, 10), packed, strict=True):
        for k, n in parts:
            room[k] += s * n
    assert len(room) == 4 and max(room.values()) == 12 and sum(room.values()) == 46


def test_compression_counts(corpus, rows):
    want = Counter()
    for i, t in rows:
        b = (t or "").encode()
        words = WORD.findall(b)
        lines = [x for x in b.split(b"\n") if WORD.search(x)]
        grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        count = Counter(grams)
        repeats = len({k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(8)})
        failed = len(words) < 20 or 100 * repeats > 30 * len(words)
        want[i, len(words), sum(len(w.decode()) for w in words), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeats, failed] += 1
    out = compression.compression_rules(corpus)
    assert multiset(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    kept = {(r.doc_id, r.verdict): r.kept for r in out.collect()}
    assert not any(k for (i, _), k in kept.items() if i in {300, 308, 402}) and sum(kept.values()) > 60


def test_compression_verdicts(spark):
    rng = random.Random(1)
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/ ") for _ in range(9000))
    rows = [(1, prose(rng, 2000)), (2, noise), (3, " ".join(f"{i} the same old words again and again" for i in range(900)))]
    got = {r.doc_id: r.verdict for r in compression.compression_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "fine" and got[2] == "incompressible" and "repetitive" in got[3]


def test_compression_judges_the_end_of_a_text():
    rng = random.Random(7)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    text = (prose(rng, 4000)[:4100] + " " + "".join(rng.choice(letters) for _ in range(3900))).encode()
    press = compression.zstandard.ZstdCompressor(level=3)
    assert compression.outside(compression.WHOLE[3], compression.ratio(press, text)) is None
    n_chunks, n_failed, verdict, kept = compression.rules(text, press)[-4:]
    assert (n_chunks, n_failed, verdict, kept) == (2, 1, "incompressible chunks", False)
    assert compression.rules(text[:4096], press)[-4] == 1 and compression.rules(text[:4095], press)[-4] == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for df in (substring.repeated_passages(docs), mixing.plan(docs), mixing.mix(docs), ngram_join.components(docs), quality_lr.classify(docs, labels), ann_graph.near_duplicates(vectors), bpe.round_trip(docs), piece_count.token_counts(docs), sharding.assign_shards(docs), line_dedup.dedup_lines(docs), compression.compression_rules(docs)):
        assert df.count() == 0


def test_pipeline_small(spark, tmp_path, corpus):
    import corpus_pipeline

    corpus.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(120)] + [(304, 0), (309, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert docs.columns == columns
            docs.write.parquet(f"{tmp_path}/s{i}")
            docs = spark.read.parquet(f"{tmp_path}/s{i}")
    out = docs.toPandas()
    kept = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/s2").select("doc_id").collect()}
    before = ngram_join.components(spark.read.parquet(f"{tmp_path}/s1")).toPandas()
    assert kept == set(before[before["doc_id"] == before["component_id"]]["doc_id"]) and len(kept) < len(before)
    assert len(out) and set(out["doc_id"]) <= kept


def test_pipeline_equals_plain_versions(spark, tmp_path, corpus, rows):
    import corpus_pipeline

    rng = random.Random(21)
    old = [x for x in dict(rows)[1].split("\n") if x][:2]
    partly = "\n".join(old + [prose(rng, 15) for _ in old])
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    extra = spark.createDataFrame([(500, partly, "en", "src1", 1)] * 2, corpus.select(columns).schema)
    corpus.select(columns).where("doc_id is not null").union(extra).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(120)] + [(304, 0), (309, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, str(tmp_path)).withColumn("h", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))).collect()

    # Lines: each goes if an earlier one, by doc_id, hash of the text and place, is the same or within one word.
    split = lambda t: (t or "").encode().split(b"\n")
    items = sorted({(r.doc_id, r.h, i, tuple(WORD.findall(x.lower()))) for r in good for i, x in enumerate(split(r.text)) if WORD.search(x)})
    gone = {x[:3] for k, x in enumerate(items) if any(close(x[3], y[3]) for y in items[:k])}
    first = []
    for r in good:
        full = [i for i, x in enumerate(split(r.text)) if WORD.search(x)]
        if not full or any((r.doc_id, r.h, i) not in gone for i in full):
            text = None if r.text is None else b"\n".join(x for i, x in enumerate(split(r.text)) if (r.doc_id, r.h, i) not in gone).decode()
            first.append((r.doc_id, r.source, text))
    assert [t for i, _, t in first if i == 500] == ["\n".join(partly.split("\n")[len(old) :])] * 2

    # Near-duplicates: rows of the least doc_id of each component.
    sets, forest = [(i, shingle_set(t)) for i, _, t in first], Forest()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                forest.join(i, j)
    once = [r for r in first if forest.find(r[0]) == r[0]]
    assert len(once) < len(first)

    # Mixing: every source is one block here, read in order of hash, epoch by epoch, up to its room.
    hashed = spark.createDataFrame(once, "doc_id long, source string, text string").withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    hashed = [(r.doc_id, r.source, r.text, r.h, r.order) for r in hashed.withColumn("order", F.array(*[F.xxhash64("doc_id", F.lit(e), "h") for e in range(5)])).collect()]
    size = lambda t: len(WORD.findall((t or "").encode()))
    sources = sorted({r[1] for r in hashed}, key=lambda s: (s is None, s or ""))
    totals = [float(sum(size(r[2]) for r in hashed if r[1] == s)) for s in sources]
    weights = mixing.weights_at(totals, mixing.bisect_exponent(totals, sum(totals)))
    copies, read = Counter(r[:4] for r in hashed), Counter()
    for source, weight, total in zip(sources, weights, totals, strict=True):
        own = [r for r in hashed if r[1] == source]
        assert len(own) <= mixing.BLOCK_ROWS
        start = 0
        for e in range(mixing.epochs(weight * sum(totals), total)):
            for r in sorted(own, key=lambda r: (r[4][e], r[0], r[3])):
                if start < weight * sum(totals) or not total:
                    read[r[:4]] += 1
                start += size(r[2])
    mixed = [r[:4] for r in hashed for _ in range(-(-read[r[:4]] // copies[r[:4]]))]

    # Token ids: the library's.
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec(bpe.RANKS).ranks, special_tokens={})
    want = Counter()
    for i, _, t, _ in mixed:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert multiset(corpus_pipeline.run(spark, str(tmp_path)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_training_equals_a_plain_loop():
    """Follow-the-regularised-leader over two epochs, weight by weight, and scores as plain sums."""
    rng = random.Random(15)
    bits, alpha, beta, l2 = 10, 0.5, 1.0, 1.0
    data = [(prose(rng, rng.randint(1, 30)) + (" bad" if k % 3 else " good"), int(k % 3 == 0)) for k in range(40)]
    got = quality_lr.train([(*quality_lr.sparse(t, bits), y) for t, y in data], bits=bits, epochs=2)
    z, n = defaultdict(float), defaultdict(float)
    bias = 1 << bits

    def weight(i):
        return -z[i] / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(2):
        for t, y in data:
            f = quality_lr.features(t, bits).tolist()
            x = {i: c / len(f) ** 0.5 for i, c in Counter(f).items()} | {bias: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - y) * x[i]
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
                n[i] += g * g
    assert np.allclose(got, [weight(i) for i in range(bias + 1)])


def test_columns_of_any_name(spark):
    """Names that the operators use inside, names with a dot, and repeated rows pass through."""
    rng = random.Random(16)
    line = prose(rng, 12)
    rows = [(1, line + "\n" + prose(rng, 9)), (2, line + "\n" + prose(rng, 20)), (2, None), (None, "")] * 2
    cols = ["key", "id", "n", "row", "t", "i", "h", "_lines", "doc", "th", "a.b", "gone", "kept", "component", "_gone", "source"]
    df = spark.createDataFrame([(*r, *range(len(cols) - 1), "s") for r in rows], "doc_id long, text string, " + ", ".join(f"`{c}` {'string' if c == 'source' else 'int'}" for c in cols))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    for out in (line_dedup.keep_first_lines(df), mixing.mix(df), ngram_join.keep_one(df), quality_lr.keep_good(df, labels)):
        assert out.columns == df.columns and len(out.collect()) > 0
    assert line_dedup.dedup_lines(df).count() == substring.repeated_passages(df).count() + 8
    for out in (ngram_join.components(df), quality_lr.classify(df, labels), bpe.round_trip(df), piece_count.token_counts(df), sharding.assign_shards(df), compression.compression_rules(df)):
        assert out.count() == 8
    empty = df.limit(0)
    for out in (line_dedup.keep_first_lines(empty), mixing.mix(empty), ngram_join.keep_one(empty), quality_lr.keep_good(empty, labels), bpe.encode(empty), bpe.decode(bpe.encode(empty))):
        assert out.count() == 0


def test_texts_of_megabytes():
    """Words, shingles and lines of a long text are those of plain splitting, whatever the stretches."""
    from tremor.llm import _text

    rng = random.Random(17)
    text = "\n".join(prose(rng, rng.randint(0, 40)) for _ in range(25_000)).encode() + b" \x0b" + b"y" * 1_500_000 + b"\r\nEND"
    data = np.frombuffer(text, np.uint8)
    words, at, bounds = _text.hash_words(data, np.array([0, len(data)]))
    plain = text.lower().split()
    assert len(words) == len(plain) == bounds[1] and all(text[i : i + len(w)].lower() == w for i, w in zip(at.tolist(), plain, strict=True))
    assert len(set(zip(words.tolist(), plain, strict=True))) == len(set(plain)) == len(set(words.tolist()))
    s, edge = _text.shingle_runs(words, bounds)
    assert len(s) == len(plain) - 4 == edge[1] and len(set(s.tolist())) == len(set(zip(*[plain[k:] for k in range(5)], strict=False)))
