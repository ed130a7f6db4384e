"""Token alignment against the libraries on whole texts and a loop over all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tremor.llm import alignment
from tremor.llm.alignment import A_FILE, B_FILE, _byte_of

ODD = ["", None, " ", "  two  spaces ", "a", "é ü 漢字🙂 \U0001f9d1‍\U0001f680", "x▁y", "<|endoftext|> <s> </s>", "\x00\x1c\x85", "don't we'll I'm", "a " * 3000, "ab" * 40000, "\n\n  x\t y", "a  b c", "x y z", "١٢٣ four 5"]


def plain(texts):
    a = Tokenizer.from_file(public_tokenizers.path(A_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B_FILE))
    byte_of = _byte_of()
    docs, held = [], Counter()
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False) if t else None
        ids = x.ids if t else []
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids]
        other = b.encode(t) if t else []
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in other]
        if not t or b"".join(raw_a) != b" " + t.encode() or b"".join(raw_b) != b" " + t.encode():
            ids, other, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(r) for r in raw_a]).tolist(), np.cumsum([len(r) for r in raw_b]).tolist()
        links, j = [], 0
        for i, e in enumerate(ends_a):
            begin = e - len(raw_a[i])
            while j < len(ends_b) and ends_b[j] <= begin:
                j += 1
            k = j
            while k < len(ends_b) and ends_b[k] - len(raw_b[k]) < e:
                links.append((ids[i], other[k]))
                k += 1
        groups, products, pa, pb = [], 0, 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            qa, qb = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, ids[pa:qa])) + "|" + ",".join(map(str, other[pb:qb])))
            products += (qa - pa) * (qb - pb)
            pa, pb = qa, qb
        docs.append((len(ids), len(other), links, groups, products))
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(n, m, len(g), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "", q) for n, m, links, g, q in docs]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["the", "alignment", "of", "tokens", "naïve", "漢字", "x_y", "3.14", "don't", "(see", "end).", "🙂", "Ünïcode", "http://a.b/c?d=e", "\n", "\t", "  ", "▁"]
    return ODD + [rng.choice([" ", ""]).join(rng.choices(words, [5] * 17 + [0.1], k=rng.randint(1, 80))) for _ in range(150)] + ["the same text"] * 5


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 40, 0])
def test_alignment_equals_plain_loops(spark, texts, most_pairs):
    rows = [(i if i % 9 else None, t, 1, 2, "k", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, n_a int, codes string, n int").repartition(4)
    got = sorted(repr(tuple(r)) for r in alignment.align_tokens(df, most_pairs=most_pairs).collect())
    assert got == sorted(repr((rows[i][0], *p)) for i, p in enumerate(plain(texts)))


def test_groups_and_products(spark, texts):
    some = [t for t in texts if t and len(t) < 400][:60]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    want = plain(some)
    for r in alignment.alignments(df).collect():
        n, m, groups, _, _, _, digest, products = want[r.doc_id]
        text = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups)
        assert (len(r.groups), len(r.products), hashlib.sha256(text.encode()).hexdigest() if text else "") == (groups, products, digest)
        assert [(p.a, p.b) for p in r.products] == [(x, y) for g in r.groups for x in g.a for y in g.b]
    assert alignment.align_tokens(df.limit(0)).count() == 0
