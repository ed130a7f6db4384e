"""Secret scans against plain regular expressions, and the derived queries against texts that match."""

import hashlib
import random
import re

import pytest

from tremor.llm import secret_scan
from tremor.llm.secret_scan import BASE, MORE, Rule, trigram_query

ODD = [
    "", None, " ", "token=abc", "password: token = abcdefgh", "é🙂 secret='abcdefg' 🙂 AKIA" + "Z" * 16, "token=abcdef " * 3000, ("ab" * 20 + " ") * 2000, "x" * 3_000_000 + " API_KEY:=abcdefgh",
    "ghp_" + "a" * 36 + " -----BEGIN RSA PRIVATE KEY-----", "AKIAAKIA" + "Q" * 16, "https://me:pass@host eyJ0123456789.0123456789.0123456789", "passwd=12345", "\x1ctoken:\x85abcdefg",
]


def plain(text, rules=(*BASE, *MORE)):
    found = sorted((m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer("[0-9a-f]+" if r.kind == "hex" else r.regex, text or "") if len(m.group(r.group)) >= r.least)
    written = lambda x: ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in x)
    return (*[sum(k == j for _, k, _ in found) for j in range(3)], hashlib.sha256(written([x for x in found if x[1] < 3]).encode()).hexdigest(), written(found))


@pytest.mark.parametrize("small", [secret_scan.SMALL, 0])
def test_spans_equal_plain_expressions(spark, small):
    rng = random.Random(5)
    parts = ["token", "=", ":", " ", "'", '"', "abcdef0123456789" * 2, "AKIA", "QWERTY0123456789", "Secret", "api_key", "APIKEY", "é", "\n", "ghp_", "z" * 36, "xoxb-", "passwd", "deadbeef" * 4, "://u:p@"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    rows = [(i % 250 if i % 7 else None, t, "x", 1, 2, "k") for i, t in enumerate(texts)] + [(5, ODD[5], "x", 1, 2, "k")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, key int, rules int, gram string").repartition(3)
    got = sorted(map(repr, (tuple(r) for r in secret_scan.scan_secrets(df, small=small).collect())))
    assert got == sorted(repr((i, *plain(t))) for i, t, *_ in rows)


def test_empty_table_and_other_rules(spark):
    df = spark.createDataFrame([(1, "a KEY-77 b")], "doc_id long, text string")
    assert secret_scan.scan_secrets(df.limit(0)).count() == 0
    assert secret_scan.scan_secrets(df, [Rule("own", "KEY-[0-9]+"), Rule("digits", "[0-9]{2}")]).first().spans == "own:2:8,digits:6:8"


def test_queries_hold_for_all_that_matches():
    words = lambda q: sorted(sorted(c) for c in q)
    assert trigram_query("[0-9a-f]{24,}") == [frozenset()] == trigram_query("ab") == trigram_query("(abc)?x*")
    assert words(trigram_query("AKIA[A-Z0-9]+")) == [["aki", "kia"]]
    assert words(trigram_query("ab(c|de)f")) == [["abc", "bcf"], ["abd", "bde", "def"]]
    assert words(trigram_query("(?:foo|bar)+.qux")) == [["bar", "qux"], ["foo", "qux"]]
    assert words(trigram_query("abc|x")) == [[]]
    examples = {"assign": ["PassWord = 'abcdef", "api_key:=aaaaaa", "apikey='zzzzzz"], "private_key": ["-----BEGIN PRIVATE KEY-----"], "forge": ["ghs_" + "a" * 40], "chat": ["xoxa-" + "1" * 10], "map_key": ["AIza" + "-" * 35], "url_login": ["ftp://a:b@"], "web_token": ["eyJ" + "a" * 8 + ".bbbbbbbb.cccccccc"]}
    for r in (*BASE, *MORE):
        for text in examples.get(r.kind, []):
            assert re.search(r.regex, text) and any(all(g in text.lower() for g in c) for c in trigram_query(r.regex)), r.kind
