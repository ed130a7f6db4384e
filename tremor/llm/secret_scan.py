"""Secrets in texts by a trigram inverted index (operator 11).

Each rule is a regular expression. Its parse tree gives the trigrams that any
match must hold, as an OR of ANDs. The index lists for each such trigram the
documents that hold it; lists are intersected clause by clause, and the
expression itself runs on what is left (Cox, 2012). A rule without mandatory
trigrams runs on every text. All work on rows is DataFrame expressions.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.session import materialize, materialize_with, remove


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what ``regex`` finds, if ``group`` has ``least`` characters or more.

    The expression means the same to Java and to Python.
    """

    kind: str
    regex: str
    least: int = 0
    group: int = 0


#: Rules that every scan has (fixed values). Runs shorter than 24 never count for hex, so they needn't be listed first.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Public formats of tokens and keys.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x00-\x20:/@"']{1,64}:[^\x00-\x20:/@"']{1,128}@"""),
)

Clauses = list[frozenset[str]]
ALWAYS: Clauses = [frozenset()]
#: Strings followed at once, clauses of a query, and characters of a class that are told apart; beyond, a query only asks for less.
MOST, WIDE = 64, 8
#: Document keys of a posting list on average, and candidates that every task may hold.
BLOCK_KEYS, SMALL = 8192, 1 << 20


def _simplest(clauses: Iterable[frozenset[str]]) -> Clauses:
    """Without clauses that ask for more than another does."""
    out: Clauses = []
    for c in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(o <= c for o in out):
            out.append(c)
    return out


def _and(a: Clauses, b: Clauses) -> Clauses:
    if len(a) * len(b) > MOST:
        return min(a, b, key=len) if ALWAYS not in (a, b) else a if b == ALWAYS else b
    return _simplest(x | y for x in a for y in b)


def _grams(strings: set[str]) -> Clauses:
    """What a text that holds one of the strings must hold."""
    return _simplest(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _characters(items: Sequence) -> set[str] | None:
    """The lower-cased characters of a class, or None for many."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 2 * WIDE:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= WIDE else None


def _walk(tree: Iterable) -> tuple[set[str] | None, Clauses]:
    """All strings that a part of an expression may match (None: too many to list), and what any of them must hold."""
    run, need, whole = {""}, ALWAYS, True
    for kind, value in tree:
        some: set[str] | None = None
        below = ALWAYS
        if kind is op.LITERAL:
            some = {chr(value).lower()}
        elif kind is op.IN:
            some = _characters(value)
        elif kind is op.SUBPATTERN:
            some, below = _walk(value[3])
        elif kind is op.BRANCH:
            arms = [_walk(arm) for arm in value[1]]
            if all(a[0] is not None for a in arms):
                some = set().union(*(a[0] for a in arms))
            below = _simplest(c for a in arms for c in (_grams(a[0]) if a[0] is not None else a[1]))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, item = value
            inner, inside = _walk(item)
            if inner is not None and high == 1:
                some = inner | {""} if low == 0 else inner
            elif inner is not None and low == high and len(inner) ** low <= MOST:
                some = {"".join(x) for x in itertools.product(inner, repeat=low)}
            elif low > 0:
                below = _grams(inner) if inner is not None else inside
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            some = {""}
        if some is not None and len(run) * len(some) <= MOST:
            run = {a + b for a in run for b in some}
            continue
        need = _and(need, _and(_grams(run), _grams(some) if some is not None else below))
        run, whole = {""}, False
    return (run, _grams(run)) if whole else (None, _and(need, _grams(run)))


def trigram_query(regex: str) -> Clauses:
    """The Boolean trigram query of an expression, on lower-cased text: a match holds all trigrams of one of the clauses.

    ``[frozenset()]`` means that nothing is mandatory.
    """
    return _walk(parser.parse(regex))[1]


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Id, whole text, and a key of both: rows of one key are equal, or else share candidates that are verified apart."""
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def build_index(rows: DataFrame, grams: Sequence[str]) -> DataFrame:
    """``gram, block, keys``: the inverted index of the trigrams that some rules ask for, over rows ``key, text``.

    A list goes by blocks of keys whose number follows the rows, so no list
    grows with the corpus however frequent its trigram is.
    """
    low = rows.select("key", F.lower("text").alias("low"))
    held = low.select("key", F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams])).alias("grams"))
    held, seen = materialize_with(held.where(F.size("grams") > 0), "grams", F.count("*").alias("n"))
    blocks = max(1, seen["n"] // BLOCK_KEYS)
    lists = held.select(F.explode("grams").alias("gram"), "key").groupBy("gram", F.pmod("key", F.lit(blocks)).alias("block")).agg(F.collect_set("key").alias("keys"))  # of one block
    index = materialize(lists, "postings")
    remove(rows.sparkSession, held)
    return index


def candidates(index: DataFrame, queries: dict[int, Clauses]) -> DataFrame:
    """``key, rules``: keys that satisfy the trigram query of a rule, the rules as bits of a number."""
    spark = index.sparkSession
    asked = [(rule, k, len(c), g) for rule, clauses in queries.items() for k, c in enumerate(clauses) for g in sorted(c)]
    asked = spark.createDataFrame(asked, "rule int, clause int, width int, gram string")
    lists = index.join(F.broadcast(asked), "gram").groupBy("rule", "clause", "width", "block")  # one list for each trigram of a clause
    lists = lists.agg(F.array_sort(F.collect_list(F.struct(F.size("keys").alias("n"), "keys"))).alias("lists")).where(F.size("lists") == F.col("width"))
    rest = F.slice("lists", F.lit(2), F.greatest(F.size("lists") - 1, F.lit(0)))
    common = F.aggregate(rest, F.col("lists")[0]["keys"], lambda a, x: F.array_intersect(a, x["keys"]))
    return lists.select("rule", F.explode(common).alias("key")).groupBy("key").agg(F.expr("bit_or(shiftleft(1L, rule))").alias("rules"))


def _totals(steps: Column) -> Column:
    """Running totals of an array of longs."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(steps, zero, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"] + x)).alias("out")), lambda s: s["out"])


#: Numbers that are summed at once: appending to an array copies it, so long ones go by blocks.
STEP = 256


def find_spans(rows: DataFrame, rules: Sequence[Rule], scan: set[int]) -> DataFrame:
    """Column ``spans`` (start, rule, end; in code points, in that order) for rows ``text, rules``: rules of set bits and those of ``scan`` are tried."""
    text = F.col("text")

    def tried(k: int, r: Rule) -> Column:
        regex, none = F.lit(r.regex), F.array().cast("array<string>")
        wanted = F.lit(True) if k in scan else F.expr(f"shiftright(rules, {k}) & 1") == 1
        of = lambda g: F.when(wanted, F.regexp_extract_all(text, regex, F.lit(g))).otherwise(none)
        return F.struct(F.lit(k).alias("rule"), regex.alias("regex"), F.lit(r.least).alias("least"), of(0).alias("found"), of(r.group).alias("counts"))

    # What lies between the matches gives their places: the lengths of both in turn, summed up.
    hits = rows.withColumn("hits", F.filter(F.array(*[tried(k, r) for k, r in enumerate(rules)]), lambda h: F.size(h["found"]) > 0))

    def steps(h: Column) -> Column:
        gaps = F.slice(F.split(text, h["regex"], -1), F.lit(1), F.size(h["found"]))
        both = F.zip_with(gaps, h["found"], lambda g, f: F.array(F.length(g).cast("long"), F.length(f).cast("long")))
        return F.struct(h["rule"].alias("rule"), h["least"].alias("least"), F.transform(h["counts"], F.length).alias("sizes"), F.flatten(both).alias("steps"))

    def blocks(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(h["steps"]) - 1) / STEP).cast("int"))
        return F.struct(h["rule"].alias("rule"), h["least"].alias("least"), h["sizes"].alias("sizes"), F.transform(starts, lambda b: _totals(F.slice(h["steps"], b * STEP + 1, F.lit(STEP)))).alias("parts"))

    def shifts(h: Column) -> Column:
        tops = _totals(F.transform(h["parts"], lambda p: F.element_at(p, -1)))
        return F.struct(h["rule"].alias("rule"), h["least"].alias("least"), h["sizes"].alias("sizes"), h["parts"].alias("parts"), F.concat(F.array(F.lit(0).cast("long")), tops).alias("shifts"))

    def ends(h: Column) -> Column:
        at = F.flatten(F.transform(h["parts"], lambda p, i: F.transform(p, lambda x: x + F.get(h["shifts"], i))))
        return F.struct(h["rule"].alias("rule"), h["least"].alias("least"), h["sizes"].alias("sizes"), at.alias("at"))

    def spans(h: Column) -> Column:
        each = F.transform(h["sizes"], lambda n, i: F.when(n >= h["least"], F.struct(F.get(h["at"], 2 * i).alias("start"), h["rule"].alias("rule"), F.get(h["at"], 2 * i + 1).alias("end"))))
        return F.array_compact(each)

    for step in (steps, blocks, shifts, ends):
        hits = hits.withColumn("hits", F.transform("hits", step))
    return hits.withColumn("spans", F.array_sort(F.flatten(F.transform("hits", spans)))).drop("hits")


def scan_secrets(docs: DataFrame, more: Sequence[Rule] = MORE, text: str = "text", doc_id: str = "doc_id", small: int = SMALL) -> DataFrame:
    """Spans of the base rules and of ``more`` in every whole text: one row per input row, repeats included.

    A null or empty text has no spans: counts of 0, ``spans`` empty, and the
    hash of an empty string. Rules never disturb one another: spans of
    different kinds may overlap, and ties in the start are in the order of the
    rules. Very long texts are scanned whole, in memory of some times their
    size; a null doc_id stays null; other columns are ignored, whatever their
    names. An empty table gives an empty result. Up to ``small`` candidates go
    to every task; beyond, candidates and texts meet by their keys.
    """
    rules = [*BASE, *more]
    queries = {k: trigram_query(r.regex) for k, r in enumerate(rules)}
    scan = {k for k, q in queries.items() if q == ALWAYS}
    asked = {k: q for k, q in queries.items() if k not in scan}
    rows = _keyed(docs, text, doc_id)
    index = build_index(rows, sorted({g for q in asked.values() for c in q for g in c}))
    chosen, seen = materialize_with(candidates(index, asked), "candidates", F.count("*").alias("n"))
    remove(docs.sparkSession, index)
    chosen = F.broadcast(chosen) if seen["n"] <= small else chosen
    met = rows.join(chosen, "key", "left").select("doc_id", "text", F.coalesce("rules", F.lit(0).cast("long")).alias("rules"))
    found = find_spans(met, rules, scan).select("doc_id", "spans")
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["rule"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rule"] < len(BASE))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
