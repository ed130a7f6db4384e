"""Alignment of the tokens of two tokenizers (operator 12).

Both tokenizers cut the same bytes. The union of their ends parts a text into
elementary intervals; each lies in one token of either side and so is one
overlap. Where both end, a group is closed, and within a group every token of
one side is set against every one of the other. All texts of a slice are
aligned at once as numpy arrays. How many documents hold a pair of ids linked
is counted over the whole corpus.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm._text import batch_slices
from tremor.session import materialize, materialize_with, remove

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Counted pairs that every task may hold (17 bytes each); rarer ones meet their documents by a join.
MOST_PAIRS = 2_000_000
#: Parts of texts that are remembered, and the longest of them in characters.
KNOWN, LONGEST = 200_000, 64

#: At a space between a visible ASCII character and an ASCII letter both tokenizers begin anew: the byte-level one starts
#: a pre-token there, and no piece of the other holds a space behind another character. So parts are encoded apart.
_CUT = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")
#: Latin letters and signs, whose classes no edition of Unicode changes: on these the two libraries that know A's vocabulary agree.
_SETTLED = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u01bf]*")
#: How byte-level BPE cuts texts into pre-tokens (a fixed value).
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible ones for themselves, the rest from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of both tokenizers for parts of texts; parts that were seen before are remembered."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_of()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        # The same vocabulary by ranks, for texts on whose characters both libraries agree.
        ranks = {token: i for i, token in enumerate(self.a_bytes) if i not in self.a.get_added_tokens_decoder()}
        self.fast = tiktoken.Encoding("a", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space behind another character: texts can't be cut at spaces")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = np.array([len(x) for x in self.a_bytes], np.int64), np.array([len(x) for x in self.b_bytes], np.int64)
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.bad: set[str] = set()

    def learn(self, parts: set[str]) -> None:
        fresh = sorted(parts)
        plain = [p for p in fresh if _SETTLED.fullmatch(p)]
        other = [p for p in fresh if not _SETTLED.fullmatch(p)]
        fresh = plain + other
        ids_a = [self.fast(" " + p) for p in plain] + [x.ids for x in self.a.encode_batch([" " + p for p in other], add_special_tokens=False)]
        ids_b = self.b.encode(fresh, num_threads=1) if fresh else []
        raw = [b" " + p.encode() for p in fresh]
        for known, ids, of in ((self.known_a, ids_a, self.a_bytes), (self.known_b, ids_b, self.b_bytes)):
            flat = list(chain.from_iterable(ids))
            given = [of[i] for i in flat]
            packed, edge = np.array(flat, np.uint32).tobytes(), np.append(0, np.cumsum([len(x) for x in ids])).tolist()
            known.update(zip(fresh, [packed[4 * i : 4 * j] for i, j in pairwise(edge)], strict=True))
            size = np.append(0, np.cumsum([len(x) for x in given]))[edge]
            if b"".join(given) != b"".join(raw) or (np.diff(size) != [len(x) for x in raw]).any():  # which of them?
                self.bad.update(p for p, r, i, j in zip(fresh, raw, edge[:-1], edge[1:], strict=True) if b"".join(given[i:j]) != r)

    def encode(self, texts: list[str]) -> Slice:
        """Tokens of both sides of space and text, for each text; none where it is empty or a side's bytes differ from it."""
        cut = [_CUT.split(t) if t else [] for t in texts]
        if len(self.known_a) > KNOWN:
            self.forget()
        self.learn(set().union(*cut).difference(self.known_a) if cut else set())
        a, b = [], []
        for parts in cut:
            if self.bad and not self.bad.isdisjoint(parts):
                parts = []
            a.append(np.frombuffer(b"".join(map(self.known_a.__getitem__, parts)), np.uint32))
            b.append(np.frombuffer(b"".join(map(self.known_b.__getitem__, parts)), np.uint32))
        for p in [p for parts in cut for p in parts if len(p) > LONGEST]:
            self.known_a.pop(p, None), self.known_b.pop(p, None), self.bad.discard(p)
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        edge = lambda x: np.append(0, np.cumsum([len(v) for v in x])).astype(np.int64)
        return Slice(join(a), join(b), edge(a), edge(b), self.a_size, self.b_size)

    def forget(self) -> None:
        self.known_a.clear(), self.known_b.clear(), self.bad.clear()


@lru_cache(1)
def encoder(a_file: str, b_file: str) -> Encoder:
    return Encoder(public_tokenizers.path(a_file), public_tokenizers.path(b_file))


def _union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """np.union1d of arrays in ascending order, which need only be merged."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return both[np.append(True, both[1:] != both[:-1])] if len(both) else both


@lru_cache(4)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of numbers below ``n`` from the left, with room for a mark behind them, and how many they are."""
    size = np.char.str_len(np.arange(n).astype("U"))
    width = int(size.max())
    table = np.zeros((n, width + 1), np.uint8)
    for k in range(width):
        some = size > k
        table[some, k] = np.arange(n)[some] // 10 ** (size[some] - 1 - k) % 10 + ord("0")
    return table, size.astype(np.int64)


@dataclass
class Slice:
    """Tokens ``a`` and ``b`` of some texts that lie side by side; ``a_edge`` and ``b_edge`` bound those of each text."""

    a: np.ndarray
    b: np.ndarray
    a_edge: np.ndarray
    b_edge: np.ndarray
    a_size: np.ndarray
    b_size: np.ndarray

    @cached_property
    def a_end(self) -> np.ndarray:
        return np.cumsum(self.a_size[self.a])

    @cached_property
    def b_end(self) -> np.ndarray:
        return np.cumsum(self.b_size[self.b])

    @cached_property
    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Token of either side for each elementary interval."""
        ends = _union(self.a_end, self.b_end)
        return np.searchsorted(self.a_end, ends), np.searchsorted(self.b_end, ends)

    @cached_property
    def shared(self) -> np.ndarray:
        """Ends of the groups."""
        both = np.sort(np.concatenate([self.a_end, self.b_end]), kind="stable")
        return both[1:][both[1:] == both[:-1]]

    @cached_property
    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the tokens of each group, on either side."""
        bounds = lambda end: np.append(0, np.searchsorted(end, self.shared) + 1)
        return bounds(self.a_end), bounds(self.b_end)

    @cached_property
    def group_edge(self) -> np.ndarray:
        """Bounds of the groups of each text."""
        return np.searchsorted(self.groups[0], self.a_edge)

    def per_text(self, values: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Sums of each text's values."""
        total = np.append(0, np.cumsum(values))
        return total[edge[1:]] - total[edge[:-1]]

    @cached_property
    def link_edge(self) -> np.ndarray:
        return np.searchsorted(self.links[0], self.a_edge)

    def products(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of tokens within each group (positions of either side)."""
        (x, y) = self.groups
        n, m = np.diff(x), np.diff(y)
        group = np.repeat(np.arange(len(n)), n * m)
        k = np.arange(len(group)) - np.append(0, np.cumsum(n * m))[group]
        return x[group] + k // m[group], y[group] + k % m[group]

    def written(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all texts, and the bounds of each."""
        x, y = self.groups
        ga, gb = np.repeat(np.arange(len(x) - 1), np.diff(x)), np.repeat(np.arange(len(y) - 1), np.diff(y))
        total = len(self.a) + len(self.b)
        ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        pa_, pb_ = np.arange(len(self.a)) + y[ga], np.arange(len(self.b)) + x[gb + 1]
        ids[pa_], ids[pb_] = self.a, self.b
        mark[pa_[x[1:] - 1]] = ord("|")
        mark[pb_[y[1:] - 1]] = ord(";")
        edge = self.a_edge + self.b_edge
        mark[edge[1:][edge[1:] > edge[:-1]] - 1] = 0
        table, lengths = _digits(max(len(self.a_size), len(self.b_size)))
        out, size = table[ids], lengths[ids]
        out[np.arange(total), size] = mark
        at = np.append(0, np.cumsum(size + (mark > 0)))
        flat = out.ravel()
        return flat[flat > 0].tobytes(), at[edge]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for part in batch_slices(batches, 256, 2 << 20):
        yield part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))


GROUPS = "doc_id long, groups array<struct<a: array<int>, b: array<int>>>, products array<struct<a: int, b: int>>"


def alignments(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The groups of every whole text, as ids of both sides, and the pairs of ids that each group's product has; one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(a_file, b_file)
        for ids, texts in _slices(batches):
            s = e.encode(texts)
            x, y = s.groups
            lists = lambda v, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int32()))
            groups = pa.StructArray.from_arrays([lists(s.a, x), lists(s.b, y)], ["a", "b"])
            i, j = s.products()
            pairs = pa.StructArray.from_arrays([pa.array(s.a[i], pa.int32()), pa.array(s.b[j], pa.int32())], ["a", "b"])
            columns = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(s.group_edge, pa.int32()), groups), pa.ListArray.from_arrays(pa.array(np.searchsorted(i, s.a_edge), pa.int32()), pairs)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "groups", "products"])
        e.forget()

    return _rows(docs, text, doc_id).mapInArrow(run, GROUPS)


#: Distinct pairs of a document's ids as numbers (a times the size of B's vocabulary, plus b), and how often it links each.
ALIGNED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, n_products long, groups_sha256 string, codes binary, times binary"


def _aligned(rows: DataFrame, a_file: str, b_file: str) -> DataFrame:
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(a_file, b_file)
        base = len(e.b_size)
        number = TaskContext.get().partitionId() << 33
        for ids, texts in _slices(batches):
            s = e.encode(texts)
            i, j = s.links
            at = np.repeat(np.arange(len(ids)), np.diff(s.link_edge))
            pairs, times = np.unique((at << 48) | (s.a[i] * base + s.b[j]), return_counts=True)
            edge = np.searchsorted(pairs, np.arange(len(ids) + 1) << 48)
            codes, times = (pairs & ((1 << 48) - 1)).astype(np.uint32 if base * len(e.a_size) < 1 << 32 else np.uint64), times.astype(np.uint32)
            raw, bounds = s.written()
            packed = lambda v: [v[p:q].tobytes() for p, q in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            sums = [np.diff(s.a_edge), np.diff(s.b_edge), np.diff(s.group_edge), np.diff(s.link_edge), s.per_text(np.diff(s.groups[0]) * np.diff(s.groups[1]), s.group_edge)]
            digests = [hashlib.sha256(raw[p:q]).hexdigest() if q > p else "" for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            columns = [pa.array(ids, pa.int64()), pa.array(np.arange(number, number + len(ids)), pa.int64()), *[pa.array(x, pa.int64()) for x in sums], pa.array(digests, pa.string()), pa.array(packed(codes), pa.binary()), pa.array(packed(times), pa.binary())]
            number += len(ids)
            yield pa.RecordBatch.from_arrays(columns, names)
        e.forget()
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, ALIGNED)


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all rows of a binary column, and how many each has."""
    parts = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind).astype(np.int64), np.array([len(x) // size for x in parts], np.int64)


def _document_counts(aligned: DataFrame, kind: type) -> DataFrame:
    """``code, n``: in how many documents each pair is linked, pre-aggregated in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        codes, counts, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

        def reduced():
            every = np.concatenate([codes, *held])
            weight = np.concatenate([counts, np.ones(len(every) - len(codes), np.int64)])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            at = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            return every[at], np.add.reduceat(weight, at) if len(at) else weight

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["code", "n"])

        for part in batch_slices(batches):
            held.append(_unpacked(part.column(0), kind)[0])
            size += len(held[-1])
            if size > 2_000_000:
                codes, counts = reduced()
                held, size = [], 0
                if len(codes) > 2_000_000:
                    yield batch()
                    codes, counts = codes[:0], counts[:0]
        codes, counts = reduced()
        yield batch()

    return aligned.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


RESULT = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, n_products long, groups_sha256 string, n_best long, count_sum long"


def align_tokens(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, most_pairs: int = MOST_PAIRS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Tokens, groups and links of every whole text, with what the corpus says of the links; one row per input row.

    Of a pair of ids counts how many rows hold it linked, repeated rows as
    often as they stand there; ``n_best`` are the links whose count is the
    highest of their A id (ties included), ``count_sum`` the sum over links.
    ``n_products`` are the pairs of the groups' products. A null or empty text,
    or one that a tokenizer doesn't give back byte for byte, has no tokens:
    zeros and an empty digest. Very long texts are aligned whole, in memory of
    some times their size; a null doc_id stays null; other columns are ignored,
    whatever their names. An empty table gives an empty result. With more
    pairs than ``most_pairs`` the commonest go to every task and the others
    meet their documents by a join.
    """
    spark = docs.sparkSession
    e = encoder(a_file, b_file)
    base, kind = len(e.b_size), np.uint32 if len(e.b_size) * len(e.a_size) < 1 << 32 else np.uint64
    aligned = materialize(_aligned(_rows(docs, text, doc_id), a_file, b_file), "aligned")
    counts = materialize(_document_counts(aligned, kind), "pairs")
    of_a = F.expr(f"code div {base}")
    top = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("top"))  # a row for each id of A's vocabulary
    pairs, seen = materialize_with(counts.withColumn("a", of_a).join(F.broadcast(top), "a").select("code", "n", (F.col("n") == F.col("top")).alias("best")), "pairs", F.count("*").alias("n"))
    few = 1
    if seen["n"] > most_pairs:
        sizes = sorted(pairs.groupBy(F.expr("length(bin(n))").alias("bits")).count().collect(), key=lambda r: -r.bits)  # 64 rows at most
        total, few = 0, 1 << 62
        for r in sizes:
            total += r["count"]
            if total > most_pairs:
                break
            few = 1 << (r.bits - 1)
    common = pairs.where(F.col("n") >= few).toArrow().sort_by("code")  # of most_pairs at most
    shared = spark.sparkContext.broadcast((common["code"].to_numpy(), common["n"].to_numpy(), common["best"].to_numpy()))

    def looked_up(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known, n, best = shared.value
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
        return hit, np.where(hit, n[at], 0) if len(known) else np.zeros(len(codes), np.int64), hit & best[at] if len(known) else hit

    carried = [x.split()[0] for x in RESULT.split(", ")][:8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batch_slices(batches):
            codes, many = _unpacked(part.column("codes"), kind)
            times, _ = _unpacked(part.column("times"), np.uint32)
            _, n, best = looked_up(codes)
            edge = np.append(0, np.cumsum(many))
            sums = [np.diff(np.append(0, np.cumsum(x))[edge]) for x in (times * best, times * n)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carried], *[pa.array(x, pa.int64()) for x in sums]], [*carried, "n_best", "count_sum"])

    out = aligned.select(*carried, "codes", "times").mapInArrow(run, RESULT)
    if few > 1:

        def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batch_slices(batches):
                codes, many = _unpacked(part.column("codes"), kind)
                times, _ = _unpacked(part.column("times"), np.uint32)
                rows = np.repeat(part.column("row").to_numpy(), many)
                miss = ~looked_up(codes)[0]
                yield pa.RecordBatch.from_arrays([pa.array(x[miss], pa.int64()) for x in (rows, codes, times)], ["row", "code", "times"])

        rare = aligned.select("row", "codes", "times").mapInArrow(rest, "row long, code long, times long").join(pairs.where(F.col("n") < few), "code")
        rare = rare.groupBy("row").agg(F.sum(F.expr("if(best, times, 0L)")).alias("more_best"), F.sum(F.expr("times * n")).alias("more"))
        out = out.join(rare, "row", "left").withColumns({"n_best": F.expr("n_best + coalesce(more_best, 0L)"), "count_sum": F.expr("count_sum + coalesce(more, 0L)")})
    remove(spark, counts)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_products")
