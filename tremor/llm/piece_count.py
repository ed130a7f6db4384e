"""Token counts by rank-synchronous array merging (operator 7).

The vocabulary is a sentencepiece BPE model with byte fallback. Texts are cut
where no piece can reach across; the distinct cuts of many texts are merged
together as one ragged numpy array: in each round every sequence merges the
pairs of its own lowest rank, all sequences at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm._text import slices

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
NONE = np.int32(2**31 - 1)
#: Cuts of more characters are never remembered.
LONGEST = 256


class PieceVocabulary:
    """Pieces, ranks and the pairs that merge into them, as arrays for look-up."""

    def __init__(self, path: str):
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        pieces = [m.id_to_piece(i) for i in usable]
        scores = sorted({m.get_score(i) for i in usable}, reverse=True)
        rank_of = {s: k for k, s in enumerate(scores)}
        at = {p: k for k, p in enumerate(pieces)}
        self.single = {p: k for p, k in at.items() if len(p) == 1}
        left, right, made = [], [], []
        for p, k in at.items():
            for cut in range(1, len(p)):
                a, b = at.get(p[:cut]), at.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(k)
        self.size = len(pieces)
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        self.rank = np.array([rank_of[m.get_score(i)] for i in usable], np.int32)
        self._index(keys, np.array(made, np.int32))
        # Pieces that at once offer a merge of the same or a lower rank than their own.
        self.hasty = np.zeros(self.size, bool)
        for part in (left, right):
            part = np.array(part, np.int64)
            self.hasty[part[self.rank[np.array(made)] <= self.rank[part]]] = True
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece holds a space after another character: texts can't be cut at spaces")
        # A character that no longer piece holds never merges: it stands alone.
        inside = "".join(sorted(set("".join(p for p in pieces if len(p) > 1)) - {SPACE}))
        self.cuts = re.compile(f"{SPACE}*[{re.escape(inside)}]+|{SPACE}+|[^{re.escape(inside)}{SPACE}]")

    def _index(self, keys: np.ndarray, made: np.ndarray) -> None:
        """An open hash table of pairs: one home slot each, the rest in a short sorted list."""
        self.slots = np.full(1 << 22, -1, np.int64)
        self.found = np.zeros(1 << 22, np.int32)
        home = self._home(keys)
        _, first = np.unique(home, return_index=True)
        self.slots[home[first]], self.found[home[first]] = keys[first], made[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.more, self.more_made = np.append(keys[rest], np.int64(2**62)), np.append(made[rest], np.int32(0))
        self.crowded = np.zeros(1 << 22, bool)
        self.crowded[home[rest]] = True

    @staticmethod
    def _home(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; rank NONE where the pair doesn't merge."""
        key = np.where((a < 0) | (b < 0), np.int64(2**61), a.astype(np.int64) * self.size + b)
        home = self._home(key)
        made, hit = self.found[home], self.slots[home] == key
        again = np.flatnonzero(self.crowded[home] & ~hit)
        if len(again):
            pos = np.searchsorted(self.more, key[again])
            made[again], hit[again] = self.more_made[pos], self.more[pos] == key[again]
        return np.where(hit, self.rank[made], NONE), made

    def count(self, sequences: list[str]) -> np.ndarray:
        """Tokens of each sequence of characters, merged on its own."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        text = "".join(sequences)
        get = self.single.get
        sym = np.fromiter((get(c, -1) for c in text), np.int32, len(text))
        seq = np.repeat(np.arange(len(sequences)), lengths)
        total = lengths.copy()
        # An unknown character falls back to its bytes.
        for i in np.flatnonzero(sym < 0):
            total[seq[i]] += len(text[i].encode()) - 1
        if len(sym) < 2:
            return total
        rank, made = self._ranks(sym, seq, np.arange(len(sym)))
        while True:
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            best = np.minimum.reduceat(rank, starts)
            live = best < NONE
            if not live.any():
                return total
            size = np.diff(np.append(starts, len(sym)))
            if live.sum() < 0.8 * len(live):  # finished sequences leave the batch
                keep = np.repeat(live, size)
                sym, seq, rank, made = sym[keep], seq[keep], rank[keep], made[keep]
                best, size = best[live], size[live]
            low = np.repeat(best, size)
            idx = np.flatnonzero((rank == low) & (rank < NONE))
            # Of overlapping pairs (runs of positions) every second one merges, from the left.
            first = np.append(True, np.diff(idx) > 1)
            if not first.all():
                idx = idx[(idx - idx[np.maximum.accumulate(np.where(first, np.arange(len(idx)), 0))]) % 2 == 0]
            x = made[idx]
            if self.hasty[x].any():
                idx = self._in_order(sym, seq, low, idx, x)
                x = made[idx]
            sym[idx] = x
            total -= np.bincount(seq[idx], minlength=len(total))
            stay = np.ones(len(sym), bool)
            stay[idx + 1] = False
            at = idx - np.arange(len(idx))  # where the merged symbols are once the others have moved up
            sym, seq, rank, made = sym[stay], seq[stay], rank[stay], made[stay]
            at = np.concatenate([at, at[at > 0] - 1])
            rank[at], made[at] = self._ranks(sym, seq, at)

    def _ranks(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the pairs that begin at the positions ``at``."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        rank, made = self.pairs(sym[at], sym[nxt])
        return np.where((seq[at] == seq[nxt]) & (nxt > at), rank, NONE), made

    def _in_order(self, sym: np.ndarray, seq: np.ndarray, low: np.ndarray, idx: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Those of the merges ``idx`` that can be done at once as if from left to right.

        Where a merge at once offers a pair of the same or a lower rank, the
        order matters: such a sequence merges only its leftmost pair.
        """
        n = len(sym)
        after, before = np.minimum(idx + 2, n - 1), np.maximum(idx - 1, 0)
        grown = np.full(n, -1, np.int32)
        grown[idx + 1] = x  # what stands on a position once the merge to its left is done

        def offered(a, b, i, j):
            return np.where((seq[i] == seq[j]) & (i != j), self.pairs(a, b)[0], NONE)

        left = np.minimum(offered(sym[before], x, before, idx), offered(grown[before], x, before, idx))
        risky = np.minimum(offered(x, sym[after], idx, after), left) <= low[idx]
        flagged = np.isin(seq[idx], seq[idx[risky]])
        return idx[~flagged | np.append(True, seq[idx[1:]] != seq[idx[:-1]])]


@lru_cache(1)
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


class Counter:
    """Token counts of whole texts; counts of cuts are remembered up to ``limit`` of them, but of long ones."""

    def __init__(self, path: str, limit: int = 300_000):
        self.vocabulary, self.limit, self.known = vocabulary(path), limit, {}

    def count(self, texts: list[str]) -> list[int]:
        find = self.vocabulary.cuts.findall
        cut = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > self.limit:
            self.known.clear()
        fresh = list(set().union(*cut).difference(self.known))
        long, at = [], 0
        while at < len(fresh):  # batches of some 200,000 characters, a longer sequence by itself
            size, end = 0, at
            while end < len(fresh) and (size == 0 or size + len(fresh[end]) < 200_000):
                size, end = size + len(fresh[end]), end + 1
            self.known.update(zip(fresh[at:end], self.vocabulary.count(fresh[at:end]).tolist(), strict=True))
            long += [x for x in fresh[at:end] if len(x) > LONGEST]
            at = end
        get = self.known.__getitem__
        total = [sum(map(get, c)) for c in cut]
        for x in long:
            del self.known[x]
        return total


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = 4096, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``limit``.

    One row per input row, repeats included. A null or empty text has no
    bytes and no tokens. Texts are never cut short; strings that look like
    special tokens are ordinary text. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = public_tokenizers.path(model)
        counter = _COUNTERS.setdefault(path, Counter(path))
        for part in slices(batches, 128):
            n = counter.count(part["t"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part["i"], pa.int64()), pa.array([len(t.encode()) for t in part["t"]], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )
        counter.known.clear()

    return docs.select(F.col(doc_id).cast("long").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(run, SCHEMA)
