"""Byte-level BPE encoding and decoding (operator 6).

A bitmap of three levels keeps which merge ranks have work; each rank has a
bucket of linked-list positions. Find-first-set gives the lowest rank, its
bucket is taken whole, entries whose pair has changed meanwhile are skipped,
and the pairs that a merge forms go to the buckets of their own ranks. One
queue serves any number of pre-tokens laid end to end (links stop at their
borders), so that a bucket holds many positions and is merged as an array;
one pre-token of megabytes costs no more per byte than many short ones.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm._text import slices
from tremor.session import small_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
NONE = np.int32(2**31 - 1)
#: What is remembered between texts holds so many characters at most; stretches of more than LONGEST never are.
CHARACTERS, LONGEST = 8 << 20, 2048
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


#: White space other than the space.
OTHER_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 32]


def crowded(text: str, words: list[str]) -> bool:
    """Has the text a space at an end or beside other white space?"""
    return "" in words or any(w in text and (" " + w in text or w + " " in text) for w in OTHER_WHITE)


class RankQueue:
    """Buckets by rank under a three-level bitmap of 64-bit words; ranks below 2**18."""

    def __init__(self):
        self.top, self.mid, self.low = 0, [0] * 64, [0] * 4096
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        found = self.buckets.get(rank)
        if found is not None:
            found.append(positions)
            return
        self.buckets[rank] = [positions]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Each position to the bucket of its rank; NONE goes nowhere."""
        keep = ranks < NONE
        ranks, positions = ranks[keep], positions[keep]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        edges = [0, *cuts.tolist(), len(ranks)]
        for rank, a, b in zip(ranks[edges[:-1]].tolist(), edges[:-1], edges[1:], strict=True):
            self.push(rank, positions[a:b])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank that has entries, and all of them in order of position."""
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | (self.mid[a] & -self.mid[a]).bit_length() - 1
        rank = b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


class ByteBPE:
    """Encoder and decoder for a rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, limit: int = 400_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        if max(self.ranks.values()) >= 1 << 18:
            raise ValueError("more ranks than the queue holds")
        self.split = regex.compile(pattern).findall
        self.piece = {str(r): b for b, r in self.ranks.items()}  # by decimal id
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.size = max(self.ranks.values()) + 1
        keys, made, hasty = [], [], np.zeros(self.size, bool)
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    made.append(r)
                    hasty[a] |= r <= a
                    hasty[b] |= r <= b
        self.hasty = hasty
        self._index(np.array(keys, np.int64), np.array(made, np.int32))
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered: ids of pre-tokens, and ids and decoded bytes of stretches of text."""
        self.known: dict[str, str] = {}
        self.runs: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}
        self.weight = 0

    def _index(self, keys: np.ndarray, made: np.ndarray) -> None:
        self.slots, self.found = np.full(1 << 22, -1, np.int64), np.full(1 << 22, NONE, np.int32)
        home = self._home(keys)
        _, first = np.unique(home, return_index=True)
        self.slots[home[first]], self.found[home[first]] = keys[first], made[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.more, self.more_made = np.append(keys[rest], np.int64(2**62)), np.append(made[rest], NONE)
        self.crowded = np.zeros(1 << 22, bool)
        self.crowded[home[rest]] = True

    @staticmethod
    def _home(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of what each pair merges into, NONE where it doesn't."""
        key = a.astype(np.int64) * self.size + b
        home = self._home(key)
        hit = self.slots[home] == key
        rank = np.where(hit, self.found[home], NONE)
        again = np.flatnonzero(self.crowded[home] & ~hit)
        if len(again):
            pos = np.searchsorted(self.more, key[again])
            rank[again] = np.where(self.more[pos] == key[again], self.more_made[pos], NONE)
        return rank

    @staticmethod
    def _chain(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of pairs that overlap in a chain every second one, from the left."""
        if len(at) < 2:
            return at
        first = np.append(True, nxt[at[:-1]] != at[1:])
        if first.all():
            return at
        k = np.arange(len(at))
        return at[(k - np.maximum.accumulate(np.where(first, k, 0))) % 2 == 0]

    def merge(self, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in order, and how many each has."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        n = int(lengths.sum())
        sym = np.append(self.byte[np.frombuffer(b"".join(pretokens), np.uint8)], np.int32(0))
        seq = np.append(np.repeat(np.arange(len(pretokens)), lengths), -1)
        nxt = np.minimum(np.arange(1, n + 2), n)  # n: past the end
        nxt[:-1][seq[1:] != seq[:-1]] = n
        prv = np.arange(-1, n)
        prv[1:][seq[1:] != seq[:-1]] = n
        prv[0] = n
        alive = np.ones(n + 1, bool)
        alive[n] = False
        pair = np.full(n + 1, NONE, np.int32)  # the present rank of the pair that begins here
        inner = np.flatnonzero(nxt[:n] < n)
        pair[inner] = self.pair_ranks(sym[inner], sym[nxt[inner]])
        queue = RankQueue()
        queue.push_all(pair[inner], inner)
        while (work := queue.pop()) is not None:
            rank, at = work
            valid = at[pair[at] == rank]  # the others are stale
            if not len(valid):
                continue
            at = self._chain(valid, nxt)
            if self.hasty[rank] and len(at) > 1:
                # A merge may offer a pair of the same or a lower rank, which then comes first:
                # each pre-token merges up to its first such pair, what follows waits.
                left, right = prv[at], nxt[nxt[at]]
                was = np.append(False, nxt[nxt[at[:-1]]] == at[1:])  # its left neighbour is merged just before
                mine = np.full(len(at), rank, np.int32)
                near = np.where(left < n, self.pair_ranks(np.where(was, mine, sym[left]), mine), NONE)
                near = np.minimum(near, np.where(right < n, self.pair_ranks(mine, sym[right]), NONE))
                risky = np.flatnonzero(near <= rank)
                if len(risky):
                    stop = np.full(len(pretokens), n, np.int64)
                    np.minimum.at(stop, seq[at[risky]], at[risky])
                    queue.push(rank, valid[valid > stop[seq[valid]]])
                    at = at[at <= stop[seq[at]]]
            gone = nxt[at]
            after = nxt[gone]
            sym[at], nxt[at] = rank, after
            prv[after] = at
            alive[gone] = False
            pair[gone] = NONE
            before = prv[at]
            near = np.concatenate([at, before[before < n]])
            near = near[alive[near]]
            right = nxt[near]
            new = np.where(right < n, self.pair_ranks(sym[near], sym[right]), NONE)
            pair[near] = new
            queue.push_all(new, near)
        keep = alive[:n]
        return sym[:n][keep], np.bincount(seq[:n][keep], minlength=len(pretokens))

    def learn(self, pretokens: set[str]) -> None:
        """Remember the ids of these pre-tokens, as decimal ids joined by commas."""
        rest, raw = [], []
        for p in pretokens:
            b = p.encode()
            r = self.ranks.get(b)
            if r is not None:
                self.known[p] = str(r)
            else:
                rest.append(p)
                raw.append(b)
        if rest:
            ids, counts = self.merge(raw)
            text = list(map(str, ids.tolist()))
            at = 0
            for p, c in zip(rest, counts.tolist(), strict=True):
                self.known[p] = ",".join(text[at : at + c])
                at += c

    def _learn_runs(self, texts: set[str]) -> dict[str, str]:
        """Ids of whole stretches of text."""
        parts = {t: self.split(t) for t in texts}
        everything = set().union(*parts.values())
        missing = everything.difference(self.known)
        if len(self.known) + len(missing) > self.limit:
            self.known.clear()
            missing = everything
        if missing:
            self.learn(missing)
        get = self.known.__getitem__
        ids = {t: ",".join(map(get, p)) for t, p in parts.items()}
        for p in missing:
            if len(p) > LONGEST:
                del self.known[p]
        return ids

    def encode_runs(self, texts: list[str]) -> Iterator[tuple[list[str], list[bytes]]]:
        """Each text in runs: their ids as decimal numbers joined by commas, and the bytes that these decode to.

        A space between two characters that are no white space always begins a
        pre-token, so the stretches between such spaces can be encoded (and
        remembered) by themselves. Texts with other white space beside a space
        are one stretch. What is remembered is bounded by number and by
        characters; stretches of over LONGEST characters never are.
        """
        cut = []
        for t in texts:
            words = t.split(" ")
            if len(words) > 1 and not crowded(t, words):
                c = [" " + w for w in words]
                c[0] = words[0]
                cut.append(c)
            else:
                cut.append([t] if t else [])
        everything = set().union(*cut)
        missing = everything.difference(self.runs)
        if missing and (len(self.runs) + len(missing) > self.limit or self.weight > CHARACTERS):
            self.runs.clear()
            self.raw.clear()
            self.weight, missing = 0, everything
        if missing:
            new = self._learn_runs(missing)
            self.weight += sum(map(len, new))
            self.runs.update(new)
            self.raw.update((x, self.decode(x)) for x in new.values())
        get, raw = self.runs.__getitem__, self.raw.__getitem__
        for c in cut:
            ids = list(map(get, c))
            yield ids, list(map(raw, ids))
        for t in missing:
            if len(t) > LONGEST:
                self.weight -= len(t)
                self.raw.pop(self.runs.pop(t), None)

    def encode_batch(self, texts: list[str]) -> list[str]:
        """Ids of each text, as decimal numbers joined by commas."""
        return [",".join(ids) for ids, _ in self.encode_runs(texts)]

    def decode(self, ids: str) -> bytes:
        """Bytes of decimal ids joined by commas."""
        return b"".join(map(self.piece.__getitem__, ids.split(","))) if ids else b""


@lru_cache(2)
def codec(ranks: str) -> ByteBPE:
    return ByteBPE(public_tokenizers.path(ranks))


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))


def encode(docs: DataFrame, ranks: str = RANKS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text; a null text counts as empty and has no ids.

    One row per input row, repeats included; other columns are ignored; no
    special tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for part in slices(batches, 1024):
            ids = [np.array(x.split(","), np.int32) if x else np.zeros(0, np.int32) for x in bpe.encode_batch(part["t"])]
            yield pa.RecordBatch.from_arrays([pa.array(part["i"], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        bpe.forget()

    return _texts(docs, text, doc_id).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, decoded binary``; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for part in slices(batches, 1024):
            raw = [bpe.decode(",".join(map(str, x))) if x else b"" for x in part["x"]]
            yield pa.RecordBatch.from_arrays([pa.array(part["i"], pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col(doc_id).cast("long").alias("i"), F.col(ids).alias("x")).mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks: str = RANKS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Token count and digests of ids and of the bytes decoded from them, for every whole text.

    Encodes, decodes the ids and digests both where the text is, so that no
    ids travel. Nulls, repeats and other columns as in :func:`encode`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for part in slices(batches, 1024):
            n, a, b = [], [], []
            for ids, raw in bpe.encode_runs(part["t"]):
                x = ",".join(ids)
                n.append(x.count(",") + 1 if x else 0)
                a.append(hashlib.sha256(x.encode()).hexdigest())
                b.append(hashlib.sha256(b"".join(raw)).hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(part["i"], pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    return _texts(docs, text, doc_id).mapInArrow(run, DIGESTS)
