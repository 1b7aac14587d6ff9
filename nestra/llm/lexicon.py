"""A minimal acyclic transducer from words (any strings of bytes) to token ids, kept in one memory-mapped file.

States with equal futures are shared (incremental construction from sorted words). Each arc adds a number; the sum along a word is its rank among all words, which selects its slice of the id table. The file also has
the vocabulary, so workers need nothing else. Lookups walk many words at once: one binary search over all arcs per byte position.
"""

from __future__ import annotations

import heapq
from base64 import b64decode
from collections.abc import Callable
from functools import cached_property

import numpy as np

_PARTS = ("arc_key", "arc_to", "arc_out", "final", "id_at", "ids", "vocab_at", "vocab", "vocab_rank")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a .tiktoken file."""
    with open(path, "rb") as f:
        return {b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair encoding of one word: always the pair of lowest rank, the leftmost first. n log n in the word's length."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    start, nxt, prev = list(range(n + 1)), list(range(1, n + 2)), list(range(-1, n))
    end = list(range(1, n + 1))
    live = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if i < n else n
        if not live[i] or j >= n or not live[j] or end[j] != stop or start[i] != i:
            continue
        end[i], live[j] = stop, False
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (r := ranks.get(word[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i] : stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = nxt[i]
    return out


class _Builder:
    """Incremental construction of the minimal automaton from words in ascending order."""

    def __init__(self):
        self.arcs: list[dict[int, int]] = [{}]
        self.final = [False]
        self.known: dict[tuple, int] = {}
        self.path: list[tuple[int, int, int]] = []  # (state, byte, next) of the last word that may still change
        self.last = b""

    def add(self, word: bytes) -> None:
        same = 0
        while same < min(len(word), len(self.last)) and word[same] == self.last[same]:
            same += 1
        self._share(same)
        state = self.path[-1][2] if self.path else 0
        for byte in word[same:]:
            self.arcs.append({})
            self.final.append(False)
            new = len(self.arcs) - 1
            self.arcs[state][byte] = new
            self.path.append((state, byte, new))
            state = new
        self.final[state] = True
        self.last = word

    def _share(self, down_to: int) -> None:
        while len(self.path) > down_to:
            state, byte, child = self.path.pop()
            future = (self.final[child], tuple(self.arcs[child].items()))
            if (twin := self.known.get(future)) is not None:
                self.arcs[state][byte] = twin
            else:
                self.known[future] = child

    def tables(self) -> dict[str, np.ndarray]:
        self._share(0)
        order, number = [], {}
        stack = [0]
        while stack:
            s = stack.pop()
            if s not in number:
                number[s] = len(order)
                order.append(s)
                stack.extend(self.arcs[s].values())
        below: dict[int, int] = {}  # words that end at or behind a state
        todo = [(0, False)]
        while todo:
            s, ready = todo.pop()
            if ready:
                below[s] = self.final[s] + sum(below[t] for t in self.arcs[s].values())
            elif s not in below:
                todo.append((s, True))
                todo.extend((t, False) for t in self.arcs[s].values() if t not in below)
        arcs = []
        for s in order:
            skip = int(self.final[s])
            for byte, to in sorted(self.arcs[s].items()):
                arcs.append((number[s] * 256 + byte, number[to], skip))
                skip += below[to]
        a = np.array(sorted(arcs) or [(-1, 0, 0)], np.int64)
        return {"arc_key": a[:, 0].copy(), "arc_to": a[:, 1].astype(np.int32), "arc_out": a[:, 2].astype(np.int32), "final": np.array([self.final[s] for s in order], np.uint8)}


def compile_lexicon(words: list[bytes], ranks: dict[bytes, int], encode: Callable[[bytes], list[int]] | None = None) -> bytes:
    """The file's bytes: header (sizes), then the tables, each aligned to 8 bytes. ``encode`` gives the ids of a word (default: merge)."""
    encode = encode or (lambda word: merge(word, ranks))
    builder, ids, at = _Builder(), [], [0]
    for word in sorted(set(words)):
        if word:
            builder.add(word)
            ids.extend(encode(word))
            at.append(len(ids))
    vocab = list(ranks)
    t = builder.tables() | {
        "id_at": np.array(at, np.int64), "ids": np.array(ids, np.int32), "vocab_at": np.r_[0, np.cumsum([len(v) for v in vocab])].astype(np.int64), "vocab": np.frombuffer(b"".join(vocab), np.uint8),
        "vocab_rank": np.array(list(ranks.values()), np.int32),
    }
    head, body, offset = [], [], 8 * 3 * len(_PARTS)
    for name in _PARTS:
        raw = t[name].tobytes()
        head.append((offset, len(t[name]), t[name].dtype.itemsize))
        raw += b"\0" * (-len(raw) % 8)
        body.append(raw)
        offset += len(raw)
    return np.array(head, np.int64).tobytes() + b"".join(body)


class Lexicon:
    """The memory-mapped file."""

    def __init__(self, path: str):
        m = np.memmap(path, np.uint8, "r")
        head = np.frombuffer(m[: 24 * len(_PARTS)], np.int64).reshape(-1, 3)
        for name, (offset, n, width) in zip(_PARTS, head.tolist(), strict=True):
            kind = {1: np.uint8, 4: np.int32, 8: np.int64}[width]
            setattr(self, name, np.asarray(m[offset : offset + n * width]).view(kind))

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        """The vocabulary, taken out of the file when the first unseen word is merged."""
        vocab, at = self.vocab.tobytes(), self.vocab_at.tolist()
        return {vocab[a:b]: r for a, b, r in zip(at, at[1:], self.vocab_rank.tolist(), strict=False)}

    def find(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word in the lexicon, -1 if it is not in it."""
        out = np.full(len(words), -1)
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        live = np.flatnonzero(size > 0)
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        k = 0
        while live.size:
            key = state[live] * 256 + flat[begin[live] + k]
            at = np.searchsorted(self.arc_key, key)
            at[at == len(self.arc_key)] = 0
            ok = self.arc_key[at] == key
            live, at = live[ok], at[ok]
            state[live] = self.arc_to[at]
            total[live] += self.arc_out[at]
            k += 1
            ended = size[live] == k
            done = live[ended]
            good = done[self.final[state[done]] == 1]
            out[good] = total[good]
            live = live[~ended]
        return out
