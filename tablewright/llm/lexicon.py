"""A minimal acyclic transducer: frequent words to token ids, in one memory-mapped file.

Words share prefixes and, as equivalent states are merged, suffixes. Each arc carries a
number; the numbers on a word's path add up to the word's place in the lexicon, and so to
its ids. States are numbered, arcs are sorted by (state, byte): a lookup of many words at
once is one binary search per byte position.
"""

from __future__ import annotations

MAGIC = 0x4C455831
FIELDS = ("arcs", "states", "words", "ids", "longest")


def _minimal(words: list[bytes]) -> list[tuple[bool, tuple[tuple[int, int], ...]]]:
    """States (final, ((byte, target), ...)) of the minimal automaton of sorted, distinct
    words; the last one is the start. A state is frozen when no later word can change it
    and merged with an equal one seen before."""
    states: list = []
    known: dict = {}
    path: list[list] = [[False, []]]  # [final, frozen arcs]; the open arc leads to the next

    def freeze(node):
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    last = b""
    for word in words:
        same = 0
        limit = min(len(word), len(last))
        while same < limit and word[same] == last[same]:
            same += 1
        for depth in range(len(last), same, -1):
            node = path.pop()
            path[-1][1].append((last[depth - 1], freeze(node)))
        path.extend([False, []] for _ in range(len(word) - same))
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        node = path.pop()
        path[-1][1].append((last[depth - 1], freeze(node)))
    states.append((path[0][0], tuple(path[0][1])))
    return states


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """The file's bytes, from (word, ids) of distinct words."""
    import numpy as np
    entries = sorted(entries)
    states = _minimal([w for w, _ in entries])
    reach = []  # words that can be read from a state; targets come before their sources
    keys, targets, adds = [], [], []
    for s, (final, arcs) in enumerate(states):
        total = int(final)
        for byte, target in arcs:
            keys.append(s * 256 + byte)
            targets.append(target)
            adds.append(total)
            total += reach[target]
        reach.append(total)
    lengths = np.array([0] + [len(ids) for _, ids in entries], np.int32)
    flat = np.array([i for _, ids in entries for i in ids], np.int32)
    header = np.array([MAGIC, len(keys), len(states), len(entries), len(flat),
                       max((len(w) for w, _ in entries), default=0)], np.int64)
    final = np.array([f for f, _ in states], np.int32)
    return b"".join(a.tobytes() for a in (
        header, np.array(keys, np.int64), np.array(targets, np.int32), np.array(adds, np.int32),
        final, np.cumsum(lengths).astype(np.int32), flat))


def listed(values) -> list:
    """An Arrow array as a list, several times faster than by ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


class Lexicon:
    """Reads a compiled file through a memory map: workers of a machine share its pages."""

    def __init__(self, path: str):
        import mmap

        import numpy as np
        import pyarrow as pa
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        header = np.frombuffer(data, np.int64, 6)
        if header[0] != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        sizes = dict(zip(FIELDS, header[1:].tolist()))
        at = header.nbytes

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.keys = take(np.int64, sizes["arcs"])
        self.targets = take(np.int32, sizes["arcs"])
        self.adds = take(np.int32, sizes["arcs"])
        self.final = take(np.int32, sizes["states"])
        self.offsets = take(np.int32, sizes["words"] + 1)
        self.ids = take(np.int32, sizes["ids"])
        # The same ids by word, as bytes.
        self.values = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), sizes["words"],
            [None, pa.py_buffer(self.offsets.astype(np.int64) * 4), pa.py_buffer(self.ids)])
        self.start, self.longest = sizes["states"] - 1, sizes["longest"]

    def places(self, words: list[bytes]):
        """The place of each word in the lexicon (an array), -1 where it isn't in it."""
        import numpy as np
        out = np.full(len(words), -1, np.int64)
        left = np.fromiter(map(len, words), np.int64, len(words))  # bytes still to read
        at = np.cumsum(left) - left
        text = np.frombuffer(b"".join(words), np.uint8)
        rows = np.flatnonzero((left > 0) & (left <= self.longest)) if len(self.keys) else np.zeros(0, np.int64)
        left, at = left[rows], at[rows]
        state = np.full(len(rows), self.start, np.int64)
        place = np.zeros(len(rows), np.int64)
        while len(rows):
            key = state * 256 + text[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            rows, left, at, arc = rows[hit], left[hit] - 1, at[hit] + 1, arc[hit]
            state, place = self.targets[arc].astype(np.int64), place[hit] + self.adds[arc]
            ends = left == 0
            found = ends & (self.final[state] == 1)
            out[rows[found]] = place[found]
            rows, left, at, state, place = (a[~ends] for a in (rows, left, at, state, place))
        return out

    def packed(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as the bytes of 32-bit numbers, None where it isn't in the lexicon."""
        import pyarrow as pa
        place = self.places(words)
        return listed(self.values.take(pa.array(place, mask=place < 0)))

    def lookup(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, None where it isn't in the lexicon."""
        import numpy as np
        return [None if x is None else np.frombuffer(x, np.int32).tolist() for x in self.packed(words)]
