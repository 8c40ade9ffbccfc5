"""BPE encoding and decoding with a compiled lexicon of frequent words.

1. Words (pre-tokens) of all documents are counted, pre-aggregated per batch.
2. The ``LEXICON_WORDS`` most frequent ones, a top-k of stated size, are encoded by exact
   merging on the executors and compiled into a minimal acyclic transducer
   (``lexicon.py``). The file goes to the shared folder and, as a Spark file, to every
   executor, where workers memory-map it.
3. Documents are cut at white space, a slice of them at once, and each distinct chunk of a
   slice is cut into words; words in the lexicon take their ids from the automaton, and a task
   remembers them; all others are merged exactly, a slice's words together. What the distinct
   chunks give is dealt out to the documents as Arrow arrays.

The lexicon only saves work: ids don't depend on what is in it. The tokenizer file (one
JSON of the tokenizers library: BPE with an end-of-word suffix, NFC, lower case, white space
dropped, byte-level symbols) is a parameter.

Defined results: null or empty text has no ids and decodes to the empty text; repeated rows
and ids are encoded each; an empty table gives an empty result; other columns aren't read.
A text is held whole by one task (texts of about ``SLICE_BYTES`` at a time).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import lasting_path
from .common import MEMO_LENGTH, freed, table, written
from .lexicon import Lexicon, compile_lexicon, listed

LEXICON_WORDS = 200_000
#: Bytes of words with their ids that a task remembers: in two halves, the older one given up when the
#: younger is full.
MEMO_BYTES = 32_000_000
#: Bytes of texts that a task encodes at once, and that it gathers to count their words.
SLICE_BYTES = 1_500_000
GATHER_BYTES = 4_000_000
#: What an entry takes besides its text and ids.
ENTRY_BYTES = 180
#: Words of at most ``SHORT`` symbols are merged ``TOGETHER`` at a time.
SHORT = 48
TOGETHER = 8192
#: A merge is its rank and the resulting id in one number.
SHIFT = 24
LOW = (1 << SHIFT) - 1
NEVER = 1 << 62
#: White space to ``str.split()`` but not to the tokenizer file; white space that isn't ASCII.
CONTROLS = "\x1c\x1d\x1e\x1f"
SPACES = frozenset("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                   "\u2028\u2029\u202f\u205f\u3000")
#: Categories of characters whose treatment depends on the Unicode version: unassigned ones and marks.
UNSURE = frozenset(("Cn", "Mn", "Mc", "Me"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """The tokenizer file's normalizer, word pattern and merges."""

    def __init__(self, path: str):
        import json

        import numpy as np
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.library = path, None
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        # Pairs of ids, sorted, both in one number; and rank and result of each, so the least is the first to merge.
        vocab, n = self.vocab, len(model["merges"])
        keys = np.fromiter((vocab[a] << SHIFT | vocab[b] for a, b in model["merges"]), np.int64, n)
        found = np.fromiter((r << SHIFT | vocab[a + b] for r, (a, b) in enumerate(model["merges"])), np.int64, n)
        order = np.argsort(keys)
        self.pairs = keys[order], found[order]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_in = regex.compile(pattern).findall
        self.words_and_ends = regex.compile(f"{pattern}|\n").findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special))) + ")").split
        symbols = byte_symbols()
        self.inner = [self.vocab.get(s) for s in symbols]
        self.last = [self.vocab.get(s + self.suffix) for s in symbols]

    @cached_property
    def merges(self) -> dict[tuple[int, int], int]:
        """``pairs`` by pair."""
        return {(key >> SHIFT, key & LOW): found for key, found in zip(*(a.tolist() for a in self.pairs))}

    def words(self, text: str) -> list[str]:
        """Words in order; a special token's text stands for itself."""
        return [w for chunk in self.chunks(text) for w in self.split(chunk)]

    def chunks(self, text: str) -> list:
        """What stands between white space, in order; ready words are tuples of one."""
        if "<|" in text:
            out = []
            for k, part in enumerate(self.cut(text)):
                out += [(part,)] if k % 2 else self._chunks(part)
            return out
        return self._chunks(text)

    def split(self, chunk):
        if isinstance(chunk, tuple):
            return chunk
        return (chunk,) if chunk.isalpha() else self.words_in(chunk)  # letters alone are one word

    def split_all(self, chunks: list[str]) -> list[list[str]]:
        """``split`` of each chunk (none is ready, none holds white space) in one search through all."""
        found = self.words_and_ends("\n".join([*chunks, ""]))
        ends = [k for k, w in enumerate(found) if w == "\n"]
        return [found[a + 1:b] for a, b in zip([-1, *ends], ends)]

    def _chunks(self, text: str) -> list:
        lowered = self._lowered(text)
        if lowered is None:
            return [(w,) for w in self._library_words(text)]
        return [(w,) for w in self.words_in(lowered)] if with_controls(lowered) else lowered.split()

    def _lowered(self, text: str) -> str | None:
        """The text as the normalizer leaves it; None if the library itself has to cut it."""
        import unicodedata
        if not text.isascii():
            # Python's tables and the library's are of different Unicode versions; a text with a
            # character that Python doesn't know yet is cut by the library itself.
            # Nor do they agree on every mark's class, so what isn't plainly NFC goes there too.
            if not unicodedata.is_normalized("NFC", text) or any(
                    unicodedata.category(c) in UNSURE for c in set(text) if c > "\u0300"):
                return None
            text = text.replace("Σ", "σ")  # lower case letter by letter: no final sigma
        return text.lower()

    def spaced(self, text: str) -> str | None:
        """The text's chunks between ASCII white space; None if there are ready words among them."""
        lowered = None if "<|" in text else self._lowered(text)
        if lowered is None or with_controls(lowered):
            return None
        return lowered if lowered.isascii() or SPACES.isdisjoint(lowered) else " ".join(lowered.split())

    def cut_texts(self, texts: list[str]):
        """Chunks of all texts in an Arrow array, ready words after a newline (which no chunk holds),
        empty chunks among them; and where each text's chunks start and end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        spaced = list(map(self.spaced, texts))
        odd = [[c if c.__class__ is str else "\n" + c[0] for c in self.chunks(t)]
               for t, s in zip(texts, spaced) if s is None]
        cut = pc.ascii_split_whitespace(pa.array([s for s in spaced if s is not None], pa.large_string()))
        chunks = [cut.flatten(), pa.array([c for part in odd for c in part], pa.large_string())]
        sizes = np.empty(len(texts), np.int64)
        ready = np.fromiter((s is None for s in spaced), bool, len(texts))
        sizes[~ready], sizes[ready] = np.diff(cut.offsets.to_numpy()), list(map(len, odd))
        ends = np.empty(len(texts), np.int64)
        order = np.argsort(ready, kind="stable")  # the odd texts' chunks come last
        ends[order] = np.cumsum(sizes[order])
        return pa.concat_arrays(chunks), ends - sizes, ends

    def words_of(self, chunks):
        """The words of all chunks in one Arrow array, chunk by chunk in an order of its own; the chunks'
        numbers in that order; and how many words each has, in that order."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        alone = pc.ascii_is_alpha(chunks).to_numpy(zero_copy_only=False)  # ASCII letters alone are one word
        ready = pc.starts_with(chunks, "\n").to_numpy(zero_copy_only=False)
        parts = [np.flatnonzero(which) for which in (alone, ready, ~(alone | ready))]
        alone, ready, mixed = (chunks.take(pa.array(rows)) for rows in parts)
        found = pa.array(self.words_and_ends("\n".join([*listed(mixed), ""])), pa.large_string())
        ends = pc.equal(found, "\n")
        at = np.flatnonzero(ends.to_numpy(zero_copy_only=False))
        words = pa.concat_arrays([alone, pc.utf8_slice_codeunits(ready, 1), found.filter(pc.invert(ends))])
        sizes = np.ones(len(chunks), np.int64)
        sizes[len(alone) + len(ready):] = np.diff(at, prepend=-1) - 1
        return words, np.concatenate(parts), sizes

    def _library_words(self, text: str) -> list[str]:
        from tokenizers import Tokenizer
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in w).decode("utf-8") for w, _ in cut]

    def merge(self, word: str) -> list[int]:
        """Exact BPE of one word: the lowest-ranked pair first, the leftmost of equals."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode("utf-8")
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        ids = [i for i in ids if i is not None]
        return merge_long(ids, self.merges) if len(ids) > SHORT else merge_short(ids, self.merges)

    def merge_all(self, words: list[str]) -> list[bytes]:
        """``merge`` of each word, as the bytes of 32-bit numbers; short words of about one length together."""
        import numpy as np
        data = [w.encode("utf-8") for w in words]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        out: list = [None] * len(words)
        if len(self.pairs[0]) and None not in self.inner and None not in self.last:
            for low, high in ((0, 6), (6, 10), (10, 16), (16, 28), (28, SHORT)):
                rows = np.flatnonzero((lengths > low) & (lengths <= high))
                for k in range(0, len(rows), TOGETHER):
                    self._merge_rows(data, lengths, rows[k:k + TOGETHER], high, out)
        for k, (w, ids) in enumerate(zip(words, out)):
            if ids is None or w in self.special:
                out[k] = np.array(self.merge(w), np.int32).tobytes()
        return out

    def _pair(self, left, right):
        """Rank and result of pairs of ids; NEVER if they don't merge or one is negative."""
        import numpy as np
        keys, found = self.pairs
        key = left.astype(np.int64) << SHIFT | right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, found[at], NEVER)

    def _merge_rows(self, data: list[bytes], lengths, rows, width: int, out: list) -> None:
        """Step by step, each row merges its pair of lowest rank, the leftmost of equals, and so gets
        one id shorter; rows without such a pair leave. Ids that a row doesn't have are -1, at its end."""
        import numpy as np
        n, size = len(rows), lengths[rows]
        text = np.frombuffer(b"".join([data[i].ljust(width, b"\0") for i in rows.tolist()]), np.uint8).reshape(n, width)
        each = np.arange(n)
        ids = np.array(self.inner, np.int32)[text]
        ids[each, size - 1] = np.array(self.last, np.int32)[text[each, size - 1]]
        ids[np.arange(width) >= size[:, None]] = -1
        ranks = self._pair(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
                go = best < NEVER
            else:
                go = np.zeros(len(rows), bool)
            ready, step = ids[~go], 4 * ids.shape[1]
            flat = ready.tobytes()
            for k, (i, m) in enumerate(zip(rows[~go].tolist(), (ready >= 0).sum(axis=1).tolist())):
                out[i] = flat[k * step:k * step + 4 * m]
            if not go.any():
                break
            rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
            each = np.arange(len(rows))
            ids[each, at] = best & LOW
            stays = np.ones(ids.shape, bool)
            stays[each, at + 1] = False
            ids = ids[stays].reshape(len(rows), -1)
            stays = np.ones(ranks.shape, bool)
            stays[each, at] = False
            ranks = ranks[stays].reshape(len(rows), -1)
            r = np.flatnonzero(at < ranks.shape[1])
            ranks[r, at[r]] = self._pair(ids[r, at[r]], ids[r, at[r] + 1])
            r = np.flatnonzero(at > 0)
            ranks[r, at[r] - 1] = self._pair(ids[r, at[r] - 1], ids[r, at[r]])


def with_controls(text: str) -> bool:
    return any(c in text for c in CONTROLS)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if it is a visible Latin-1 character, else
    the next of the characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [], 256
    for b in range(256):
        if b in visible:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def merge_short(ids: list[int], merges: dict) -> list[int]:
    get = merges.get
    ranks = [get(pair, NEVER) for pair in zip(ids, ids[1:])]
    while ranks:
        best = min(ranks)
        if best == NEVER:
            break
        k = ranks.index(best)
        ids[k:k + 2] = [best & LOW]
        del ranks[k]
        if k < len(ranks):
            ranks[k] = get((ids[k], ids[k + 1]), NEVER)
        if k:
            ranks[k - 1] = get((ids[k - 1], ids[k]), NEVER)
    return ids


def merge_long(ids: list[int], merges: dict) -> list[int]:
    """The same on a linked list with a heap: n log n steps for a word of any length."""
    import heapq
    n = len(ids)
    ids, after, before = list(ids), [*range(1, n), -1], [-1, *range(n - 1)]
    alive, heap = [True] * n, []

    def offer(k):
        j = after[k]
        if j >= 0 and (m := merges.get((ids[k], ids[j]))) is not None:
            heapq.heappush(heap, (m, k, ids[k], ids[j]))

    for k in range(n):
        offer(k)
    while heap:
        m, k, a, b = heapq.heappop(heap)
        j = after[k]
        if not alive[k] or j < 0 or ids[k] != a or ids[j] != b:
            continue
        ids[k], alive[j], after[k] = m & LOW, False, after[j]
        if after[j] >= 0:
            before[after[j]] = k
        offer(k)
        if before[k] >= 0:
            offer(before[k])
    return [i for i, keep in zip(ids, alive) if keep]


def _texts(piece, column: int) -> list[str]:
    """Texts from bytes; what isn't valid UTF-8 becomes U+FFFD."""
    return [(t or b"").decode("utf-8", "replace") for t in piece.column(column).to_pylist()]


def slices_of(batch, size: int):
    """An Arrow batch in pieces with at most ``size`` bytes of texts, its last column, or one row (no copy)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    lengths = pc.binary_length(batch.column(batch.num_columns - 1).cast(pa.large_binary()))
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False))
    start = done = 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(ends, done + size, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def joined(values, ends):
    """An Arrow array of binaries of which each is some of ``values`` in a row: up to ``ends``, from where
    the one before it ended."""
    import numpy as np
    import pyarrow as pa
    offsets = offsets_of(values)[np.concatenate([[0], ends])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(np.ascontiguousarray(offsets)), values.buffers()[2]])


def offsets_of(values):
    """Where each value of an array of large binaries starts in its bytes, and the end of the last."""
    import numpy as np
    if not len(values):
        return np.zeros(1, np.int64)
    return np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, 8 * values.offset)


def uncollected(run):
    """``run`` without Python's search for cycles of objects, which it doesn't make: the search goes through
    all lists of words again and again."""
    def plain(batches):
        import gc
        was = gc.isenabled()
        gc.disable()
        try:
            yield from run(batches)
        finally:
            if was:
                gc.enable()
    return plain


def _count_words(path: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        encoder = Encoder(path)

        def flush(texts):
            chunks = encoder.cut_texts(texts)[0].value_counts()
            texts.clear()
            words, order, sizes = encoder.words_of(chunks.field("values"))
            n = np.repeat(chunks.field("counts").to_numpy()[order], sizes)
            words = words.dictionary_encode()
            total = np.zeros(len(words.dictionary), np.int64)
            np.add.at(total, words.indices.to_numpy(), n)
            words = words.dictionary
            for k in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [words.slice(k, 50_000).cast(pa.string()), pa.array(total[k:k + 50_000])], ["word", "n"])

        texts, size = [], 0
        for batch in batches:
            for piece in slices_of(batch, SLICE_BYTES):
                texts += _texts(piece, 0)
                size += piece.nbytes
                if size > GATHER_BYTES:
                    yield from flush(texts)
                    size = 0
        yield from flush(texts)
    return run


def _encode_words(path: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        encoder = Encoder(path)
        for batch in batches:
            words = batch.column(0)
            ids = [np.frombuffer(x, np.int32) for x in encoder.merge_all(words.to_pylist())]
            yield pa.RecordBatch.from_arrays([words, pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])
    return run


def frequent_words(docs: DataFrame, path: str, limit: int, text_col: str = "text") -> DataFrame:
    """(word, ids) of the most frequent words of all documents, at most ``limit``.

    All words down to some least count: the counts' own distribution, in 64 steps to the power of
    two (at most 4,096 rows), says which, so nothing is sorted and no task sees all words.
    """
    counts = (docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
              .mapInArrow(freed(uncollected(_count_words(path))), "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1 AND length(word) <= 64")
              .withColumn("step", F.floor(64 * F.log2("n")).cast("int")))
    counts = written(counts, "op2-counts")
    steps = sorted(counts.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    total, least = 0, 1 << 30
    for r in steps:
        total += r["words"]
        if total > limit:
            break
        least = r["step"]
    return (counts.where(F.col("step") >= least).select("word").repartition(8)
            .mapInArrow(_encode_words(path), "word string, ids array<int>"))


def share_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Write ``data`` into the shared folder and hand it to all executors; the file's name."""
    path = lasting_path(spark, name)
    jvm, sc = spark._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(data)
    finally:
        out.close()
    sc.addFile(path)
    return path.rpartition("/")[2]


def build_lexicon(docs: DataFrame, path: str, limit: int = LEXICON_WORDS, text_col: str = "text") -> str:
    """Compile the lexicon of ``docs``; the name of the Spark file."""
    rows = frequent_words(docs, path, limit, text_col).toArrow()  # at most ``limit`` short rows
    words, ids = rows.column(0).to_pylist(), rows.column(1).to_pylist()
    data = compile_lexicon([(w.encode("utf-8"), i) for w, i in zip(words, ids)])
    return share_file(docs.sparkSession, "lexicon", data)


def _encode(path: str, lexicon_file: str, full: bool):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        from pyspark import SparkFiles
        encoder = Encoder(path)
        lexicon = Lexicon(SparkFiles.get(lexicon_file))
        # Ids and tokens, each after the space that parts it from the one before.
        tokens = [" " + encoder.tokens.get(i, "") for i in range(max(encoder.tokens) + 1)]
        numbers = pa.array([b" %d" % i for i in range(len(tokens))], pa.large_binary())
        tokens = pa.array([t.encode("utf-8") for t in tokens], pa.large_binary())

        memo, older = {}, {}  # word -> its ids' bytes
        held = 0  # bytes of ``memo``, about

        def remember(words, known, which):
            nonlocal held
            entries = {words[k]: known[k] for k in which}
            memo.update(entries)
            held += ENTRY_BYTES * len(entries) + sum(map(len, entries)) + sum(map(len, entries.values()))

        def ids_of(words):
            """The ids' bytes of each word, all different."""
            nonlocal older, held
            if held > MEMO_BYTES // 2:
                older = dict(memo)
                memo.clear()
                held = 0
            known = list(map(memo.get, words))
            new = [k for k, ids in enumerate(known) if ids is None]
            for k in new:
                known[k] = older.get(words[k])
            asked = [k for k in new if known[k] is None]
            for k, ids in zip(asked, lexicon.packed([words[k].encode("utf-8") for k in asked])):
                known[k] = ids
            # Long words and those that the lexicon lacks, so rare ones, are held for one slice.
            remember(words, known, [k for k in new if known[k] is not None and len(words[k]) <= MEMO_LENGTH])
            rare = [k for k in asked if known[k] is None]
            for k, ids in zip(rare, encoder.merge_all([words[k] for k in rare])):
                known[k] = ids
            return known

        def cut(texts):
            """Where each text's chunks start and end, each chunk's place among the distinct ones, and these ones'
            ids: all in a row, and where each chunk's end."""
            chunks, starts, stops = encoder.cut_texts(texts)
            chunks = chunks.dictionary_encode()
            words, order, sizes = encoder.words_of(chunks.dictionary)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            words = words.dictionary_encode()
            known = pa.array(ids_of(listed(words.dictionary)), pa.large_binary()).take(words.indices)
            ends = offsets_of(known)[np.cumsum(sizes)] // 4
            flat = np.frombuffer(known.buffers()[2] or b"", np.int32, int(ends[-1]) if len(ends) else 0)
            return starts, stops, place[chunks.indices.to_numpy()], flat, ends

        def dealt(values, flat, ends, places):
            """The value of each id, in the order of the texts' chunks: their bytes, and where each chunk's start."""
            out = joined(values.take(pa.array(flat)), ends).take(places)
            return memoryview(out.buffers()[2] or b""), offsets_of(out)

        def encoded(piece):
            starts, stops, places, flat, ends = cut(_texts(piece, piece.num_columns - 1))
            before = np.concatenate([[0], np.cumsum(np.diff(ends, prepend=0)[places])])
            columns = [pa.array(before[stops] - before[starts], pa.int64())]
            places = pa.array(places)
            for values in (numbers, tokens):
                data, at = dealt(values, flat, ends, places)
                bounds = list(zip((at[starts] + 1).tolist(), at[stops].tolist()))  # without the first space
                columns.append(pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in bounds], pa.string()))
                if full:
                    columns.append(pa.array([bytes(data[a:b]).decode("utf-8") for a, b in bounds], pa.string()))
                data = at = None
            if full:
                n, ids, numerals, text, decoded = columns
                numerals = [[int(i) for i in t.split()] for t in numerals.to_pylist()]
                columns = [n, ids, text, pa.array(numerals, pa.list_(pa.int32())), decoded]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(columns)]
            return pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], *columns], piece.schema.names[:-1] + names)

        for batch in batches:
            yield from map(encoded, slices_of(batch, SLICE_BYTES))
    return run


def encode(docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS,
           id_col: str = "doc_id", text_col: str = "text", full: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row, with ``full`` also ids and decoded."""
    path = path or tokenizer_path()
    lexicon_file = build_lexicon(docs, path, lexicon_words, text_col)
    df = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if full:
        schema += ", ids array<int>, decoded string"
    return df.mapInArrow(freed(uncollected(_encode(path, lexicon_file, full))), schema)


def decode(ids: list[int], encoder: Encoder) -> str:
    """The tokens joined by spaces, as the tokenizer file (which has no decoder) asks for."""
    return " ".join(encoder.tokens[i] for i in ids if i in encoder.tokens)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


