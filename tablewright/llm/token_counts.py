"""Token counts that follow edits: a segment tree of pre-tokens per document.

A document is a row of leaves of about ``LEAF`` pre-tokens each. Over the leaves stand the sums of
their characters and tokens, as a binary tree: the leaf at a position is found, and a changed leaf's
sums are updated, along one path. An edit (position, characters removed, text put in)
re-encodes only the leaves that it touches, with boundary context:

* to the left, from the start of the last leaf that starts three characters or more before the edit.
  A pre-token depends on at most two characters after its end (a contraction, or white space
  before a word), so nothing earlier can change;
* to the right, up to the first old leaf border that is a border again. The pattern never looks back, so
  all that follows is cut as before.

Edits of a document are applied in order, each to the text the one before left; positions count
characters and are held within the text. The tokenizer file (ranks of a byte-level BPE) is a
parameter; tokens of a pre-token are counted once and remembered.

Defined results: null or empty text has no tokens and can be edited; an edit with a null position
appends, null removes nothing, null puts nothing in; a document without edits keeps its count; an
empty table gives an empty result; other columns are not read. ``apply_edits`` streams the edits of
a document, so only one document and its tree are held, however many edits it has; rows that share an
id each get all of its edits; edits without a document, or with a null id, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, table

LEAF = 32
CONTEXT = 3
MEMO = 300_000


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class Counter(dict):
    """pre-token -> number of tokens, remembered."""

    def __init__(self, path: str, pattern: str):
        import base64

        import regex
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.cut = regex.compile(pattern).findall

    def __missing__(self, piece):
        if len(self) > MEMO:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n


class Tree:
    """The leaves of one document with their sums."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.encoded = counter, 0
        self.leaves, chars, tokens = self._leaves(counter.cut(text))
        self._sums(chars, tokens)

    def _leaves(self, pieces: list[str]):
        """(texts, characters, tokens) of leaves for these pre-tokens."""
        leaves, tokens = [], []
        for k in range(0, len(pieces), LEAF):
            part = pieces[k:k + LEAF]
            leaves.append("".join(part))
            tokens.append(sum([self.counter[p] for p in part]))
        return leaves, list(map(len, leaves)), tokens

    def _sums(self, chars: list[int], tokens: list[int]):
        self.size = 1
        while self.size < max(1, len(chars)):
            self.size *= 2
        room = self.size - len(chars)
        self.chars = [0] * self.size + chars + [0] * room
        self.tokens = [0] * self.size + tokens + [0] * room
        for k in range(self.size - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def _set(self, leaf: int, text: str, tokens: int):
        """Replace one leaf and update the sums on its path."""
        more, gain = len(text) - self.chars[self.size + leaf], tokens - self.tokens[self.size + leaf]
        self.leaves[leaf] = text
        k = self.size + leaf
        while k:
            self.chars[k] += more
            self.tokens[k] += gain
            k //= 2

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """(leaf, its start) of the character at ``position`` (which exists)."""
        k, start = 1, 0
        while k < self.size:
            k *= 2
            if position - start >= self.chars[k]:
                start += self.chars[k]
                k += 1
        return k - self.size, start

    def edit(self, position: int, remove: int, put: str):
        total = self.chars[1]
        position = max(0, min(position, total))
        end = min(total, position + max(0, remove))
        first, start = self._leaf_at(position - CONTEXT) if position >= CONTEXT else (0, 0)
        if not self.leaves:
            self.encoded += len(put)
            self.leaves, chars, tokens = self._leaves(self.counter.cut(put))
            self._sums(chars, tokens)
            return
        # Old text from the first leaf on, as far as needed; ``last`` is the first leaf kept.
        last, old = first, []
        held = 0
        while last < len(self.leaves) and start + held < end:
            old.append(self.leaves[last])
            held += len(old[-1])
            last += 1
        while True:
            ahead, beyond = [], last
            while beyond < len(self.leaves) and sum(map(len, ahead)) < CONTEXT:
                ahead.append(self.leaves[beyond])
                beyond += 1
            text = "".join(old)
            new = text[:position - start] + put + text[end - start:]
            pieces = self.counter.cut(new + "".join(ahead))
            at, border = 0, None
            for k, piece in enumerate(pieces):
                if at == len(new):
                    border = k
                    break
                at += len(piece)
            if border is None and at == len(new):
                border = len(pieces)
            if border is not None or last >= len(self.leaves):
                break
            old.append(self.leaves[last])
            last += 1
        self.encoded += len(new)
        pieces = pieces[:border]
        slots = last - first
        per = max(LEAF, -(-len(pieces) // max(1, slots)))
        if not slots or per > 2 * LEAF:
            # Too much for these leaves: new ones, and the sums anew. No text is encoded again.
            leaves, chars, tokens = self._leaves(pieces)
            kept_chars = self.chars[self.size:self.size + len(self.leaves)]
            kept_tokens = self.tokens[self.size:self.size + len(self.leaves)]
            self.leaves[first:last], kept_chars[first:last], kept_tokens[first:last] = leaves, chars, tokens
            self._sums(kept_chars, kept_tokens)
            return
        for k in range(slots):
            part = pieces[k * per:(k + 1) * per]
            self._set(first + k, "".join(part), sum([self.counter[p] for p in part]))

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)


def _apply(tree: Tree, edits) -> int:
    n = 0
    for e in edits or []:
        position = e["position"]
        tree.edit(tree.chars[1] if position is None else position, e["remove"] or 0, e["put"] or "")
        n += 1
    return n


FIELDS = "n_tokens_before long, n_tokens long, n_chars long, n_edits long, n_encoded_chars long, text_sha256 string"


def _row(before: int, tree: Tree, edits: int) -> tuple:
    import hashlib
    text = tree.text
    return (before, tree.n_tokens, len(text), edits, tree.encoded, hashlib.sha256(text.encode("utf-8")).hexdigest(),
            text, [len(x) for x in tree.leaves], tree.tokens[tree.size:tree.size + len(tree.leaves)])


def _batch(pa, names, arrays, rows, full):
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    fields = ["n_tokens_before", "n_tokens", "n_chars", "n_edits", "n_encoded_chars", "text_sha256",
              "text", "leaf_chars", "leaf_tokens"]
    take = 9 if full else 6
    columns = list(zip(*rows)) or [()] * 9
    return pa.RecordBatch.from_arrays(
        arrays + [pa.array(c, k) for c, k in zip(columns[:take], kinds)], names + fields[:take])


def _within(path: str, pattern: str, full: bool):
    def run(batches):
        import pyarrow as pa
        counter = Counter(path, pattern)
        for whole in batches:
            for piece in slices(whole):
                rows = []
                for text, edits in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                    tree = Tree(counter, text or "")
                    before = tree.n_tokens
                    rows.append(_row(before, tree, _apply(tree, edits)))
                yield _batch(pa, [piece.schema.names[0]], [piece.column(0)], rows, full)
    return run


EDITS = "array<struct<position:int,remove:int,put:string>>"


def edit_rows(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text",
              path: str | None = None, pattern: str | None = None, full: bool = False) -> DataFrame:
    """Counts before and after the edits that a row carries (an array of (position, remove, put));
    with ``full`` also the edited text and the tree's leaves. Nothing is shuffled."""
    df = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"),
                     edits.cast(EDITS).alias("edits"))
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {FIELDS}" + (
        ", text string, leaf_chars array<int>, leaf_tokens array<int>" if full else "")
    return df.mapInArrow(_within(path or tokenizer_path(), pattern or token_pattern(), full), schema)


def _streamed(path: str, pattern: str, full: bool):
    """Rows (id, kind, seq, text, position, remove, put), sorted: documents of an id, then its edits."""
    def run(batches):
        import pyarrow as pa
        counter = Counter(path, pattern)
        current, trees = None, []

        def finished():
            rows = [_row(before, tree, n) for before, tree, n in trees]
            return _batch(pa, ["id"], [pa.array([current] * len(rows), pa.int64())], rows, full)

        for whole in batches:
            for piece in slices(whole):
                for r in piece.to_pylist():
                    if r["kind"] == 0:
                        if trees and r["id"] != current:
                            yield finished()
                            trees = []
                        current = r["id"]
                        tree = Tree(counter, r["text"] or "")
                        trees.append([tree.n_tokens, tree, 0])
                    elif trees and r["id"] == current and current is not None:
                        for t in trees:
                            t[2] += _apply(t[1], [r])
        if trees:
            yield finished()
    return run


def apply_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                path: str | None = None, pattern: str | None = None, full: bool = False) -> DataFrame:
    """The same for edits of a table of its own: (id, seq, position, remove, put)."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"),
                    F.col(text_col).cast("string").alias("text"), F.lit(None).cast("int").alias("position"),
                    F.lit(None).cast("int").alias("remove"), F.lit(None).cast("string").alias("put"))
    e = edits.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.lit(1).alias("kind"), F.col("seq").cast("long").alias("seq"),
        F.lit(None).cast("string").alias("text"), F.col("position").cast("int"), F.col("remove").cast("int"),
        F.col("put").cast("string"))
    rows = d.unionByName(e).repartition("id").sortWithinPartitions("id", "kind", "seq", "position", "remove", "put")
    schema = f"id long, {FIELDS}" + (", text string, leaf_chars array<int>, leaf_tokens array<int>" if full else "")
    out = rows.mapInArrow(_streamed(path or tokenizer_path(), pattern or token_pattern(), full), schema)
    return out.withColumnRenamed("id", id_col)


def sample_edits(doc_id: Column, text: Column) -> Column:
    """The registered query's edits of a document: a piece of it repeated, one removed, one replaced;
    where is a matter of the id and the length."""
    n = F.length(text)
    code = F.crc32(doc_id.cast("string").cast("binary"))

    def spot(shift: int) -> Column:
        return F.pmod(F.shiftright(code, shift), n + 1).cast("int")

    def edit(position: Column, remove: int, put: Column) -> Column:
        return F.struct(position.alias("position"), F.lit(remove).alias("remove"), put.alias("put"))

    return F.array(edit(spot(0), 0, F.substring(text, 1, 40)), edit(spot(7), 25, F.lit("")),
                   edit(spot(13), 10, F.concat(F.lit(" edited "), doc_id.cast("string"))))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    return edit_rows(docs, sample_edits(F.col("doc_id"), text))
