"""BPE against the tokenizers library itself, and the transducer against a dictionary."""

import hashlib
import random

import pytest

from tablewright.llm import bpe
from tablewright.llm.lexicon import Lexicon, compile_lexicon

PATH = bpe.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def odd_texts(n=400):
    rng = random.Random(5)
    kinds = [lambda: rng.randrange(1, 128), lambda: rng.randrange(1, 0x3000), lambda: rng.randrange(0xA0, 0x250),
             lambda: rng.randrange(0x370, 0x3D0), lambda: rng.randrange(0x10000, 0x1F000),
             lambda: rng.choice([0x3A3, 0x130, 0x1C, 0x85, 0xA0, 0x2028, 0x301, 0x1C89])]
    texts = ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    return texts + ["", "   ", "<|startoftext|>Hello <|endoftext|>x<|ENDOFTEXT|>", "don't I'LL we've 123 a1b2",
                    "a" * 5000, "%%%***" * 300, "ab " * 3000, "ΑΣ ΣΑΣ", "É é İ"]


def test_encoder_equals_library(library):
    encoder = bpe.Encoder(PATH)
    for text in odd_texts():
        want = library.encode(text, add_special_tokens=False).ids
        got = [i for w in encoder.words(text) for i in encoder.merge(w)]
        assert got == want, text
        assert bpe.decode(got, encoder) == library.decode(want, skip_special_tokens=False)


def test_long_and_short_merges_agree():
    encoder = bpe.Encoder(PATH)
    rng = random.Random(2)
    for _ in range(300):
        ids = [encoder.inner[rng.choice(b"aabeinorst")] for _ in range(rng.randrange(1, 40))]
        assert bpe.merge_long(ids, encoder.merges) == bpe.merge_short(list(ids), encoder.merges)


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_lexicon_is_exact_and_minimal(tmp_path, n):
    rng = random.Random(n)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 9))) for _ in range(n)}
    entries = [(w, [len(w), sum(w)][: rng.randrange(1, 3)]) for w in words]
    path = tmp_path / "lex"
    path.write_bytes(compile_lexicon(entries))
    lex = Lexicon(str(path))
    assert lex.lookup([w for w, _ in entries]) == [ids for _, ids in entries]
    other = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(0, 10))) for _ in range(500)]
    assert all((got is None) == (w not in words) for w, got in zip(other, lex.lookup(other)))
    # minimal: as many states as there are different sets of endings
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p))
               for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(lex.final) == max(1, len(endings))


def test_encode_matches_library_and_edge_rows(spark, library):
    texts = [*odd_texts(60), None, "same text twice", "same text twice"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    for words in (1, 50, 10_000):
        got = {r["doc_id"]: r for r in bpe.encode(df, lexicon_words=words, full=True).collect()}
        assert len(got) == len(rows)
        for i, t, _ in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids) and got[i]["decoded"] == text
            assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(df).collect() == []


def test_a_shared_file_is_no_scratch(spark):
    import os
    from tablewright import session
    from tablewright.llm import bpe
    before = list(session._SCRATCH.get(session.session_id(spark), []))
    name = bpe.share_file(spark, "lexicon", b"x")
    assert session._SCRATCH.get(session.session_id(spark), []) == before
    session.release_scratch(spark)
    assert os.path.exists(os.path.join(session.shared_dir(spark), name))


def test_words_merged_together_and_alone_agree():
    encoder = bpe.Encoder(PATH)
    rng = random.Random(3)
    words = sorted({w for t in odd_texts(200) for w in encoder.words(t)} | {
        "".join(rng.choice("abeinorst\u00e9\u4e2d") for _ in range(rng.randrange(1, 60))) for _ in range(500)})
    assert [encoder.merge(w) for w in words] == [memoryview(x).cast("i").tolist() for x in encoder.merge_all(words)]
    chunks = [c for t in odd_texts(200) for c in encoder.chunks(t) if isinstance(c, str)]
    assert encoder.split_all(chunks) == [list(encoder.split(c)) for c in chunks]
    assert encoder.merge_all([]) == [] and encoder.split_all([]) == []


def run_task(tmp_path, monkeypatch, lexicon, texts, rows=256):
    """What one task makes of ``texts``, and the words it asked the lexicon for."""
    import pyarrow as pa
    from pyspark import SparkFiles
    encoder, asked = bpe.Encoder(PATH), []
    (tmp_path / "lex").write_bytes(compile_lexicon([(w.encode(), encoder.merge(w)) for w in set(lexicon)]))
    monkeypatch.setattr(SparkFiles, "get", lambda name: str(tmp_path / name))
    for name in ("packed", "lookup"):
        if hasattr(Lexicon, name):
            real = getattr(Lexicon, name)
            monkeypatch.setattr(Lexicon, name, lambda self, words, real=real: asked.extend(words) or real(self, words))
    batches = [pa.RecordBatch.from_arrays([pa.array(range(k, k + len(part))), pa.array(part, pa.binary())], ["id", "t"])
               for k in range(0, len(texts), rows) if (part := [t.encode() for t in texts[k:k + rows]])]
    return [r for b in bpe._encode(PATH, "lex", True)(iter(batches)) for r in b.to_pylist()], asked


@pytest.mark.parametrize("rare", [False, True])
def test_frequent_words_outlast_a_full_memo(tmp_path, monkeypatch, library, rare):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 400_000)
    rng = random.Random(4)
    others = ["".join(rng.choice("abeinorst") for _ in range(9)) for _ in range(10_000)]
    texts = [f"the {' '.join(others[k:k + 4])}." for k in range(0, len(others), 4)]
    got, asked = run_task(tmp_path, monkeypatch, ["the", "."] + ([] if rare else others), texts)
    assert asked.count(b"the") == 1
    for r, t in zip(got, texts):
        assert r["ids"] == library.encode(t, add_special_tokens=False).ids


def test_special_tokens_and_their_look_alikes(tmp_path, monkeypatch, library):
    texts = ["<|ENDOFTEXT|>", "<|endoftext|>", "<|endoftext|>x <|ENDOFTEXT|> \u0939\u093f it's", "it's <|"] * 3
    for lexicon in ([], ["<|endoftext|>", "<|", "endoftext", "|>", "x", "it", "'s"]):
        with monkeypatch.context() as m:
            for rows in (1, 2, 12):
                got, _ = run_task(tmp_path, m, lexicon, texts, rows)
                assert [r["ids"] for r in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_cut_together_and_alone_agree():
    import sys
    spaces = {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c > "\x7f"}
    assert bpe.SPACES == spaces
    encoder = bpe.Encoder(PATH)
    texts = ["", " x ", *odd_texts(200), *(f"a{c}\u00e9 b{c}" for c in sorted(spaces)), "", "a\x1cb", "\n", "\u00e9\x85\x1d"]
    for some in (texts, texts[::-1], ["", ""], ["a\x1cb"], ["a b"], []):
        chunks, starts, stops = encoder.cut_texts(some)
        of = chunks.to_pylist()
        want = [[c if isinstance(c, str) else "\n" + c[0] for c in encoder.chunks(t)] for t in some]
        assert [[c for c in of[a:b] if c] for a, b in zip(starts, stops)] == want
        words, order, sizes = encoder.words_of(chunks)
        words, at, got = words.to_pylist(), 0, {}
        for k, n in zip(order.tolist(), sizes.tolist()):
            got[k], at = words[at:at + n], at + n
        assert [[w for k in range(a, b) for w in got[k]] for a, b in zip(starts, stops)] == [encoder.words(t) for t in some]


def test_a_word_is_looked_up_once_whatever_stands_beside_it(tmp_path, monkeypatch, library):
    texts = ["abc, x", "abc. x", "(abc) x", "abc", "x-abc"]
    got, asked = run_task(tmp_path, monkeypatch, ["abc", "x", ",", ".", "(", ")", "-"], texts, rows=1)
    assert [r["ids"] for r in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked.count(b"abc") == asked.count(b"x") == 1


def test_a_task_counts_a_word_once_over_many_others():
    import pyarrow as pa
    texts = [" ".join(["the", *(f"w{i}" for i in range(k, k + 1000)), "The."]) for k in range(100_000, 400_000, 1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts[k:k + 100]], pa.binary())], ["text"])
               for k in range(0, len(texts), 100)]
    rows = [(r["word"], r["n"]) for b in bpe._count_words(PATH)(iter(batches)) for r in b.to_pylist()]
    assert sorted(rows) == sorted([("the", 600), (".", 300), ("w", 300_000), *((str(d), n) for d, n in _digits().items())])


def _digits():
    from collections import Counter
    return Counter(d for i in range(100_000, 400_000) for d in str(i))


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_slices_by_bytes(tmp_path, monkeypatch, library, size):
    monkeypatch.setattr(bpe, "SLICE_BYTES", size)
    texts = ["", "one two", "", "three " * 30, "", "<|endoftext|> four", " ", "five\u00a0six"]
    got, _ = run_task(tmp_path, monkeypatch, ["one", "three", "six"], texts, rows=3)
    for r, t in zip(got, texts, strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
