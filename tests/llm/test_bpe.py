"""BPE by prefixes against the public library, at its default settings."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loanpanel.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, "a <|endoftext|> b<|endoftext|><|endoftext|>c <|endof"), (1, "a <|endoftext|> b"), (2, None), (3, ""), (None, "no id"),
       (4, " \t\n\x0b\x0c\r\x85\xa0  　x"), (5, "it's we'll I'VE 's'S 123abc½²Ⅷ"), (6, "\U0001f600é́ 日本語 \x00\x1c�"),
       (7, "a" * 100_001), (8, " " * 100_000 + "end"), (9, "=" * 5_000 + "\n" * 5_001), (10, "͸\U0003ffff x"),
       (11, "word" * 20_000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), bpe.ID_TYPE).tolist()


def merged(words, single, made, piece):
    """Ids by merging the leftmost pair of lowest rank, over and over."""
    out = [single[bytes([b])] for b in piece]
    while True:
        known = [(words.rank[made[p]], at) for at, p in enumerate(zip(out, out[1:])) if p in made]
        if not known:
            return out
        at = min(known)[1]
        out[at:at + 2] = [made[out[at], out[at + 1]]]


def test_every_prefix_ends_with_the_token_that_merging_gives(encoder):
    rng, words = random.Random(5), encoder.words
    single = {words.bytes[k]: k for k in words.words if len(words.bytes[k]) == 1}
    made = {(words.left[k], words.right[k]): k for k in words.words if words.rank[k] >= 0}
    for alphabet in ("ab", "a", " e", "theinrsao", "=-", "é日a"):
        for _ in range(60):
            piece = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))).encode()
            last = encoder.last_tokens(piece)
            assert list(last[1:]) == [merged(words, single, made, piece[:n])[-1] for n in range(1, len(piece) + 1)]


def test_every_code_point(encoder, library):
    """Splits are equal for all that this Python's Unicode version knows, and ids for what a newer version may have added."""
    for c in (chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000):
        text = f"a{c}1{c}!{c} {c}{c}é{c}x"
        if unicodedata.category(c) == "Cn":
            assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids
        else:
            want = [text[start:end] for _, (start, end) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert encoder.pieces.findall(text) == want


def test_every_token_and_random_texts(encoder, library):
    rng = random.Random(3)
    texts = [library.decode([k], skip_special_tokens=False) for k in range(50_257)]
    texts += ["".join(rng.choice(["a", "aa", " ", "  ", "\n", "'s", "<|endoftext|>", "<|", "=", "é", "9", "the"])
                      for _ in range(rng.randint(0, 40))) for _ in range(3_000)]
    assert all(ids(encoder, text) == got.ids for text, got in zip(texts, library.encode_batch(texts, add_special_tokens=False)))


def test_bounds_of_what_is_remembered(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 2)
    encoder = bpe.Encoder(PATH)
    text = "one two three four five six one two three four, unbelievably internationalization"
    assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 3 and len(encoder.fit) <= 2


def test_query(spark, sf, library, tmp_path):
    odd = str(tmp_path / "odd")
    docs = spark.createDataFrame([(*r, b"x", "y", 1) for r in ODD], "doc_id long, text string, ids binary, lang string, n_tokens int")
    docs.repartition(3).write.parquet(f"{odd}/documents.parquet")
    none = str(tmp_path / "none")
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    for folder in (sf, odd, none):
        want = []
        for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
            found = library.encode(row.text or "", add_special_tokens=False).ids
            text = library.decode(found, skip_special_tokens=False)
            assert text == (row.text or "")
            want.append((row.doc_id, len(found), hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
        got = queries.corpus_queries()["op13_bpe"](spark, folder)
        assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_bytes_that_are_no_text(spark):
    encoded = spark.createDataFrame([(1, np.array([bpe.Vocabulary(PATH).bytes.index(b"\xe2")], "<u4").tobytes()), (2, b""), (3, None)],
                                    "doc_id long, ids binary")
    assert [r.text for r in bpe.decode(encoded, PATH).orderBy("doc_id").collect()] == ["�", "", ""]
