"""Byte-level BPE against another implementation of the same vocabulary, and round trips."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from conftest import rows
from spoorlens.llm import byte_bpe
from spoorlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  ", "a", "\n\n \n", "it's we'll 'Twas I'd", "naïve café  über straße", "日本語のテキスト。", "🙂🙃👩‍👩‍👧",
    "<|endoftext|> text", "\x00\x01\x7f", "=" * 700, " " * 700 + "x", "a" * 3000, "1234567890 12 3", "tab\tand\r\nline",
    "éé", "  　x", "'s's 's", "ÿþ½¼", "͸՘\U0003fc2c!",
]


@pytest.fixture(scope="module")
def other():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def checked(tool, other, text):
    (ids,) = tool.encode([text])
    assert ids.tolist() == other.encode_ordinary(text)
    assert tool.decode(ids, np.array([0, len(ids)])) == [text.encode()]
    assert "".join(tool.pieces(ids.tolist())) == text


def test_ids_equal_the_other_library(other):
    tool = byte_bpe.codec(*byte_bpe.public_vocabulary())
    for text in ODD:
        checked(tool, other, text)
    rng = np.random.default_rng(3)
    letters = list("aabcdeest  \n'.=-1") + ["é", "日", "🙂", " ", "՘"]
    for _ in range(400):
        checked(tool, other, "".join(rng.choice(letters, rng.integers(1, 60))))
    # New code points stand in classes that the two libraries may see differently.
    for lo in range(0x20, 0x30000, 97):
        if not 0xD800 <= lo < 0xE000:
            checked(tool, other, "a{0}a1{0}!{0} {0}{0}  {0}".format(chr(lo)))


def test_long_texts_are_cut_where_matches_end(other, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", 40)
    tool = byte_bpe.codec(*byte_bpe.public_vocabulary())
    for text in ["word  two \n three's " * 30, "x" * 300, "a b" * 99 + " " * 90 + "y " * 50, " \n " * 100]:
        checked(tool, other, text)
    texts = ["long text of words " * 20, "", "short", "another one " * 9, ""]
    assert [i.tolist() for i in tool.encode(texts)] == [other.encode_ordinary(t) for t in texts]


def test_query_on_whole_table(spark, other):
    want = []
    for key, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        ids = other.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((key, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    df = QUERIES["op13_byte_level_bpe"](spark, FOLDER)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows(df) == sorted(want)


def tool_bytes(ids):
    tool = byte_bpe.codec(*byte_bpe.public_vocabulary())
    return b"".join(tool.tokens[i] for i in ids)


def test_offsets_pieces_and_odd_rows(spark, other):
    given = [(i, t, [1]) for i, t in enumerate(ODD)] + [(None, None, None), (1, " ", None), (1, " ", None)]
    docs = spark.createDataFrame(given, "doc_id long, text string, ids array<int>")
    got = byte_bpe.decode(byte_bpe.encode(docs), pieces=True).collect()
    assert len(got) == len(given)
    texts = dict((k, t or "") for k, t, _ in given)
    for r in got:
        text = texts[r["doc_id"]]
        assert r["ids"] == other.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
        assert "".join(r["pieces"]) == text and len(r["pieces"]) == len(r["ids"])
        data = text.encode()
        for i, start, char in zip(r["ids"], r["byte_start"], r["char_start"]):
            token = other.decode_single_token_bytes(i)
            assert data[start:start + len(token)] == token
            assert char == sum((b & 0xC0) != 0x80 for b in data[:start + 1]) - 1
    assert byte_bpe.encode(docs.limit(0)).collect() == []
    unknown = spark.createDataFrame([(1, [10 ** 6]), (2, None), (3, []), (4, [101, 0]), (5, [0, -1]), (6, [5, None])], "k int, ids array<int>")
    parts = [r["decoded"] for r in byte_bpe.decode(unknown.coalesce(1), pieces=True).orderBy("k").collect()]
    assert parts == [None, b"", b"", tool_bytes([101, 0]), None, None]


def test_split_characters_come_with_the_last_token():
    tool = byte_bpe.codec(*byte_bpe.public_vocabulary())
    single = {token: i for i, token in tool.tokens.items()}
    ids = [single[bytes([b])] for b in "é🙂".encode()]
    assert tool.pieces(ids) == ["", "é", "", "", "", "🙂"]
    assert tool.pieces(ids[:3]) == ["", "é", "�"]


class Counting:
    """A tokenizer that counts the characters given to it."""

    def __init__(self, tool):
        self.tool, self.chars = tool, 0

    def encode_batch_fast(self, texts, **how):
        self.chars += sum(map(len, texts))
        return self.tool.encode_batch_fast(texts, **how)


def test_a_match_is_encoded_once(other, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 20)
    tool = byte_bpe.Codec(*byte_bpe.public_vocabulary())
    tool.tokenizer = Counting(tool.tokenizer)
    text = "the same words again, it's 12 times  over\n" * 500
    (ids,) = tool.encode([text])
    assert ids.tolist() == other.encode_ordinary(text)
    assert tool.tokenizer.chars < 100
    many = " ".join(f"word{i}x" for i in range(300)) + " " + "y" * 500
    assert [i.tolist() for i in tool.encode([many, many])] == [other.encode_ordinary(many)] * 2
    assert len(tool.known) <= 20 and max(map(len, tool.known)) <= byte_bpe.KNOWN_CHARS


def test_sure_characters_split_the_same():
    from tokenizers import Regex, pre_tokenizers

    tool = byte_bpe.codec(*byte_bpe.public_vocabulary())
    split = pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")
    sure = [c for c in map(chr, range(0xD800)) if not byte_bpe._UNSURE.search(c)]
    assert len(sure) > 30_000
    for k in range(0, len(sure), 512):
        text = "".join("a{0}a1{0}!{0} {0}{0}  {0}\n".format(c) for c in sure[k:k + 512])
        assert [x for x, _ in split.pre_tokenize_str(text)] == tool.matches.findall(text)
