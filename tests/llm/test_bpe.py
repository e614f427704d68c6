import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from custval.llm.bpe import LETTER, NUMBER, OTHER, WHITE, Merger, Vocabulary, classes, decode, encode, round_trip
from tests.llm.conftest import EDGE_DOCS

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return Vocabulary.of(f.read())


def own(vocabulary, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    return [np.frombuffer(x, "<u4").tolist() for x in vocabulary.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)]


def test_random_texts_against_the_library(vocabulary, reference):
    random.seed(11)
    signs = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "٣", ".", "!", "'S", " ", "　", "\r\n", "日本", "🙂",
             "_", "\x1c", "\x85", "​", "r", "v", "l", "\U00011bc1", "\U00010d41", "\x00"]
    texts = ["".join(random.choice(signs) for _ in range(random.randrange(30))) for _ in range(8000)]
    texts += ["", "", "a" * 20000, " " * 5000, "'" * 300, "ab" * 4000, "'s" * 200, " \n" * 200]
    assert own(vocabulary, texts) == [reference.encode_ordinary(t) for t in texts]


def test_classes_against_the_library():
    ranks = {bytes([i]): i for i in range(256)}
    table = classes()
    codes = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for pattern, kinds in ((r"\p{L}", [LETTER]), (r"\p{N}", [NUMBER]), (r"\s", [WHITE]), (r"[^\s\p{L}\p{N}]", [OTHER])):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found = set()
        for i in range(0, len(codes), 50_000):
            found |= set(bytes(probe.encode_ordinary("".join(map(chr, codes[i:i + 50_000])))).decode())
        assert found == {chr(c) for c in codes if table[c] in kinds}


def test_cache_is_bounded_and_does_not_change_results(vocabulary):
    small = Merger(vocabulary.merger.ranks, limit=3, longest=4)
    for piece in (b"hello", b" the", b"xq", b"zz9", b"hell", b"xq", b" the"):
        assert small[piece] == vocabulary.merger[piece] and len(small) <= 3


def test_frame_round_trip(edge_docs, reference):
    out = round_trip(edge_docs, PATH).collect()
    expected = []
    for i, text, _ in EDGE_DOCS:
        ids = reference.encode_ordinary(text or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)


def test_bytes_that_are_not_utf8_survive(spark):
    raw = bytes(range(256)) + b"\xff\xfe ok \xe2\x82"
    df = spark.createDataFrame([(1, bytearray(raw))], "doc_id long, text binary")
    row = decode(encode(df, PATH), PATH).head()
    assert bytes(row.decoded) == raw and len(row.offsets) == len(row.ids) == 4 * row.n_tokens


def test_empty_table_and_unknown_ids(spark, no_docs):
    assert round_trip(no_docs, PATH).collect() == []
    bad = spark.createDataFrame([(1, 1, bytearray(b"\xff\xff\xff\x7f"), None)], "doc_id long, n_tokens long, ids binary, offsets binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode(bad, PATH).collect()
    none = spark.createDataFrame([(1, None, None, None)], "doc_id long, n_tokens long, ids binary, offsets binary")
    assert decode(none, PATH).head().decoded is None


def test_bytes_that_join_across_texts(spark, vocabulary):
    """What is not UTF-8 in one text never joins the next one's bytes."""
    raw = [b"\xc3", b"\xa9", b"\xc3", b"\xa9ab", b"", b"\xe6\x97", b"\xa5 x", "\u65e5".encode(), b"\xf0\x9f", b"\x99\x82"]
    df = spark.createDataFrame(list(enumerate(raw)), "doc_id long, text binary").coalesce(1)
    out = {r.doc_id: bytes(r.decoded) for r in decode(encode(df, PATH), PATH).collect()}
    assert out == dict(enumerate(raw))
    ids = [vocabulary.encode(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in raw]
    whole = {r.doc_id: bytes(r.ids) for r in encode(df, PATH).collect()}
    assert [whole[k] for k in range(len(raw))] == [x[0] for x in ids]
