from __future__ import annotations

import json
import random
from hashlib import sha256

import pytest
from tokenizers import Tokenizer

from crowdpulse.llm import byte_pairs
from crowdpulse.llm.byte_pairs import BytePairCodec, decode, digests, encode
from crowdpulse.llm.queries import table, tokenizer

PATH = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return BytePairCodec(PATH)


ODD = [
    "",
    " ",
    "  a",
    "\n\n\n a\n",
    "don't 'll 'S _x__ a_b",
    "<|endoftext|>a<|endoftext|> <|endoftext",
    "a" * 3_001,
    " " * 50 + "x",
    "\x1c a\x1d\x00",
    "a\x85b\xa0c \x85 d e　",
    "½²Ⅷ9٣ é́",
    "日本語 テスト 123\U0001f600\U0001f600 x‍",
    "ab" * 5_000 + "\n" + "x y " * 5_000,
]


def test_ids_are_the_librarys(codec, library):
    chance = random.Random(2)
    letters = [*" \n\t'sdABzé1٣　\xa0\x85\x1c<>|.,-日\U0001f600́", "<|endoftext|>"]
    made = ["".join(chance.choices(letters, k=chance.randint(0, 40))) for _ in range(3_000)]
    texts = ODD + made
    found = ["".join(row)[1:] for row in codec.as_text(texts)]
    for text, ids, want in zip(texts, found, library.encode_batch(texts, add_special_tokens=False)):
        assert ids == ",".join(map(str, want.ids)), text
    for text in ODD:
        ids = codec.encode(text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_any_ids_decode_as_in_the_library(codec, library):
    chance = random.Random(3)
    for _ in range(300):
        ids = [chance.randrange(50_257) for _ in range(chance.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_merged_together_are_words_merged_alone(codec):
    """Overlapping pairs, repeats and many words in one index."""
    words = [b"aaaa", b"aaa", b" the", b" the", b"lololol", b" " * 17, bytes(range(256)), b"the" * 99]
    together = codec.merge_all(words)
    for word, ids in zip(words, together):
        assert ids.tolist() == codec.merge_all([word])[0].tolist()
        assert b"".join(codec.bytes_of[i] for i in ids.tolist()) == word


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "KEPT_WORDS", 5)
    monkeypatch.setattr(byte_pairs, "INDEXED", 7)
    monkeypatch.setattr(byte_pairs, "_GROUP_CHARS", 9)
    codec = BytePairCodec(PATH)
    texts = [f"word{i % 7} and {i % 3}\nthen<|endoftext|>" for i in range(60)]
    for text, ids in zip(texts, codec.as_text(texts)):
        assert ids[1:] == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_other_vocabularies_are_refused(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError):
            BytePairCodec(str(path))


def test_digests_of_documents(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    want = {}
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digest = sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[row.doc_id] = (row.doc_id, len(ids), digest, sha256(text.encode()).hexdigest())
    found = digests(docs, PATH).collect()
    assert {r.doc_id: tuple(r) for r in found} == want and len(found) == len(want)


def test_odd_rows(spark, odd_documents, no_documents):
    found = digests(odd_documents, PATH)
    empty = sha256(b"").hexdigest()
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()}
    assert found.count() == odd_documents.count()
    assert (2, 0, empty, empty) in rows and (3, 0, empty, empty) in rows
    assert digests(no_documents, PATH).count() == 0
    back = decode(encode(odd_documents, PATH), PATH)
    want = sorted((r.doc_id or -1, r.text or "") for r in odd_documents.collect())
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == want
