import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm.backtracking_bpe import decode_documents, encode_documents, round_trip, text_encoder
from tallyhouse.llm.word_tokens import word_encoder
from tests.llm.brute import documents, prose

ODD = ["", " ", "\n\n x", "don't  'S <|endoftext|> a'llb ''s \x1f ΣΣ é \xa0x it's'd!!'ve 12a3", "a" * 4000, "the" * 900,
       "x<|endoftext|>y <|startoftext|>", "İ ǅ É̀ ŒDIPE ß", "日本語 テスト 🙂🙃", "3.14, 2,718;(x)..", prose(1, 30_000)]


def texts() -> list[str]:
    draw = random.Random(3)
    letters = "aetsh ion'sT\n  .,1é日 \xa0\x1f<|>"
    return ODD + ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(400)]


@pytest.mark.parametrize(("name", "make"), [("byte_bpe_50k.json", text_encoder), ("word_bpe_49k.json", word_encoder)])
def test_ids_equal_the_library(name, make):
    path = public_tokenizers.path(name)
    library, own = Tokenizer.from_file(path), make(path)
    for text in texts():
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_forgetting_changes_nothing(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr("tallyhouse.llm.backtracking_bpe.MEMORY", 3)
    monkeypatch.setattr("tallyhouse.llm.word_tokens.MEMORY", 3)
    own, library = text_encoder(path), Tokenizer.from_file(path)
    assert [own.encode(t).tolist() for t in ODD] == [library.encode(t, add_special_tokens=False).ids for t in ODD]
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = word_encoder(path), Tokenizer.from_file(path)
    assert [own.encode(t).tolist() for t in ODD] == [library.encode(t, add_special_tokens=False).ids for t in ODD]


def test_decoding_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), text_encoder(path)
    draw = np.random.default_rng(1)
    for ids in [[], [50256], *draw.integers(0, 50257, (200, 12)).tolist()]:
        assert own.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_query(spark):
    rows = [(k, t) for k, t in enumerate(texts()[:60])] + [(None, "a b"), (900, None), (3, "again"), (3, "again")]
    docs = documents(spark, rows).withColumnRenamed("lang", "ids_sha256")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def digests(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    assert sorted(map(tuple, round_trip(docs).collect()), key=repr) == sorted([digests(*r) for r in rows], key=repr)
    back = decode_documents(encode_documents(docs))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(i, t or "") for i, t in rows], key=repr)
    assert round_trip(documents(spark, [])).count() == 0
