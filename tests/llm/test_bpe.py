import hashlib

import numpy as np
import pyarrow as pa
import pytest
from frames import TEXTS, documents, empty

from tidemark.llm import bpe
from tidemark.llm.queries import WORD_TOKENIZER, op6_forced_bpe
from tidemark.llm.shared import read_table


@pytest.fixture(scope="module")
def encoder():
    return bpe.forced_encoder(WORD_TOKENIZER)


def library(encoder, text):
    ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, encoder.tokenizer.decode(ids, skip_special_tokens=False)


ODD = ["osóciónta elñgacoar", "日本語テキスト、漢字", "naïve café İstanbul", "a<|startoftext|>b <|endoftext|", "🎉🎉 it'll DON'T 1234 ###$$$ =>", " x\u0085y z", "zzqxj" * 300]


@pytest.mark.parametrize("text", [t for _, t in TEXTS] + ODD)
def test_ids_equal_the_library(encoder, text):
    found = encoder.encode(pa.array([text or ""]))[0].tolist()
    assert found == library(encoder, text)[0]


def test_words_are_cut_only_where_no_token_reaches(encoder):
    word = bpe.byte_letters("osóciónta".encode())
    parts = encoder.fragments(word)
    assert len(parts) > 1 and "".join(parts) == word
    tokens = [t.removesuffix("</w>") for t in encoder.tokenizer.get_vocab(with_added_tokens=False)]
    for left, right in zip(parts, parts[1:]):
        assert not any(left[-1] + right[0] in t for t in tokens)


def test_query_equals_the_library(spark, sf_dir, encoder):
    found = {r.doc_id: r for r in op6_forced_bpe(spark, sf_dir).collect()}
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        ids, text = library(encoder, r.text)
        hashes = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), text)]
        assert list(found[r.doc_id][1:]) == [len(ids), *hashes]


def test_awkward_rows(spark, encoder):
    found = bpe.encode(documents(spark), WORD_TOKENIZER).collect()
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]))
    expected = [(i, *library(encoder, t)) for i, t in TEXTS]
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert bpe.digests(empty(spark), WORD_TOKENIZER).count() == 0
    assert np.dtype(encoder.dtype).itemsize == 2
