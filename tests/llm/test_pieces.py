import random
import re

import pytest
from frames import TEXTS, documents, empty

from tidemark.llm import pieces
from tidemark.llm.queries import BYTE_TOKENIZER, op5_piece_counts
from tidemark.llm.shared import read_table


def greedy(word, vocabulary):
    count = 0
    while word:
        size = next((n for n in range(min(len(word), 130), 0, -1) if word[:n] in vocabulary), 0)
        if not size:
            return 1
        word, count = word[size:], count + 1
    return count


@pytest.fixture(scope="module")
def vocabulary():
    back = {letter: byte for byte, letter in pieces.ALPHABET.items()}
    tokens = pieces.Tokenizer.from_file(BYTE_TOKENIZER).get_vocab(with_added_tokens=False)
    return {bytes(back[c] for c in t) for t in tokens}


def slow(text, vocabulary):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return len(words), sum(greedy(b" " + w, vocabulary) for w in words)


def test_automaton_on_random_vocabularies():
    rng = random.Random(3)
    for _ in range(300):
        letters = b"abc"[: rng.randint(1, 3)]
        some = {bytes(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 12))}
        automaton = pieces.Automaton(sorted(some))
        for _ in range(40):
            word = bytes(rng.choices(b"abc", k=rng.randint(1, 15)))
            assert automaton.count(word) == greedy(word, some), (some, word)


def test_query_equals_greedy_matching(spark, sf_dir, vocabulary):
    rows = read_table(spark, sf_dir, "documents").where("length(text) < 3000").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in op5_piece_counts(spark, sf_dir).collect()}
    for r in rows:
        assert tuple(found[r.doc_id][1:]) == slow(r.text, vocabulary)


def test_awkward_rows(spark, vocabulary):
    found = pieces.piece_counts(documents(spark), BYTE_TOKENIZER).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=key) == sorted(((i, *slow(t, vocabulary)) for i, t in TEXTS), key=key)
    assert pieces.piece_counts(empty(spark), BYTE_TOKENIZER).count() == 0


def test_query_equals_greedy_matching_on_long_texts(spark, sf_dir, vocabulary):
    rows = read_table(spark, sf_dir, "documents").where("length(text) >= 3000").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in op5_piece_counts(spark, sf_dir).collect()}
    known = {}
    for r in rows:
        words = [b" " + w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", r.text)]
        known |= {w: greedy(w, vocabulary) for w in set(words) - known.keys()}
        assert tuple(found[r.doc_id][1:]) == (len(words), sum(map(known.__getitem__, words)))
    assert rows
