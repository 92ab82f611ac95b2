import random
import zlib
from collections import defaultdict

import numpy as np
from frames import TEXTS, documents, empty

from tidemark.llm import packing
from tidemark.llm.queries import WORD_TOKENIZER, op4_packing
from tidemark.llm.shared import read_table
from tidemark.llm.tokens import encoder


def test_pieces_cover_each_text_and_sequences_have_no_gaps(spark):
    texts = [(n, t) for n, (_, t) in enumerate(TEXTS)]
    found = packing.pack(documents(spark, texts), WORD_TOKENIZER, end=1, group_pieces=4).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for n, text in texts:
        ids = [*encoder(WORD_TOKENIZER).tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[n], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(r.length for r in rows[:k]) for k in range(len(rows))]
        assert sum(r.length for r in rows) <= packing.LENGTH


def test_repeated_and_null_identifiers_and_empty_table(spark):
    found = packing.pack(documents(spark), WORD_TOKENIZER, end=1).collect()
    assert {r.doc_id for r in found} == {i for i, _ in TEXTS}
    assert packing.pack(empty(spark), WORD_TOKENIZER, end=1).count() == 0


def test_full_pieces_of_long_documents_are_in_no_group(spark):
    texts = [(n, "a long text of many words " * (7000 + n)) for n in range(6)]
    found = packing.pack(documents(spark, texts), WORD_TOKENIZER, end=1, group_pieces=2).collect()
    total = sum({r.doc_id: r.doc_tokens for r in found}.values())
    assert sum(r.length for r in found) == total and len(found) > 60
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
    grouped = [r for r in found if r.sequence_id < 3 * packing.GROUP_SPAN]
    # One rest per document, which is not cut again.
    assert {r.doc_id for r in grouped} == set(range(6)) and len(grouped) == 6
    assert all(r.start >= r.doc_tokens // packing.LENGTH * packing.LENGTH for r in grouped)
    full = [r for r in found if r.sequence_id >= 3 * packing.GROUP_SPAN]
    assert all(r.length == packing.LENGTH and len(sequences[r.sequence_id]) == 1 for r in full)
    assert len(full) == sum(n // packing.LENGTH for n in {r.doc_id: r.doc_tokens for r in found}.values())


def test_first_fit_decreasing():
    assert packing.first_fit_decreasing([3, 5, 2, 6, 4], 8) == [[3, 2], [1, 0], [4]]


def quadratic(sizes, capacity):
    """First-fit decreasing that looks at every bin."""
    bins, room = [], []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for bin, left in enumerate(room):
            if left >= sizes[item]:
                break
        else:
            bin = len(bins)
            bins.append([])
            room.append(capacity)
        bins[bin].append(item)
        room[bin] -= sizes[item]
    return bins


def test_tournament_finds_the_first_bin_that_fits():
    rng = random.Random(12)
    for n in [0, 1, 2, 3, 64, 65, 500]:
        sizes = [rng.choice([rng.randrange(1, 2048), rng.randrange(1, 100), 2047, 1024]) for _ in range(n)]
        assert packing.first_fit_decreasing(sizes, 2048) == quadratic(sizes, 2048)


def test_each_group_is_packed_by_first_fit_decreasing(spark):
    texts = [(n, "some words of a text " * (1 + n * 37 % 300)) for n in range(120)]
    found = packing.pack(documents(spark, texts), WORD_TOKENIZER, end=1, group_pieces=30).collect()
    groups = defaultdict(lambda: defaultdict(list))
    for r in found:
        if r.sequence_id < 4 * packing.GROUP_SPAN:
            groups[r.sequence_id // packing.GROUP_SPAN][r.sequence_id].append(r)
    assert len(groups) > 1 and sum(len(b) for g in groups.values() for b in g.values()) == 120
    for bins in groups.values():
        rests = sorted((r for b in bins.values() for r in b), key=lambda r: r.doc_id)
        expected = quadratic([r.length for r in rests], packing.LENGTH)
        packed = [[r.doc_id for r in sorted(bins[s], key=lambda r: r.offset)] for s in sorted(bins)]
        assert packed == [[rests[i].doc_id for i in b] for b in expected]


def test_query_covers_each_document(spark):
    sf_dir = "/root/testdata/sf0.001"
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in op4_packing(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert pieces.keys() == {r.doc_id for r in rows}
    for doc in rows:
        ids = [*encoder(WORD_TOKENIZER).tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(r.length for r in parts[:k]) for k in range(len(parts))]
        sizes.append(sum(r.length for r in parts))
    padding = packing.LENGTH * len(sizes) - sum(sizes)
    assert max(sizes) <= packing.LENGTH and padding < 0.02 * sum(sizes)
