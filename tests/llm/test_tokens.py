"""Byte BPE, packing: against the published tokenizers."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = " \n\t\x1c\x1f\x85\u00a0abcdeESTLR'''sSltvemd12٣²,.!?#漢字🎉\u0301ñÉßΣςİſ\x00\x0b\x7f\u212a<|>ŉǅȀə"


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(RANKS, public_tokenizers.PATTERN, remembered=300)


@pytest.fixture(scope="module")
def published(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


CONTROLS = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]


def strings(n, seed, more=()):
    rnd = random.Random(seed)
    return ["".join(rnd.choice([*ALPHABET, *more]) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


def test_queue_gives_lowest_rank_then_leftmost():
    rnd, queue, held = random.Random(3), bpe.RankQueue(), []
    for _ in range(3000):
        if held and rnd.random() < 0.45:
            held.sort()
            assert queue.pop() == held.pop(0)
        else:
            entry = rnd.choice([rnd.randrange(50_000), 5, 64, 63]), rnd.randrange(1000)
            held.append(entry)
            queue.push(*entry)
    assert bool(queue) == bool(held)


def test_bpe_equals_published(coder, published):
    for text in [*strings(1500, 1), "", "a", "ab" * 5000 + "the" * 2000, "x" * 9001, " " * 500 + "y"]:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == published.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_bpe_rows(spark, edge_docs, edge_rows, empty_docs, published):
    got = sorted((row.doc_id is not None, row.doc_id or 0, bytes(row.ids), bytes(row.decoded)) for row in bpe.encode_documents(edge_docs, RANKS, public_tokenizers.PATTERN).collect())
    want = sorted((d is not None, d or 0, np.array(published.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t, _ in edge_rows)
    assert got == want
    assert bpe.encode_documents(empty_docs, RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def test_word_tokenizer_equals_published(words):
    own = packing.WordTokenizer(WORDS, remembered=200)
    texts = [*strings(2500, 2), *strings(1500, 3, CONTROLS * 3), "a <|endoftext|>b", "IT'S we'Re O'NEIL", "z" * 3000]
    assert any(49407 in words.encode(text, add_special_tokens=False).ids for text in texts)
    for text in texts:
        assert own.encode(text).tolist() == words.encode(text, add_special_tokens=False).ids


def test_control_strings_as_text():
    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    own = packing.WordTokenizer(WORDS, controls_as_text=True)
    for text in [*strings(500, 4, CONTROLS * 3), "a <|endoftext|>b"]:
        ids = own.encode(text).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids
        assert not {49406, 49407} & set(ids)


def test_sequences_of_small_partitions(spark, words):
    """Tails are solved like the rest: a partition has one sequence below 512 tokens at most, cut where documents or sentences end."""
    from conftest_llm import make_docs, prose

    docs = make_docs(spark, [(k, ". ".join(prose(k + j, 12) for j in range(k % 40)), None) for k in range(400)]).repartition(32)
    lengths = {}
    for row in packing.pack_documents(docs, WORDS).collect():
        lengths[row.sequence_id] = max(lengths.get(row.sequence_id, 0), row.offset + row.length)
    short = [sequence >> 32 for sequence, n in lengths.items() if n < 512]
    assert len(short) == len(set(short)) and max(lengths.values()) <= 4096
    padded = sum(4096 - n for n in lengths.values() if n & (n - 1))
    assert padded < 32 * 4096 + 0.02 * sum(lengths.values())


def brute_cost(positions, penalties, window, exact):
    best = [0.0] + [float("inf")] * (len(positions) - 1)
    for j in range(1, len(positions)):
        for i in range(j):
            length = positions[j] - positions[i]
            if length <= window:
                padding = 0 if i in exact.get(j, []) else window - length
                best[j] = min(best[j], best[i] + padding + penalties[j])
    return best[-1]


def test_cuts_cost_least():
    rnd = random.Random(5)
    for _ in range(200):
        window = rnd.choice([8, 16, 33])
        positions = [0]
        while len(positions) < rnd.randint(2, 40):
            positions.append(positions[-1] + rnd.randint(1, window))
        penalties = [rnd.choice([0.0, 1.5, 4.0]) for _ in positions]
        exact = packing._without_padding(np.array(positions), window, 1)
        cuts = packing.cut(positions, penalties, window, exact)
        cost = sum((0 if a in exact.get(b, []) else window - positions[b] + positions[a]) + penalties[b] for a, b in zip(cuts, cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == len(positions) - 1
        assert cost == pytest.approx(brute_cost(positions, penalties, window, exact))


def check_packing(rows, texts, words, most_waste):
    """Each id in one piece; sequences gapless, at most 4096 long, little padding."""
    by_seq, by_doc = {}, {}
    for row in rows:
        by_seq.setdefault(row.sequence_id, []).append(row)
        by_doc.setdefault(row.doc_id, []).append(row)
    used = padded = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda row: row.offset)
        at = 0
        for piece in pieces:
            assert piece.offset == at
            at += piece.length
        assert 0 < at <= 4096
        used += at
        padded += at if at & (at - 1) == 0 else 4096
    assert padded - used <= most_waste * padded
    for doc_id, copies in texts.items():
        ids = [words.encode(t or "", add_special_tokens=False).ids + [2] for t in copies]
        assert sorted(set(row.doc_tokens for row in by_doc[doc_id])) == sorted({len(x) for x in ids})
        if len(ids) == 1:
            at = 0
            for row in sorted(by_doc[doc_id], key=lambda row: row.start):
                assert row.start == at
                assert row.ids_crc32 == zlib.crc32(np.array(ids[0][at : at + row.length], "<u4").tobytes())
                at += row.length
            assert at == len(ids[0])


def test_packing_rows(spark, edge_docs, edge_rows, empty_docs, words):
    texts = {}
    for d, t, _ in edge_rows:
        texts.setdefault(d, []).append(t)
    rows = packing.pack_documents(edge_docs.coalesce(1), WORDS).collect()
    check_packing(rows, texts, words, 0.02)
    assert all(zlib.crc32(bytes(row.ids)) == row.ids_crc32 and len(row.ids) == 4 * row.length for row in rows)
    assert packing.pack_documents(empty_docs, WORDS).collect() == []


def test_packing_query(spark, words):
    from tidemark.llm.common import table
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {row.doc_id: [row.text] for row in table(spark, sf, "documents").collect()}
    check_packing(QUERIES["op9_packing"](spark, sf).collect(), texts, words, 0.02)


def test_bpe_query(spark, published):
    from tidemark.llm.common import table
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {row.doc_id: row for row in QUERIES["op2_byte_bpe"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = published.encode_ordinary(doc.text)
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()
