import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trajspark.llm.byte_bpe import ByteBpe, encode_documents, load, token_digests
from trajspark.llm.huffman import Code, code_lengths
from trajspark.llm.token_files import token_file_digests

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = list("abcdest'mrvl  \n\t.,!?0189ÉéñßA中文字ـعрус   \u0085\x1c\x1f🙂👩‍👩½²Ⅷ_-\r")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load(RANKS).ranks, special_tokens={})


@pytest.fixture(scope="module")
def strange_texts(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices(LETTERS, k=rng.randint(0, 80))) for _ in range(500)]
    texts += ["", None, "a" * 50_000, "ab" * 20_000, " " * 3000, "'s 's're'll'd 'x' it's we'll", "<|endoftext|> x"]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "again"), (3, "again")]


def test_encodes_like_the_library(spark, strange_texts, library):
    docs = spark.createDataFrame(strange_texts, "doc_id long, text string").repartition(3)
    want = []
    for i, t in strange_texts:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted([tuple(r) for r in token_digests(docs, RANKS).collect()], key=str) == sorted(want, key=str)
    for r in encode_documents(docs, RANKS).filter("doc_id < 20").collect():
        assert library.decode_bytes(np.frombuffer(r.ids, "<u4").tolist()) == bytes(r.decoded)


def test_odd_rows(odd_docs, no_docs):
    assert token_digests(odd_docs, RANKS).count() == odd_docs.count()
    assert token_digests(no_docs, RANKS).count() == 0
    assert token_file_digests(odd_docs, VOCABULARY, block_ids=50).count() == odd_docs.count()
    assert token_file_digests(no_docs, VOCABULARY).count() == 0


def test_untrained_vocabulary_merges_pair_by_pair():
    """Ranks in no trained order: a merge may make a pair of a lower rank than its own."""
    rng = random.Random(9)
    for _ in range(30):
        tokens = {"".join(rng.choices("ab", k=rng.randint(2, 5))).encode() for _ in range(12)}
        order = list(tokens)
        rng.shuffle(order)
        bpe = ByteBpe({bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(order)})
        pieces = ["".join(rng.choices("ab", k=rng.randint(1, 25))).encode() for _ in range(40)]
        flat, sizes = bpe.encode_pieces(pieces)
        assert [a.tolist() for a in np.split(flat, np.cumsum(sizes)[:-1])] == [_merged(p, bpe.ranks) for p in pieces]


def _merged(piece, ranks):
    parts = [piece] if piece in ranks else [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_token_files_hold_the_ids_of_the_library(spark, strange_texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    docs = spark.createDataFrame(strange_texts, "doc_id long, text string").repartition(3)
    start, want = 0, []
    for i, t in sorted(strange_texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for size in (1 << 18, 100):
        assert sorted([tuple(r) for r in token_file_digests(docs, VOCABULARY, block_ids=size).collect()], key=str) == sorted(want, key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=500), st.integers(6, 16), st.sampled_from([1, 7, 128]))
def test_huffman_round_trip(ids, limit, every):
    ids = np.array(ids, dtype=np.uint32)
    counts = np.bincount(ids, minlength=41)
    lengths = code_lengths(counts, limit)
    assert lengths.max(initial=0) <= limit and ((lengths > 0) == (counts > 0)).all()
    assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
    code = Code(lengths)
    payload, points = code.encode(ids, every)
    assert code.decode(payload, points, len(ids), every).tolist() == ids.tolist()


def test_code_is_optimal_without_a_limit():
    import heapq

    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 0, 7])
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((code_lengths(counts, 16) * counts).sum()) == cost
