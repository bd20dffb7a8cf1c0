import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattloom.llm.packing import Encoder, complete, packed, piece_bounds, sequences, tokenizer_file

ODD = ["", None, " ", "\n", "a\nb", "a \n b", "  two  spaces ", "tab\tx y", "it's we'll  don't", "é ü x y\x1cz", "end ", "\r\n a", "<|endoftext|> a <|endoftext|>",
       "x" * 5000, "123 456,789 a1b2", "日本 語　文", "🙂 🙂🙂\n🙂", "a\n\nb\n c", " lead", "end. Next, 5. x.. y., é. ß, ².", "a <|endoftext|> b", "\x01 a"]


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def test_words_encode_like_whole_texts(spark, model):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [t or "" for t in ODD]
    for text, got in zip(texts, Encoder(tokenizer_file()).encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet="ab' \n\t.,1é　s\x1c\x01ª", max_size=30))
def test_any_white_space(text):
    model = test_any_white_space.model = getattr(test_any_white_space, "model", None) or Encoder(tokenizer_file())
    assert np.frombuffer(next(model.encode([text])), "<u4").tolist() == model.model.encode(text, add_special_tokens=False).ids


def test_pieces_cover_and_only_the_first_is_short():
    for n in (1, 7, 8, 9, 16, 17):
        got = piece_bounds(n, 8)
        assert [s for s, _ in got] == [sum(k for _, k in got[:i]) for i in range(len(got))] and sum(k for _, k in got) == n
        assert all(k == 8 for _, k in got[1:])


def test_packing_is_tight_and_whole():
    rnd = random.Random(3)
    counts = {}
    for _ in range(5000):
        k = min(2048, int(rnd.expovariate(1 / 600)) + 1)
        counts[k] = counts.get(k, 0) + 1
    used, bins = {}, 0
    for pattern, times in complete(counts):
        assert sum(pattern) <= 2048
        bins += times
        for x in pattern:
            used[x] = used.get(x, 0) + times
    assert used == counts
    assert bins <= -(-sum(k * v for k, v in counts.items()) // 2048) + 1


def test_packing_is_optimal_on_small_cases():
    assert sum(t for _, t in complete({6: 2, 5: 2, 4: 2, 3: 1, 2: 1, 1: 0}, 10)) == 4
    assert sum(t for _, t in complete({7: 3, 3: 3}, 10)) == 3
    assert complete({}) == []


def least(sizes, capacity):
    """Fewest sequences by exhaustive search over subsets: (sequences, fill of the last one), least first."""
    best = {0: (1, 0)}
    for mask in range(1, 1 << len(sizes)):
        ways = []
        for i, x in enumerate(sizes):
            if mask >> i & 1:
                n, fill = best[mask ^ 1 << i]
                ways.append((n, fill + x) if fill + x <= capacity else (n + 1, x))
        best[mask] = min(ways)
    return best[(1 << len(sizes)) - 1][0] if sizes else 0


def test_a_case_where_single_sequences_are_not_enough():
    counts = {14: 1, 13: 1, 9: 1, 8: 1, 5: 1, 4: 1, 3: 2}
    assert sum(t for _, t in complete(counts, 20)) == 3


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_optimal_on_random_small_cases(seed):
    rnd = random.Random(seed)
    for _ in range(250):
        capacity = rnd.choice([10, 20, 50])
        sizes = [rnd.randint(1, rnd.choice([capacity // 2, capacity])) for _ in range(rnd.randint(0, 9))]
        counts = {x: sizes.count(x) for x in sizes}
        got = complete(counts, capacity)
        assert sorted(x for p, n in got for x in p * n) == sorted(sizes) and all(sum(p) <= capacity for p, _ in got)
        assert sum(n for _, n in got) == least(sizes, capacity)


def check_rows(rows, docs, model, capacity):
    rows_of = {}
    for r in rows:
        rows_of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in rows_of.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    want = []
    for d, t in docs:
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(piece_bounds(len(ids), capacity))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)


def test_documents_round_trip(spark, model):
    docs = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, "no id"), (3, "again"), (3, "again"), (99, "word " * 300)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, length int").repartition(3)
    check_rows(packed(df, capacity=64).collect(), docs, model, 64)
    for r in sequences(df, capacity=64).collect():
        assert r.length == len(r.ids) <= 64


def test_empty_table(spark):
    assert packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0
