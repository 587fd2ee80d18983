import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from trendspark.llm import bpe, packing as P

from .helpers import frame, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_equal_the_tokenizer_and_sequences_are_gapless(spark):
    rows = odd_rows()
    out = P.pack_documents(frame(spark, rows, clash=True), PATH).collect()
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    expected = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start:first if start == 0 else start + 1024]
            expected.append((doc, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024


def test_added_tokens_are_one_id_as_in_the_library(spark):
    """The library as it is by default."""
    mark = "<|endoftext|>"
    texts = [mark, f"one {mark} two", f"{mark}{mark}it's{mark}", f" {mark}\n", "<|endoftext|", f"<|endof{mark}text|>", "é" * 400 + mark + "中 a" * 900, "", None]
    library = Tokenizer.from_file(PATH)
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for fast in (False, True):
        own = bpe.encoder(PATH, fast)
        got = list(own.encode([t or "" for t in texts], at_once=50))
        assert [x.tolist() for x in got] == expected
        assert [own.decode(x).decode() for x in got] == [t or "" for t in texts]
        assert all(own.offsets(x)[-1] == len((t or "").encode()) for x, t in zip(got, texts))
    out = P.pack_documents(frame(spark, list(enumerate(texts))), PATH).collect()
    lengths, crcs = defaultdict(int), {}
    for r in out:
        lengths[r.doc_id] += r.length
        crcs[r.doc_id, r.piece] = r.ids_crc32
    assert [lengths[i] for i in range(len(texts))] == [len(x) + 1 for x in expected]
    assert crcs[1, 0] == zlib.crc32(np.array([*expected[1], 2], "<u4").tobytes())


def test_empty_table(spark):
    assert P.pack_documents(frame(spark, []), PATH).count() == 0


def checked(counts, capacity):
    plan = P.match(dict(counts), capacity)
    ranks, used = defaultdict(list), defaultdict(list)
    for length, rank, n, sequence, offset in plan:
        ranks[length] += range(rank, rank + n)
        for k in range(n):
            used[sequence + k].append((offset, length))
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in counts.items() if n}
    for pieces in used.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(used)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 9), max_size=20))
def test_match_places_every_piece_once(counts):
    used = checked(counts, 64)
    volume = sum(s * n for s, n in counts.items())
    # never worse than first-fit's bound
    assert used <= max(1, 1.7 * -(-volume // 64) + 1) if volume else used == 0


def test_match_is_close_to_the_lower_bound():
    counts = {s: 1000 for s in range(1, 1024)} | {1024: 5000}
    volume = sum(s * n for s, n in counts.items())
    assert checked_size(counts) <= 1.001 * volume / 1024


def checked_size(counts):
    return max(sequence + n for _, _, n, sequence, _ in P.match(dict(counts), 1024))
