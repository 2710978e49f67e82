import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridwright.llm import packing, token_files, tokens
from gridwright.llm.tokens import Encoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", " ", "a  b", "a \n b", "\n\na", " x", "x ", "don't we'll 12 3a4 a_b x-y", "éx", "a\tb\n\nc", "<|endoftext|> a",
       "a <|endoftext|>", "日本語 テスト", "ﬁne ½ ² x²", "A'S it's", "a b c", "\x1ca b\x1c", "ǅ İ ß ẞ", "a\r\nb", "a  \n",
       "ÀÉÎ,ÕÜ! ...", "x​y", "a\x85b c", "É é", "Σας ΟΔΟΣ."]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_fragments_give_the_librarys_ids(path, awkward):
    ours, library = Encoder(path), Tokenizer.from_file(path)
    assert ours.kind != "whole"
    rng = np.random.default_rng(1)
    mixed = ["".join(rng.choice(list("ab É.,' \n\t1²"), 12)) for _ in range(2000)]
    for text in [*ODD, *mixed, *(t for _, t in awkward if t)]:
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])


def _expected(pairs, path):
    library = Tokenizer.from_file(path)
    return [(i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")) for i, t in pairs]


def test_packing_places_every_piece_once(documents, awkward):
    packed = packing.pack(documents(awkward), WORDS, with_ids=True)
    rows = packed.collect()
    want = sorted((str(i), n, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()))
                  for i, ids in _expected(awkward, WORDS) for n, s in enumerate(range(0, len(ids), 2048)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    lengths = np.bincount([r.length for r in rows], minlength=2049)
    assert len(by_sequence) <= packing.fewest(lengths, 2048) + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert packing.pack(documents(awkward).limit(0), WORDS).count() == 0


def _optimum(sizes, capacity):
    """Fewest bins by trying all ways to place the pieces, largest first."""
    best = len(sizes)

    def place(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= rest[0]}:
            left = list(rooms)
            left.remove(room)
            place(rest[1:], [*left, room - rest[0]])
        place(rest[1:], [*rooms, capacity - rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = np.random.default_rng(8)
    for _ in range(60):
        capacity = int(rng.integers(10, 60))
        sizes = rng.integers(1, capacity + 1, rng.integers(1, 10))
        plan = packing.bin_completion(np.bincount(sizes, minlength=capacity + 1), capacity)
        placed = sorted(s for filled, times in plan for _ in range(times) for s in filled)
        assert placed == sorted(sizes.tolist()) and all(sum(f) <= capacity for f, _ in plan)
        assert sum(t for _, t in plan) == _optimum(sizes.tolist(), capacity)


def test_bin_completion_beats_best_fit():
    counts = np.bincount([6, 6, 5, 5, 4, 4, 4, 3, 3] * 40, minlength=11)
    worse = sum(t for _, t in packing.best_fit(counts, 10))
    assert sum(t for _, t in packing.bin_completion(counts, 10)) == packing.fewest(counts, 10) == 160 <= worse


def test_completions_leave_out_dominated_ways():
    found = packing.completions(np.bincount([7, 5, 4, 3, 2], minlength=11), 9, ways=10)
    assert found[0] == (0, (7, 2)) and all(9 - sum(c) == w for w, c in found)
    for waste, chosen in found:
        assert all(s in chosen or s > waste for s in (7, 5, 4, 3, 2))


def test_token_files_round_trip(spark, documents, awkward):
    frame = documents(awkward)
    files = token_files.write_token_files(frame, BYTES, file_ids=300)
    assert files.count() > 3
    rows = sorted(token_files.read_token_files(files, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in awkward), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        at += r.n_tokens
    want = sorted((str(i), ids.tolist()) for i, ids in _expected(awkward, BYTES))
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert token_files.read_token_files(token_files.write_token_files(frame.limit(0), BYTES)).count() == 0


def test_ranks_of_every_length_and_count():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (2 ** rng.uniform(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_ranks(ranks)
        assert token_files.decode_ranks(control, data, n).tolist() == ranks.tolist()
    common = [np.array([9] * 50 + [7] * 20 + [70_000], dtype=np.uint32), np.zeros(0, dtype=np.uint32)]
    raw = b"".join(token_files.file_parts([None, 4], common))
    keys, parts = token_files.parse_file(raw)
    assert keys == [None, 4] and [p.tolist() for p in parts] == [c.tolist() for c in common]
    with pytest.raises(ValueError):
        token_files.parse_file(b"x" * 64)


def test_loose_texts_are_those_of_the_pattern():
    rng = random.Random(12)
    for _ in range(20_000):
        text = "".join(rng.choices("ab \n\t\u00a0\x1c\u3000", weights=(9, 9, 4, 2, 1, 1, 1, 1), k=rng.randint(1, 9)))
        assert tokens._is_loose(text) == (tokens._LOOSE.search(text) is not None)


def test_pieces_in_and_beyond_ascii():
    """Letters and signs of ASCII are spelled as they are, others by the stand-ins of their bytes."""
    known = Encoder(BYTES)
    for piece in ("word", " word", "Été", " Été", "...", " (", "x", " ÿ", "~", " !"):
        assert known._piece(piece) == known._library(piece)
