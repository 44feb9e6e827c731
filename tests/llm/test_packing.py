"""Best-fit packing: against a plain best-fit decreasing over single pieces, and an exact round trip of the ids."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing

from helpers import documents, letters, odd_documents

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_plain_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 100])
    lengths = [r.randint(1, capacity) if r.random() < 0.5 else r.randint(1, 1 + capacity // 4) for _ in range(r.randint(1, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    placements, sequences = packing.plan_packing(counts, capacity)
    assert sequences == plain_best_fit(lengths, capacity)
    used = [[] for _ in range(sequences)]
    for n, count in counts.items():
        own = [p for p in placements if p[0] == n]
        for rank in range(count):
            _, first_rank, first, each, offset = [p for p in own if p[1] <= rank][-1]
            used[first + (rank - first_rank) // each].append((offset + (rank - first_rank) % each * n, n))
    for pieces in used:
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert 0 < at <= capacity


def test_room_tree_finds_the_tightest():
    r, capacity = random.Random(1), 37
    tree, rooms = packing.RoomTree(capacity), []
    for _ in range(300):
        need = r.randint(1, capacity)
        assert tree.tightest(need) == min((x for x in rooms if x >= need), default=None)
        room = r.randint(1, capacity)
        rooms.append(room)
        tree.add(room, 1)
        if r.random() < 0.5:
            tree.add(gone := rooms.pop(r.randrange(len(rooms))), -1)
            assert gone


def test_length_out_of_range_is_an_error():
    for bad in (0, 11):
        with pytest.raises(ValueError):
            packing.plan_packing({bad: 1}, 10)


def test_pieces_and_sequences_round_trip(spark):
    texts = [letters(i, 5 + 37 * i % 400) for i in range(60)] + [letters(99, 5000), "", None]
    docs = documents(spark, texts)
    packed = packing.pack_documents(docs, TOKENIZER, capacity=512, units="bare", keep_ids=True)
    rows = packed.collect()
    tok = Tokenizer.from_file(TOKENIZER)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    for i, ids in want.items():
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["start"] for r in pieces] == list(range(0, len(ids), 512))
        assert all(r["length"] == 512 for r in pieces[:-1])
        assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces]).tolist() == ids
        assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in pieces)
    lengths = [r["length"] for r in rows]
    assert len({r["sequence_id"] for r in rows}) == plain_best_fit(lengths, 512)
    by_place = {(r["sequence_id"], r["offset"]): bytes(r["ids"]) for r in rows}
    for s in packing.sequences(packed).collect():
        parts = b"".join(v for (q, _), v in sorted(by_place.items()) if q == s["sequence_id"])
        assert bytes(s["ids"]) == parts and s["n_tokens"] == len(parts) // 4 <= 512


def test_odd_and_empty_tables(spark):
    rows = packing.pack_documents(odd_documents(spark), TOKENIZER, units="bare").collect()
    assert sorted(str(r["doc_id"]) for r in rows if r["piece"] == 0) == sorted(map(str, [0, 1, 2, 3, 4, None, 6, 7, 8, 9, 9]))
    assert [r["length"] for r in rows if r["doc_id"] in (0, 1, 2)] == [1, 1, 1]
    assert packing.pack_documents(documents(spark, []), TOKENIZER, units="bare").count() == 0
