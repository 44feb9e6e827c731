"""Token files: exact round trip, file layout, order and edge cases."""

import os
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.common import scratch

from helpers import ODD_IDS, ODD_TEXTS, documents, letters, odd_documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def encoded(texts):
    tok = Tokenizer.from_file(TOKENIZER)
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_round_trip_in_id_order(spark):
    texts = [letters(i, 1 + i * 7 % 90) + ("\n" if i % 3 else ".") for i in range(80)]
    ids = [(i * 37) % 80 for i in range(80)]
    got = {r["doc_id"]: r for r in token_files.round_trip(documents(spark, texts, ids).repartition(5), TOKENIZER, units="space_led").collect()}
    start = 0
    for doc_id, want in sorted(zip(ids, encoded(texts))):
        crc = zlib.crc32(np.array(want, "<u4").tobytes())
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"], got[doc_id]["ids_crc32"]) == (start, len(want), crc)
        start += len(want)


def test_files_are_flat(spark):
    folder = scratch(spark, "test-token-files")
    texts = [letters(i, 20) for i in range(30)]
    token_files.write_token_files(documents(spark, texts).repartition(3), TOKENIZER, folder, units="space_led")
    root = folder.removeprefix("file:")
    names = sorted(n for n in os.listdir(root) if n.endswith(".ids"))
    flat = np.concatenate([np.fromfile(f"{root}/{n}", "<u2") for n in names])
    assert flat.tolist() == sum(encoded(texts), [])
    offsets = np.concatenate([np.fromfile(f"{root}/{n[:-4]}.offsets", "<u8")[:-1] for n in names])
    assert offsets.tolist() == np.cumsum([0, *map(len, encoded(texts))])[:-1].tolist()
    assert token_files.id_type(1 << 16) == "<u2" and token_files.id_type((1 << 16) + 1) == "<u4"


def test_wide_ids(spark):
    texts = [letters(i, 9) for i in range(5)]
    got = token_files.round_trip(documents(spark, texts), TOKENIZER, units="space_led", end_id=70_000).collect()
    want = [zlib.crc32(np.array([*ids[:-1], 70_000], "<u4").tobytes()) for ids in encoded(texts)]
    assert [r["ids_crc32"] for r in sorted(got)] == want


def test_odd_and_empty_tables(spark):
    got = token_files.round_trip(odd_documents(spark), TOKENIZER, units="space_led").orderBy("start").collect()
    order = sorted(range(len(ODD_IDS)), key=lambda i: (ODD_IDS[i] is not None, ODD_IDS[i] or 0))
    assert [r["doc_id"] for r in got] == [ODD_IDS[i] for i in order]  # a NULL id comes first
    assert [r["n_tokens"] for r in got] == [len(x) for x in encoded([ODD_TEXTS[i] for i in order])]
    assert token_files.round_trip(documents(spark, []), TOKENIZER, units="space_led").count() == 0
