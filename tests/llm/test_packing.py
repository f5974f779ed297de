from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import documents, prose

from surfacekit.llm.packing import FreeRoom, WordTokenizer, pack, pack_documents
from surfacekit.llm.queries import END_ID, tokenizer_path

ODD = ["It's a test, don't!", "ΣΑΣ ΟΔΟΣ", "İstanbul <|ENDOFTEXT|> <|endoftext|>x", "a\x1cb c\x85d e\xa0f", "café café Å 12ab 3.4,5 ...", "",
       None, "<|startoftext|> The END.", "naïve—dash word; x:y ﬁ Ⅷ ²", "日本語 テスト。한국어 й й", "'s 's' 'tis we'll. o'clock!!", "a≠b ×a÷b"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    return lambda t: encoder.encode(t or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_on_whole_texts(whole):
    rnd, letters = random.Random(3), "aB 1.,'<|>éÉ×÷İı\n\t≠ñß²ªΣσ—\x1c\x85\xa0字ŉ"
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(500)]
    for most in (10**6, 5):
        encode = WordTokenizer(tokenizer_path(), most)
        for at in (0, 100, 0):
            part = texts[at:]
            got = encode([None if t is None else t.encode() for t in part])
            assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole(t) for t in part]


def test_tournament_tree_finds_the_first_fit():
    rnd = random.Random(1)
    tree, room = FreeRoom(200, 100), [100] * 256
    for _ in range(200):
        size = rnd.randrange(1, 100)
        slot = tree.first_fit(size)
        assert slot == next(k for k, r in enumerate(room) if r >= size)
        tree.take(slot, size)
        room[slot] -= size


def test_pack_covers_every_token_once():
    rnd = random.Random(2)
    for trial in range(40):
        sizes = [rnd.choice([1, 2, 63, 64, 65, 128, 200, rnd.randrange(1, 40)]) for _ in range(rnd.randrange(1, 60))]
        out = pack(sizes, 64, 1 + trial % 8)
        seen = sorted((d, a, a + n) for s in out for d, a, n in s)
        for d, size in enumerate(sizes):
            parts = [(a, b) for e, a, b in seen if e == d]
            assert parts[0][0] == 0 and parts[-1][1] == size and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
        loads = [sum(n for _, _, n in s) for s in out]
        assert max(loads) <= 64 and min(n for s in out for _, _, n in s) > 0
        waste = sum(0 if x & (x - 1) == 0 else 64 - x for x in loads)
        assert waste <= len(loads) * (1 + trial % 8) + 64


def test_pieces_join_to_the_ids(spark, whole):
    rows = list(enumerate(ODD)) + [(100, prose(1, 9000)), (101, prose(2, 900)), (101, prose(2, 900)), (None, "no id"), (102, "x" * 60000)]
    rows += [(200 + k, prose(k, 5 * k)) for k in range(60)]
    df = pack_documents(documents(spark, rows, "part start ids"), tokenizer_path(), end_id=END_ID, group_docs=30)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = [r.asDict() for r in df.collect()]
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(np.array([*whole(t), END_ID], dtype="<u4"))
    sequences: dict = {}
    for r in got:
        texts = want[r["doc_id"]]
        assert r["doc_tokens"] == len(texts[0])
        assert r["ids_crc32"] == zlib.crc32(texts[0][r["start"] : r["start"] + r["length"]].tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, texts in want.items():
        assert sum(r["length"] for r in got if r["doc_id"] == i) == sum(map(len, texts))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096


def test_empty_table(spark):
    assert pack_documents(documents(spark, []), tokenizer_path()).count() == 0
