"""op11 to op13 against the tokenizers on whole texts, a brute-force alignment, and exact round trips."""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents

from surfacekit.llm import fill_middle, piece_bpe, token_alignment
from surfacekit.llm.queries import op11_token_alignment, op12_byte_bpe, op13_fill_middle, tokenizer_path
from surfacekit.llm.unit_cache import UnitEncoder

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
PATH_A, PATH_B, RANKS = (tokenizer_path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
ODD = ["", " ", "  ", "a", " a ", "It's a test, don't!  we'll\n\n\tsee 's", "<|endoftext|> <s></s><unk><0x41>", "▁under▁score ▁", "naïve — ﬁ Ⅷ ² 日本語 テスト 한국어 й", "\x00\x01\x7f\x85\xa0 　x",
       "x" * 3000, " " * 500 + "end" + " " * 7, "emoji 👩‍👩‍👧 \U0010ffff", "12,345.67 1e-9", "a<P>b", "<", "<<S>>", "lone > sign <P", "\r\n\r\n", "a;\r\n\t}\r\n b \u3000  x\x85 y", "\n\n x\ty \n"]


@pytest.fixture(scope="module")
def tiktoken_encode():
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=piece_bpe.read_ranks(RANKS), special_tokens={})
    return own.encode_ordinary


@pytest.fixture(scope="module")
def spelled():
    """(id, bytes) of every token of a text by A and by B, on whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATH_A), SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    with open(PATH_A) as f:
        names = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    alphabet = token_alignment.byte_alphabet()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def both(text):
        return ([(i, bytes(alphabet[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids], [(i, piece(i)) for i in b.encode(text)])

    return both


def brute_alignment(rows, spelled):
    """The contract's columns, by the plain definition."""
    kept, links = {}, {}
    for k, (_, text) in enumerate(rows):
        a, b = spelled(text) if text else ([], [])
        want = f" {text or ''}".encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a, b = [], []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        kept[k] = spans
        links[k] = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
    counts = Counter(p for v in links.values() for p in v)
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        a, b = kept[k]
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = [[[str(i) for s, e, i in side if lo <= s and e <= hi] for side in (a, b)] for lo, hi in zip([0, *cuts], cuts)]
        text = ";".join("|".join(",".join(side) for side in g) for g in groups)
        own = links[k]
        out.append((doc_id, len(a), len(b), len(cuts), len(own), sum(counts[p] == top[p[1]] for p in own), sum(counts[p] for p in own),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def aligned(df):
    rows = df.select(COLUMNS).collect()
    return sorted(((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in map(tuple, rows)), key=str)


def odd_rows():
    rnd = random.Random(5)
    letters = "aB 1.,'<|>éÉ×İı\n\t≠ñß ▁  —\x1c\x85\xa0字ŉ"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(60)]
    texts = ODD + made + ["the same words again"] * 3
    return [(k, t) for k, t in enumerate(texts)] + [(None, None), (7, "another text of id 7"), (None, "the same words again")]


@pytest.mark.parametrize("hot_pairs", [0, 25, 10**6])
def test_alignment_equals_brute_force_with_and_without_rare_pairs(spark, spelled, hot_pairs):
    rows = [(i, t if t is None or len(t) < 400 else t[:400]) for i, t in odd_rows()]
    df = documents(spark, rows, "a b row pair links groups n_a")
    assert aligned(token_alignment.alignment(df, PATH_A, PATH_B, hot_pairs)) == brute_alignment(rows, spelled)


def test_alignment_query_equals_brute_force_on_given_documents(spark, spelled):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").select("doc_id", "text").collect()]
    sub = spark.createDataFrame(given, "doc_id long, text string")
    assert aligned(token_alignment.alignment(sub, PATH_A, PATH_B)) == brute_alignment(given, spelled)
    whole = op11_token_alignment(spark, SF)
    assert whole.columns == [*COLUMNS[:-1], "groups_sha256"]
    assert whole.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_ids_by_units_are_those_of_whole_texts(spark, spelled):
    encoders = token_alignment.Encoders(PATH_A, PATH_B)
    given = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for texts in (ODD, [t for _, t in odd_rows()], given):
        a, b = encoders(texts)
        for text, x, y in zip(texts, a.to_pylist(), b.to_pylist()):
            whole = spelled(text) if text else ([], [])
            if x:
                assert (x, y) == tuple([i for i, _ in side] for side in whole)
            else:
                want = f" {text or ''}".encode()
                assert not text or any(b"".join(v for _, v in side) != want for side in whole)


def test_tokens_of_an_underscore_text_do_not_spell_it(spark):
    df = documents(spark, [(1, "plain text"), (2, "▁under score")])
    out = {r["doc_id"]: r for r in token_alignment.alignment(df, PATH_A, PATH_B).collect()}
    assert out[1]["n_links"] > 0 and (out[2]["n_a"], out[2]["n_b"], out[2]["groups"]) == (0, 0, "")


def test_empty_tables(spark):
    df = documents(spark, [])
    assert token_alignment.alignment(df, PATH_A, PATH_B).collect() == []
    assert piece_bpe.decode_ids(piece_bpe.encode_texts(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect() == []
    assert fill_middle.restore(fill_middle.transform(df)).collect() == []


def test_frequent_pairs_keep_to_their_bound(spark):
    counts = spark.createDataFrame([(k, 1 + k % 40, True) for k in range(400)], "pair long, links long, best boolean")
    for most in (0, 1, 50, 200, 399, 400, 1000):
        hot, least = token_alignment.frequent(counts, most)
        assert hot.num_rows <= most and hot.num_rows == sum(1 + k % 40 >= least for k in range(400))
    assert token_alignment.frequent(counts, 400)[1] == 1


def test_long_documents_in_parts_of_a_batch(spelled):
    encoders = token_alignment.Encoders(PATH_A, PATH_B)
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["alpha", "βeta", "don't", "12", "x" * 30]) for _ in range(n)) for n in (3, 4000, 0, 1, 9000)]
    a, b = encoders(texts)
    batch = pa.RecordBatch.from_arrays([a, b], names=["a", "b"])
    size, token_alignment.BATCH_TOKENS = token_alignment.BATCH_TOKENS, 5000
    try:
        parts = list(token_alignment._parts(batch))
    finally:
        token_alignment.BATCH_TOKENS = size
    assert sum(p.num_rows for p in parts) == 5 and len(parts) > 2
    n = [token_alignment.all_ends(token_alignment._lists(p, "a"), token_alignment._lists(p, "b"), encoders).num_rows for p in parts]
    assert sum(n) == token_alignment.all_ends(a, b, encoders).num_rows


def encoded(spark, rows, extra=""):
    df = piece_bpe.encode_texts(documents(spark, rows, extra), RANKS, P.PATTERN)
    return [tuple(r) for r in piece_bpe.decode_ids(df, RANKS, P.PATTERN).collect()]


def test_pieces_encode_like_the_rank_library_and_decode_back(spark, tiktoken_encode):
    rows = odd_rows()
    out = encoded(spark, rows, "ids decoded n_tokens")
    assert len(out) == len(rows)
    by = Counter((i, bytes(back)) for i, _, _, back in out)
    assert by == Counter((i, (t or "").encode()) for i, t in rows)
    for _, n, ids, back in out:
        want = tiktoken_encode(bytes(back).decode())
        assert np.frombuffer(ids, "<u4").tolist() == want and n == len(want)


def test_every_character_and_every_token(tiktoken_encode):
    codec = piece_bpe.PieceCodec(RANKS, P.PATTERN)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{c}x {c}1{c} " for c in chars[k : k + 97]) for k in range(0, len(chars), 97)]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [tiktoken_encode(t) for t in texts]
    assert [codec.decode(x) for x in codec.encode(texts)] == [t.encode() for t in texts]
    ranks = piece_bpe.read_ranks(RANKS)
    assert {piece_bpe.as_bytes(piece_bpe.as_piece(t)) for t in ranks} == set(ranks)
    assert codec.bytes == sorted(ranks, key=ranks.__getitem__)


def test_a_token_that_its_merges_do_not_reach_is_one_id_as_a_whole_unit(tmp_path, monkeypatch):
    import base64

    import tiktoken

    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"abcd"]
    tokens += [b"wxyz"]  # no pair of tokens makes it
    file = tmp_path / "ranks"
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens)))
    codec = piece_bpe.PieceCodec(str(file), P.PATTERN)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    for text in ("wxyz", "wxyza", "abcd", "bcabc", "abcabcd wxyz", "wxyz wxyz"):
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)
    with pytest.raises(ValueError):
        piece_bpe.serialised_model({b"a": 0})


def test_units_are_kept_within_their_bound_and_long_texts_go_in_blocks(monkeypatch):
    calls = []
    units = UnitEncoder(lambda t: re.compile(r"\w+|\W"), lambda u: calls.append(len(u)) or [[len(x)] for x in u], most=50)
    monkeypatch.setattr("surfacekit.llm.unit_cache.LONG_TEXT", 100)
    monkeypatch.setattr("surfacekit.llm.unit_cache.BLOCK", 7)
    texts = [f"w{k} " * (k % 50) for k in range(120)] + [None, ""]
    want = [[len(x) for x in re.findall(r"\w+|\W", t or "")] for t in texts]
    for _ in range(2):
        got = [units([t])[0] for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
        assert [np.frombuffer(x, "<u4").tolist() for x in units(texts)] == want
    assert units.size < 2000 and sum(map(len, units.older)) < 2000


def test_byte_bpe_query_on_given_documents(spark, tiktoken_encode):
    given = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = op12_byte_bpe(spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        text = given[r["doc_id"]] or ""
        ids = tiktoken_encode(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def brute_form(doc_id, text, seed="1"):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:x]), "".join(tokens[x:y]), "".join(tokens[y:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_the_plain_form_and_restores(spark):
    rows = odd_rows() + [(1000 + k, t) for k in range(40) for t in ("<", "S><", "<P", ">", "aé字 b", "one two, three")]
    out = fill_middle.restore(fill_middle.transform(documents(spark, rows, "form output n restored"))).collect()
    want = Counter((i, *brute_form(i, t), t or "") for i, t in rows)
    assert Counter((r[0], r[1], r[2], r[3], r[4], r[5].decode(), r[6].decode()) for r in out) == want
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


def test_rotation_exchanges_neighbouring_blocks():
    rnd = random.Random(4)
    for _ in range(300):
        text = bytes(rnd.randrange(256) for _ in range(rnd.randrange(1, 40)))
        i, j, k = sorted(rnd.randrange(len(text) + 1) for _ in range(3))
        buffer = bytearray(text)
        fill_middle.rotate(buffer, i, j, k)
        assert buffer == text[:i] + text[j:k] + text[i:j] + text[k:]
        fill_middle.rotate(buffer, i, i + k - j, k)
        assert buffer == text


def test_fill_middle_query_on_given_documents(spark):
    given = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in op13_fill_middle(spark, SF).collect():
        n, form, prefix, middle, output = brute_form(r["doc_id"], given[r["doc_id"]])
        assert tuple(r)[1:] == (n, form, prefix, middle, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((given[r["doc_id"]] or "").encode()).hexdigest())


def test_shared_units_slice_long_texts_and_forget(spelled):
    encoders = token_alignment.Encoders(PATH_A, PATH_B)
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(["alpha", " ", "βeta", "\n", "don't ", "\t", "x" * 70, ". "]) for _ in range(n)) for n in (0, 3, 50, 700, 1, 2000)]
    whole = [x.to_pylist() for x in encoders(texts)]
    for most, part in ((5, 1 << 20), (10**6, 64), (3, 100)):
        encoders.units.most, encoders.units.part = most, part
        assert [x.to_pylist() for x in encoders(texts)] == whole
