import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from transitlake.llm import coder
from transitlake.llm.tokens import encoder

from .conftest import prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "a'b c's d.'s", "É.É, ﬁ!", "<|endoftext|>", "x<|EndOfText|>y", "don't.", "日本語。テスト, a", "ΑΣ ΣΑΣ. İstanbul,",
       "a b,", "x²,y", "１２3.", "a\x1cb", "é.x", "'LL 'll", "🙂🙂.", "é.", "a.b,c;", " ".join(map(chr, range(0x21, 0x600)))]


def test_ids_are_the_tokenizers(documents):
    plain = Tokenizer.from_file(PATH)
    enc = encoder(PATH)
    for t in ODD + [r["text"] or "" for r in documents.limit(60).collect()]:
        assert enc.ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids
    assert len(enc.ids(None)) == 0


def test_a_full_cache_starts_anew(monkeypatch):
    from transitlake.llm import tokens
    enc = tokens.Encoder(PATH)
    want = enc.ids(prose(1, 300)).tolist()
    monkeypatch.setattr(tokens, "_MOST_CACHED", 10)
    assert all(enc.ids(prose(1, 300)).tolist() == want for _ in range(3)) and enc.ids("new Word, x").size


def test_words_with_punctuation_share_what_is_learnt():
    """A word is encoded and held once, whatever punctuation follows it."""
    from transitlake.llm import tokens
    enc, plain = tokens.Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["Alpha. beta, alpha, (beta). alpha", None, " ", "beta?! Alpha;\n\n beta.", "é. Alpha.<|endoftext|> BETA.", "..., . a.b. é."]
    ids, sizes = enc.joined(texts[:4], 1)
    assert set(enc.words) == {b"alpha", b"beta", b".", b",", b"(beta", b").", b"?!", b";"}
    for some in (texts[:4], texts, [], [""], texts[::-1]):
        ids, sizes = enc.joined(some, 1)
        want = [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in some]
        assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


def test_random_words_are_the_tokenizers():
    import random
    rng, signs = random.Random(7), "aAbsStTdlLvVe019 éÉßçŁжΣς日ﬁ²½̸́​ \x85\x1c\x7f\n\t\r\x0b\x0c'\"`~!@#$%^&*()-_=+[]{}\\|;:,.<>/?     "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    enc, plain = encoder(PATH), Tokenizer.from_file(PATH)
    want = [x.ids for x in plain.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.ids_of(texts)] == want


def test_runs_of_texts(monkeypatch):
    from transitlake.llm import tokens
    monkeypatch.setattr(tokens, "_MOST_CHARS", 5)
    assert [(r.start, r.stop) for r in tokens.runs(["ab", "cde", None, "f", "a long one", "", "x"])] == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert not list(tokens.runs([]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535) | st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=5))
def test_blocks_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    assert [b.tolist() for b in coder.read_blocks(coder.write_blocks(blocks))] == [b.tolist() for b in blocks]


def test_long_and_wide_blocks():
    rng = np.random.default_rng(3)
    blocks = [np.tile(rng.integers(0, 49000, 50), 400), np.zeros(20_000, int), rng.zipf(1.4, 20_000) % 49000, rng.integers(0, 65536, 4096)]
    blocks = [b.astype(np.uint32) for b in blocks]
    payloads = coder.write_blocks(blocks)
    assert [b.tolist() for b in coder.read_blocks(payloads)] == [b.tolist() for b in blocks]
    assert len(payloads[0]) < 2 * len(blocks[0]) / 8 and len(payloads[1]) < 1200      # repeats cost little
    wide = [rng.integers(0, 1 << 32, 300).astype(np.uint32)]
    assert coder.read_blocks(coder.write_blocks(wide, 32))[0].tolist() == wide[0].tolist()


def test_blocks_are_independent(monkeypatch):
    """A block's payload is the same whatever is coded beside it, and is read alone."""
    monkeypatch.setattr(coder, "LANE", 64)
    rng = np.random.default_rng(4)
    blocks = [(rng.zipf(1.3, n) % 3000).astype(np.uint32) for n in (5000, 64, 63, 1, 4096, 700)]
    together = coder.write_blocks(blocks)
    assert together == [coder.write_blocks([b])[0] for b in blocks]
    for p, b in list(zip(together, blocks))[::-1]:
        assert coder.read_blocks([p])[0].tolist() == b.tolist()


def test_beats_a_general_compressor_on_prose():
    """Fewer bytes an id than zlib and than the entropy of single ids on texts with words in common."""
    enc = encoder(PATH)
    ids = np.concatenate([enc.ids(prose(i % 150, 300)) for i in range(200)]).astype(np.uint32)
    size = len(coder.write_blocks([ids])[0])
    counts = np.unique(ids, return_counts=True)[1]
    entropy = -(counts * np.log2(counts / len(ids))).sum() / 8
    assert size < len(zlib.compress(ids.astype("<u2").tobytes(), 9)) and size < entropy


def test_order_zero_frequencies():
    rng = np.random.default_rng(5)
    for counts in ([1], [1] * 100_000, [10 ** 6, 1, 1], rng.zipf(1.2, 50_000).clip(0, 10 ** 6)):
        zero = coder._OrderZero.of(np.arange(len(counts)) * 3, np.array(counts))
        assert zero.frequencies.sum() == 1 << zero.bits and zero.frequencies.min() >= 1
        back = coder._OrderZero.unpack(zero.pack())
        assert back.ids.tolist() == zero.ids.tolist() and back.frequencies.tolist() == zero.frequencies.tolist() and back.bits == zero.bits


def test_cells_lead_to_the_owner():
    """A number's cell names its id or the one before it."""
    rng = np.random.default_rng(6)
    for counts in ([1], [7] * 3, rng.zipf(1.2, 2000).clip(0, 10 ** 6)):
        zero = coder._OrderZero.of(np.arange(len(counts)) * 2, np.array(counts))
        owner = np.repeat(np.arange(len(counts)), zero.frequencies)
        first = zero.owners()[np.arange(len(owner)) >> zero.cell]
        assert ((owner == first) | (owner == first + 1)).all() and zero.cell <= int(zero.frequencies.min()).bit_length() - 1
        assert zero.place(zero.ids).tolist() == list(range(len(counts)))


def test_damage_is_found():
    payload = bytearray(coder.write_blocks([np.arange(500, dtype=np.uint32)])[0])
    payload[60] ^= 1
    with pytest.raises(ValueError):
        coder.read_blocks([bytes(payload)])
    with pytest.raises(ValueError):
        coder.read_blocks([b"\0" * 40])


@given(st.binary(max_size=40), st.binary(max_size=40))
def test_checksums_join(a, b):
    assert coder.join_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def check(spark, docs):
    enc, at = encoder(PATH), 0
    got = coder.digests(spark, docs, PATH).collect()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == [r["doc_id"] for r in rows]
    pool = {}
    for r in rows:
        ids = np.append(enc.ids(r["text"]).astype("<u4"), np.uint32(1))
        pool.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in by_start:
        assert r["start"] == at
        pool[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
        at += r["n_tokens"]


def test_files_match_the_tokenizer(spark, documents):
    check(spark, documents)


def test_files_with_edge_texts(spark, make_docs):
    rows = [(None, "null id", "s"), (5, None, "s"), (4, "", "s"), (3, prose(1, 20_000), "s"), (2, "same", "s"), (2, "same", "s"), (1, '" "', "s")]
    check(spark, make_docs(rows).withColumnRenamed("lang", "start"))
    assert coder.digests(spark, make_docs([]), PATH).count() == 0
