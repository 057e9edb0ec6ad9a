import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from strataforge.llm import bpe, packing

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def library(path=RANKS):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(path, texts):
    data = [x.encode() for x in texts]
    off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    ids, counts, _ = bpe.encoder(path).encode(np.frombuffer(b"".join(data), np.uint8), off)
    cut = np.concatenate(([0], np.cumsum(counts)))
    return [ids[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)]


ALPHABET = [*"abcderstvlm'   \n\t\r019 .,!é ß中  \U0001f600\x00\x1c", "'re", "'ve", "'ll", "'s", " '", "<|endoftext|>"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join), max_size=8))
def test_ids_equal_the_libraries(texts):
    lib = library()
    assert encode(RANKS, texts) == [lib.encode_ordinary(x) for x in texts]
    hf = tokenizers.Tokenizer.from_file(JSON)
    hf.encode_special_tokens = True
    assert encode(JSON, texts) == [x.ids for x in hf.encode_batch(texts, add_special_tokens=False)]


def test_every_code_point_is_cut_as_the_library_cuts():
    ranks = {bytes([i]): i for i in range(256)}
    ranks |= {b"a" + bytes([i]): 256 + i for i in range(256)}
    ranks |= {b"1" + bytes([i]): 600 + i for i in range(256) if i != 97}
    lib = tiktoken.Encoding("probe", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = bpe.kinds_table()
    for cp in [*range(0xD800), *range(0xE000, 0x20000), *range(0x2FA00, 0x110000, 97)]:
        c = chr(cp)
        letter, digit = lib.encode_ordinary("a" + c)[0] >= 256, lib.encode_ordinary("1" + c)[0] >= 256
        assert (table[cp] in bpe._LETTERS, table[cp] == bpe.DIGIT) == (letter, digit), hex(cp)


def test_scan_equals_the_automaton_step_by_step():
    rnd = random.Random(3)
    kinds = np.array([rnd.randrange(12) for _ in range(3000)], np.uint8)
    state, want = bpe.AFRESH, []
    for k in kinds.tolist():
        state = bpe._step(state, k)
        want.append(state)
    for width in (2, 7, 256):
        assert bpe.states_after(kinds, width).tolist() == want


def test_long_slices_and_another_vocabulary():
    rnd = random.Random(1)
    texts = ["a" * 3000, "".join(rnd.choice("abcdefgh") for _ in range(8000)), "x " * 500]
    lib = library()
    assert encode(RANKS, texts) == [lib.encode_ordinary(x) for x in texts]
    multi = P.path("byte_bpe_multi_50k.tiktoken")
    assert encode(multi, ["Пример текста", "mixed текст 12"]) == [library(multi).encode_ordinary(x) for x in ["Пример текста", "mixed текст 12"]]


def mirrored(steps):
    """Two words of the same length that every polynomial hash modulo 2^64 confuses from ten steps on."""
    out = []
    for a, b in ("ab", "ba"):
        word = a
        for _ in range(steps):
            word += word.translate(str.maketrans(a + b, b + a))
        out.append(word)
    return out


@pytest.mark.parametrize("few", [False, True])
def test_cached_slices_are_compared_byte_by_byte(monkeypatch, few):
    if few:  # a hash of a few values only: nearly all slices meet a stranger's
        real = bpe.byte_hashes
        monkeypatch.setattr(bpe, "byte_hashes", lambda *a: real(*a) % np.uint64(11))
    texts = [*mirrored(9), *mirrored(10), *mirrored(11), "one two three four", "once upon a time, two", "", "four three"]
    own = bpe.Encoder(RANKS)
    lib = library()
    for batch in (texts, texts[::-1], texts[4:]):
        data = [x.encode() for x in batch]
        off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
        ids, counts, _ = own.encode(np.frombuffer(b"".join(data), np.uint8), off)
        cut = np.concatenate(([0], np.cumsum(counts)))
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)] == [lib.encode_ordinary(x) for x in batch]


def test_columns_of_encode_and_decode(spark):
    rows = [(1, "Hello world's end\n\n ok", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (4, "wörd " * 3000, None)]
    df = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, n string"), RANKS)
    lib = library()
    for r in bpe.decode(df, RANKS).collect():
        text = r.text or ""
        assert r.ids == lib.encode_ordinary(text) and bytes(r.decoded) == text.encode()
        whole = [len(lib.decode_bytes(r.ids[:k])) for k in range(min(len(r.ids), 20))]
        assert r.offsets[:20] == whole
    with pytest.raises(ValueError):
        bpe.encode(df, RANKS)


def test_digests(spark):
    rows = [(1, "It's 5 o'clock"), (2, None), (2, ""), (None, "null id"), (5, "ü" * 70000)]
    got = {(r.doc_id, r.ids_sha256): r for r in bpe.round_trip_digests(spark.createDataFrame(rows, "doc_id long, text string"), RANKS).collect()}
    lib = library()
    for i, text in rows:
        ids = np.array(lib.encode_ordinary(text or ""), "<u4")
        r = got[i, hashlib.sha256(ids.tobytes()).hexdigest()]
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip_digests(spark.createDataFrame([], "doc_id long, text string"), RANKS).count() == 0


def test_packing_covers_every_id_once(spark):
    import zlib

    rnd = random.Random(2)
    rows = [(i, None if i % 9 == 0 else "".join(rnd.choice("ab c'\n") for _ in range(rnd.choice([0, 3, 200, 4000])))) for i in range(60)] + [(7, "twice"), (7, "twice")]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, start string, offset int").repartition(3)
    got = packing.pack(df, JSON, 64, 0).collect()
    hf = tokenizers.Tokenizer.from_file(JSON)
    hf.encode_special_tokens = True
    want = sorted((i, zlib.crc32(np.array(hf.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))) for i, t in rows)
    by_seq, whole = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = []
    for s in sorted(by_seq):
        at = 0
        for offset, length in sorted(by_seq[s]):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert sorted(by_seq) == list(range(len(by_seq))) and all(x == 64 for x in sizes[:-1]) and sizes[-1] <= 64
    assert sum(sizes) == sum(len(hf.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    single = sorted((r.doc_id, r.ids_crc32) for r in got if r.length == r.doc_tokens)
    assert set(single) <= set(want)
    for r in got:
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for (i, n), parts in whole.items():
        assert sum(x for _, x in parts) % n == 0, i
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), JSON).count() == 0


def test_piece_digests(spark):
    import zlib

    text = "one two three four five six seven eight nine ten"
    got = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), JSON, 4, 0).orderBy("start").collect()
    ids = np.array([*tokenizers.Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids, 0], "<u4")
    for r in got:
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length]) and r.doc_tokens == len(ids)
