"""Token files: packing, order and offsets, random access, equality with the tokenizer on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quaymart.llm import token_files

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    JSON = file.read()


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 31, 32])
def test_packing(bits):
    rnd = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1000):
        ids = rnd.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        raw = token_files.pack(ids, bits)
        assert len(raw) == token_files.packed_size(n, bits)
        assert (token_files.unpack(raw, n, bits) == ids).all()


def test_units_equal_whole_texts():
    tokenizer = Tokenizer.from_str(JSON)
    rnd = random.Random(3)
    letters = "abc 's 'll  \n\t 　é日🙂\x001 9!?<|endoftext|> don't\r\n \x0b\x85 "
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(800)] + ["<|endoftext|>", "a <|endoftext|> b", ""]
    ids, begins = token_files.UnitEncoder(JSON).encode(pa.array(texts, pa.large_string()))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == want


def test_files(spark, wide, rows, empty):
    tokenizer = Tokenizer.from_str(JSON)
    manifest = token_files.write(wide, JSON, files=3)
    got = token_files.read_back(spark, manifest).orderBy("start").collect()
    want, at = [], 0
    for doc, text in sorted((r[0], r[1] or "") for r in rows):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in got] == want
    for part in manifest.collect():
        where, name = token_files._open(part.file)
        reader = token_files.FileReader(where, name)
        whole = reader.ids(0, reader.count)
        rnd = random.Random(1)
        for _ in range(20):
            a = rnd.randrange(reader.count + 1)
            b = rnd.randrange(a, reader.count + 1)
            assert (reader.ids(a, b) == whole[a:b]).all()
    assert token_files.read_back(spark, token_files.write(empty, JSON, files=2)).count() == 0


def test_missing_ids(spark):
    """A missing id comes first and stays missing; -1 is an id like any other."""
    df = spark.createDataFrame([(-1, "a b"), (None, "c"), (-7, "d"), (0, None), (None, "e f g")], "doc_id bigint, text string")
    got = token_files.read_back(spark, token_files.write(df, JSON, files=2)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -7, -1, 0]
    assert got[-1].n_tokens == 1
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(5)]


def test_units_forgotten(monkeypatch):
    """Ids do not depend on what the encoder has met before or has forgotten."""
    monkeypatch.setattr(token_files, "KNOWN_UNITS", 20)
    monkeypatch.setattr(token_files, "AT_ONCE", 3)
    tokenizer, encoder, rnd = Tokenizer.from_str(JSON), token_files.UnitEncoder(JSON), random.Random(4)
    for _ in range(12):
        texts = [" ".join(f"unit{rnd.randrange(40)}" for _ in range(rnd.randrange(9))) + rnd.choice(["", "  x", "\ty "]) for _ in range(6)]
        ids, begins = encoder.encode(pa.array(texts, pa.large_string()), 2)
        want = [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == want


def test_closed_encoder_holds_nothing():
    """Worker processes are used again, so what a task leaves behind adds to the next one."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = token_files.UnitEncoder(file.read())
    text = pa.array([" ".join(f"unit{i}" for i in range(200_000))], pa.large_string())
    before = pa.total_allocated_bytes()
    encoder.encode(text, 2)
    held = pa.total_allocated_bytes() - before
    encoder.close()
    assert held > 2_000_000
    assert pa.total_allocated_bytes() - before < held / 10 and sum(map(len, encoder.flat)) == 1 and encoder.tokenizer is None
