"""Token ids: pieces against whole texts, packing, and files of planes."""

import io
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tokenizers import AddedToken, Tokenizer

from maskwright.llm import bitplanes, packing
from maskwright.llm.catalog import tokenizer
from maskwright.llm.tokens import Encoder, with_end
from maskwright.session import scratch_path

ODD = ["  lead", "trail  ", "a  b", "a\tb c\t d", "x  y z", "\n\n\nq\r\nw", "a\x1c b\x1cc d", "", " ", "a \n b\n", "\n",
       "I'll don't 's 's", "<|endoftext|> a <|startoftext|>b", "x <|endoftext|> y", "x  <|endoftext|>\n\n y<|startoftext|><|endoftext|>",
       "<|endoftext|>", " <|ENDOFTEXT|> <|endoftext|", "a<|endoftext|>  b <|endoftext|>\n", "ΣΑΣ ΟΔΟΣ, ΑΣ.", "é e ́x", "日本語 テスト  123 4567 !!",
       "　全角　 space", None, "word " * 3000, "x" * 5000, "ALL\nCAPS and  ’quotes’ "]


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def encoder(request):
    return Encoder(tokenizer(request.param[0])(), request.param[1])


@cache
def library(gaps):
    return Tokenizer.from_file(tokenizer("byte_bpe_50k.json" if gaps else "word_bpe_49k.json")())


def whole(encoder, texts):
    """Ids of whole texts by the library alone, from the file."""
    return [e.ids for e in library(encoder.gaps).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_texts(encoder):
    for _ in range(2):  # the second time from the table
        ids, starts = encoder.encode(ODD)
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == whole(encoder, ODD)
    ids, starts = with_end(ids, starts, 7)
    assert ids[starts[1:] - 1].tolist() == [7] * len(ODD)


def test_special_tokens_that_reach_over_cuts(tmp_path):
    fresh = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")())
    fresh.add_special_tokens([AddedToken("<a b>"), AddedToken("<r>", rstrip=True), AddedToken("<l>", lstrip=True)])
    fresh.save(str(tmp_path / "more.json"))
    texts = ["x <a b> y", "x <r>   y z", "x   <l> y", "x <l>  <r>\n<a b>", "plain words"]
    ids, starts = Encoder(str(tmp_path / "more.json"), True).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [
        fresh.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting(encoder, monkeypatch):
    monkeypatch.setattr("maskwright.llm.tokens.MOST_PIECES", 40)
    for turn in range(30):
        texts = [f"the same words {turn} w{turn * 7} x{turn * 3}y often, often {k}" for k in range(6)] + [None]
        ids, starts = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == whole(encoder, texts)
        assert len(encoder.pieces) < 120


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t\r\x1c  abcXYZ'.,!?é ́Σ字12", "<|endoftext|>", "<|startoftext|>"]),
                         max_size=40).map("".join), max_size=5))
def test_any_text(encoder, texts):
    ids, starts = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == whole(encoder, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70), st.sampled_from([1, 8]))
def test_planes(ids, unit):
    held = np.array(ids, np.uint32)
    assert bitplanes.from_planes(bitplanes.to_planes(held, unit), len(held), unit).tolist() == ids


@pytest.mark.parametrize("unit", [1, 8])
def test_file(unit, monkeypatch):
    monkeypatch.setattr(bitplanes, "CHUNK", 50)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 49_408, n).astype(np.uint32) for n in (3, 0, 170, 1, 46, 50, 0)]
    out = io.BytesIO()
    writer = bitplanes.Writer(out, unit)
    for k, ids in enumerate(docs):
        entry = np.zeros(1, bitplanes._DOC)
        entry["doc_id"], entry["known"], entry["n"] = k, 1, len(ids)
        writer.add(ids, entry)
    assert writer.close() == (7, 270)
    file = pa.BufferReader(out.getvalue())
    unit_, chunks, _ = bitplanes.read_index(file)
    assert unit_ == unit and chunks["ids"].tolist() == [50] * 5 + [20]
    read = [(e["doc_id"], x.tolist()) for entries, ids in bitplanes.read_file(file) for e, x in zip(entries, ids)]
    assert read == [(k, ids.tolist()) for k, ids in enumerate(docs)]
    with pytest.raises(ValueError):
        bitplanes.read_index(pa.BufferReader(out.getvalue()[:-1]))


ROWS = [(5, "b c"), (1, "a b c"), (None, "x"), (3, None), (3, ""), (2, "word " * 4000), (5, "b c"), (5, "b c")]


def test_write_and_read(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in ROWS], "doc_id bigint, text string, path string, row_ int")
    find = tokenizer("word_bpe_49k.json")
    files = bitplanes.write_ids(df.repartition(3), scratch_path(spark, "planes"), find, gaps=False, end_id=1, file_bytes=9)
    found = sorted(bitplanes.read_ids(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 3, 5, 5, 5]
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert files.count() > 1 and bitplanes.total_tokens(spark, files) == sum(r.n_tokens for r in found)
    encoder = Encoder(find(), False)
    texts = {i: t for i, t in ROWS}
    for r in found:
        assert np.frombuffer(r.ids, "<u4").tolist() == whole(encoder, [texts[r.doc_id]])[0] + [1]
    none = bitplanes.write_ids(df.limit(0), scratch_path(spark, "planes"), find, gaps=False, end_id=1)
    assert bitplanes.read_ids(none).count() == 0


def check_packed(rows, encoder, end):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length, r.ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return docs, sum(packing.LENGTH - sum(n for _, n in p) for p in sequences.values()), len(sequences)


def test_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    find = tokenizer("byte_bpe_50k.json")
    rows = packing.pack(docs.repartition(4, "doc_id"), find).collect()
    encoder = Encoder(find(), True)
    held, padding, sequences = check_packed(rows, encoder, 0)
    for r in docs.collect():
        pieces = sorted(held[r.doc_id])
        ids = np.concatenate([np.frombuffer(p[2], "<u4") for p in pieces])
        assert ids.tolist() == whole(encoder, [r.text])[0] + [0] and {p[3] for p in pieces} == {len(ids)}
        assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist()
    assert padding < packing.LENGTH  # the partitions are merged in one group


def test_packing_encodes_a_megabyte_of_text_at_a_time(spark, monkeypatch):
    class Letters:
        def encode(self, texts):
            sizes = [len(t) for t in texts]
            assert sum(sizes) <= 1 << 20, "a worker holds too much text"
            return np.ones(sum(sizes), np.uint32), np.cumsum([0, *sizes])

    monkeypatch.setattr(packing, "encoder", lambda path, gaps: Letters())
    docs = spark.range(0, 30, 1, 1).selectExpr("id AS doc_id", "repeat('x', 100000) AS text")
    assert packing.pack(docs, lambda: "none").selectExpr("sum(length)").first()[0] == 30 * 100_001


def test_packing_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id bigint, text string, length int")
    held, _, _ = check_packed(packing.pack(df, tokenizer("byte_bpe_50k.json")).collect(), None, 0)
    assert {i: sum(p[1] for p in held[i]) for i in held if i != 5} == {None: 2, 1: 4, 2: 4002, 3: 2}
    assert zlib.crc32(held[3][0][2]) == zlib.crc32(bytes(4)) and held[3][0][1] == 1
    assert packing.pack(df.limit(0), tokenizer("byte_bpe_50k.json")).count() == 0


def test_bounded_windows_and_merge():
    packer = packing.Packer(2, 100, 3)
    for doc, n in enumerate([60, 70, 80, 90, 10, 250, 40, 100, 1]):
        packer.add(doc, np.zeros(n, np.uint32))
        assert len(packer.free) <= 3
    packer.finish()
    left = [r for r in packer.out if r[-1]]
    assert {r[4] >> 32 for r in packer.out} == {2} and sum(r[2] for r in packer.out) == 701
    full = {}
    for r in packer.out:
        full[r[4]] = full.get(r[4], 0) + r[2]
    assert left and all(full[r[4]] == 100 for r in packer.out if not r[-1])


def test_merged_leftovers():
    rng = np.random.default_rng(3)
    for sizes in ([], [5], [60, 30, 70, 40], [99] * 7, rng.integers(1, 100, 50).tolist()):
        rows, at = [], 0
        for window, size in enumerate(sizes):
            cut = int(rng.integers(1, size + 1))
            for offset, n in ((0, cut), (cut, size - cut)):
                if n:
                    rows.append((window % 3, 7, n, 500, window, offset, np.arange(at, at + n, dtype="<u4").tobytes()))
                    at += n
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        found = packing.merge(pd.DataFrame(rows, columns=names), 100)
        ids = np.concatenate([np.empty(0, "<u4"), *[np.frombuffer(x, "<u4") for x in found["ids"]]])
        assert sorted(ids.tolist()) == list(range(at)) and (found["length"] * 4 == found["ids"].map(len)).all()
        fills = []
        for _, part in found.sort_values("offset").groupby("sequence_id"):
            assert part["offset"].tolist() == np.cumsum([0, *part["length"]])[:-1].tolist()
            fills.append(part["length"].sum())
        assert sum(f < 100 for f in fills) <= 1
        source = {r[6]: r for r in rows}
        for r in found.itertuples():  # a piece lies where its ids lie in the document
            whole = next(b for b in source if r.ids in b)
            assert r.start == 7 + whole.index(r.ids) // 4


def test_words_and_signs_go_to_the_model_alone(monkeypatch):
    find = tokenizer("byte_bpe_50k.json")
    alone = Encoder(find(), True)

    def joined(texts):
        assert not [t for t in texts if t.startswith((" ", "\n"))], "a word went through the whole tokenizer"
        return Encoder._joined(alone, texts)

    monkeypatch.setattr(alone, "_joined", joined)
    texts = ["first Unseenword, unseenword unseenword. naïveté,!! Straße\nßtraße... it''' q\nlines) end.", "x Unseenword naïveté,"]
    for _ in range(2):
        ids, starts = alone.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == whole(alone, texts)


@pytest.mark.parametrize("special", ["word", "word,", ",,", " of", "<w>", "rd,"])
def test_special_tokens_within_words(tmp_path, special):
    fresh = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")())
    fresh.add_special_tokens([AddedToken(special)])
    fresh.save(str(tmp_path / "more.json"))
    texts = ["a word, swords,, of often <w> x<w>, words", "word,\nword,,\n<w> of"]
    ids, starts = Encoder(str(tmp_path / "more.json"), True).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [
        fresh.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_is_sent_a_few_megabytes_at_a_time(spark, monkeypatch):
    small = packing.chunks

    def chunks(batches, *given):
        for batch in batches:
            assert batch.nbytes < 6 << 20, "an executor and its worker hold too much text"
            yield from small([batch], *given)

    monkeypatch.setattr(packing, "chunks", chunks)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        docs = spark.range(0, 120, 1, 1).selectExpr("id AS doc_id", "repeat('x ', 50000) AS text")
        assert packing.pack(docs, tokenizer("byte_bpe_50k.json")).selectExpr("count(distinct doc_id)").first()[0] == 120
    finally:
        spark.conf.set(name, before)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None
