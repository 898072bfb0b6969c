"""Packing and piece encoding against the tokenizer libraries."""

import zlib

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from inkwell.llm import packing, sentencepiece_bpe

ODD = [
    "", " ", "a", "  a  b ", "a\tb\n c", "▁x ▁", "ﬁ é Å ½ é", "<s> </s> <unk> <|endoftext|>x", "\x00z", "a　b　 c", "word " * 3000, "x" * 3000,
    " " * 400, "ab" * 2000, "emoji 😀😀 ok\n\nnext  line \n", "it's we'll I'M don't", "梦 дом 12345 1,000.50", "a b  c",
]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_bpe.PieceModel(public.path("piece_bpe_32k.model")), sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("text", ODD)
def test_piece_ids_are_those_of_the_library(pieces, text):
    own, library = pieces
    ids = library.encode(text) + [2]
    assert next(sentencepiece_bpe.encode_texts(own, [text])) == (len(ids), " ".join(map(str, ids)), library.decode(ids))


def test_long_words_merge_as_short_ones(pieces):
    own, _ = pieces
    for word in ("▁the", "▁▁▁▁▁▁▁▁▁▁▁▁a", "▁internationalisation", "▁xéy\tz"):
        assert own.merge_long(word) == own.merge_rounds([word])[0]


@pytest.mark.parametrize("text", ODD)
def test_byte_tokens_are_those_of_the_library(text):
    tokens = packing.ByteTokens()
    want = Tokenizer.from_file(public.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encode_all([text])[0], dtype="<u4").tolist() == want


def test_piece_query_rows(spark, frame):
    rows = [(1, "a b"), (2, None), (None, "a b"), (1, "a b"), (3, "")]
    out = sentencepiece_bpe.encode_documents(frame(rows), "piece_bpe_32k.model").collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["decoded"]) for r in out) == [(0, 3, "a b"), (1, 3, "a b"), (1, 3, "a b"), (2, 1, ""), (3, 1, "")]
    assert sentencepiece_bpe.encode_documents(frame([]), "piece_bpe_32k.model").count() == 0


def test_packing_holds_every_piece_once(spark, frame):
    rows = [(i, "word " * (i * 7 % 900)) for i in range(300)] + [(None, None), (5, "x"), (5, "x"), (999, "long text " * 3000)]
    out = packing.pack_documents(frame(rows)).toPandas()
    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for i, text in ((999, rows[-1][1]), (7, rows[7][1])):
        ids = whole.encode(text, add_special_tokens=False).ids + [2]
        own = out[out.doc_id == i].sort_values("piece")
        assert own.length.sum() == len(ids) and list(own.start) == list(own.length.cumsum() - own.length)
        assert (own.length[1:] == 1024).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    for _, group in out.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert list(group.offset) == list(group.length.cumsum() - group.length) and group.length.sum() <= 1024
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 1024) + 3
    assert packing.pack_documents(frame([])).count() == 0


def test_plan_is_as_good_as_plain_best_fit():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(300, 700, 3000), np.minimum(rng.lognormal(5.5, 1, 4000).astype(int) + 2, 1024)):
        counts = np.bincount(lengths, minlength=1025)
        groups = packing.plan_sequences(counts)
        assert (sum(p * n for p, n in groups) == counts).all()
        bins = []
        for size in sorted(lengths.tolist(), reverse=True):
            fit = min((b for b in range(len(bins)) if bins[b] >= size), key=lambda b: bins[b], default=None)
            if fit is None:
                bins.append(1024 - size)
            else:
                bins[fit] -= size
        assert sum(n for _, n in groups) <= len(bins) * 1.005


def test_packing_keeps_the_columns_of_the_caller(frame):
    rows = [(i, 300 + i % 5, "a", i, "b", -1, -1) for i in range(40)] + [(40, None, None, None, None, None, None), (41, 2000, "c", 1, "d", -1, -1)]
    schema = "key long, length int, pack_salt string, pack_number int, pack_place string, sequence_id int, offset int"
    out = {r["key"]: r for r in packing.pack(frame(rows, schema), "length", ["key"]).collect()}
    assert len(out) == len(rows)
    for row in rows:
        own = out[row[0]]
        assert (own["key"], own["length"], own["pack_salt"], own["pack_number"], own["pack_place"]) == row[:5]
    assert out[40]["sequence_id"] is None and out[41]["offset"] is None
    placed = {}
    for i in range(40):
        placed.setdefault(out[i]["sequence_id"], []).append((out[i]["offset"], out[i]["length"]))
    for held in placed.values():
        held.sort()
        assert [at for at, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= 1024
