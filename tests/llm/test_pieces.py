"""Pieces of distinct words put together, against the tokenizer on whole texts."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = [
    "", " ", "  ", "a", " ab", "ab ", "  a  b  ab ", "▁", "▁▁a ▁b", "a▁b", "日本語 テキスト", "\x00 \x01", "🎉🏽 x", "\n\n a\n  b\tc", "<0x41> <s>",
    " " * 50 + "z", "a" * 3000, "ab a " * 500,
]


def _field(number: int, value) -> bytes:
    if isinstance(value, int):
        return bytes([number << 3, value])
    kind, size = (5, b"") if isinstance(value, float) else (2, bytes([len(value)]))
    return bytes([number << 3 | kind]) + size + (struct.pack("<f", value) if kind == 5 else value)


def _unigram(*rules: int) -> bytes:
    """A small model whose normaliser has the flags prefix, squeeze, escape."""
    content = b""
    for text, score, kind in [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("▁ab", -1.5, 1), ("b", -2.0, 1), ("▁", -3.0, 1), ("a", -2.5, 1)]:
        content += _field(1, _field(1, text.encode()) + _field(2, score) + _field(3, kind))
    flags = b"".join(_field(3 + i, rule) for i, rule in enumerate(rules))
    return content + _field(2, _field(3, 1)) + _field(3, flags)


@pytest.mark.parametrize("rules", [None, (1, 1, 1), (1, 0, 1), (0, 0, 1), (0, 1, 1), (1, 0, 0)])
def test_words_put_together_are_the_whole_texts(rules):
    content = open(MODEL, "rb").read() if rules is None else _unigram(*rules)
    whole, coder = pieces.build_tokenizer(content), pieces.Coder(content)
    for texts in (TEXTS, [""], [], TEXTS[3:9]):
        ids = [e.ids if t else [] for t, e in zip(texts, whole.encode_batch_fast(texts, add_special_tokens=False))]
        got = coder.encode(pa.array(["cut off", *texts], pa.string()).slice(1))
        assert got.to_pylist() == ids
        assert coder.decode(got).to_pylist() == whole.decode_batch(ids, skip_special_tokens=False)


def test_any_pieces_are_spelled_out():
    content = open(MODEL, "rb").read()
    whole, coder = pieces.build_tokenizer(content), pieces.Coder(content)
    draw = np.random.default_rng(3)
    ids = [draw.integers(0, 32000, draw.integers(0, 20)).tolist() for _ in range(500)]
    ids += [[203, 68], [229, 153, 132], [35], [35, 35], []]  # bytes that are no character, a mark, spaces
    for some in (ids, [[300, 4000], [], [35, 300]]):
        assert coder.decode(pa.array(some, pa.list_(pa.int32()))).to_pylist() == whole.decode_batch(some, skip_special_tokens=False)


def test_equal_words_are_encoded_once(monkeypatch):
    coder, given = pieces.Coder(open(MODEL, "rb").read()), []

    class Core:
        encode_batch_fast = staticmethod(lambda words, core=coder.core, **options: given.extend(words) or core.encode_batch_fast(words, **options))

    coder.core = Core
    coder.encode(pa.array(["one two one"] * 1000 + ["two one"] * 1000))
    assert sorted(given) == ["▁one", "▁two"]


def test_long_batches_are_cut_between_texts(monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_BYTES", 100)
    monkeypatch.setattr(pieces, "WORDS", 3)
    content = open(MODEL, "rb").read()
    batch = pa.RecordBatch.from_arrays([pa.array([None, *TEXTS]), pa.array(range(len(TEXTS) + 1))], ["text", "row"])
    done = pa.Table.from_batches(pieces._pieces(content, 1)(iter([batch, batch.slice(0, 0)])))
    whole = pieces.build_tokenizer(content)
    assert done.column("row").to_pylist() == batch.column("row").to_pylist()
    assert done.column("piece_ids").to_pylist() == [[], *[e.ids if t else [] for t, e in zip(TEXTS, whole.encode_batch_fast(TEXTS, add_special_tokens=False))]]
