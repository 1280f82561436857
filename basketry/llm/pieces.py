"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protobuf; its pieces, scores, normaliser and flags are read from it and rebuilt as a
tokenizers pipeline: character map, white space as the metaspace mark, unigram scores or merges in the order of
their scores, bytes for what the vocabulary lacks. Texts are cut before each run of marks, where no
piece can cross, and each distinct word of some megabytes of texts is encoded once, by several threads. Pieces
are spelled out again by looking up their bytes.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
BATCH_BYTES = 8 << 20  # texts whose distinct words are encoded together
WORDS = 20_000  # words given to the threads at once
# Kinds of pieces and models in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of every field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: object = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = message[at : at + size]
            at += size
        yield key >> 3, value


def parse_model(content: bytes) -> dict:
    """Pieces (text, score, kind), model kind, byte fallback, and the normaliser of a model file."""
    model = {"pieces": [], "kind": UNIGRAM, "bytes": False, "charmap": b"", "prefix": True, "squeeze": True, "escape": True}
    for number, value in _fields(content):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
            model["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            trainer = dict(_fields(value))
            model["kind"] = trainer.get(3, UNIGRAM)
            model["bytes"] = bool(trainer.get(35, 0))
        elif number == 3:
            rules = dict(_fields(value))
            model["charmap"] = rules.get(2, b"")
            model["prefix"], model["squeeze"], model["escape"] = (bool(rules.get(k, 1)) for k in (3, 4, 5))
    return model


def build_tokenizer(content: bytes):
    """A ``tokenizers.Tokenizer`` that encodes and decodes as the model file says."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = parse_model(content)
    if model["kind"] not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    pieces = model["pieces"]
    unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
    usable = {text: (score, i) for i, (text, score, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    if model["kind"] == UNIGRAM:
        lowest = min(score for score, _ in usable.values())
        # Control pieces must never come out of a text.
        vocab = [(text, score if kind in (NORMAL, USER) else lowest - 1e6) for text, score, kind in pieces]
        core = models.Unigram(vocab, unknown, model["bytes"])
    else:
        merges = []
        for text, (score, rank) in usable.items():
            for cut in range(1, len(text)):
                left, right = text[:cut], text[cut:]
                if left in usable and right in usable:
                    merges.append((-score, rank, usable[left][1], left, right))
        merges.sort()
        core = models.BPE(
            {text: i for i, (text, _, _) in enumerate(pieces)}, [m[3:] for m in merges],
            unk_token=pieces[unknown][0], fuse_unk=True, byte_fallback=model["bytes"],
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model["charmap"])] if model["charmap"] else []
    if model["squeeze"]:
        steps += [normalizers.Replace(Regex(r"^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["prefix"]:
        steps.append(normalizers.Prepend(MARK if model["escape"] else " "))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model["escape"] and not any(MARK in text.lstrip(MARK) for text in usable):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model["prefix"]:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    return tokenizer


class Coder:
    """A model's tokenizer, applied to Arrow columns of texts and lists of pieces."""

    def __init__(self, content: bytes):
        model = parse_model(content)
        self.whole = build_tokenizer(content)
        self.core = build_tokenizer(content)
        self.core.normalizer = self.core.pre_tokenizer = None
        self.cut = self.whole.pre_tokenizer is not None
        self.plain = model["escape"] and not model["squeeze"] and not model["charmap"]
        self.prefix = model["prefix"]
        byte = [re.fullmatch("<0x([0-9A-Fa-f]{2})>", text) for text, _, _ in model["pieces"]]
        spelled = [bytes.fromhex(b[1]) if b else text.replace(MARK, " ").encode() for b, (text, _, _) in zip(byte, model["pieces"])]
        # A second time as the first piece of a text.
        self.spelled = pa.array(spelled + [s.removeprefix(b" ") if self.prefix else s for s in spelled], pa.binary())

    def _normal(self, texts: pa.Array) -> pa.Array:
        """The texts as the model normalises them. Empty ones stay so."""
        if self.plain:
            normal = pc.replace_substring(texts, " ", MARK) if not self.cut else texts
            if self.prefix:
                first = MARK if not self.cut else " "
                normal = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(first, normal, ""))
            return normal
        return pa.array([self.whole.normalizer.normalize_str(t) if t else "" for t in texts.to_pylist()], pa.string())

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The pieces of every text; none of an empty one."""
        texts = self._normal(texts)
        if self.cut:
            texts = pc.replace_substring(texts, MARK, " ")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        begins = np.zeros(len(data) + 1, bool)
        if self.cut:
            begins[:-1] = data == 0x20
            begins[1:-1] &= data[:-1] != 0x20
        begins[offsets] = True
        begins = np.flatnonzero(begins)
        words = pa.Array.from_buffers(
            pa.string(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(data)]
        ).dictionary_encode()
        known = words.dictionary
        known = (pc.replace_substring(known, " ", MARK) if self.cut else known).to_pylist()
        ids = []
        for first in range(0, len(known), WORDS):
            ids += [e.ids for e in self.core.encode_batch_fast(known[first : first + WORDS], add_special_tokens=False)]
        taken = pa.array(ids, pa.list_(pa.int32())).take(words.indices)
        ends = taken.offsets.to_numpy()[np.searchsorted(begins, offsets)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken.flatten())

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The texts that lists of pieces stand for."""
        offsets, places = ids.offsets.to_numpy(), ids.flatten().to_numpy().copy()
        places[offsets[:-1][offsets[:-1] < offsets[1:]] - offsets[0]] += len(self.spelled) // 2
        spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), self.spelled.take(pa.array(places))), b"")
        try:
            return spelled.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no character
            return pa.array(self.whole.decode_batch(ids.to_pylist(), skip_special_tokens=False), pa.string())


@lru_cache(maxsize=2)
def _cached(content: bytes) -> Coder:
    return Coder(content)


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model file's bytes (a vocabulary: well below a megabyte), from this machine or any store Spark reads."""
    if os.path.exists(path):
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def _pieces(content: bytes, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        coder = _cached(content)
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            cuts = np.unique([0, *(np.flatnonzero(np.diff(size // BATCH_BYTES)) + 1), len(batch)]).tolist()
            for first, end in zip(cuts[:-1], cuts[1:]):
                some = batch.slice(first, end - first)
                ids = coder.encode(pc.fill_null(some.column("text"), "").cast(pa.string()))
                yield pa.RecordBatch.from_arrays([some.column("row"), ids, coder.decode(ids)], ["row", "piece_ids", "decoded"])
            # Workers live on between tasks: what Arrow keeps for later goes back.
            pa.default_memory_pool().release_unused()

    return run


def encode(documents: DataFrame, model_path: str, carry: list[str] | None = None, threads: int = 2) -> DataFrame:
    """``(*carry, piece_ids, n_pieces, decoded, round_trip)`` of every row of ``documents`` (text, ...).

    Whole texts are encoded. ``decoded`` is the text that ``piece_ids`` stand for, ``round_trip`` whether it is the
    original (a model that normalises changes some texts). NULL and empty texts have no pieces and
    decode to the empty text. ``carry`` names columns to pass through (``doc_id`` by default).
    """
    carry = carry or ["doc_id"]
    content = read_model(documents.sparkSession, model_path)
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.sha2("text", 256).alias("digest"))
    rows = documents.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, piece_ids array<int>, decoded string"
    done = rows.mapInArrow(_pieces(content, threads), schema)
    return done.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)],
        "piece_ids",
        F.size("piece_ids").alias("n_pieces"),
        "decoded",
        (F.sha2("decoded", 256) == F.coalesce("row.digest", F.sha2(F.lit(""), 256))).alias("round_trip"),
    )
