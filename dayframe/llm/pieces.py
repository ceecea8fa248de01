"""SentencePiece encoding and decoding with the tokenizers library.

The model file (a protocol buffer) is parsed here; its normaliser, boundary marks, pieces, scores
and byte fallback are rebuilt as a tokenizers pipeline (BPE or unigram) that encodes in batches
with several threads. Where no piece continues behind a word boundary, a text's ids are its chunks'
ids (a run of spaces with what follows): new chunks go through the pipeline in one batch, and their
ids are remembered. Every text can be verified against the sentencepiece library.
"""

from __future__ import annotations

import re
import struct
import zlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .tokens import WordEncoder, text_slices

MARK = "▁"
# Piece and model types of the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
CHUNK = re.compile(rb" +[^ ]*|^[^ ]+")
PART = 1 << 14  # bytes of new chunks that are handed over as one text


def fields(raw: bytes):
    """(number, value) of every field of a message: int, 4 or 8 raw bytes, or bytes."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = raw[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, raw[i:i + size]
        i += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse_spaces: bool = True


def parse_model(raw: bytes) -> Model:
    m = Model()
    for number, value in fields(raw):
        if number == 1:
            f = dict(fields(value))
            score = struct.unpack("<f", f[2])[0] if 2 in f else 0.0
            m.pieces.append((f[1].decode("utf-8"), score, f.get(3, NORMAL)))
        elif number == 2:
            f = dict(fields(value))
            m.kind = f.get(3, UNIGRAM)
            m.byte_fallback = bool(f.get(35, 0))
            m.unknown = f.get(40, 0)
        elif number == 3:
            f = dict(fields(value))
            m.charsmap = f.get(2, b"")
            m.dummy_prefix = bool(f.get(3, 1))
            m.collapse_spaces = bool(f.get(4, 1))
    return m


def normaliser(m: Model, first: bool = True):
    """The model's normaliser as a tokenizers one: character map, spaces, boundary marks. Only the
    ``first`` chunk of a text gets the mark in front."""
    from tokenizers import Regex, normalizers as n
    steps = [n.Precompiled(m.charsmap)] if m.charsmap else []
    if m.collapse_spaces:
        steps += [n.Replace(MARK, " "), n.Replace(Regex(" +"), " "), n.Replace(Regex("^ | $"), "")]
    if m.dummy_prefix and first:
        steps.append(n.Prepend(MARK))  # an empty text stays empty
    return n.Sequence([*steps, n.Replace(" ", MARK)])


def backend(m: Model, first: bool = True):
    """The model as a tokenizers pipeline for whole texts (or for chunks)."""
    from tokenizers import Tokenizer, models
    if m.kind == UNIGRAM:
        made = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], m.unknown,
                                        m.byte_fallback))
    else:
        ids = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        merges = []
        for i, (p, score, kind) in enumerate(m.pieces):
            if kind in (NORMAL, USER):
                merges += [(-score, i, ids[p[:k]], p[:k], p[k:]) for k in range(1, len(p))
                           if p[:k] in ids and p[k:] in ids]
        merges.sort()
        made = Tokenizer(models.BPE(
            ids, [(a, b) for *_, a, b in merges], fuse_unk=True,
            unk_token=m.pieces[m.unknown][0], byte_fallback=m.byte_fallback))
    made.normalizer = normaliser(m, first)
    return made


class PieceEncoder(WordEncoder):
    """Encodes and decodes whole texts with a SentencePiece model.

    Texts go by chunks if that changes no id: no piece continues behind a boundary mark, spaces are
    kept as they are, and there is no character map. Else each text goes whole.
    """

    def __init__(self, path: str, part: int = PART):
        with open(path, "rb") as f:
            m = self.spec = parse_model(f.read())
        self.part = part
        self.by_chunk = m.byte_fallback and not m.charsmap and not m.collapse_spaces and all(
            MARK not in p.lstrip(MARK) for p, _, kind in m.pieces if kind in (NORMAL, USER))
        self._use(backend(m, first=not self.by_chunk))
        self.opens = np.array([p.startswith(MARK) for p, _, _ in m.pieces])
        self.blank = np.array([not p.strip(MARK) for p, _, _ in m.pieces])
        spell = [self._bytes(p, kind) for p, _, kind in m.pieces]
        self.piece_sizes = np.array([len(x) for x in spell], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(spell), np.uint8)

    @staticmethod
    def _bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()

    def _direct_words(self):
        return None, {}  # see _ids

    def split(self, text: bytes) -> list[bytes]:
        text = text.replace(MARK.encode(), b" ")
        return CHUNK.findall(b" " + text if self.spec.dummy_prefix and text else text)

    def _grouped(self, chunks: list[bytes]) -> list[list[bytes]]:
        """The chunks in order, in groups of about ``part`` bytes. One without a space in front or
        without anything behind its spaces is a group of its own."""
        groups: list[list[bytes]] = []
        held = self.part
        for c in chunks:
            alone = c[:1] != b" " or c[-1:] == b" "
            if alone or held >= self.part:
                groups.append([])
                held = 0
            groups[-1].append(c)
            held = self.part if alone else held + len(c)
        return groups

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks' ids by one batch. A group is one text: a chunk begins there with a piece that has
        a boundary mark in front and does not follow another mark."""
        groups = self._grouped(words)
        ids, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(
                [b"".join(g).decode("utf-8") for g in groups], add_special_tokens=False), strict=True):
            got = np.array(e.ids, np.int32)
            begins = self.opens[got]
            begins[1:] &= ~self.blank[got[:-1]]
            at = np.flatnonzero(begins) if len(group) > 1 else np.zeros(1, np.int64)
            if len(at) != len(group):
                raise RuntimeError("a piece reaches over a word boundary")
            ids.append(got)
            sizes.append(np.diff(at, append=len(got)))
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and their number per text."""
        if self.by_chunk:
            return super().encode(texts)
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(
            [t.decode("utf-8") for t in texts], add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of ids (one after the other; ``counts`` per text), as UTF-8."""
        sizes = self.piece_sizes[ids]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        size = np.int32 if total < 1 << 31 else np.int64
        where = np.repeat((self.piece_starts[ids] - ends + sizes).astype(size), sizes)
        where += np.arange(total, dtype=size)
        raw = self.piece_bytes[where].tobytes()
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        skip = 1 if self.spec.dummy_prefix else 0
        return [raw[a + min(skip, b - a):b] for a, b in zip(edges, edges[1:], strict=False)]


_encoders: dict[str, tuple] = {}


def _encoder(path: str, threads: int, verify: bool):
    """This worker's encoder and, to verify, the sentencepiece processor."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    if path not in _encoders:
        processor = None
        if verify:
            import sentencepiece
            processor = sentencepiece.SentencePieceProcessor(model_file=path)
        _encoders[path] = PieceEncoder(path), processor
    return _encoders[path]


ENCODED = ("doc_id long, ids array<int>, n_tokens long, ids_crc32 long, parity boolean, "
           "round_trip boolean")


def encode(docs: DataFrame, model: str, threads: int = 2, verify: bool = True) -> DataFrame:
    """Encode every whole text, decode it again, and compare.

    ``threads`` is for the tokenizers batches. ``docs`` needs doc_id and text; other columns are
    ignored, whatever their names. Row by row returns doc_id, ids, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), parity (the tokenizers ids equal the sentencepiece library's; NULL without
    ``verify``) and round_trip (the decoded ids are the text). A text without parity keeps its
    tokenizers ids, and the flag says so. NULL text is empty and has no ids. Rows with equal doc_id are
    encoded one by one; an empty table gives an empty result. No shuffle; a task holds about a
    megabyte of text at a time, or one longer text.
    """
    def run(batches):
        enc, processor = _encoder(model, threads, verify)
        for doc_ids, texts in text_slices(batches):
            ids, counts = enc.encode(texts)
            ends = np.cumsum(counts)
            parity: list = [None] * len(texts)
            if processor is not None:
                other = processor.encode([t.decode("utf-8") for t in texts])
                flat = ids.tolist()
                parity = [flat[e - n:e] == o for e, n, o in zip(
                    ends.tolist(), counts.tolist(), other, strict=True)]
            back = enc.decode(ids, counts)
            raw = ids.astype("<u4")
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(doc_ids, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                pa.array(counts, pa.int64()),
                pa.array([zlib.crc32(raw[e - n:e].tobytes()) for e, n in zip(
                    ends, counts, strict=True)], pa.int64()),
                pa.array(parity, pa.bool_()),
                pa.array([a == b for a, b in zip(back, texts, strict=True)], pa.bool_())],
                names=["doc_id", "ids", "n_tokens", "ids_crc32", "parity", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, ENCODED)
