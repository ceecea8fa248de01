"""Token ids in fixed-width packed files with random access.

A file holds blocks of up to ``BLOCK`` ids, each id in the fewest bits that hold the vocabulary,
64 ids in exactly ``width`` 64-bit words, so that whole blocks unpack with a few numpy shifts. The
footer has the blocks' byte offsets and the documents' ids and lengths. Any stretch of ids is read
from just the blocks that hold it.

    header: MAGIC
    blocks: little-endian uint64 words
    footer: block offsets (uint64), doc ids (int64), doc id is NULL (uint8), doc lengths (int64)
    tail:   n_ids, n_docs, n_blocks, footer offset (uint64), width, block size (uint32), MAGIC
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, shared_path, stored, text_or_empty

MAGIC = b"IDPACK01"
TAIL = struct.Struct("<QQQQII8s")
BLOCK = 1 << 16
# How many distinct words (and bytes of them) a worker remembers, and how many bytes of text it
# handles at once.
CACHE_WORDS = 400_000
CACHE_BYTES = 32 << 20
SLICE_BYTES = 1 << 20
# Letters and signs below this are tried for the direct way to the model: none of them combines
# with its neighbours.
DIRECT_BELOW = 0x180
MANIFEST = "part int, path string, n_docs long, n_ids long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, width: int) -> np.ndarray:
    """ids (padded with zeros to a multiple of 64) as ``width`` words for every 64 ids."""
    groups = -(-len(ids) // 64)
    x = np.zeros(groups * 64, np.uint64)
    x[:len(ids)] = ids
    x = x.reshape(groups, 64)
    words = np.zeros((groups, width), np.uint64)
    for j in range(64):
        k, s = divmod(j * width, 64)
        words[:, k] |= x[:, j] << np.uint64(s)
        if s + width > 64:
            words[:, k + 1] |= x[:, j] >> np.uint64(64 - s)
    return words.reshape(-1)


def unpack_ids(words: np.ndarray, width: int, n: int) -> np.ndarray:
    words = words.reshape(-1, width)
    out = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        k, s = divmod(j * width, 64)
        x = words[:, k] >> np.uint64(s)
        if s + width > 64:
            x = x | (words[:, k + 1] << np.uint64(64 - s))
        out[:, j] = x & mask
    return out.reshape(-1)[:n]


class Writer:
    """Writes one file; whole blocks go out as they fill."""

    def __init__(self, stream, width: int, block: int = BLOCK):
        self.stream, self.width, self.block = stream, width, block
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.offsets, self.docs, self.lengths = [len(MAGIC)], [], []
        stream.write(MAGIC)

    def add(self, doc_ids: Iterable, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs += doc_ids
        self.lengths.append(lengths)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block:
            every = np.concatenate(self.held)
            whole = len(every) // self.block * self.block
            for i in range(0, whole, self.block):
                self._put(every[i:i + self.block])
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _put(self, ids: np.ndarray) -> None:
        raw = pack_ids(ids, self.width).astype("<u8").tobytes()
        self.stream.write(raw)
        self.offsets.append(self.offsets[-1] + len(raw))

    def close(self) -> None:
        if self.n_held:
            self._put(np.concatenate(self.held))
        footer = self.offsets[-1]
        self.stream.write(np.array(self.offsets, "<u8").tobytes())
        self.stream.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.stream.write(np.array([d is None for d in self.docs], np.uint8).tobytes())
        lengths = np.concatenate(self.lengths) if self.lengths else np.empty(0)
        self.stream.write(lengths.astype("<i8").tobytes())
        self.stream.write(TAIL.pack(self.n_ids, len(self.docs), len(self.offsets) - 1, footer,
                                    self.width, self.block, MAGIC))
        self.stream.close()


class Reader:
    """Random access to one file: ``ids(start, n)`` and the document table."""

    def __init__(self, path: str):
        fs, p = filesystem(path)
        self.file = fs.open_input_file(p)
        size = self.file.size()
        tail = self.file.read_at(TAIL.size, size - TAIL.size)
        (self.n_ids, self.n_docs, self.n_blocks, footer, self.width, self.block,
         magic) = TAIL.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"not a packed id file: {path}")
        raw = self.file.read_at(size - TAIL.size - footer, footer)
        a = 8 * (self.n_blocks + 1)
        b = a + 8 * self.n_docs
        c = b + self.n_docs
        self.offsets = np.frombuffer(raw[:a], "<u8")
        self.doc_ids = np.frombuffer(raw[a:b], "<i8")
        self.doc_null = np.frombuffer(raw[b:c], np.uint8).astype(bool)
        self.lengths = np.frombuffer(raw[c:], "<i8")

    def ids(self, start: int, n: int) -> np.ndarray:
        if n <= 0:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        at = int(self.offsets[first])
        raw = self.file.read_at(int(self.offsets[last + 1]) - at, at)
        # only the last block of a file is short, so blocks read together unpack together
        got = unpack_ids(np.frombuffer(raw, "<u8"), self.width, start + n - first * self.block)
        return got[start - first * self.block:]

    def documents(self, step: int = 1 << 22) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start, length, crc32 of the ids as little-endian uint32) of every document."""
        have, base = np.empty(0, np.uint32), 0
        start = 0
        for doc, null, n in zip(self.doc_ids.tolist(), self.doc_null.tolist(),
                                self.lengths.tolist(), strict=True):
            crc, at = 0, start
            while at < start + n:
                if at >= base + len(have):
                    base = at
                    have = self.ids(at, min(step, self.n_ids - at))
                take = min(start + n, base + len(have)) - at
                crc = zlib.crc32(have[at - base:at - base + take].astype("<u4").tobytes(), crc)
                at += take
            yield (None if null else doc), start, n, crc
            start += n

    def close(self) -> None:
        self.file.close()


class _Places(dict):
    """word -> its place; a new word gets the next place and is queued in ``new``."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordEncoder:
    """Encodes whole texts with a tokenizer whose tokens never cross ASCII white space.

    Every distinct word goes through the tokenizers library once per worker and is remembered; a
    text's ids are its words' ids in order, put together with numpy. The memory is bounded: when it
    holds ``limit`` words or ``CACHE_BYTES`` of them, the half that was used most stays.
    """

    limit = CACHE_WORDS
    note_key, note, n_notes = None, None, 0

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._use(Tokenizer.from_file(path))

    def _use(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.vocabulary = tokenizer.get_vocab_size()
        self.model = tokenizer.model
        self.direct, self.spelling = self._direct_words()
        self.signs = functools.lru_cache(4096)(self._piece_ids)
        self._fill(_Places(), np.empty(0, np.int32), np.empty(0, np.int32), np.empty((0, 0)),
                   np.empty(0, np.int64))

    def _direct_words(self):
        """A match of words that are letters, then signs, where both reach the model as one piece
        each, only spelled anew character by character; and that spelling.

        The tokenizer itself is asked: characters count that it neither normalises nor splits. The
        way is closed (None) if they don't stay whole next to each other, or if an added token
        could lie in such a word.
        """
        t = self.tokenizer
        normal = t.normalizer.normalize_str if t.normalizer else str
        split = t.pre_tokenizer.pre_tokenize_str if t.pre_tokenizer else lambda x: [(x, None)]
        spelled = {}
        for c in map(chr, range(0x21, DIRECT_BELOW)):
            pieces = split(c) if normal(c) == c and c != "'" else []
            if len(pieces) == 1 and (pieces[0][0] == c or not c.isascii()):
                spelled[c] = pieces[0][0]
        letters = "".join(c for c in spelled if c.isalpha())
        signs = "".join(c for c in spelled if not c.isalnum())
        table = str.maketrans(spelled)

        def whole(*parts: str) -> bool:
            word = "".join(parts)
            return normal(word) == word and [p for p, _ in split(word)] == [
                x.translate(table) for x in parts]

        if not letters or not all(whole(x) for x in [letters, letters[::-1], *"st", "re", "ll", *(
                f"a{c}b" for c in letters)]):
            return None, table
        if not all(whole(x, y) for x in (letters, "a") for y in [signs, signs[::-1], *signs]):
            signs = ""
        pattern = f"([{re.escape(letters)}]+)" + (f"([{re.escape(signs)}]*)" if signs else "()")
        inside = re.compile(pattern.replace("]+)", "]*)", 1)).fullmatch
        if any(inside(x.content.strip()) for x in t.get_added_tokens_decoder().values()):
            return None, table
        return re.compile(pattern).fullmatch, table

    def _piece_ids(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = piece.translate(self.spelling)
        return [t.id for t in self.model.tokenize(piece)]

    def _fill(self, index: _Places, flat: np.ndarray, sizes: np.ndarray, noted: np.ndarray,
              uses: np.ndarray) -> None:
        """Set the memory: ids of all words one after the other, and numbers per word."""
        n, room = len(sizes), 1 << max(14, int(2 * len(sizes)).bit_length())
        self.index, self.used = index, len(flat)
        self.flat = np.concatenate([flat, np.empty(1 << 16, np.int32)])
        self.sizes = np.zeros(room, np.int32)
        self.sizes[:n] = sizes
        self.starts = np.zeros(room, np.int32)
        self.starts[:n] = np.cumsum(sizes) - sizes
        self.noted = np.zeros((room, self.n_notes))
        self.noted[:n] = noted if noted.shape == (n, self.n_notes) else 0
        self.uses = np.zeros(room, np.int64)
        self.uses[:n] = uses
        self.held = sum(map(len, index))

    def annotate(self, key: str, n_notes: int, note) -> None:
        """From now on ``words`` also gives ``n_notes`` numbers per word in ``notes``:
        ``note(words, ids, sizes)``, computed once per distinct word."""
        if self.note_key != key:
            self.note_key, self.note, self.n_notes = key, note, n_notes
            n = len(self.index)
            self.noted = np.zeros((len(self.sizes), n_notes))
            self.noted[:n] = note(list(self.index), self.flat[:self.used], self.sizes[:n])

    def _shrink(self) -> None:
        """Keep the half of the words that was used most, as far as used more than once and not
        very long."""
        n = len(self.index)
        words = list(self.index)  # in the order of their places
        keep = np.argsort(-self.uses[:n], kind="stable")[:self.limit // 2]
        keep = np.array([i for i in np.sort(keep).tolist()
                         if self.uses[i] > 1 and len(words[i]) < 256], np.int64)
        sizes = self.sizes[keep]
        flat = self.flat[spread(self.starts[keep], sizes)]
        index = _Places((words[i], j) for j, i in enumerate(keep.tolist()))
        self._fill(index, flat, sizes, self.noted[keep], self.uses[keep] // 2)

    def _ids(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """The words' ids, one after the other, and how many each has."""
        ids: list[int] = []
        sizes: list[int] = []
        slow: list[int] = []
        for i, w in enumerate(words):
            m = self.direct and self.direct(w.decode("utf-8", "replace"))
            if m:
                got = self._piece_ids(m[1])
                if m[2]:
                    got = got + (self.signs(m[2]) if len(m[2]) < 9 else self._piece_ids(m[2]))
                ids += got
                sizes.append(len(got))
            else:
                slow.append(i)
                sizes.append(0)
        if slow:
            self._insert(words, slow, ids, sizes)
        return ids, sizes

    def _insert(self, words, slow, ids, sizes) -> None:
        """Encode the words at ``slow`` through the whole tokenizer, and put their ids in place."""
        texts = [self.spelled(words[i]) for i in slow]
        step, found, counts = 256, [], []
        chunks = [texts[i:i + step] for i in range(0, len(texts), step)]
        for chunk, e in zip(chunks, self.tokenizer.encode_batch(
                chunks, is_pretokenized=True, add_special_tokens=False), strict=True):
            found += e.ids
            n = [0] * len(chunk)
            for w in e.word_ids:
                n[w] += 1
            counts += n
        starts = np.cumsum(counts) - counts
        before = np.cumsum(sizes) - sizes
        parts, at = [], 0
        for i, start, n in zip(slow, starts.tolist(), counts, strict=True):
            parts += ids[at:before[i]]
            at = before[i]
            parts += found[start:start + n]
            sizes[i] = n
        ids[:] = parts + ids[at:]

    def _learn(self) -> None:
        new, self.index.new = self.index.new, []
        n, began = len(self.index) - len(new), self.used
        ids, sizes = self._ids(new)
        while len(self.index) > len(self.sizes):
            self.starts, self.sizes, self.noted, self.uses = (
                np.concatenate([a, np.zeros_like(a)])
                for a in (self.starts, self.sizes, self.noted, self.uses))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[began:began + len(ids)] = ids
        self.sizes[n:n + len(new)] = sizes
        self.starts[n:n + len(new)] = began + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.held += sum(map(len, new))
        if self.note is not None:
            self.noted[n:n + len(new)] = self.note(new, self.flat[began:self.used],
                                                   self.sizes[n:n + len(new)])

    def distinct(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``words`` for words that come once: they are not remembered and have no notes."""
        ids, sizes = self._ids(words)
        return np.array(ids, np.int32), np.array(sizes, np.int32)

    def spelled(self, word: bytes) -> str:
        """The string that stands for a word in the tokenizer."""
        return word.decode("utf-8", "replace")

    def split(self, text: bytes) -> list[bytes]:
        """The words of a text: bytes split at ASCII white space."""
        return text.split()

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a list of words, and how many each word has; ``notes`` has the words' notes."""
        if len(self.index) > self.limit or self.held > CACHE_BYTES:
            self._shrink()
        at = np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))
        if self.index.new:
            self._learn()
        sizes = self.sizes[at]
        n = len(self.index)
        self.uses[:n] += np.bincount(at, minlength=n)
        self.notes = self.noted[at]
        return self.flat[spread(self.starts[at], sizes)], sizes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one after the other, and how many each text has."""
        every: list[bytes] = []
        counts = np.empty(len(texts), np.int64)
        for i, t in enumerate(texts):
            w = self.split(t)
            counts[i] = len(w)
            every += w
        ids, sizes = self.words(every)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        last = np.cumsum(counts)
        return ids, ends[last] - ends[last - counts]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of ranges that begin at ``starts`` and have ``sizes``, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int32)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total, dtype=np.int32)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder; its memory outlives a task."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def text_slices(batches, limit: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8) of the batches' first two columns, about ``limit`` bytes at a time."""
    for b in batches:
        ids = b.column(0).to_pylist()
        texts = b.column(1).cast(pa.binary())
        at = 0
        sizes = np.cumsum(np.array(pa.compute.binary_length(texts).to_numpy(
            zero_copy_only=False), np.int64))
        while at < len(ids):
            base = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, base + limit, "right")))
            yield ids[at:end], texts.slice(at, end - at).to_pylist()
            at = end


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The texts' ids with ``end_id`` behind each text."""
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
              block: int = BLOCK, cache_words: int = 2 * CACHE_WORDS) -> DataFrame:
    """Encode every whole text and write the ids in ascending doc_id order.

    Range partitions of doc_id write one file each into ``folder`` (by default a new one in the
    shared folder). A file's name is new for each attempt, and only files of finished tasks are in
    the manifest that is returned: part (the files' order), path, n_docs, n_ids. ``docs`` needs
    doc_id and text; other columns are ignored, whatever their names. NULL text is empty (the end
    id only), NULL doc_id comes first, rows with equal doc_id follow each other in the order of a
    hash of their text. Without documents there may be files without ids.
    """
    spark = docs.sparkSession
    root = folder or shared_path(spark, "ids")

    def write(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        enc.limit = cache_words
        path = f"{root}/ids-{part:06d}-{uuid.uuid4().hex}.bin"
        fs, p = filesystem(path)
        fs.create_dir(p.rpartition("/")[0], recursive=True)
        out = Writer(fs.open_output_stream(p), bits_for(max(enc.vocabulary, end_id + 1)), block)
        for ids, texts in text_slices(batches):
            tokens, counts = enc.encode(texts)
            out.add(ids, counts + 1, with_end(tokens, counts, end_id))
        out.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path],
                                          "n_docs": [len(out.docs)], "n_ids": [out.n_ids]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    tie = rows.withColumn("tie", F.xxhash64("text"))
    ordered = tie.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return stored(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "ids-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start (ids before the document), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    # one row a file: offsets of groups of files, then of the files in a group
    group = (F.col("part") / 1024).cast("long")
    rows = manifest.withColumn("__group", group)
    before = lambda *by: Window.partitionBy(*by).orderBy("__group" if not by else "part").rowsBetween(  # noqa: E731,E501
        Window.unboundedPreceding, -1)
    totals = rows.groupBy("__group").agg(F.sum("n_ids").alias("__n"))
    offsets = totals.select("__group", F.coalesce(F.sum("__n").over(before()), F.lit(0)).alias("__o"))
    files = rows.join(offsets, "__group").withColumn("first", F.col("__o") + F.coalesce(
        F.sum("n_ids").over(before("__group")), F.lit(0)))
    n = max(1, manifest.count())

    def read(batches):
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                reader = Reader(path)
                held: list[tuple] = []
                for doc, start, length, crc in reader.documents():
                    held.append((doc, first + start, length, crc))
                    if len(held) == 10_000:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)
                reader.close()

    def _batch(rows):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = min(n, 4 * spark.sparkContext.defaultParallelism)
    return files.select("path", "first").repartition(max(1, spread)).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")
