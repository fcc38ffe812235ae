"""Token-id output: fixed-width bit packing with block offsets.

A token file holds the ids of consecutive documents (ascending id order across files):

    blocks | document ids i64 | null flags u8 | ids per document u64 | block offsets u64 (blocks + 1)
    | magic 8 bytes, u32 bits, u32 ids a block, u64 documents, u64 ids, u64 blocks

Each block packs its ids, most significant bit first, in the minimum number of bits the vocabulary
needs, padded to a byte. Offsets let a reader unpack any block alone with numpy, so a document or a
range of ids is read without the rest of the file. The index comes last, so a writer holds one block
and the documents' lengths only, however large the file.

Documents are dealt out by range of (id, hash of text), so one id may hold any share of the rows;
every task writes files of bounded size under names that no other attempt uses and reports them in a
manifest, which is written once; files of lost attempts are never listed. ``start`` is a running
total in two steps: over the files of a part, and over the parts, whose number the session fixes.

Defined cases: a null text is encoded as empty, so only the end id is left; null ids come first;
equal ids are ordered by their text; an empty table gives no file and no rows; only the id and text
columns are read.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import in_batches, new_folder, partition_count, release_memory, slices, written

MAGIC = b"TSLATOK1"
FOOTER = struct.Struct("<8sIIQQQ")
BLOCK_IDS = 65_536
FILE_IDS = 32_000_000
END_ID = 2
#: Larger slices share more chunks.
SLICE_BYTES = 6 * 2**20
#: Documents a batch when files are read back.
READ_DOCS = 10_000
#: Chunks that go through the library as one text.
JOINED = 512
#: A text may be cut before a space or line end that surely starts a pre-token: one followed by none of these.
UNSURE = re.compile("[ \n](?=[\x00-\x20\x7f-\xa0 ᠎ -‏ -  -⁤　﻿]|$)")
CUT = re.compile(" (?=[^\x00-\x20\x7f-\xa0 ᠎ -‏ -  -⁤　﻿])")
MARKS = ",.;:!?"
#: A chunk (a leading space aside) that keeps its pre-tokens between line ends: no line end in it, and no white space at its ends.
EDGE = r"[!-~\x{A1}-\x{24F}\x{370}-\x{167F}\x{2E80}-\x{2FFF}\x{3001}-\x{9FBF}\x{AC00}-\x{D7A3}]"
STANDS_ALONE = rf"^ ?{EDGE}(?:[^\n]*{EDGE})?$"
#: A line end before a word.
LED = rf"^\n{EDGE}"
#: A letter and a mark at the end.
MARKED = rf"[A-Za-z\x{{C0}}-\x{{D6}}\x{{D8}}-\x{{F6}}\x{{F8}}-\x{{24F}}][{MARKS}]$"


def vocabulary_bits(size: int) -> int:
    """Least number of bits that holds ids 0 .. size - 1."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """One block: each id in ``bits`` bits."""
    raw = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, 4 - bits // 8 :].tobytes()
    wide = np.unpackbits(raw, axis=1)
    return np.packbits(wide[:, 32 - bits :]).tobytes()


def unpack(block: bytes, n: int, bits: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    if bits % 8 == 0:
        raw = np.zeros((n, 4), dtype=np.uint8)
        raw[:, 4 - bits // 8 :] = np.frombuffer(block, dtype=np.uint8).reshape(n, bits // 8)
        return raw.view(">u4").ravel().astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(block, dtype=np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, 32 - bits :] = flat
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def _open(uri: str):
    """File system and path of a URI; any store pyarrow knows."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(uri)


class TokenWriter:
    """Writes one token file, block by block."""

    def __init__(self, uri: str, bits: int):
        store, path = _open(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.bits = store.open_output_stream(path), bits
        self.doc_ids, self.null, self.lengths, self.offsets = array("q"), array("B"), array("Q"), array("Q", [0])
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0

    def add(self, doc_id: int | None, *ids: np.ndarray) -> None:
        """Append a document, given in one or more pieces."""
        self.doc_ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        n = sum(map(len, ids))
        self.lengths.append(n)
        self.held.extend(ids)
        self.n_held, self.n_ids = self.n_held + n, self.n_ids + n
        if self.n_held >= BLOCK_IDS:
            self._write(self.n_held // BLOCK_IDS * BLOCK_IDS)

    def _write(self, upto: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for i in range(0, upto, BLOCK_IDS):
            block = pack(ids[i : min(i + BLOCK_IDS, upto)], self.bits)
            self.out.write(block)
            self.offsets.append(self.offsets[-1] + len(block))
        self.held, self.n_held = [ids[upto:].copy()], len(ids) - upto

    def close(self) -> None:
        """Write what is held and the index."""
        self._write(self.n_held)
        for kind, values in (("<i8", self.doc_ids), ("u1", self.null), ("<u8", self.lengths), ("<u8", self.offsets)):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(FOOTER.pack(MAGIC, self.bits, BLOCK_IDS, len(self.doc_ids), self.n_ids, len(self.offsets) - 1))
        self.out.close()


def write_file(uri: str, doc_ids: list[int | None], docs: list[np.ndarray], bits: int) -> int:
    """Write one token file; returns its number of ids."""
    writer = TokenWriter(uri, bits)
    for doc_id, ids in zip(doc_ids, docs):
        writer.add(doc_id, ids)
    writer.close()
    return writer.n_ids


class TokenFile:
    """Random access to one token file."""

    def __init__(self, uri: str):
        store, path = _open(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        magic, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.file.seek(size - FOOTER.size - n_docs * 17 - 8 * (n_blocks + 1))
        read = lambda kind, n: np.frombuffer(self.file.read(np.dtype(kind).itemsize * n), dtype=kind)
        ids, null = read("<i8", n_docs), read(np.uint8, n_docs)
        self.doc_ids = [None if no else int(i) for i, no in zip(ids, null)]
        self.ends = np.cumsum(read("<u8", n_docs).astype(np.int64))
        self.offsets = read("<u8", n_blocks + 1).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        """Ids of block ``k``."""
        self.file.seek(int(self.offsets[k]))
        raw = self.file.read(int(self.offsets[k + 1] - self.offsets[k]))
        return unpack(raw, min(self.block_ids, self.n_ids - k * self.block_ids), self.bits)

    def read(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from position ``first``; only the blocks that hold them are read."""
        if not count:
            return np.zeros(0, np.uint32)
        k0, k1 = first // self.block_ids, (first + count - 1) // self.block_ids
        ids = np.concatenate([self.block(k) for k in range(k0, k1 + 1)])
        return ids[first - k0 * self.block_ids :][:count]

    def documents(self):
        """(document id, position in the file, ids) of every document; a block is unpacked once."""
        first, cached, held = 0, -1, None
        for doc_id, end in zip(self.doc_ids, self.ends.tolist()):
            parts, at = [], first
            while at < end:
                k = at // self.block_ids
                if k != cached:
                    cached, held = k, self.block(k)
                upto = min(end, (k + 1) * self.block_ids)
                parts.append(held[at - k * self.block_ids : upto - k * self.block_ids])
                at = upto
            yield doc_id, first, np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            first = end


class ChunkEncoder:
    """The tokenizers library over the distinct chunks of a slice of texts.

    A text is cut only before a single space or line end that starts a word, where byte-level
    pre-tokenisation always starts a pre-token. Arrow splits a slice and numbers its distinct chunks; each of them goes
    through the library once, and numpy gathers the ids of all places. Nothing outlives a slice.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.bits = vocabulary_bits(self.library.get_vocab_size(with_added_tokens=True))
        one = lambda text: self.library.encode(text, add_special_tokens=False).ids
        self.line_end = one("\n")
        self.mark = np.zeros(128, dtype="<u4")
        for m in MARKS:
            self.mark[ord(m)] = one(m)[0]
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, special)) or None

    def _alone(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk as a text of its own."""
        return [x.ids for i in range(0, len(chunks), 2000) for x in self.library.encode_batch_fast(chunks[i : i + 2000], add_special_tokens=False)]

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of chunks that share texts, ``JOINED`` a text, with line ends between them, and the number of ids of
        each; None if a line end is not a token of its own."""
        texts = ["\n".join(chunks[i : i + JOINED]) + "\n" for i in range(0, len(chunks), JOINED)]
        parts = [np.array(x.ids, dtype="<u4") for i in range(0, len(texts), 16) for x in self.library.encode_batch_fast(texts[i : i + 16], add_special_tokens=False)]
        ids = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        ends = np.flatnonzero(ids == self.line_end[0])
        if len(ends) != len(chunks):
            return None
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the distinct chunks one after the other, and the number of ids of each."""
        # A line end before a word and one mark after a letter are pre-tokens of their own, so "word" and "word," share their ids.
        marked = pc.match_substring_regex(chunks, MARKED)
        bare = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, 0, stop=-1), chunks)
        led = pc.match_substring_regex(bare, LED)
        led = led if len(self.line_end) == 1 else pc.and_(led, False)
        numbered = pc.if_else(led, pc.utf8_slice_codeunits(bare, 1), bare).dictionary_encode()
        bases, code = numbered.dictionary, numbered.indices.to_numpy().astype(np.int64)
        shared = pc.match_substring_regex(bases, STANDS_ALONE)
        if self.special:
            shared = pc.and_not(shared, pc.match_substring_regex(bases, self.special))
        shared = shared.to_numpy(zero_copy_only=False) & (len(self.line_end) == 1)
        together = self._joined(bases.filter(pa.array(shared)).to_pylist())
        if together is None:
            shared, together = np.zeros(len(bases), bool), (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        others = self._alone(bases.filter(pa.array(~shared)).to_pylist())
        flat = np.concatenate([together[0], np.fromiter(itertools.chain.from_iterable(others), dtype="<u4")])
        sizes, begin = np.empty(len(bases), np.int64), np.empty(len(bases), np.int64)
        sizes[shared], sizes[~shared] = together[1], list(map(len, others))
        order = np.r_[np.flatnonzero(shared), np.flatnonzero(~shared)]
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        marked, led = marked.to_numpy(zero_copy_only=False), led.to_numpy(zero_copy_only=False)
        own = sizes[code] + marked + led
        ends = np.cumsum(own)
        # Line ends and marks get a place next to their base's ids, whatever is there, and are then put there.
        flat = np.r_[flat, np.zeros(1, "<u4")]
        out = flat[np.repeat(begin[code] - led - (ends - own), own) + np.arange(int(ends[-1]))]
        raw, offsets = np.frombuffer(chunks.buffers()[2] or b"", np.uint8), np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset :][: len(chunks) + 1]
        out[ends[marked] - 1] = self.mark[raw[offsets[1:][marked] - 1]]
        out[(ends - own)[led]] = self.line_end[:1]
        return out, own

    def _gathered(self, chunks: pa.Array, codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of texts: ``codes`` number the chunks of all places, a text's places end before ``ends``."""
        flat, sizes = self.encode_chunks(chunks)
        begin = np.cumsum(sizes) - sizes
        sizes = sizes[codes]
        upto = np.cumsum(sizes)
        shift = (begin[codes] - (upto - sizes)).astype(np.int32)
        ids = flat[np.repeat(shift, sizes) + np.arange(int(upto[-1]), dtype=np.int32)]
        return np.split(ids, upto[ends[:-1] - 1])

    def encode_slice(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        sure = np.array([bool(t) and not UNSURE.search(t) for t in texts], dtype=bool)
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        places = [i for i, (t, ok) in enumerate(zip(texts, sure.tolist())) if t and not ok]
        if places:
            cut = [_cut(texts[i]) for i in places]
            numbered = pa.array(list(itertools.chain.from_iterable(cut)), pa.string()).dictionary_encode()
            found = self._gathered(numbered.dictionary, numbered.indices.to_numpy().astype(np.int64), np.cumsum(list(map(len, cut))))
            for i, ids in zip(places, found):
                out[i] = ids
        places = np.flatnonzero(sure).tolist()
        if places:
            split = pc.split_pattern(pa.array([texts[i].replace("\n", " \n") for i in places], pa.string()), " ")
            offsets = split.offsets.to_numpy()
            numbered = split.flatten().dictionary_encode()
            codes = numbered.indices.to_numpy().astype(np.int64)
            # A text's first chunk has no leading space: its places get numbers beyond those of the others.
            firsts = pc.list_element(split, 0).dictionary_encode()
            codes[offsets[:-1]] = len(numbered.dictionary) + firsts.indices.to_numpy()
            words = numbered.dictionary
            spaced = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise("", words, " "))
            chunks = pa.concat_arrays([spaced, firsts.dictionary])
            for i, ids in zip(places, self._gathered(chunks, codes, offsets[1:])):
                out[i] = ids
        return out


def _cut(text: str) -> list[str]:
    """The chunks of a text that has other white space than single spaces between words."""
    cuts = [m.start() for m in CUT.finditer(text)]
    return [c for c in (text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])) if c]


@functools.lru_cache(maxsize=2)
def load(path: str) -> ChunkEncoder:
    """One encoder for each tokenizer file and Python worker; Spark already runs a worker for each core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = ChunkEncoder(path)
    release_memory()  # reading the file takes several times what is kept
    return loaded


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode and write all documents; returns the manifest ``part, seq, path, n_docs, n_ids, start``."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        encoder, part, seq, writer, path = load(tokenizer), TaskContext.get().partitionId(), 0, None, ""
        end = np.array([end_id], dtype=np.uint32)

        def closed():
            writer.close()
            row = {"part": [part], "seq": [seq], "path": [path], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]}
            return pa.RecordBatch.from_pydict(row, schema=schema)

        for some in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in some.column("text").to_pylist()]
            for doc_id, found in zip(some.column("id").to_pylist(), encoder.encode_slice(texts)):
                if writer is None:
                    path = f"{folder}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.tok"
                    writer = TokenWriter(path, encoder.bits)
                writer.add(doc_id, found, end)
                if writer.n_ids >= file_ids:
                    yield closed()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield closed()

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    dealt = rows.repartitionByRange(partition_count(spark), F.col("id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.xxhash64("text"), "text"
    )
    manifest = written(in_batches(dealt).mapInArrow(run, "part int, seq int, path string, n_docs long, n_ids long"), "token-manifest")
    before = lambda window: F.coalesce(F.sum("n_ids").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))  # at most a row a shuffle partition
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_start"))
    inside = manifest.withColumn("in_part", before(Window.partitionBy("part").orderBy("seq")))
    return inside.join(F.broadcast(parts), "part").select(*manifest.columns, (F.col("part_start") + F.col("in_part")).alias("start"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents read back from the files: ``doc_id, start, n_tokens, ids_crc32``."""

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = TokenFile(path).documents()
                while some := list(itertools.islice(found, READ_DOCS)):
                    rows = zip(*((d, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, at, ids in some))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)

    dealt = manifest.select("path", "start").repartition(partition_count(manifest.sparkSession))
    return in_batches(dealt).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
