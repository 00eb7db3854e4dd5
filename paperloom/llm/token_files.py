"""Token ids in bit-plane shuffled files.

A file holds the ids of consecutive documents, cut into blocks of a fixed number of ids. A
block is transposed into byte planes (all lowest bytes, all second bytes, ..) or bit planes
(all lowest bits, ..), each plane is compressed with zstandard on its own, and an index of
chunks at the end tells where every plane of every block starts. Planes that are zero
throughout take no space.

Layout, little-endian: magic, plane kind, block size; the planes; the documents (ids and
lengths, compressed); the chunk index (plane offsets, compressed); a footer of fixed size
with the offsets and lengths of the last two. Files are values of a binary column, so any store
that Spark writes can hold them.
"""

from __future__ import annotations

import os
import string
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm.arrow import pieces, spans
from paperloom.session import written

MAGIC = b"PLTK0001"
HEAD, HEAD_SIZE = "<8sBxxxI", 16
FOOTER, FOOTER_SIZE = "<QQQQQ8s", 48
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 20  # ids of one file; the document that passes this mark is its last
LEVEL = 3


# --- planes ----------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, i].tobytes() for i in range(4)]
    unpacked = np.unpackbits(raw, axis=1, bitorder="little")
    packed = np.packbits(unpacked.T, axis=1, bitorder="little")
    return [packed[i].tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        raw = np.empty((n, 4), dtype=np.uint8)
        for i, plane in enumerate(planes):
            raw[:, i] = np.frombuffer(plane, dtype=np.uint8)
        return raw.reshape(-1).view("<u4")
    packed = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes])
    unpacked = np.unpackbits(packed, axis=1, count=n, bitorder="little").T
    return np.packbits(unpacked, axis=1, bitorder="little").reshape(-1).view("<u4")


def plane_bytes(n: int, bits: bool) -> int:
    return (n + 7) // 8 if bits else n


# --- one file --------------------------------------------------------------------------


def write_file(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, bits: bool) -> bytes:
    """One file of whole documents: their ids (int64), lengths, and all token ids in order."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    parts = [struct.pack(HEAD, MAGIC, int(bits), BLOCK_IDS)]
    at, ends = HEAD_SIZE, []
    for start in range(0, len(ids), BLOCK_IDS):
        for plane in to_planes(ids[start : start + BLOCK_IDS], bits):
            if plane.count(0) != len(plane):
                parts.append(pack(plane))
                at += len(parts[-1])
            ends.append(at)
    docs = pack(doc_ids.astype("<i8").tobytes() + lengths.astype("<i8").tobytes())
    index = pack(np.array(ends, dtype="<u8").tobytes())
    footer = struct.pack(FOOTER, len(doc_ids), len(ids), at, at + len(docs), len(index), MAGIC)
    return b"".join([*parts, docs, index, footer])


def read_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, lengths and token ids of a file."""
    view = memoryview(data)
    magic, bits, block = struct.unpack(HEAD, view[:HEAD_SIZE])
    n_docs, n_ids, docs_at, index_at, index_size, end = struct.unpack(FOOTER, view[-FOOTER_SIZE:])
    if magic != MAGIC or end != MAGIC or index_at + index_size + FOOTER_SIZE != len(data):
        raise ValueError("not a whole token file")
    unpack = zstandard.ZstdDecompressor().decompress
    docs = np.frombuffer(unpack(view[docs_at:index_at]), dtype="<i8")
    ends = np.frombuffer(unpack(view[index_at : index_at + index_size]), dtype="<u8")
    ids = np.empty(n_ids, dtype="<u4")
    at, plane = HEAD_SIZE, 0
    for start in range(0, n_ids, block):
        n = min(block, n_ids - start)
        planes = []
        for _ in range(32 if bits else 4):
            stop = int(ends[plane])
            planes.append(unpack(view[at:stop]) if stop > at else bytes(plane_bytes(n, bits)))
            at, plane = stop, plane + 1
        ids[start : start + n] = from_planes(planes, n, bits)
    return docs[:n_docs], docs[n_docs:], ids


# --- encoding --------------------------------------------------------------------------

# White space other than single spaces and line feeds between other characters.
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
IRREGULAR = ["  ", " \n", "\n ", "\n\n", *OTHER_SPACE]
LETTER = np.zeros(256, dtype=bool)
LETTER[list(string.ascii_letters.encode())] = True
MARK = np.zeros(256, dtype=bool)
MARK[list((string.digits + string.punctuation).encode())] = True
KNOWN = 1_000_000  # pieces that a worker remembers before it forgets them all
JOINED = 1 << 14  # bytes of new pieces encoded as one string


class PieceEncoder:
    """Ids of texts as the tokenizers library gives them, each different piece encoded once.

    A byte-level vocabulary whose pattern takes a space along with what follows splits text
    the same way on both sides of a single space or line feed between other characters. So a
    text with no other white space is cut there, and where a run of letters ends before a digit
    or a mark of ASCII, since a run of letters is never split from within. The pieces of many texts become numbers of
    known pieces, whose ids are gathered from one flat array; the library sees only pieces that
    are new, joined into longer strings. Every other text goes to the library whole.
    """

    def __init__(self, file_text: str) -> None:
        self.tokenizer = Tokenizer.from_str(file_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(0, dtype="<u4")  # of all known pieces, one after another
        self.ends = np.zeros(1, dtype=np.int64)  # where the ids of each known piece begin and end

    def regular(self, text: str) -> bool:
        if text[0] in " \n" or text[-1] in " \n":
            return False
        return not any(s in text for s in IRREGULAR) and not any(s in text for s in self.special)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def learn(self, new: list[bytes]) -> None:
        """Encode pieces: on their own at the beginning of a text, joined where a space begins them."""
        first = [p for p in new if p[0] not in b" \n"]
        ids = self.whole([p.decode() for p in first])
        sizes = [len(i) for i in ids]
        rest = [p for p in new if p[0] in b" \n"]
        bytes_of = np.fromiter(map(len, rest), dtype=np.int64, count=len(rest))
        groups = np.cumsum(bytes_of) // JOINED
        starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if rest else []
        joined = [b"".join(rest[a:b]).decode() for a, b in zip(starts, [*starts[1:], len(rest)])]
        found = self.whole(joined)
        if found:
            # Ids of a byte-level vocabulary stand for a fixed number of bytes each.
            ends = np.cumsum(self.n_bytes[np.concatenate(found)])
            cuts = np.searchsorted(ends, np.cumsum(bytes_of)) + 1
            sizes = np.append(sizes, np.diff(cuts, prepend=0))
        number = len(self.known)
        self.known.update(zip([*first, *rest], range(number, number + len(new))))
        self.ids = np.concatenate([self.ids, *ids, *found])
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int64))

    def pieces_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of regular texts one after another, and the number of each text's ids."""
        encoded = [t.encode() for t in texts]
        raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        first = np.cumsum([0, *map(len, encoded)])[:-1]
        cut = (raw == ord(" ")) | (raw == ord("\n"))
        cut[1:] |= MARK[raw[1:]] & LETTER[raw[:-1]]
        cut[first] = True
        starts = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)]
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        different = found.dictionary.to_pylist()
        new = [p for p in different if p not in self.known]
        if len(self.known) + len(new) > KNOWN:
            self.forget()
            new = different
        if new:
            self.learn(new)
        number = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
        number = number[found.indices.to_numpy()]
        begin = self.ends[number]
        sizes = self.ends[number + 1] - begin
        per_text = np.add.reduceat(sizes, np.searchsorted(starts, first))
        return self.ids[spans(begin, sizes)], per_text

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        cut, odd = [], []
        for i, text in enumerate(texts):
            if text:
                (cut if self.regular(text) else odd).append(i)
        for i, ids in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = ids.tobytes()
        if cut:
            ids, per_text = self.pieces_of([texts[i] for i in cut])
            raw, at = ids.tobytes(), 0
            for i, n in zip(cut, (4 * per_text).tolist()):
                out[i] = raw[at : at + n]
                at += n
        return out


def worker_encoder(file_text: str) -> PieceEncoder:
    """The encoder of this Python worker, which Spark uses for one task after another."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
    held = sys.__dict__.setdefault("_piece_encoders", {})
    key = zlib.crc32(file_text.encode())
    if key not in held:
        held[key] = PieceEncoder(file_text)
    return held[key]


# --- tables of files -------------------------------------------------------------------

NULL_ID = -(1 << 63)  # a null id in a file; reading gives the null back
FILES = "part int, file int, n_ids bigint, data binary"


class FileWriter:
    """Collects documents in order and closes a file at the first document end past ``FILE_IDS``."""

    def __init__(self, part: int, bits: bool) -> None:
        self.part, self.bits, self.number = part, bits, 0
        self.held = 0
        self.docs: list[int] = []
        self.ids: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> pa.RecordBatch | None:
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.ids.append(ids)
        self.held += len(ids) // 4
        return self.close() if self.held >= FILE_IDS else None

    def close(self) -> pa.RecordBatch | None:
        if not self.docs:
            return None
        lengths = np.fromiter((len(i) // 4 for i in self.ids), np.int64, len(self.ids))
        flat = np.frombuffer(b"".join(self.ids), dtype="<u4")
        data = write_file(np.array(self.docs, dtype=np.int64), lengths, flat, self.bits)
        row = [[self.part], [self.number], [len(flat)], [data]]
        self.docs, self.ids, self.held = [], [], 0
        self.number += 1
        types = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, types)], ["part", "file", "n_ids", "data"]
        )


def write_tokens(
    docs: DataFrame,
    model_file: str,
    end_id: int = 0,
    bits: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token files of whole texts in ascending order of id, as a written table.

    Texts are encoded with the vocabulary ``model_file`` of the tokenizers library, without
    added special tokens, and ``end_id`` follows each document; null and empty texts have only
    the end id. Documents are range-partitioned by id and sorted before they are encoded;
    rows that repeat an id are ordered by their text, null ids come first. Returns
    (part, file, n_ids, data); (part, file) is the order of the files. A task holds one file.
    An empty table gives no files.
    """
    with open(model_file, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        for batch in batches:
            for piece in pieces(batch, "text"):
                encoder = worker_encoder(model.value)
                files = files or FileWriter(piece.column("part")[0].as_py(), bits)
                found = encoder.encode([t or "" for t in piece.column("text").to_pylist()])
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), found):
                    if full := files.add(doc_id, ids + end):
                        yield full
        if files and (rest := files.close()):
            yield rest

    ordered = (
        docs.select(
            F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
            F.col(f"`{text_col}`").alias("text"),
        )
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .withColumn("part", F.spark_partition_id())
    )
    return written(ordered.mapInArrow(run, FILES), "token-files")


READ = (
    "doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint, part int, file int"
)


def read_tokens(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents read back from a table of files, one row each.

    Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (unsigned
    crc32 of the ids as little-endian unsigned 32-bit integers), and ids array<int> unless
    ``with_ids`` is off.
    """
    per_part = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per range partition of the writer.
    part_starts = per_part.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start")
    )
    in_part = Window.partitionBy("part").orderBy("file")
    starts = (
        files.select("part", "file", "n_ids")
        .withColumn("file_start", F.sum("n_ids").over(in_part) - F.col("n_ids"))
        .join(part_starts, "part")
        .select("part", "file", (F.col("part_start") + F.col("file_start")).alias("before"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, sizes, ids = read_file(batch.column("data")[i].as_py())
                offsets = np.cumsum([0, *sizes])
                raw = memoryview(ids).cast("B")
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
                columns = [
                    pa.array(docs, mask=docs == NULL_ID),
                    pa.array(offsets[:-1]),
                    pa.array(sizes),
                    pa.array(crcs, pa.int64()),
                    pa.repeat(batch.column("part")[i], len(docs)),
                    pa.repeat(batch.column("file")[i], len(docs)),
                ]
                names = ["doc_id", "first", "n_tokens", "ids_crc32", "part", "file"]
                if with_ids:
                    columns.append(
                        pa.ListArray.from_arrays(
                            pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32))
                        )
                    )
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = READ + (", ids array<int>" if with_ids else "")
    documents = files.select("part", "file", "data").mapInArrow(run, schema)
    return documents.join(starts, ["part", "file"]).select(
        "doc_id",
        (F.col("before") + F.col("first")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )
