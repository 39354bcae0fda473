"""Token ids in seekable zstandard files.

A file is a run of independent zstandard frames, one a document (its ids as little-endian
unsigned 32-bit integers, with zstandard's own content checksum), then a skippable frame with
the documents' ids, then the skippable frame with the seek table of the public "seekable
format": for each frame its compressed size, its size and the low 32 bits of its XXH64, and a
footer that a reader finds from the file's end. :func:`read_documents` fetches and decompresses the
frames of the wanted documents only.

Documents are dealt to files by range, so files and their frames ascend in ``doc_id`` (nulls first;
equal ids in order of a hash of their text). Each task writes under a name of its own and
reports it; a lost or repeated task's file isn't in the manifest and so isn't read.

Defined results: a null text is empty and has the end id alone; repeated rows are repeated
documents; a null ``doc_id`` stays null; an id is a long, and one that can't be cast to it (a text) counts as
null; an empty table gives no file. Other columns are ignored.
"""

from __future__ import annotations

import gc
import io
import struct
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_key, once, prepare, shared_path, stored

# Fixed values of the zstandard seekable format.
SKIPPABLE_IDS, SKIPPABLE_SEEK, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
#: Pieces that aren't words whose ids a worker remembers, twice: when the newer half is full it becomes the older
#: one, whose pieces come back when they are met again. So frequent pieces stay known.
REMEMBERED = 600_000
if sys.byteorder != "little":
    raise ImportError("token files are written on little-endian machines")
#: Marks that may end a piece.
MARKS = ".,!?;:%$#*&|<>"
#: Characters of texts that are cut at once.
CUT_CHARACTERS = 1 << 23
#: Words that are encoded at once.
WORDS_AT_ONCE = 1 << 17
#: The characters that the byte-level tokenizers write bytes as: printable ones of Latin-1 as they are, others from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARACTERS = {chr(b): chr(256 + i) for i, b in enumerate(sorted({*range(256)} - _PRINTED))}
MANIFEST = "part int, path string, documents long, tokens long"
ENTRIES = "doc_id long, start long, n_tokens long, ids_crc32 long"


def file_system(uri: str):
    """(file system, path) of a URI; Hadoop writes local ones with one slash."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _joined(pieces: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), pa.scalar("\n", pa.large_string()))[0].as_py()


def _taken(ids: np.ndarray, sizes: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces ``used``, of which the ids of all lie end to end in ``ids``, and how many each has."""
    n = sizes.astype(np.int32)[used]
    kind = np.int32 if max(len(ids), n.sum(dtype=np.int64)) < 1 << 31 else np.int64
    shift = (np.cumsum(sizes) - sizes).astype(kind)[used]
    shift -= np.cumsum(n, dtype=kind) - n
    at = np.repeat(shift, n)
    at += np.arange(len(at), dtype=kind)
    return ids[at], n


class Encoder:
    """A text's ids as bytes. The byte-level pre-tokenizer always cuts before a single blank
    between two other characters, so the pieces between such blanks encode on their own, the
    different ones of many texts once; other texts (white space after a blank, special tokens' strings)
    go to the tokenizer whole. Either way the ids are the tokenizer's."""

    def __init__(self, tokenizer_json: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)").search
        self.blanks = re.compile(r" \s").search
        self.line = re.compile(r" \S+")
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        # the same model for words that the pre-tokenizer leaves whole: only line feeds part them
        self.words = Tokenizer.from_str(tokenizer_json)
        self.words.pre_tokenizer = pre_tokenizers.Split(BYTE_CHARACTERS["\n"], "isolated")
        self.checked, self.odd = set("\n"), set()
        self.known: dict[str, np.ndarray] = {}
        self.older: dict[str, np.ndarray] = {}

    def whole(self, text: str) -> bool:
        """Whether a text can't be cut at its blanks."""
        return bool(self.blanks(text) or self.special(text))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, pieces: list[str]) -> dict[str, np.ndarray]:
        """The ids of pieces. Those that are a blank and then no white space go as the lines of one
        text: a line feed before a blank is a token of its own, so its id parts the lines."""
        lines = [p for p in pieces if self.line.fullmatch(p)]
        made: dict[str, np.ndarray] = {}
        if lines:
            (ids,) = self._ids(["\n".join(lines)])
            cuts = np.flatnonzero(ids == self.feed)
            if len(cuts) == len(lines) - 1:
                made = {p: ids[a:b].copy() for p, a, b in zip(lines, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])}
        rest = [p for p in pieces if p not in made]
        made.update(zip(rest, self._ids(rest)))
        return made

    def _others(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of pieces that aren't words, remembered."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        known.update((p, older[p]) for p in set(pieces).difference(known).intersection(older))
        known.update(self._lines(list(set(pieces).difference(known))))
        return [known[p] for p in pieces]

    def _words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, size of each piece) of words, which start with a NUL where no blank is before them."""
        ids, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(pieces), WORDS_AT_ONCE):  # the tokenizer's own records of a text take many times its size
            text = ("\n" + _joined(pieces[i : i + WORDS_AT_ONCE])).replace("\n", "\n ").replace("\n \0", "\n")[1:]
            if text.isascii():
                text = text.replace(" ", BYTE_CHARACTERS[" "]).replace("\n", BYTE_CHARACTERS["\n"])
            else:
                text = text.encode().decode("latin-1")
                for c, written in BYTE_CHARACTERS.items():
                    text = text.replace(c, written)
            made = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            feeds = made == self.feed
            ids.append(made[~feeds])
            sizes.append(np.diff(np.r_[-1, np.flatnonzero(feeds), len(made)]) - 1)
        return np.concatenate(ids), np.concatenate(sizes)

    def _letters(self, pieces: pa.Array) -> str:
        """The class of letters that words are made of: the pre-tokenizer is asked about each other character once, as its
        Unicode may be another than Arrow's."""
        foreign = pieces.filter(pc.invert(pc.string_is_ascii(pieces)))
        new = set(_joined(foreign)) - self.checked
        self.checked |= new
        self.odd |= {c for c in new if c.isalpha() != (len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f" a{c}a")) == 1)}
        return "A-Za-z" if self.odd else r"\pL"

    def _cut(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that can be cut at their blanks, from those of their different pieces. A NUL marks a piece that has
        no blank before it: a text's first, and a line feed beside no other white space, a token of its own, and what follows it.
        Marks after letters are a token run of their own."""
        parted = []
        for t in texts:
            lines = t.split("\n")
            apart = all(x and not x[0].isspace() and not x[-1].isspace() for x in lines)
            parted.append("\0" + (" \0\n \0".join(lines) if apart else t))
        split = pc.split_pattern(pa.array(parted, pa.large_string()), " ")
        begin = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        pieces, number = coded.dictionary, coded.indices.to_numpy()
        found = pc.extract_regex(pieces, rf"^(?P<word>\x00?[{self._letters(pieces)}]+)(?P<marks>[{MARKS}]*)$")
        word = found.field("word").filter(found.is_valid()).dictionary_encode()
        marks = found.field("marks").filter(found.is_valid()).dictionary_encode()
        other = pieces.filter(found.is_null()).to_pylist()
        ids, sizes = self._words(word.dictionary)
        more = self._others([*marks.dictionary.to_pylist(), *(p[1:] if p[:1] == "\0" else f" {p}" for p in other)])
        # each piece is a word and its marks, or another piece and nothing
        own = np.full((len(pieces), 2), len(sizes) + len(more))
        matched = found.is_valid().to_numpy(zero_copy_only=False)
        own[matched, 0] = word.indices.to_numpy()
        own[matched, 1] = marks.indices.to_numpy() + len(sizes)
        own[~matched, 0] = np.arange(len(other)) + len(sizes) + len(marks.dictionary)
        ids, n = _taken(np.concatenate([ids, *more]), np.r_[sizes, [len(x) for x in more], 0], own.ravel())
        ids, n = _taken(ids, n.reshape(-1, 2).sum(axis=1), number)
        at = (np.r_[0, np.cumsum(n, dtype=np.int64)][begin] * 4).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        run: list[int] = []
        held = 0
        for k, t in enumerate(texts):
            if t and ("\0" in t or self.whole(t)):
                out[k] = self._ids([t])[0].tobytes()
            elif t:
                run.append(k)
                held += len(t)
            if run and (held >= CUT_CHARACTERS or k == len(texts) - 1):
                for i, ids in zip(run, self._cut([texts[i] for i in run])):
                    out[i] = ids
                run, held = [], 0
        return out


# ---- one file -----------------------------------------------------------------------------


class FileWriter:
    """Appends documents to an open binary stream; ``close`` adds the tables."""

    def __init__(self, sink, level: int = 3):
        import zstandard as zs

        self.sink, self.ids, self.frames = sink, [], []
        self.compress = zs.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self.compress(ids)
        self.sink.write(frame)
        self.ids.append(doc_id)
        self.frames.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))

    def close(self) -> None:
        n = len(self.ids)
        names = b"".join(struct.pack("<qB", i or 0, i is not None) for i in self.ids)
        self.sink.write(struct.pack("<II", SKIPPABLE_IDS, len(names)) + names)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", n, HAS_CHECKSUMS, SEEK_FOOTER)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class FileReader:
    """Reads a file from a seekable stream: the tables first, then only the frames asked for."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, io.SEEK_END)
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_FOOTER or not flags & HAS_CHECKSUMS:
            raise ValueError("not a seekable token file")
        table = self._at(end - 9 - 12 * n, 12 * n)
        self.frames = list(struct.iter_unpack("<III", table))
        names = self._at(end - 9 - 12 * n - 8 - 9 * n, 9 * n)
        self.ids = [i if valid else None for i, valid in struct.iter_unpack("<qB", names)]
        self.offsets = [0]
        for size, _, _ in self.frames:
            self.offsets.append(self.offsets[-1] + size)

    def _at(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def document(self, k: int) -> bytes:
        """The ids of the k-th document; a damaged frame raises."""
        import xxhash
        import zstandard as zs

        size, plain, checksum = self.frames[k]
        ids = zs.ZstdDecompressor().decompress(self._at(self.offsets[k], size), max_output_size=plain)
        if len(ids) != plain or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return ids


def read_documents(uri: str, wanted: Iterable[int | None]) -> dict[int | None, list[list[int]]]:
    """The ids of the wanted documents of one file; other frames aren't read."""
    fs, path = file_system(uri)
    wanted = set(wanted)
    found: dict[int | None, list[list[int]]] = {}
    with fs.open_input_file(path) as source:
        reader = FileReader(source)
        for k, doc_id in enumerate(reader.ids):
            if doc_id in wanted:
                found.setdefault(doc_id, []).append([x[0] for x in struct.iter_unpack("<I", reader.document(k))])
    return found


# ---- the operator -------------------------------------------------------------------------


def tokenizer_json(path: str | None = None) -> str:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """Write ``docs(doc_id, text, ..)`` below ``folder`` (a URI); the manifest, a row for each file
    in order."""
    spark = prepare(docs.sparkSession)
    vocabulary = spark.sparkContext.broadcast(tokenizer_json(tokenizer_path))
    end = struct.pack("<I", end_id)
    key = new_key()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = sink = None
        tokens = documents = waiting = 0
        held: list[pa.RecordBatch] = []

        def add() -> None:
            nonlocal tokens, documents, waiting
            if held:
                doc_ids, texts = ([x for batch in held for x in batch.column(k).to_pylist()] for k in ("doc_id", "text"))
                for doc_id, ids in zip(doc_ids, encoder.encode(texts)):
                    ids += end
                    writer.add(doc_id, ids)
                    tokens += len(ids) // 4
                    documents += 1
            held.clear()
            waiting = 0

        gc.disable()  # its passes over the many live lists find nothing to free
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    encoder = once(key, lambda: Encoder(vocabulary.value))
                    fs, base = file_system(folder)
                    part = TaskContext.get().partitionId()
                    name = f"tokens-{part:06d}-{uuid.uuid4().hex}.zst"
                    fs.create_dir(base, recursive=True)
                    sink = fs.open_output_stream(f"{base}/{name}", compression=None)  # not by the name
                    writer = FileWriter(sink)
                held.append(batch)
                waiting += batch.nbytes
                if waiting >= CUT_CHARACTERS:
                    add()
            add()
        finally:
            gc.enable()
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"], "documents": pa.array([documents], pa.int64()), "tokens": pa.array([tokens], pa.int64())})

    rows = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text")
    return stored(dealt.mapInArrow(write, MANIFEST), "manifest")


def describe_token_files(manifest: DataFrame) -> DataFrame:
    """Read the files back: ``(doc_id, start, n_tokens, ids_crc32)`` for each document, ``start``
    counting the ids of all documents before it."""
    # a row for each file, so the one-task window sees as many rows as there are files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = file_system(row["path"])
                start = row["start"]
                with fs.open_input_file(path) as source:
                    reader = FileReader(source)
                    for at in range(0, len(reader.ids), 4096):
                        out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                        for k in range(at, min(at + 4096, len(reader.ids))):
                            ids = reader.document(k)
                            for name, value in zip(out, (reader.ids[k], start, len(ids) // 4, zlib.crc32(ids))):
                                out[name].append(value)
                            start += len(ids) // 4
                        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    spark = manifest.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "start").repartition(tasks, "path").mapInArrow(read, ENTRIES)


def token_files(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to the shared folder and describe every document from the files."""
    folder = shared_path(docs.sparkSession, "tokens")
    return describe_token_files(write_token_files(docs, folder, tokenizer_path, end_id))
