"""Token-ID output in the Arrow file format (operator 2).

A table of documents becomes a set of Arrow IPC files. ``part-*.arrow`` holds equal-length sequences: record batches with
a fixed-size-list column of token ids and one of mask bits (true: a token, false: padding after the file's last token), so
any sequence is found by arithmetic and read without a copy from a memory map. ``part-*.docs.arrow`` lists the file's
documents in order with the place of their first token. The table of files (one row each) is Parquet, beside them.

Documents are dealt by ranges of doc_id; each range is written by one task, to files of bounded size under names of its own, so a task that
runs twice leaves files that no row names. A document's place among all documents is the sum of the tokens of the
earlier files, from the table of files, and its place in its file.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.llm.common import KEPT, bounded_batches, new_path, release, spread, tidy

LENGTH = 2048
#: Sequences in a record batch; tokens after which a file ends with the next document.
GROUP, FILE_TOKENS = 256, 1 << 27
FILES = "file string, low bigint, docs bigint, tokens bigint"
DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

#: White space other than space and line feed.
_OTHER_SPACE = "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]"
#: Marks that end words, but for those of contractions.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """Token ids of whole texts as little-endian bytes, with a memory of the words between single spaces.

    A byte-level BPE encodes the parts between word boundaries on their own. A space or a line feed between two characters
    that are not white space is such a boundary, so the ids of a text are those of its lines' first words, of its other words with the
    space before them, and of line feeds. A text with other white space or with a special token's string is encoded whole, and so are all
    texts once a token is met that crosses such a boundary. ``words`` bounds the memory.
    """

    def __init__(self, path: str, words: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes that each id stands for: a byte-level token has a character for each.
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        self.line_feed = self.ids(["\n"])[0]
        #: Texts with any of these are encoded whole: white space other than single spaces and line feeds between words, special tokens.
        self.odd = "|".join(["  ", " \n", "\n ", "\n\n", "^[ \n]", "[ \n]$", _OTHER_SPACE, *(re.escape(x) for x in self.special)])
        #: Marks after a letter to their ids, null where the letter and the marks may share a token.
        self.tails: dict[str, bytes | None] = {}
        #: Words with and without a space before them.
        self.later: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.words, self.by_words = words, True

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.type).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text. Words are units between spaces; Arrow finds the distinct ones of all texts and lays their ids out in the order of the words."""
        if len(self.later) + len(self.first) > self.words:  # short words come back the most
            for known in (self.later, self.first):
                kept = {w: x for w, x in known.items() if len(w) <= 7}
                known.clear()
                if len(kept) <= self.words // 4:
                    known.update(kept)
        plain = pc.invert(pc.or_(pc.match_substring_regex(texts, self.odd), pc.equal(texts, ""))) if self.by_words else pa.array(np.zeros(len(texts), bool))
        whole = iter(self.ids(texts.filter(pc.invert(plain)).to_pylist()))
        # A line feed before the text makes its first word one after a line feed, like the other lines' first words.
        units = pc.split_pattern(pc.binary_join_element_wise("\n", texts.filter(plain), ""), " ")
        words = units.flatten().dictionary_encode()
        distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary), " ")[0].as_py().split(" ") if len(words) else []
        codes = list(map(self.later.get, distinct))
        new = {w: i for i, w in enumerate(distinct) if codes[i] is None}
        lines = {w: w.split("\n") for w in new if "\n" in w}
        firsts, laters = {x for parts in lines.values() for x in parts[1:]}, {parts[0] for parts in lines.values()}.union(w for w in new if w not in lines)
        laters.discard("")
        if not (self.learn(firsts.difference(self.first), self.first, False) and self.learn(laters.difference(self.later), self.later, True)):
            self.by_words = False
            return self.encode(texts)
        for w, i in new.items():
            codes[i] = self.line_feed.join([self.later[lines[w][0]] if lines[w][0] else b"", *map(self.first.__getitem__, lines[w][1:])]) if w in lines else self.later[w]
        laid = pa.array(codes, pa.large_binary()).take(words.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1] if len(laid) else np.zeros(1, np.int64)
        at = (ends[np.asarray(units.offsets) - (units.offsets[0].as_py() if len(units) else 0)]).tolist()
        data = memoryview(laid.buffers()[2]) if len(laid) else memoryview(b"")
        skip = len(self.line_feed)
        done = iter([data[lo + skip : hi].tobytes() for lo, hi in zip(at, at[1:], strict=False)])
        return [next(done) if x else next(whole) for x in plain.to_pylist()]

    def tail(self, marks: str) -> bytes | None:
        if marks not in self.tails:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str("a" + marks)
            self.tails[marks] = self.ids([marks])[0] if cut[0][1] == (0, 1) else None
        return self.tails[marks]

    def learn(self, new: set[str], known: dict[str, bytes], spaced: bool) -> bool:
        """Many words are encoded in one text, with the boundary that they stand at, and told apart by the bytes of their ids."""
        marked = []
        for x in new:
            if x[-1] in _MARKS and (bare := x.rstrip(_MARKS)) and bare[-1].isalpha() and (tail := self.tail(x[len(bare) :])) is not None:
                marked.append((x, bare, tail))
        if marked:
            new = new.difference(x for x, _, _ in marked).union(bare for _, bare, _ in marked if bare not in known)
        new = list(new)
        groups = [new[lo : lo + 4000] for lo in range(0, len(new), 4000)]
        size = np.dtype(self.type).itemsize
        joined = [" " + " ".join(g) if spaced else "\n".join(g) for g in groups]
        for group, text, data in zip(groups, joined, self.ids(joined), strict=True):
            raw = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(raw == 32)[1:] if spaced else np.flatnonzero(raw == 10), len(raw))
            at = np.cumsum(self.widths[np.frombuffer(data, self.type)])
            cut = np.searchsorted(at, ends) + 1
            if cut[-1] > len(at) or (at[cut - 1] != ends).any():
                return False
            cut = (cut * size).tolist()
            starts = [0, *cut[:-1]] if spaced else [0, *(c + len(self.line_feed) for c in cut[:-1])]
            known.update({x: data[a:b] for x, a, b in zip(group, starts, cut, strict=True)})
        known.update({x: known[bare] + tail for x, bare, tail in marked})
        return True


def encoder_of(path: str) -> Encoder:
    """This process's encoder: a worker that runs several tasks loads the tokenizer and learns common words once."""
    home = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if path not in home:
        home[path] = Encoder(path)
    return home[path]


def opened(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


class SequenceWriter:
    """Cuts a stream of token ids into sequences of one file."""

    def __init__(self, root: str, name: str, kind: type, length: int):
        self.fs, base = opened(root)
        self.file, self.length, self.kind, self.tokens = f"{base}/{name}.arrow", length, kind, 0
        value = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("input_ids", pa.list_(pa.field("item", value, False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])
        self.sink = self.fs.open_output_stream(self.file)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.left: list[bytes] = []
        self.held = 0

    def add(self, ids: bytes) -> None:
        self.left.append(ids)
        self.held += len(ids)
        self.tokens += len(ids) // np.dtype(self.kind).itemsize
        if self.held >= (unit := self.length * GROUP * np.dtype(self.kind).itemsize):
            data = b"".join(self.left)
            cut = len(data) // unit * unit
            for lo in range(0, cut, unit):
                self.put(np.frombuffer(data[lo : lo + unit], self.kind), unit // np.dtype(self.kind).itemsize)
            self.left, self.held = [data[cut:]], len(data) - cut

    def put(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema, strict=True)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        ids = np.frombuffer(b"".join(self.left), self.kind)
        if len(ids):
            whole = -(-len(ids) // self.length) * self.length
            self.put(np.concatenate([ids, np.zeros(whole - len(ids), self.kind)]), len(ids))
        self.writer.close()
        self.sink.close()


class FileWriter:
    """One sequence file and the list of its documents, both written as they come."""

    def __init__(self, root: str, name: str, kind: type, length: int):
        self.name, self.ids = name, SequenceWriter(root, name, kind, length)
        self.schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens")])
        self.sink = self.ids.fs.open_output_stream(self.ids.file.removesuffix(".arrow") + ".docs.arrow")
        self.list = pa.ipc.new_file(self.sink, self.schema)
        self.rows: list[tuple] = []
        self.low, self.docs = None, 0

    def add(self, doc_id: int | None, code: bytes) -> None:
        if not self.docs:
            self.low = doc_id
        self.rows.append((doc_id, self.ids.tokens, len(code) // np.dtype(self.ids.kind).itemsize))
        self.docs += 1
        self.ids.add(code)
        if len(self.rows) >= 1 << 16:
            self.put()

    def put(self) -> None:
        if self.rows:
            self.list.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)], schema=self.schema))
            self.rows = []

    def close(self) -> pa.RecordBatch:
        self.put()
        self.list.close()
        self.sink.close()
        self.ids.close()
        return pa.RecordBatch.from_arrays([pa.array([self.name]), pa.array([self.low], pa.int64()), pa.array([self.docs], pa.int64()), pa.array([self.ids.tokens], pa.int64())], ["file", "low", "docs", "tokens"])


@partial(tidy, keep=True)
def write_batches(batches: Iterator[pa.RecordBatch], root: str, tokenizer: str, end: int | None, length: int, tokens: int) -> Iterator[pa.RecordBatch]:
    encoder, out, made, task = None, None, 0, uuid.uuid4().hex
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for lo in range(0, len(ids), 2000):
            encoder = encoder or encoder_of(tokenizer)
            last = b"" if end is None else np.array([end], encoder.type).tobytes()
            for doc_id, code in zip(ids[lo : lo + 2000], encoder.encode(texts[lo : lo + 2000].fill_null("")), strict=True):
                out = out or FileWriter(root, f"part-{task}-{made:06d}", encoder.type, length)
                out.add(doc_id, code + last)
                if out.ids.tokens >= tokens:
                    yield out.close()
                    out, made = None, made + 1
        release()
    if out is not None:
        yield out.close()


class SequenceFile:
    """Random access to the sequences of a file, and its documents in order."""

    def __init__(self, root: str, name: str):
        self.fs, base = opened(root)
        path = f"{base}/{name}.arrow"
        self.source = pa.memory_map(path) if isinstance(self.fs, pafs.LocalFileSystem) else self.fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.docs = f"{base}/{name}.docs.arrow"

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """The ``k``-th sequence's ids and mask, both views of the file: nothing is copied from a memory map."""
        batch = self.reader.get_batch(k // GROUP)
        ids, mask = batch.column("input_ids")[k % GROUP].values, batch.column("mask")[k % GROUP].values
        return ids.to_numpy(zero_copy_only=True), mask

    def documents(self) -> Iterator[tuple[int, int, int]]:
        """(doc_id, place of the first token, number of tokens), in order."""
        with self.fs.open_input_file(self.docs) as f:
            table = pa.ipc.open_file(f)
            for k in range(table.num_record_batches):
                yield from zip(*(c.to_pylist() for c in table.get_batch(k).columns), strict=True)

    def tokens(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, start, ids) of each document."""
        k, held = 0, np.empty(0)
        for doc_id, start, n in self.documents():
            parts, lacking = [held[:n]], n - len(held[:n])
            held = held[n:]
            while lacking:
                flat, real = self.group(k)
                k += 1
                flat = flat[:real]
                parts.append(flat[:lacking])
                held, lacking = flat[lacking:], lacking - len(flat[:lacking])
            yield doc_id, start, np.concatenate([p for p in parts if len(p)] or [held[:0]])

    def group(self, k: int) -> tuple[np.ndarray, int]:
        batch = self.reader.get_batch(k)
        return batch.column("input_ids").flatten().to_numpy(), int(batch.column("mask").flatten().true_count)


@tidy
def read_batches(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows: list[tuple] = []
            for doc_id, start, ids in SequenceFile(root, name).tokens():
                rows.append((doc_id, before + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if len(rows) == 10_000:
                    yield doc_batch(rows)
                    rows = []
            if rows:
                yield doc_batch(rows)


def doc_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, root: str, tokenizer: str, end: int | None = None, length: int = LENGTH, ranges: int | None = None, tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes documents as sequence files under ``root`` and returns the table of files.

    A range of doc_ids is a task, which begins a new file once one has ``tokens`` tokens, so files stay of one size however many
    documents there are. Null texts are empty; a null doc_id comes first; rows that repeat a doc_id are ordered by text and are
    documents of their own; a text of any length is one document, which may go over many sequences; further columns are
    ignored; an empty table writes no file. ``end`` is appended to each document.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 2000)
    opened(root)[0].create_dir(opened(root)[1], recursive=True)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(ranges or spread(spark), "doc_id").sortWithinPartitions("doc_id", F.length("text"), "text")
    path = f"{root}/files.parquet"
    rows.mapInArrow(lambda it: write_batches(it, root, tokenizer, end, length, tokens), FILES).write.parquet(path)
    return spark.read.schema(FILES).parquet(path)


def read_tokens(files: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files.

    The running sum runs over one small row a file, never over documents.
    """
    before = F.coalesce(F.sum("tokens").over(Window.orderBy(F.asc_nulls_first("low"), "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.select("file", before.alias("before")).repartition(spread(files.sparkSession), "file")
    return placed.mapInArrow(lambda it: read_batches(it, root), DOCS)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_ids(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """All documents through the format, with the byte-level BPE of 50k tokens and end id 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    root = new_path(spark, "tokens")
    return read_tokens(write_tokens(docs, root, tokenizer_path(), end=2), root)
