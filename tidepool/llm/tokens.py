"""Token ids of whole texts, and token files: flat unsigned integers with 64-bit offsets.

Encoding goes through a public tokenizer file (its path is a parameter). Byte-pair tokenizers that
pre-split at white space give a text's ids as the ids of its space-led pieces one after another, so
a step's texts are cut at spaces in Arrow and each distinct piece is looked up once. Plain Latin words
with marks behind them are looked up by the word and by the marks, all others as they are, in bounded
memos held as Arrow columns that live as long as the worker. New words go through the library's merges
many at a time, new marks and other pieces through the whole tokenizer. With
``added_tokens`` the strings of added tokens in a text become their ids, as the library does by
default: such a text goes whole through the tokenizer. Without, special ones are ordinary text.

File format, per part (one range of documents in ascending id order): ``.ids`` holds all token
ids as little-endian unsigned integers (16 bits if the vocabulary fits, else 32), ``.idx`` holds
n + 1 little-endian unsigned 64-bit offsets in tokens from the part's start, ``.doc`` n 64-bit
document ids and n validity bytes. The manifest has one row per part; a part's base is the prefix
sum of the tokens of the parts before it. Readers memory-map local files.

Edge cases: a null or empty text is a document of no text tokens (only the end id, if any); null
document ids come first; repeated rows are documents of their own, in order of length and text; an empty
table gives an empty manifest and no documents; further columns are not stored.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import materialize
from tidepool.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words remembered per worker (the more recent half survives when it is full; as many other pieces),
#: the longest remembered, and new ones per call.
MEMO_PIECES = 400_000
MEMO_CHARS = 48
CALL_PIECES = 4096
#: Texts encoded together (characters, rows), and documents read by one read task.
TEXT_STEP = 4_000_000
TEXT_ROWS = 8192
READ_DOCS = 4096

LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: Marks that may follow a word: ASCII punctuation and symbols.
MARKS = r"!-/:-@\[-`{-~"
#: White space but spaces and line feeds.
OTHER_SPACE = re.compile(r"[^\S \n]")
PIECE_EDGE = re.compile(r"(?<=\S)(?= \S)")
SPACE, NO_TEXT, NO_IDS = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar(b"", pa.large_binary())


def odd(text: str) -> bool:
    """Whether some space or line feed does not stand by itself between words, or there is other space."""
    return "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0].isspace() \
        or text[-1].isspace() or OTHER_SPACE.search(text) is not None


def pieces(texts: Sequence[str | None]) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts, and the number of pieces before each text and in all. A text's pieces, encoded
    one after another, give its ids: the first is led by a tab (it has nothing before it), words that
    begin a line by a line feed, all others stand for a space and a word."""
    even, rest, last = [], [], []  # runs of even texts are cut in Arrow, the rest one by one
    runs, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)

    def close() -> None:
        if rest:
            runs.append(pa.array(rest, pa.large_string()))
            rest.clear()
        if even:
            cut = pc.split_pattern(pa.array(even, pa.large_string()), " ")
            counts[np.array(last) + 1] = cut.value_lengths().to_numpy()
            runs.append(cut.flatten())
            even.clear()
            last.clear()

    for i, t in enumerate(texts):
        if t and odd(t):
            if even:
                close()
            first, *others = PIECE_EDGE.split(t)
            rest.extend(["\t" + first, *(p[1:] for p in others)])
            counts[i + 1] = 1 + len(others)
        elif t:
            if rest:
                close()
            even.append("\t" + t.replace("\n", " \n"))
            last.append(i)
    close()
    return pa.concat_arrays(runs) if runs else pa.array([], pa.large_string()), np.cumsum(counts)


class Memo:
    """Ids of strings, learned when first asked for. Keys and ids are Arrow columns; when those
    learned or used since the last time fill half the memo, the half before them is forgotten."""

    def __init__(self, learn: Callable[[list[str]], list[bytes | None]]):
        self.learn = learn
        self.recent = self.older = (pa.array([], pa.large_string()), pa.array([], pa.large_binary()))

    def get(self, keys: pa.Array) -> pa.Array:
        """Ids of distinct keys (none may be null)."""
        if len(self.recent[0]) > MEMO_PIECES // 2:
            self.older, self.recent = self.recent, (self.recent[0][:0], self.recent[1][:0])
        at = pc.index_in(keys, value_set=self.recent[0])
        if at.null_count == 0:
            return self.recent[1].take(at)
        asked = keys.filter(at.is_null())
        was = pc.index_in(asked, value_set=self.older[0])
        new = asked.filter(was.is_null())
        keys_in = pa.concat_arrays([asked.filter(was.is_valid()), new])
        ids_in = pa.concat_arrays([self.older[1].take(was.drop_null()),
                                   pa.array(self.learn(new.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())])
        base, lost = len(self.recent[0]), was.is_null().to_numpy(zero_copy_only=False)
        place = np.where(lost, len(lost) - lost.sum() + np.cumsum(lost) - 1, np.cumsum(~lost) - 1)
        every = at.fill_null(0).to_numpy().astype(np.int64)
        every[at.is_null().to_numpy(zero_copy_only=False)] = base + place
        out = pa.concat_arrays([self.recent[1], ids_in]).take(pa.array(every))
        short = pc.less_equal(pc.utf8_length(keys_in), MEMO_CHARS)
        self.recent = tuple(pa.concat_arrays([old, x.filter(short)]) for old, x in zip(self.recent, (keys_in, ids_in)))
        return out

    def of(self, strings: pa.Array) -> pa.Array:
        """Ids of any strings; null for null ones."""
        each = strings.dictionary_encode()
        return self.get(each.dictionary).take(each.indices)


class Encoder:
    """Whole-text ids, equal to ``tokenizer.encode(text, add_special_tokens=False)``; without
    ``added_tokens``, with the strings of special tokens taken as ordinary text."""

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path) if added_tokens else None
        added = self.whole.get_added_tokens_decoder().values() if added_tokens else []
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.plain.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = Tokenizer(self.plain.model)  # the same merges on words cut and mapped before
        # What the tokenizer's own pre-tokenizer makes of a space-led word of each letter.
        letters = re.findall(f"[{LATIN}]", "".join(map(chr, range(256))))
        cut = {c: self._cut(f" x{c}") for c in letters}
        heads = {v[0][:v[0].index("x")] for v in cut.values() if len(v) == 1}
        self.head = heads.pop() if len(heads) == 1 else None
        if self.head is not None:
            self.mapped = {ord(c): v[0][len(self.head) + 1:] for c, v in cut.items() if len(v) == 1}
            self.folds = all(self.mapped.get(c) == self.mapped.get(ord(chr(c).lower())) for c in self.mapped)
            whole = "".join(rf"\x{{{c:x}}}" for c in self.mapped)
            self.simple = rf"\A(?P<lead>[\t\n]?)(?P<word>[{whole}]+)(?P<marks>[{MARKS}]*)\z"
            self.stop = self._stop()
        self.leads = Memo(lambda new: [self.direct(x.strip("\t")) for x in new])
        self.words = Memo(self._merge)
        self.marks = Memo(lambda new: [self._after(x) for x in new])
        self.others = Memo(self._alone)
        self.added = [t.content for t in added]
        self.added_normal = [self._normal(t.content) for t in added if t.normalized and self.plain.normalizer]

    def _normal(self, text: str) -> str:
        return self.plain.normalizer.normalize_str(text) if self.plain.normalizer else text

    def _has_added(self, text: str) -> bool:
        """Whether an added token's string is in the text (or, for those that say so, in its normal form)."""
        if any(a in text for a in self.added):
            return True
        if not self.added_normal:
            return False
        normal = self._normal(text)
        return any(a in normal for a in self.added_normal)

    def _cut(self, text: str) -> list[str]:
        return [p for p, _ in self.plain.pre_tokenizer.pre_tokenize_str(self._normal(text))]

    def _after(self, marks: str) -> bytes | None:
        """Ids that marks add behind a letter; None if they are not cut off from it."""
        if marks and self._cut(f" x{marks}")[:1] != self._cut(" x"):
            return None
        return self.direct(f" x{marks}")[len(self.direct(" x")):]

    def _stop(self) -> tuple[str, int] | None:
        """A symbol that is no part of any mapped letter and whose id, if it stands alone, no word has."""
        for c in "!#$%&":
            ids = self.model.encode([c], is_pretokenized=True, add_special_tokens=False).ids
            if len(ids) == 1 and c in self.model.id_to_token(ids[0]) \
                    and not any(c in x for x in [self.head, *self.mapped.values()]):
                return c, ids[0]
        return None

    def direct(self, text: str) -> bytes:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _alone(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces through the whole tokenizer, each by itself."""
        texts = [p[1:] if p[0] == "\t" else p if p[0] == "\n" else " " + p for p in pieces]
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]

    def _merge(self, new: list[str]) -> list[bytes]:
        """Ids of words through the library's merges directly, many in one call: the ids of a stop between
        them tell where each ends."""
        words = [self.head + x[1:].translate(self.mapped) if x[0] == " " else x.translate(self.mapped) for x in new]
        if self.stop is None:
            return [np.array(e.ids, self.dtype).tobytes() for e in self.model.encode_batch_fast(
                [[x] for x in words], is_pretokenized=True, add_special_tokens=False)]
        stop, stop_id = self.stop
        w, out = self.dtype.itemsize, []
        for at in range(0, len(words), CALL_PIECES):
            part = words[at:at + CALL_PIECES]
            apart = [stop] * (2 * len(part))
            apart[::2] = part
            got, = self.model.encode_batch_fast([apart], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, self.dtype)
            ends = np.flatnonzero(ids == stop_id)
            starts, data = [0, *((ends + 1) * w).tolist()], ids.tobytes()
            out.extend(data[a:b] for a, b in zip(starts[:len(part)], (ends * w).tolist(), strict=True))
        return out

    def _of(self, distinct: pa.Array) -> pa.Array:
        """Ids of distinct pieces."""
        if self.head is None:
            return self.others.get(distinct)
        lead, word, marks = pc.extract_regex(distinct, self.simple).flatten()
        key = pc.utf8_lower(word) if self.folds else word
        if self.head:
            key = pc.binary_join_element_wise(pc.if_else(pc.equal(lead, ""), SPACE, NO_TEXT), key, NO_TEXT)
        ids = pc.binary_join_element_wise(self.leads.of(lead), self.words.of(key), self.marks.of(marks), NO_IDS)
        if ids.null_count:
            other = ids.is_null()
            ids = pc.replace_with_mask(ids, other, self.others.get(distinct.filter(other)))
        return ids

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``."""
        whole = {i for i, t in enumerate(texts) if t and self._has_added(t)} if self.added else ()
        cut, before = pieces([None if i in whole else t for i, t in enumerate(texts)] if whole else texts)
        each = cut.dictionary_encode()
        ids = self._of(each.dictionary).take(each.indices)
        _, ends, data = ids.buffers()
        data = memoryview(data or b"")
        at = np.frombuffer(ends, np.int64)[ids.offset:][before].tolist() if len(ids) else [0] * len(before)
        out = [bytes(data[a:b]) for a, b in zip(at, at[1:])]
        for i in whole:
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, self.dtype).tobytes()
        return out


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file and option. It is kept on the library's module, which
    outlives a task in a reused worker (this module is shipped with each task)."""
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_tidepool_encoders", {})
    key = path, added_tokens
    if key not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept.clear()
        kept[key] = Encoder(path, added_tokens)
    return kept[key]


def text_steps(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(start, texts) in steps of bounded length (a longer text is a step of its own)."""
    at, held, size = 0, [], 0
    for t in texts:
        held.append(t.as_py())
        size += len(held[-1] or "")
        if size >= TEXT_STEP or len(held) >= TEXT_ROWS:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def crc_u32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


# ---------------------------------------------------------------- token files

def _open(root: str):
    """(file system, path) of a folder URI or plain path; local ones need no Hadoop client."""
    from pyarrow import fs
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return fs.FileSystem.from_uri(root)


def _write_part(batches: Iterator[pa.RecordBatch], root: str, tokenizer: str,
                end_id: int | None, added_tokens: bool) -> Iterator[pa.RecordBatch]:
    """Write one part's three files (under a name of this attempt, then renamed)."""
    task = TaskContext.get()
    files, folder = _open(root)
    name = f"{folder}/part-{task.partitionId():06d}"
    tmp = f"{name}.{task.taskAttemptId()}"
    enc, sizes, ids_of, valid = None, [], [], []
    out = None
    for batch in batches:
        if out is None:
            enc = encoder(tokenizer, added_tokens)
            end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
            files.create_dir(folder, recursive=True)
            out = files.open_output_stream(f"{tmp}.ids")
        docs = batch.column("doc_id")
        valid.append(np.array(docs.is_valid(), dtype=np.uint8))
        ids_of.append(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        for _, texts in text_steps(batch.column("text")):
            data = [x + end for x in enc.encode(texts)]
            sizes.extend(len(x) // enc.dtype.itemsize for x in data)
            out.write(b"".join(data))
    if out is None:
        return
    out.close()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    for kind, data in (("idx", offsets.tobytes()),
                       ("doc", np.concatenate(ids_of).tobytes() + np.concatenate(valid).tobytes())):
        with files.open_output_stream(f"{tmp}.{kind}") as f:
            f.write(data)
    for kind in ("ids", "idx", "doc"):
        files.move(f"{tmp}.{kind}", f"{name}.{kind}")
    yield pa.RecordBatch.from_pydict({
        "part": pa.array([task.partitionId()], pa.int32()),
        "path": [f"{root}/part-{task.partitionId():06d}"],
        "n_docs": pa.array([len(sizes)], pa.int64()),
        "n_tokens": pa.array([int(offsets[-1])], pa.int64()),
        "width": pa.array([enc.dtype.itemsize], pa.int32())})


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int | None = None, doc_id: str = "doc_id",
                 text: str = "text", root: str | None = None, added_tokens: bool = False) -> DataFrame:
    """Write the token files of all documents in ascending id order; returns the manifest
    (``part, path, n_docs, n_tokens, width, base_docs, base``), also stored in ``root``."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.octet_length("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    parts = materialize(ranged.mapInArrow(
        partial(_write_part, root=root, tokenizer=tokenizer, end_id=end_id, added_tokens=added_tokens),
        "part int, path string, n_docs bigint, n_tokens bigint, width int"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = parts.withColumns({f"base{s}": F.coalesce(F.sum(f"n_{c}").over(before), F.lit(0))
                               for s, c in (("_docs", "docs"), ("", "tokens"))})
    based.write.mode("overwrite").parquet(f"{root}/manifest.parquet")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/manifest.parquet")


def _map_file(path: str, dtype: str, offset: int, count: int) -> np.ndarray:
    """``count`` numbers from byte ``offset`` of a file: a memory map if it is local."""
    files, name = _open(path)
    if count == 0:
        return np.zeros(0, dtype)
    if type(files).__name__ == "LocalFileSystem":
        return np.memmap(name, dtype=dtype, mode="r", offset=offset, shape=(count,))
    with files.open_input_file(name) as f:
        return np.frombuffer(f.read_at(count * np.dtype(dtype).itemsize, offset), dtype)


def _read_ranges(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            n, path, lo = r["hi"] - r["lo"], r["path"], r["lo"]
            offsets = _map_file(f"{path}.idx", "<u8", 8 * lo, n + 1).astype(np.int64)
            dtype = f"<u{r['width']}"
            ids = _map_file(f"{path}.ids", dtype, r["width"] * int(offsets[0]), int(offsets[-1] - offsets[0]))
            docs = _map_file(f"{path}.doc", "<i8", 8 * lo, n)
            valid = _map_file(f"{path}.doc", "u1", 8 * r["n_docs"] + lo, n)
            cuts = (offsets - offsets[0]).tolist()
            each = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
            out = {"doc_id": pa.array(docs, pa.int64(), mask=valid == 0),
                   "start": pa.array(offsets[:-1] + r["base"], pa.int64()),
                   "n_tokens": pa.array(np.diff(offsets), pa.int64()),
                   "ids_crc32": pa.array([crc_u32(x) for x in each], pa.int64())}
            if with_ids:
                out["ids"] = pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of the token files: ``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids``."""
    spans = manifest.withColumn("lo", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("n_docs") - 1, F.lit(0)), F.lit(READ_DOCS).cast("bigint")))) \
        .withColumn("hi", F.least(F.col("lo") + READ_DOCS, F.col("n_docs"))) \
        .select("path", "lo", "hi", "n_docs", "width", "base")
    slots = manifest.sparkSession.sparkContext.defaultParallelism
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" \
        + (", ids array<int>" if with_ids else "")
    return spans.repartition(max(slots, int(spans.count() // 4))) \
        .mapInArrow(partial(_read_ranges, with_ids=with_ids), schema)
