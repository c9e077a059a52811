"""Toxic passages by maximum-scoring segment search, calibrated by extreme-value statistics.

Token scores are log-odds with Dirichlet priors: a word's toxic share has as prior its 5-letter
stem's, that stem's its 4-letter stem's, and that one the labelled corpus' own share, each with the
same concentration. Counts are of documents, equal texts once, so neither a repeated word nor a
group of copies passes for evidence; every word and stem has counts of its own under a 64-bit hash.
The counts grow with the labelled vocabulary and never reach the driver: they are files in the
shared folder, sorted by key, of which a model holds the paths and first keys; workers map
them into memory and touch the pages their words are on. Less a constant, scores are negative on average; a linear-time scan finds every
maximal scoring segment of a text. On clean documents that took no part in the counts, the scale
(the root of E[exp(scale * score)] = 1) and the size factor of the extreme-value law are fitted,
which turn a segment's score and the text's length into an expected number of chance segments.
A document's score is a logistic function of its best segment's and of how many are significant.

Edge cases: null, empty and wordless texts have no segments and get the score of a text without
evidence; unlabelled rows and rows with null ids do not train; of repeated label rows the highest
counts; without labels every text gets the prior's score; an empty table gives an empty result;
further columns are carried unchanged. Tokens are all runs of letters and digits wherever they
stand (a mark, slash or hyphen ends one), overlapping letter pairs in scripts without spaces, symbols
such as emoji, and marks that stand alone; a word counts whole, however long.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.llm import tokens as token_files
from tidepool.llm.common import materialize, packed_row
from tidepool.plans.joins import note_scratch, sized_lookup
from tidepool.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Letters of the stems.
STEMS = (4, 5)
#: Keys that a counting task holds before it sums them up, and keys per file of counts.
HELD_KEYS = 1 << 21
FILE_KEYS = 1 << 19
#: Strength of each prior, in documents.
CONCENTRATION = 20.0
#: Taken from every token's log-odds, and the largest expected chance count of a significant one.
DRIFT = 2.0
SIGNIFICANT = 0.01
FOLDS = 5
#: Fold 0 is held out, these count words, the rest calibrates.
COUNT_FOLDS = (1, 2, 3)
#: Most labelled rows used to fit the two logistic weights (the rows of least hash).
FIT_ROWS = 20_000
MEMO_WORDS = 300_000
MEMO_PIECES = 400_000
#: Most tokens of a piece that is remembered.
MEMO_TOKENS = 4
#: Rows taken out of an Arrow batch together.
BATCH_ROWS = 512
#: Characters of texts that are cut and looked up together.
TEXT_STEP = 4_000_000
#: A word of one token that Arrow and Python bring to lower case alike, its ASCII letters there already.
LATIN_WORD = r"\A[0-9a-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+\z"
#: Marks that end a word and are no tokens beside one: ASCII punctuation and symbols.
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Code blocks written without spaces: Thai, Lao, Myanmar, Khmer, Tai, kana, Han.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF),
            (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
            (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
            (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))


def char_ranges(kinds: Sequence[str], spans: Sequence[tuple[int, int]]) -> str:
    """The characters of ``spans`` whose category begins with one of ``kinds``, for a regex class."""
    out: list[list[int]] = []
    for lo, hi in spans:
        if lo >= 0x20000:  # Han planes, also what this Unicode version does not know yet
            out.append([lo, hi])
            continue
        for c in range(lo, hi + 1):
            if unicodedata.category(chr(c)).startswith(tuple(kinds)):
                if out and out[-1][1] == c - 1:
                    out[-1][1] = c
                else:
                    out.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out)


def token_pattern(joined: str, marks: str, symbols: str) -> re.Pattern:
    """Tokens: marks that stand alone, runs without spaces, words, symbols."""
    letter = rf"[^\W_{joined}]"
    runs = rf"[{joined}][{joined}{marks}]*+|" if joined else ""
    return re.compile(rf"(?<!\S)(?:[^\w\s]|_)++(?!\S)|{runs}"
                      rf"{letter}++(?:(?:[{marks}]++['’]?|['’]){letter}++)*+[{marks}]*+|[{symbols}]++")


JOINED_CHARS = char_ranges("LMN", UNSPACED)
TOKEN = token_pattern(JOINED_CHARS, char_ranges("M", [(0, 0x1FFFF)]) + "\u00ad\u200c\u200d",
                      char_ranges(["So", "Sk"], [(0x80, 0x1FFFF)]))
#: The same for texts without characters of ``RARE``, which it reads faster.
PLAIN_TOKEN = token_pattern("", "\u00ad", char_ranges(["So", "Sk"], [(0x80, 0x2FF)]))
RARE = re.compile("[\u0300-\u1fff\u200c\u200d\u20d0-\U0010ffff]")
JOINED = re.compile(f"[{JOINED_CHARS}]")


def spans_of(text: str) -> list[tuple[int, int]]:
    """Places of the text's tokens."""
    rare = not text.isascii() and RARE.search(text) is not None
    spans = [m.span() for m in (TOKEN if rare else PLAIN_TOKEN).finditer(text)]
    if not rare or JOINED.search(text) is None:
        return spans
    out = []
    for a, b in spans:
        if JOINED.match(text, a):
            out.extend((i, min(i + 2, b)) for i in range(a, max(a + 1, b - 1)))
        else:
            out.append((a, b))
    return out


def words_of(text: str | None) -> list[str]:
    """The text's tokens in order."""
    if not text:
        return []
    if text.isascii() or RARE.search(text) is None:
        return PLAIN_TOKEN.findall(text)
    if JOINED.search(text) is None:
        return TOKEN.findall(text)
    return [text[a:b] for a, b in spans_of(text)]


def piece_words(piece: str) -> Sequence[str]:
    """The tokens of a piece without white space; one that is a word is not held twice."""
    found = words_of(piece)
    return (piece,) if len(found) == 1 and found[0] == piece else found


def _strings(column: pa.Array) -> list[str]:
    """``column.to_pylist()`` without a scalar per value."""
    return column.to_numpy(zero_copy_only=False).tolist()


class PieceTokens(dict):
    """Lower-case tokens of a piece without ASCII white space; short ones are remembered."""

    def __missing__(self, piece: str) -> Sequence[str]:
        found = [w.lower() for w in piece_words(piece)]
        if len(found) <= MEMO_TOKENS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = found
        return found

    def of(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct tokens of all texts, the number in that list of every token in order, and how
        many tokens come before each text and in all.

        No token spans white space, so a text's tokens are those of its pieces. Texts are cut in Arrow and
        each distinct piece is read once: a Latin word between ASCII marks is what is left without the
        marks, any other piece goes through the pattern."""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string())))
        each = cut.flatten().dictionary_encode()
        bare = pc.ascii_trim(each.dictionary, ASCII_MARKS)
        plain = pc.match_substring_regex(bare, LATIN_WORD)
        odd = [self[p] for p in _strings(each.dictionary.filter(pc.invert(plain)))]
        words = pa.concat_arrays([pc.utf8_lower(bare.filter(plain)), pa.array(chain.from_iterable(odd), pa.large_string())]).dictionary_encode()
        # How many tokens a piece has, and where they begin among those of all distinct pieces, plain ones first.
        alone = plain.to_numpy(zero_copy_only=False)
        count, start = np.ones(len(alone), np.int64), np.cumsum(alone) - 1
        count[~alone] = [len(w) for w in odd]
        start[~alone] = alone.sum() + np.cumsum(count[~alone]) - count[~alone]
        at = each.indices.to_numpy()
        first, many = start[at], count[at]
        ends = np.concatenate([[0], np.cumsum(many)])
        if (many != 1).any():
            first = np.repeat(first - ends[:-1], many) + np.arange(ends[-1])
        pieces = np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy())])
        return _strings(words.dictionary), words.indices.to_numpy()[first], ends[pieces]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker holds the texts of few rows beside the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _steps(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """(start, texts) in steps of bounded length (a longer text is a step of its own)."""
    at, held, size = 0, [], 0
    for t in texts:
        if held and size + len(t or "") > TEXT_STEP:
            yield at, held
            at, held, size = at + len(held), [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield at, held


def fold(doc_id: Column) -> Column:
    return (F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS).cast("int")


def _hash(texts: list[str], kind: int) -> np.ndarray:
    """64-bit SipHash of each text, by another key for each kind."""
    column = np.empty(len(texts), dtype=object)
    column[:] = texts
    return hash_array(column, hash_key=f"tidepool-kind-{kind:02d}", categorize=False).view(np.int64)


def keys_of(words: Sequence[str]) -> np.ndarray:
    """64-bit keys of lower-case tokens, a row each: stems from short to long, then the word itself."""
    return np.column_stack([*[_hash([w[:k] for w in words], k) for k in STEMS], _hash(list(words), 0)])


def features(token: str) -> list[int]:
    """64-bit keys of a token in any case."""
    return keys_of([token.lower()])[0].tolist()


# ---------------------------------------------------------------- word counts

def _sums(held: list[tuple[np.ndarray, np.ndarray]], side: int) -> pa.RecordBatch:
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)
    return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "toxic": pa.array([side] * len(keys), pa.int32()),
                                       "n": pa.array(n, pa.int64())})


def _document_counts(words: list[str], at: np.ndarray, before: np.ndarray, sides: np.ndarray
                     ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per side the keys of its texts' tokens and in how many of these texts each is."""
    keys, of_word = np.unique(keys_of(words), return_inverse=True)
    of_word = of_word.reshape(len(words), -1)
    text = np.repeat(np.arange(len(sides)), np.diff(before))
    text, word = np.divmod(np.unique(text * len(words) + at), len(words))
    text, key = np.divmod(np.unique(text[:, None] * len(keys) + of_word[word]), len(keys))
    for side in (0, 1):
        n = np.bincount(key[sides[text] == side], minlength=len(keys))
        some = np.flatnonzero(n)
        yield side, keys[some], n[some]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, toxic, documents) of the task's labelled texts; key null counts the documents."""
    held, size, total, pieces = ([], []), [0, 0], [0, 0], PieceTokens()
    for batch in _parts(batches):
        sides = batch.column("toxic").to_numpy(zero_copy_only=False)
        for side in (0, 1):
            total[side] += int((sides == side).sum())
        for first, texts in _steps(batch.column("text").to_pylist()):
            words, at, before = pieces.of(texts)
            if not words:
                continue
            for side, keys, n in _document_counts(words, at, before, sides[first:first + len(texts)]):
                held[side].append((keys, n))
                size[side] += len(keys)
                if size[side] > HELD_KEYS:
                    yield _sums(held[side], side)
                    held[side].clear()
                    size[side] = 0
    for side in (0, 1):
        if held[side]:
            yield _sums(held[side], side)
    yield pa.RecordBatch.from_pydict({"key": pa.array([None, None], pa.int64()), "toxic": pa.array([0, 1], pa.int32()),
                                      "n": pa.array(total, pa.int64())})


@dataclass
class CountFiles:
    """Document counts by key, in files of ascending keys: a file's keys, then its toxic counts, then
    all counts, each 64 bits. Only paths, sizes and first keys are held."""

    paths: list[str]
    sizes: list[int]
    first: np.ndarray

    def column(self, part: int, k: int) -> np.ndarray:
        """Column k (keys, toxic, every) of a file: a memory map if the folder is a local mount."""
        return token_files._map_file(self.paths[part], "<i8", 8 * k * self.sizes[part], self.sizes[part])

    def whole(self, k: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *[self.column(p, k) for p in range(len(self.paths))]])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic and all documents of each key (0 for unknown ones)."""
        toxic, every = np.zeros(keys.shape), np.zeros(keys.shape)
        part = np.searchsorted(self.first, keys, side="right") - 1
        for p in np.unique(part[part >= 0]).tolist():
            where = np.nonzero(part == p)
            wanted, back = np.unique(keys[where], return_inverse=True)  # ascending: near pages together
            if p not in self.maps:
                self.maps[p] = [self.column(p, k) for k in range(3)]
            held = self.maps[p]
            at = np.minimum(np.searchsorted(held[0], wanted), self.sizes[p] - 1)
            known = held[0][at] == wanted
            toxic[where] = np.where(known, held[1][at], 0)[back]
            every[where] = np.where(known, held[2][at], 0)[back]
        return toxic, every

    def __post_init__(self):
        self.maps: dict[int, list[np.ndarray]] = {}

    def __getstate__(self):
        return {**self.__dict__, "maps": {}}


@dataclass
class Model:
    """Token counts and calibration."""

    counts: CountFiles
    share: float
    scale: float = 1.0
    factor: float = 0.1
    weights: tuple[float, float, float] = (-3.0, 0.5, 1.0)

    @property
    def keys(self) -> np.ndarray:
        """All keys, ascending (for tests: the whole vocabulary)."""
        return self.counts.whole(0)

    @property
    def toxic(self) -> np.ndarray:
        return self.counts.whole(1)

    @property
    def every(self) -> np.ndarray:
        return self.counts.whole(2)

    def log_odds(self, words: Sequence[str]) -> np.ndarray:
        p = np.full(len(words), self.share)
        if len(words):
            toxic, every = self.counts.find(keys_of([w.lower() for w in words]))
            for k in range(toxic.shape[1]):
                p = (toxic[:, k] + CONCENTRATION * p) / (every[:, k] + CONCENTRATION)
        p, q = np.clip(p, 1e-6, 1 - 1e-6), self.share
        return np.log(p / (1 - p)) - math.log(q / (1 - q))


def _write_counts(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """One file of sorted counts, under a name of this attempt; its manifest row names it."""
    columns = [[], [], []]
    for batch in batches:
        for held, name in zip(columns, ("key", "toxic", "every")):
            held.append(batch.column(name).to_numpy(zero_copy_only=False).astype("<i8"))
    keys, toxic, every = (np.concatenate(c) if c else np.zeros(0, "<i8") for c in columns)
    if not len(keys):
        return
    task = TaskContext.get()
    files, folder = token_files._open(root)
    files.create_dir(folder, recursive=True)
    name = f"counts-{task.partitionId():06d}-{task.taskAttemptId()}"
    with files.open_output_stream(f"{folder}/{name}") as out:
        for part in (keys, toxic, every):
            out.write(part.tobytes())
    yield pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "n": pa.array([len(keys)], pa.int64()),
                                      "first": pa.array([int(keys[0])], pa.int64())})


def count_model(labelled: DataFrame) -> Model:
    """Word counts of labelled texts (``text, toxic``); a row per file of counts comes back."""
    spark = labelled.sparkSession
    counted = materialize(labelled.select("text", "toxic").mapInArrow(_count, "key bigint, toxic int, n bigint")
                          .groupBy("key").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                                              F.sum("n").alias("every")))
    total = counted.where(F.col("key").isNull()).agg(F.sum("every").alias("every"), F.sum("toxic").alias("toxic")).first()
    share = min(max(((total.toxic or 0) + 0.5) / ((total.every or 0) + 1.0), 1e-4), 1 - 1e-4)
    known = counted.where(F.col("key").isNotNull())
    root = scratch_path(spark, f"tables/counts-{uuid.uuid4().hex}")
    note_scratch(root)
    rows = known.repartitionByRange(max(1, -(-known.count() // FILE_KEYS)), "key").sortWithinPartitions("key") \
        .mapInArrow(partial(_write_counts, root=root), "path string, n bigint, first bigint").collect()
    rows.sort(key=lambda r: r.first)
    return Model(CountFiles([r.path for r in rows], [r.n for r in rows],
                            np.array([r.first for r in rows], dtype=np.int64)), float(share))


# ---------------------------------------------------------------- segments

def maximal_segments(scores: Sequence[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in one linear scan: candidate segments
    are kept in order with the running totals at their ends, and a new one swallows the earlier
    candidates it can only gain by joining."""
    kept: list[list] = []  # start, end, total before, total after, previous with smaller 'before'
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = kept[j][4]
            new[4] = j
            if j < 0 or kept[j][3] >= new[3]:
                kept.append(new)
                break
            new[0], new[2] = kept[j][0], kept[j][2]
            del kept[j:]
    return [(k[0], k[1], k[3] - k[2]) for k in kept]


class Scorer:
    """Token scores, and segments of whole texts. Scores of words are remembered, a bounded number."""

    def __init__(self, model: Model):
        self.model, self.pieces, self.tokens = model, PieceTokens(), {}

    def _values(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words."""
        values = np.array(list(map(self.tokens.get, words)), dtype=np.float64)
        new = np.flatnonzero(np.isnan(values))
        if len(new):
            asked = [words[i] for i in new.tolist()]
            values[new] = self.model.log_odds(asked) - DRIFT
            if len(self.tokens) + len(asked) > MEMO_WORDS:
                self.tokens.clear()
            self.tokens.update(zip(asked, values[new].tolist()))
        return values

    def scores(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Scores of each text's tokens in order. Words are looked up for many texts at a time."""
        for _, some in _steps(texts):
            words, at, before = self.pieces.of(some)
            every = self._values(words)[at]
            yield from (every[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist()))

    def segments(self, texts: Sequence[str | None]) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """Of each text the number of tokens, and segments as (first token, end token, score).

        Runs of tokens that score at or below zero only matter by their sum, so the scan sees the
        scoring tokens and one sum per run between them."""
        for s in self.scores(texts):
            up = np.flatnonzero(s > 0)
            if not len(up):
                yield len(s), []
                continue
            total = np.concatenate([[0.0], np.cumsum(s)])
            gaps = total[up] - np.concatenate([[total[up[0]]], total[up[:-1] + 1]])
            mixed = np.column_stack([gaps, s[up]]).ravel().tolist()
            yield len(s), [(int(up[a // 2]), int(up[(b - 1) // 2]) + 1, x) for a, b, x in maximal_segments(mixed)]


def surprise(score: float, tokens: int, model: Model) -> float:
    """-ln of the expected number of chance segments of at least this score in such a text."""
    return model.scale * score - math.log(max(model.factor * max(tokens, 1), 1e-300))


def summary(tokens: int, found, model: Model) -> tuple[float, float]:
    """Best segment's surprise (0 if none) and ln(1 + number of significant ones)."""
    each = [surprise(x, tokens, model) for _, _, x in found]
    many = sum(e >= -math.log(SIGNIFICANT) for e in each)
    return min(max(0.0, max(each, default=0.0)), 40.0), math.log1p(many)


def probability(x: tuple[float, float], weights) -> float:
    z = weights[0] + weights[1] * x[0] + weights[2] * x[1]
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


# ---------------------------------------------------------------- calibration

BIN = 0.125
BIN_LOW, BIN_HIGH = -30.0, 30.0
BINS = int((BIN_HIGH - BIN_LOW) / BIN) + 1


def _token_scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Histogram of token scores."""
    scorer, hist = Scorer(model), np.zeros(BINS, dtype=np.int64)
    for batch in _parts(batches):
        for s in scorer.scores(batch.column("text").to_pylist()):
            at = np.clip(np.rint((s - BIN_LOW) / BIN), 0, BINS - 1).astype(np.int64)
            hist += np.bincount(at, minlength=BINS)
    at = np.flatnonzero(hist)
    yield pa.RecordBatch.from_pydict({"bin": pa.array(at, pa.int32()), "n": pa.array(hist[at], pa.int64())})


def _best(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per text: number of tokens, and score of the best segment (0 if there is none)."""
    scorer = Scorer(model)
    for batch in _parts(batches):
        rows = list(scorer.segments(batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_pydict({
            "tokens": pa.array([n for n, _ in rows], pa.int64()),
            "best": pa.array([max((x for *_, x in f), default=0.0) for _, f in rows], pa.float64())})


def _summaries(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per text: the two inputs of the logistic function under the calibrated model."""
    scorer = Scorer(model)
    for batch in _parts(batches):
        rows = [summary(n, found, model) for n, found in scorer.segments(batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "toxic": batch.column("toxic"), "x": pa.array([a for a, _ in rows], pa.float64()),
            "many": pa.array([b for _, b in rows], pa.float64())})


def root_scale(bins: np.ndarray, counts: np.ndarray) -> float:
    """Positive root of mean(exp(scale * score)) = 1, or 1 where chance scores have none."""
    scores = BIN_LOW + bins * BIN
    if not len(scores) or scores.max() <= 0 or (scores * counts).sum() >= 0:
        return 1.0
    p, lo, hi = counts / counts.sum(), 0.0, 1.0
    mean = lambda k: float((p * np.exp(np.minimum(k * scores, 600.0))).sum())
    while mean(hi) < 1 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    return max(0.05, min(hi, 5.0))


def fit_logistic(x: np.ndarray, y: np.ndarray, start: Sequence[float]) -> tuple[float, float, float]:
    """A constant and two weights, neither below zero, by damped Newton steps, held to ``start``
    by a weak Gaussian prior. A weight that would fall below zero is set to zero and left out."""
    every = np.column_stack([np.ones(len(x)), x])
    w0, pull = np.array(start, dtype=np.float64), np.array([0.02, 0.1, 0.1])
    free = [0, 1, 2]
    while True:
        a, w = every[:, free], w0[free].copy()

        def loss(v: np.ndarray) -> float:
            z = a @ v
            return float((np.logaddexp(0, z) - y * z).sum() + (pull[free] * (v - w0[free]) ** 2).sum() / 2)

        now = loss(w)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
            grad = a.T @ (p - y) + pull[free] * (w - w0[free])
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pull[free]), grad)
            size = 1.0
            while size > 1e-8 and loss(w - size * step) > now:
                size /= 2
            w = w - size * step
            before, now = now, loss(w)
            if before - now < 1e-9 * (1 + abs(now)):
                break
        below = [k for k, v in zip(free, w) if k and v < 0]
        if not below:
            out = np.zeros(3)
            out[free] = w
            return tuple(out.tolist())
        free = [k for k in free if k not in below]


def calibrate(model: Model, held: DataFrame) -> Model:
    """Fit scale and factor on all clean rows of ``held`` (``_id, text, toxic, pick``), and the
    logistic weights on the ``FIT_ROWS`` rows of least ``pick``."""
    clean = held.where(F.col("toxic") == 0)
    hist = clean.select("text").mapInArrow(partial(_token_scores, model=model), "bin int, n bigint") \
        .groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    model.scale = root_scale(hist["bin"].to_numpy(), hist["n"].to_numpy())
    best = clean.select("text").mapInArrow(partial(_best, model=model), "tokens bigint, best double")
    # The expected number of chance segments above the best is exponential with mean 1.
    rare = best.where(F.col("tokens") > 0).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("tokens") * F.exp(-F.lit(model.scale) * F.col("best"))).alias("s")).first()
    if rare["n"]:
        model.factor = max(1e-6, min(10.0, rare["n"] / max(rare["s"], 1e-9)))
    some = held.select("pick", "_id").orderBy("pick", "_id").limit(FIT_ROWS)
    chosen = held.join(F.broadcast(some.select("_id")), "_id", "left_semi")
    rows = chosen.select("text", "toxic").mapInArrow(
        partial(_summaries, model=model), "toxic int, x double, many double").toArrow()
    y, x, many = (rows.column(c).to_numpy() for c in ("toxic", "x", "many"))
    if len(y):
        model.weights = fit_logistic(np.column_stack([x, many]), y.astype(np.float64), Model.weights)
    return model


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    marks = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()) \
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label)).cast("int").alias("toxic")) \
        .where((fold(F.col("_id")) != 0) & F.col("toxic").isin(0, 1))
    known = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    # Of equal texts with equal labels only the smallest id learns.
    one = known.select("_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")) \
        .join(sized_lookup(marks), "_id").groupBy("sha", "toxic").agg(F.min("_id").alias("_id"))
    rows = known.join(sized_lookup(one.select("_id", "toxic")), "_id") \
        .withColumn("_fold", fold(F.col("_id")))
    model = count_model(rows.where(F.col("_fold").isin(*COUNT_FOLDS)))
    held = rows.where(~F.col("_fold").isin(*COUNT_FOLDS)).withColumn("pick", F.xxhash64("_id"))
    return calibrate(model, held)


# ---------------------------------------------------------------- scoring

PASSAGES = "array<struct<start: int, end: int, score: double, expected: double, text: string>>"


def passages(text: str, tokens: int, found, model: Model) -> list[dict]:
    """Significant segments with their place and words (character offsets in the text)."""
    keep = [(a, b, x) for a, b, x in found if surprise(x, tokens, model) >= -math.log(SIGNIFICANT)]
    if not keep:
        return []
    spans = spans_of(text)
    return [{"start": spans[a][0], "end": spans[b - 1][1], "score": x,
             "expected": math.exp(-surprise(x, tokens, model)),
             "text": text[spans[a][0]:spans[b - 1][1]]} for a, b, x in keep]


def _score(batches: Iterator[pa.RecordBatch], model: Model, with_passages: bool) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                               ("expected", pa.float64()), ("text", pa.string())]))
    for batch in _parts(batches):
        score, places = [], []
        texts = batch.column("_text").to_pylist()
        for text, (n, found) in zip(texts, scorer.segments(texts)):
            score.append(probability(summary(n, found, model), model.weights))
            if with_passages:
                places.append(passages(text, n, found, model) if found else [])
        cols = [batch.column("_row"), pa.array(score, pa.float64())]
        names = ["_row", "score"]
        if with_passages:
            cols, names = [*cols, pa.array(places, kind)], [*names, "passages"]
        yield pa.RecordBatch.from_arrays(cols, names)


def score(docs: DataFrame, model: Model, text: str = "text", carry: Sequence[str] | None = None,
          with_passages: bool = True) -> DataFrame:
    """``carry`` columns (default: all) with ``score`` (0 to 1), ``predicted`` (score >= 0.5) and
    ``passages``, the significant toxic segments. Carried columns called like these, in any case, are
    replaced by them."""
    carry = list(docs.columns if carry is None else carry)
    rows = docs.select(F.col(text).alias("_text"), packed_row(carry))
    made = "score double" + (f", passages {PASSAGES}" if with_passages else "")
    schema = StructType([rows.schema["_row"], *StructType.fromDDL(made).fields])
    done = rows.mapInArrow(partial(_score, model=model, with_passages=with_passages), schema)
    extra = ["passages"] if with_passages else []
    return done.select(*[F.col("_row").getField(c).alias(c) for c in carry
                         if c.lower() not in ("score", "predicted", *extra)],
                       "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *extra)
