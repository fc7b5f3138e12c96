"""Operator 11: spelling variants by blocked Gram matrices of letter counts.

1. Every task counts the words of its texts; the counts are summed by word, and
   words long and frequent enough make the vocabulary.
2. A word's letters fall into ``CLASSES`` classes.  Words with equal class counts
   (so of equal length) are a *cell*, whose number is linear in the counts: one
   inserted letter adds a fixed step to it, one replaced letter the difference
   of two.  Cells that one edit apart words can lie in are thus known by an
   addition: of the same length (``CLASSES`` * (``CLASSES`` - 1) / 2 steps and the
   cell itself) or of the next length (``CLASSES`` steps).
3. A cell is cut into blocks of about ``BLOCK_WORDS`` words, and each block meets
   the blocks of its own and the adjacent cells, each pair of blocks once.  The
   NumPy product of two blocks' letter-count matrices gives all squared distances;
   one edit changes them by at most two, so only such pairs are kept, and their
   letters are compared.
4. A task sends per word its number of near words and the most frequent of them,
   never the pairs; both are combined by word.  A form's form is followed by
   doubling, in about log2 of the longest chain rounds.

Blocks are bounded in words and letters, however many words share a cell, and
block pairs are dealt by block, so a hot cell is spread over tasks.  A number
that two cells share by wrapping (over 127 letters of a class) makes one cell of
both: more is compared, nothing is missed or met twice.

Edge cases: null or empty text has no words; a null doc_id counts as an empty
one in the edit rule; rows that repeat are counted each; ties between near
words go to the smaller in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastry.llm.common import LOWER, checkpointed, id_and_text
from forecastry.session import drop_scratch, scratch_path

LETTERS = "A-Za-zÀ-ÿ"
CLASSES = 8
BLOCK_WORDS = 1024
BLOCK_LETTERS = 1 << 16
PRODUCT = 1 << 21  # distances held at once
HELD = 500_000  # words whose counts a task holds before it sends them
#: Letters in their order of use in European text dealt to the classes in turn,
#: so that classes are about equally full; accented letters follow by code point.
_BY_USE = "eaniorstldcumphgbfvzkwyjxq"
_STEPS = [128**k for k in range(CLASSES)]
WRAP = 1 << 62


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and column (of the count matrix) of every code point below 256."""
    kind, column = np.arange(256) % CLASSES, 26 + np.arange(256) % 6
    for k, c in enumerate(_BY_USE):
        kind[ord(c)], column[ord(c)] = k % CLASSES, k
    return kind, column


KIND, COLUMN = letter_tables()


def cell_numbers(words: list[str]) -> np.ndarray:
    """The cell of every word."""
    step = np.array(_STEPS, np.int64)[KIND]
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    sums = np.concatenate([[0], np.cumsum(step[letters])])
    return (sums[ends] - sums[np.concatenate([[0], ends[:-1]])]) % WRAP


def edited(doc_id: int | None, run: str, every: int) -> str:
    """The rule that plants variants: in one of ``every`` (document, run) pairs
    one letter of the run is deleted."""
    return _edited(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), run, every)


def _edited(start: int, run: str, every: int) -> str:
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def count_words(df: DataFrame, least_letters: int, every: int | None) -> DataFrame:
    """(word, n) over all texts; ``every``: see :func:`edited` (None: texts as they are)."""
    runs = re.compile(f"[{LETTERS}]{{{least_letters},}}")  # shorter runs cannot give a word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def sent() -> Iterator[pa.RecordBatch]:
            ws, ns = list(total), list(total.values())
            for k in range(0, len(ws), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ws[k : k + 50_000], pa.string()), pa.array(ns[k : k + 50_000], pa.int64())], names=["word", "n"]
                )
            total.clear()

        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py()
                if not text:
                    continue
                found = Counter(runs.findall(text.encode().translate(LOWER).decode()))
                if every is None:
                    total.update(found)
                else:
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for w, n in found.items():
                        total[_edited(start, w, every)] += n
                if len(total) > HELD:
                    yield from sent()
        yield from sent()

    return df.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(df: DataFrame, least_letters: int, least_count: int, every: int | None) -> DataFrame:
    """(word, n, cell) of the words kept."""
    counted = count_words(df, least_letters, every).where((F.col("n") >= least_count) & (F.length("word") >= least_letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = pa.array(cell_numbers(batch.column("word").to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["word", "n", "cell"])

    return counted.mapInArrow(run, "word string, n long, cell long")


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of code points of equal length, or ``b`` one longer: whether
    exactly one is replaced, or one is inserted."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(1) == 1
    before = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return before + after >= n


class Block:
    """Words of one block, their letters and their letter counts."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = np.array(words, dtype=object), np.array(counts, np.int64)
        self.length = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        owner = np.repeat(np.arange(len(words)), self.length)
        self.grams = np.bincount(owner * 32 + COLUMN[letters], minlength=32 * len(words)).reshape(-1, 32).astype(np.float64)
        self.square = (self.grams * self.grams).sum(1)
        # code-point order within the block, for ties
        self.order = np.empty(len(words), np.int64)
        self.order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        self.starts, self.letters = np.concatenate([[0], np.cumsum(self.length)]), letters

    def rows(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.letters[self.starts[at][:, None] + np.arange(length)]


def near_pairs(a: Block, b: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words one edit apart (``same``: the blocks are one)."""
    left, right = [], []
    rows = max(1, PRODUCT // max(1, len(b.words)))
    for lo in range(0, len(a.words), rows):
        distance = a.square[lo : lo + rows, None] + b.square - 2 * (a.grams[lo : lo + rows] @ b.grams.T)
        i, j = np.nonzero(distance <= 2)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        left.append(i), right.append(j)
    i, j = np.concatenate(left), np.concatenate(right)
    keep_i, keep_j = [], []
    width = a.length[i] - b.length[j]
    for d in (0, -1, 1):
        of = np.flatnonzero(width == d)
        for n in np.unique(a.length[i[of]]).tolist():  # one length in all but wrapped cells
            at = of[a.length[i[of]] == n]
            step = max(1, PRODUCT // n)
            for k in range(0, len(at), step):
                part = at[k : k + step]
                x, y = a.rows(i[part], n), b.rows(j[part], n - d)
                ok = one_edit(y, x) if d == 1 else one_edit(x, y)
                keep_i.append(i[part[ok]]), keep_j.append(j[part[ok]])
    if not keep_i:
        return i[:0], j[:0]
    return np.concatenate(keep_i), np.concatenate(keep_j)


class Near:
    """Number of near words, and the most frequent one, of a block's words."""

    def __init__(self, block: Block):
        self.block = block
        self.count = np.zeros(len(block.words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def add(self, mine: np.ndarray, other: Block, theirs: np.ndarray) -> None:
        if not len(mine):
            return
        self.count += np.bincount(mine, minlength=len(self.count))
        order = np.lexsort((other.order[theirs], -other.n[theirs], mine))
        first = order[np.concatenate([[True], np.diff(mine[order]) != 0])]
        for i, j in zip(mine[first].tolist(), theirs[first].tolist(), strict=True):
            new = (-int(other.n[j]), other.words[j])
            if i not in self.best or new < self.best[i]:
                self.best[i] = new

    def batch(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.count)
        best = [self.best[i] for i in at.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.block.words[at].tolist(), pa.string()), pa.array(self.count[at]),
             pa.array([n for n, _ in best], pa.int64()), pa.array([w for _, w in best], pa.string())],
            names=["word", "n_near", "minus_n", "best"],
        )


def search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, i) and visitors after the block itself to what each
    word's near words are; one block and one visitor are held."""
    at, home, mine, words, counts = None, None, None, [], []

    def meet() -> Iterator[pa.RecordBatch]:
        block = Block(words, counts)
        i, j = near_pairs(home, block, False)
        mine.add(i, block, j)
        if len(j):
            theirs = Near(block)
            theirs.add(j, home, i)
            yield theirs.batch()

    def done() -> Iterator[pa.RecordBatch]:
        if words:
            yield from meet()
        if mine is not None:
            yield mine.batch()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "i", "visitor", "words", "counts")]
        for *key, visitor, new_words, new_counts in zip(*columns, strict=True):
            if visitor and key != at:
                continue  # of a block that got no words
            if visitor:
                words += new_words
                counts += new_counts
                if len(words) >= BLOCK_WORDS or sum(map(len, words)) >= BLOCK_LETTERS:  # small cells visit together
                    yield from meet()
                    words, counts = [], []
                continue
            yield from done()
            at, home, words, counts = key, Block(new_words, new_counts), [], []
            mine = Near(home)
            i, j = near_pairs(home, home, True)
            mine.add(np.concatenate([i, j]), home, np.concatenate([j, i]))
    yield from done()


def steps_to_adjacent() -> list[int]:
    """Differences of cell numbers that one edit makes, each pair one way."""
    return _STEPS + [b - a for a, b in combinations(_STEPS, 2)]


def blocks_of(words: DataFrame) -> DataFrame:
    """(cell, i, blocks, words, counts): the blocks, and how many their cell has."""
    cells = words.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("word")).alias("letters")).select(
        "cell", F.ceil(F.greatest(F.col("n") / BLOCK_WORDS, F.col("letters") / BLOCK_LETTERS)).cast("int").alias("blocks")
    )
    return (
        words.join(cells, "cell").withColumn("i", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .groupBy("cell", "i", "blocks").agg(F.collect_list(F.struct("word", "n")).alias("w"))
        .select("cell", "i", "blocks", F.col("w.word").alias("words"), F.col("w.n").alias("counts"))
    )


def near_words(blocks: DataFrame) -> DataFrame:
    """(word, n_near, minus_n, best): summed over all block pairs."""
    cells = blocks.select("cell", "blocks").distinct()
    adjacent = cells.select("cell", "blocks", F.explode(F.array(*[F.lit(s).cast("long") for s in steps_to_adjacent()])).alias("s"))
    pairs = adjacent.select(
        F.col("cell").alias("home"), F.col("blocks").alias("home_blocks"), ((F.col("cell") + F.col("s")) % WRAP).alias("cell")
    )
    own = cells.select(F.col("cell").alias("home"), F.col("blocks").alias("home_blocks"), "cell")
    met = pairs.join(cells.select("cell"), "cell", "left_semi").select("home", "home_blocks", "cell").union(own)
    last = F.when(F.col("home") == F.col("cell"), F.col("j") - 1).otherwise(F.col("home_blocks") - 1)
    visitors = (
        blocks.withColumnRenamed("i", "j").join(met, "cell").where(last >= 0)
        .select(F.col("home").alias("cell"), F.explode(F.sequence(F.lit(0), last)).alias("i"), F.lit(True).alias("visitor"),
                "words", "counts")
    )
    homes = blocks.select("cell", "i", F.lit(False).alias("visitor"), "words", "counts")
    found = (
        homes.union(visitors).repartition("cell", "i").sortWithinPartitions("cell", "i", "visitor")
        .mapInArrow(search_blocks, "word string, n_near long, minus_n long, best string")
    )
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "best")).alias("best")
    ).select("word", "n_near", "best.minus_n", "best.best")


def follow(forms: DataFrame, base: str) -> DataFrame:
    """(word, root) of the words with a form: forms followed to the last.

    A form is more frequent than its word, so there is no way back; each round
    doubles the steps taken, and is written, until none moves."""
    spark, round_ = forms.sparkSession, 0
    forms.select("word", F.col("form").alias("root")).write.parquet(f"{base}/roots-0")
    while True:
        roots = spark.read.parquet(f"{base}/roots-{round_}")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(onward, "root", "left")
        round_ += 1
        moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).write.parquet(
            f"{base}/roots-{round_}"
        )
        if spark.read.parquet(f"{base}/roots-{round_}").where("moved").isEmpty():
            return spark.read.parquet(f"{base}/roots-{round_}").select("word", "root")


def spelling_variants(
    df: DataFrame, least_letters: int = 7, least_count: int = 2, ratio: int = 10, edit_every: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of at least
    ``least_letters`` letters that occurs ``least_count`` times.

    Near words differ by one inserted, deleted or replaced letter; the form is
    the most frequent near word if it is ``ratio`` times as frequent.
    ``edit_every`` deletes a letter from some runs first (:func:`edited`)."""
    spark, base = df.sparkSession, scratch_path(df.sparkSession, "variants")
    vocabulary(id_and_text(df, id_col, text_col), least_letters, least_count, edit_every).write.parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")
    blocks_of(words).write.parquet(f"{base}/blocks")
    near = near_words(spark.read.parquet(f"{base}/blocks"))
    is_form = -F.col("minus_n") >= ratio * F.col("n")
    words.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, -F.col("minus_n")).alias("form_n"),
    ).write.parquet(f"{base}/forms")
    forms = spark.read.parquet(f"{base}/forms")
    roots = follow(forms.where("form is not null"), base)
    found = checkpointed(forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")))
    drop_scratch(spark, base)
    return found
