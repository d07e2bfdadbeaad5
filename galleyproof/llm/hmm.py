"""A hidden Markov language model over words, trained and applied on whole corpora.

Hidden states emit word classes, and classes emit words. Frequent words are classes of their own;
all others share a class with words of the same ending. The chain over classes is small enough for
every task; the words' own counts stay a distributed table that grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import hashed_share, remainder
from .shared import bounded_batches, slices, text_of, work_folder, written

#: Bytes of text in one block, which shares a vocabulary, and in one slice that is coded at a time.
BLOCK_BYTES = 24 << 20
SLICE_BYTES = 2 << 20
#: Words in one row of a vocabulary, and rows of counts that are packed at a time.
VOCABULARY_ROWS = 1 << 16
PACKED_ROWS = 1 << 20
#: Parquet else counts a hundred rows before it looks at their bytes, and readers take a row group at once.
SMALL_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}
#: A space can't be part of a word, so it stands for the end of a text.
END = b" "
STATES = 8
#: Words that are classes of their own, and classes by ending for the rest.
TOP_WORDS = 8192
ENDINGS = 2048
#: Tokens of a segment: how often the forward values of a long text are kept, and samples are cut.
WINDOW = 256
TEXTS_AT_ONCE = 2048
START_DOCS = 1500
START_ROUNDS = 12
START_CHARS = 16384
#: Steps over the corpus end when one raises the log likelihood by less than this share of it.
GAIN = 1e-3
SMOOTHING = 0.1
#: Added to each expected count before it becomes a chance.
PRIOR = 0.01


def tokens(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased, and the end."""
    return [*text.encode().lower().split(), END]


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


@dataclass
class Chain:
    """Chances of first states, of moves between states and of classes in each state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes

    @staticmethod
    def random(classes: int, states: int, seed: int = 7) -> Chain:
        rng = np.random.default_rng(seed)
        move = rng.uniform(0.5, 1.5, (states, states)) + 5 * np.eye(states)
        emit = rng.uniform(0.5, 1.5, (states, classes))
        return Chain(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @staticmethod
    def counted(first: np.ndarray, pairs: np.ndarray, seen: np.ndarray) -> Chain:
        """From expected counts: ``seen`` is states x classes."""
        first, pairs, seen = first + PRIOR, pairs + PRIOR, seen + PRIOR
        return Chain(first / first.sum(), pairs / pairs.sum(1, keepdims=True), seen / seen.sum(1, keepdims=True))


def windows(classes: np.ndarray, lengths: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of consecutive windows of each text."""
    count = -(-lengths // width)
    text = np.repeat(np.arange(len(lengths)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(lengths) - lengths)[text] + place * width
    return first, np.minimum(width, lengths[text] - place * width)


def expected(chain: Chain, classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of whole texts: first states, moves, and states x classes."""
    return counted(chain, classes, lengths)[:3]


def counted(chain: Chain, classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """``expected`` and the natural log likelihood of the texts.

    The recursions run over whole texts. So that a long one needs little memory, the forward one
    keeps its values where a segment of ``WINDOW`` tokens begins, and repeats a segment from there
    when the backward one comes to it.
    """
    states, n_classes = chain.emit.shape
    first_counts, pairs = np.zeros(states), np.zeros((states, states))
    seen, total = np.zeros((states, n_classes)), 0.0
    table = np.ascontiguousarray(chain.emit.T)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), TEXTS_AT_ONCE):
        first, size = starts[order[at:at + TEXTS_AT_ONCE]], lengths[order[at:at + TEXTS_AT_ONCE]]
        steps = int(size[0])
        active = np.searchsorted(-size, -np.arange(steps), side="left").tolist()

        def forward(t: int, last: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            k = active[t]  # noqa: B023
            e = table[classes[first[:k] + t]]  # noqa: B023
            a = chain.start * e if t == 0 else (last[:k] @ chain.move) * e
            s = a.sum(axis=1, keepdims=True)
            return a / s, e, s

        before: list[np.ndarray | None] = [None]  # the values just before each segment
        last = None
        for t in range((steps - 1) // WINDOW * WINDOW):
            last = forward(t, last)[0]
            if (t + 1) % WINDOW == 0:
                before.append(last)
        beta = np.ones((len(first), states))
        for segment in range(len(before) - 1, -1, -1):
            low, high = segment * WINDOW, min((segment + 1) * WINDOW, steps)
            values, last = [], before.pop()
            alphas = [last]
            for t in range(low, high):
                last, e, s = forward(t, last)
                alphas.append(last)
                values.append((e, s))
            met, shares = [], []
            for t in range(high - 1, low - 1, -1):
                k = active[t]
                e, s = values[t - low]
                total += float(np.log(s).sum())
                gamma = alphas[t - low + 1] * beta[:k]
                met.append(classes[first[:k] + t])
                shares.append(gamma)
                if t == 0:
                    first_counts += gamma.sum(axis=0)
                else:
                    right = e * beta[:k] / s
                    pairs += chain.move * (alphas[t - low][:k].T @ right)
                    beta[:k] = right @ chain.move.T
            met, shares = np.concatenate(met), np.concatenate(shares)
            for s in range(states):
                seen[s] += np.bincount(met, shares[:, s], n_classes)
    return first_counts, pairs, seen, total


def likelihood(chain: Chain, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact natural log likelihood of each whole text by the scaled forward recursion."""
    out = np.zeros(len(lengths))
    if not len(lengths):
        return out
    order = np.argsort(-lengths, kind="stable")
    first, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    table = np.ascontiguousarray(chain.emit.T)
    total, alpha = np.zeros(len(order)), np.zeros((len(order), chain.emit.shape[0]))
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    for t, k in enumerate(active.tolist()):
        e = table[classes[first[:k] + t]]
        a = chain.start * e if t == 0 else (alpha[:k] @ chain.move) * e
        s = a.sum(axis=1)
        alpha[:k] = a / s[:, None]
        total[:k] += np.log(s)
    out[order] = total
    return out


def encode(docs: DataFrame, folds: int, folder: str) -> DataFrame:
    """Texts as numbers, in blocks with a vocabulary of their own, written once.

    A block holds consecutive rows of one task up to ``BLOCK_BYTES`` of text (one slice at least).
    It is many rows, so that none is large: one per slice with ``doc_ids``, ``held``, ``lengths``
    and ``ids`` (numbers of all tokens), and then the vocabulary in parts: ``words`` with each
    word's count in the block's training texts, numbered from ``first``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
        F.coalesce(remainder(folds) == 0, F.lit(False)).alias("held"))
    kinds = {"block": pa.int64(), "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "lengths": pa.list_(pa.int32()),
             "ids": pa.binary(), "first": pa.int32(), "words": pa.list_(pa.binary()), "counts": pa.list_(pa.int64())}

    def one(**values) -> pa.RecordBatch:
        return pa.record_batch([pa.array([values.get(k)], kind) for k, kind in kinds.items()], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, task, size = 0, TaskContext.get().partitionId(), 0
        names_of: dict[bytes, int] = {}
        counts = np.zeros(0, np.int64)

        def vocabulary() -> Iterator[pa.RecordBatch]:
            words = list(names_of)
            for at in range(0, len(words), VOCABULARY_ROWS):
                to = at + VOCABULARY_ROWS
                yield one(block=(task << 24) + made, first=at, words=words[at:to], counts=counts[at:to])

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                bytes_in = sum(len(t.as_buffer()) for t in part.column("text"))
                if names_of and size + bytes_in > BLOCK_BYTES:
                    yield from vocabulary()
                    made += 1
                    names_of.clear()
                    counts, size = np.zeros(0, np.int64), 0
                size += bytes_in
                cut = [tokens(t) for t in part.column("text").to_pylist()]
                number = names_of.setdefault
                flat = np.array([number(w, len(names_of)) for c in cut for w in c], np.int32)
                held, lengths = part.column("held").to_pylist(), [len(c) for c in cut]
                del cut
                met = np.bincount(flat[np.repeat(~np.array(held, bool), lengths)], minlength=len(names_of))
                met[:len(counts)] += counts
                counts = met
                yield one(block=(task << 24) + made, doc_ids=part.column("doc_id").to_pylist(), held=held, lengths=lengths,
                          ids=flat.astype("<i4").tobytes())
        yield from vocabulary()

    coded = rows.mapInArrow(
        run, "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, ids binary,"
        " first int, words array<binary>, counts array<long>")
    coded.write.option("compression", "zstd").options(**SMALL_GROUPS).parquet(f"{folder}/blocks")
    return spark.read.schema(coded.schema).parquet(f"{folder}/blocks")


def word_counts(blocks: DataFrame, folder: str) -> DataFrame:
    """Every training word with its count: one row per word of a block enters the shuffle."""
    pairs = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("p")).select("p.words", "p.counts")
    counted = pairs.filter("counts > 0").groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c"))
    return written(counted, f"{folder}/words")


def top_words(words: DataFrame, most: int) -> list[bytes]:
    """The ``most`` words with the highest counts.

    A histogram of counts (a few hundred rows) first tells which counts can be among them, so that
    tasks don't each send so many rows to the driver.
    """
    level = F.floor(F.log2("c") * 16).alias("level")
    histogram = sorted(words.groupBy(level).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["level"])
    least, above = 0, 0
    for r in histogram:
        least, above = r["level"], above + r["n"]
        if above >= most:
            break
    top = words.filter(F.floor(F.log2("c") * 16) >= least).orderBy(F.desc("c"), "word").limit(most)
    return [bytes(r["word"]) for r in top.collect()]


def class_table(top: list[bytes]) -> dict[bytes, int]:
    """Classes of the frequent words and the end; the others follow by ending."""
    return {w: i for i, w in enumerate([END, *(w for w in top if w != END)])}


def classes_of(words: list[bytes], own: dict[bytes, int]) -> np.ndarray:
    get, base = own.get, len(own)
    return np.fromiter((c if (c := get(w)) is not None else base + ending(w) for w in words), np.int64, len(words))


def class_sizes(words: DataFrame, own: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of every class, over all training words."""
    n_classes = len(own) + ENDINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(n_classes, np.int64), np.zeros(n_classes, np.int64)
        for batch in batches:
            cls = classes_of(batch.column("word").to_pylist(), own)
            total += np.bincount(cls, batch.column("c").to_numpy(), n_classes).astype(np.int64)
            kinds += np.bincount(cls, minlength=n_classes)
        at = np.flatnonzero(kinds)
        yield pa.record_batch([pa.array(x) for x in (at, total[at], kinds[at])], names=["cls", "n", "v"])

    summed = words.mapInArrow(run, "cls long, n long, v long").groupBy("cls").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v"))
    total, kinds = np.zeros(n_classes, np.int64), np.zeros(n_classes, np.int64)
    for r in summed.collect():  # a row per class, whatever the corpus
        total[r.cls], kinds[r.cls] = r.n, r.v
    return total, kinds


def first_chain(docs: DataFrame, own: dict[bytes, int], folds: int, states: int, start_docs: int) -> Chain:
    """Starting values from ``start_docs`` training texts of any length, first by a hash of doc_id.

    They only break the symmetry between states; the counts of the model come from all texts. Of a
    longer text 16,384 characters from a place by a hash of doc_id stand for it, so that the rows
    that meet on the driver are bounded.
    """
    rows = docs.select("doc_id", text_of(docs).alias("text")).filter(remainder(folds) != 0)
    size = F.greatest(F.char_length("text") - START_CHARS, F.lit(0)) + 1
    piece = F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit("place")), size.cast("long")).cast("int") + 1, F.lit(START_CHARS))
    picked = rows.filter(hashed_share(start_docs, docs.count())).select("doc_id", piece.alias("text"))
    cut = [tokens(r.text) for r in picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(start_docs).collect()]
    chain = Chain.random(len(own) + ENDINGS, states)
    if cut:
        lengths = np.array([len(c) for c in cut], np.int64)
        classes = classes_of([w for c in cut for w in c], own)
        for _ in range(START_ROUNDS):
            chain = Chain.counted(*expected(chain, classes, lengths))
    return chain


def packed_counts(words: DataFrame, blocks: DataFrame, own: dict[bytes, int]) -> DataFrame:
    """Class and training count of every word of every block, many to a row: ``at`` (numbers in the
    block's vocabulary), ``counts`` and ``classes``. Words of held-out texts alone have a count of 0."""
    base = len(own)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = classes_of(batch.column("word").to_pylist(), own)
            yield pa.record_batch([*batch.columns, pa.array(cls, pa.int64())], names=["word", "c", "cls"])

    asked = blocks.select("block", "first", F.posexplode("words").alias("i", "word"))
    asked = asked.select("block", (F.col("first") + F.col("i")).alias("at"), "word")
    of_ending = F.crc32(F.substring("word", -3, 3)) % ENDINGS + base
    known = asked.join(words.mapInArrow(classed, "word binary, c long, cls long"), "word", "left").select(
        "block", "at", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("cls", of_ending).cast("int").alias("cls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            whole = [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(4)]
            order = np.argsort(whole[0], kind="stable")
            block, at, c, cls = (x[order] for x in whole)
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            rows = [pa.array(block[cuts])]
            for x, kind in ((at, "<i4"), (c, "<i8"), (cls, "<u2")):
                rows.append(pa.array([x.tobytes() for x in np.split(x.astype(kind), cuts[1:])], pa.binary()))
            yield pa.record_batch(rows, names=["block", "at", "counts", "classes"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= PACKED_ROWS:
                yield from packed()
                held.clear()
        if held:
            yield from packed()

    return known.mapInArrow(run, "block long, at binary, counts binary, classes binary")


def coded(
    blocks: DataFrame, words: DataFrame, own: dict[bytes, int], total: np.ndarray, kinds: np.ndarray, folder: str,
) -> DataFrame:
    """Blocks as classes of all tokens, a row per block, with what the chain doesn't change of each text.

    The latter are ``n_known``, ``base`` (log10 by smoothed unigrams) and ``within`` (natural log of
    the words' shares of their classes). Slices of texts meet their block's counts of words in a
    shuffle, counts first, and pass by one at a time: memory doesn't grow with the blocks of a task.
    """
    n, v = int(total.sum()), int(kinds.sum())
    counts = packed_counts(words, blocks, own).withColumn("kind", F.lit(0))
    texts = blocks.filter("ids IS NOT NULL").select("block", "doc_ids", "held", "lengths", "ids", F.lit(1).alias("kind"))
    met = counts.unionByName(texts, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    kept = ("doc_ids", "held", "lengths", "codes", "n_known", "base", "within")
    fields = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()),
              pa.list_(pa.float64()), pa.list_(pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, told, tables, texts = None, [], None, {k: [] for k in kept}

        def done() -> Iterator[pa.RecordBatch]:
            if texts["codes"]:
                rows = {k: x if k in ("doc_ids", "held") else b"".join(x) if k == "codes" else np.concatenate(x)
                        for k, x in texts.items()}
                yield pa.record_batch([pa.array([rows[k]], kind) for k, kind in zip(kept, fields, strict=True)], names=list(kept))

        for row in (row for batch in batches for row in batch.to_pylist()):
            if row["block"] != block:
                yield from done()
                block, told, tables, texts = row["block"], [], None, {k: [] for k in kept}
            if row["kind"] == 0:
                told.append([np.frombuffer(row[k], kind) for k, kind in (("at", "<i4"), ("counts", "<i8"), ("classes", "<u2"))])
                continue
            if tables is None:
                at = np.concatenate([x[0] for x in told])
                c, cls = np.zeros(len(at), np.int64), np.zeros(len(at), np.uint16)
                c[at], cls[at] = (np.concatenate([x[i] for x in told]) for i in (1, 2))
                told.clear()
                within = np.log((c + SMOOTHING) / (total[cls] + SMOOTHING * (kinds[cls] + 1)))
                within[cls < len(own)] = 0.0
                tables = cls, c > 0, np.log10((c + SMOOTHING) / (n + SMOOTHING * (v + 1))), within
            cls, known, base, within = tables
            ids, lengths = np.frombuffer(row["ids"], "<i4"), np.array(row["lengths"], np.int32)
            starts = np.cumsum(lengths) - lengths
            texts["doc_ids"] += row["doc_ids"]
            texts["held"] += row["held"]
            texts["lengths"].append(lengths)
            texts["codes"].append(cls[ids].astype("<u2").tobytes())
            for k, x in (("n_known", known.astype(np.int32)), ("base", base), ("within", within)):
                texts[k].append(np.add.reduceat(x[ids], starts))
        yield from done()

    rows = met.mapInArrow(
        run, "doc_ids array<long>, held array<boolean>, lengths array<int>, codes binary, n_known array<int>,"
        " base array<double>, within array<double>")
    rows.write.option("compression", "zstd").options(**SMALL_GROUPS).parquet(f"{folder}/coded")
    return blocks.sparkSession.read.schema(rows.schema).parquet(f"{folder}/coded")


def reestimate(blocks: DataFrame, chain: Chain, own: dict[bytes, int]) -> tuple[Chain, float]:
    """One Baum-Welch step over `coded` blocks: expected counts of every training text, summed over all tasks.

    Also the log likelihood of these texts under ``chain``, before the step.
    """
    states, n_classes = len(chain.start), len(own) + ENDINGS
    shape = states + 1 + states + 1  # rows: emissions by state, first states, moves by state, likelihood

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape, max(n_classes, states)))
        for batch in batches:
            for row in batch.to_pylist():
                lengths, held = np.array(row["lengths"], np.int64), np.array(row["held"], bool)
                classes = np.frombuffer(row["codes"], "<u2")[np.repeat(~held, lengths)]
                first, pairs, seen, told = counted(chain, classes, lengths[~held])
                total[:states, :n_classes] += seen
                total[states, :states] += first
                total[states + 1:-1, :states] += pairs
                total[-1, 0] += told
        i, j = np.nonzero(total)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "n"])

    need = blocks.select("codes", "lengths", "held")
    summed = need.mapInArrow(run, "i long, j long, n double").groupBy("i", "j").agg(F.sum("n").alias("n"))
    total = np.zeros((shape, max(n_classes, states)))
    for r in summed.collect():  # states x classes, whatever the corpus
        total[r.i, r.j] = r.n
    step = Chain.counted(total[states, :states], total[states + 1:-1, :states], total[:states, :n_classes])
    return step, total[-1, 0]


def trained(blocks: DataFrame, chain: Chain, own: dict[bytes, int], passes: int | None = None) -> Chain:
    """``chain`` after ``passes`` Baum-Welch steps; by default until the likelihood's gain is small."""
    done, last = 0, -np.inf
    while passes is None or done < passes:
        chain, told = reestimate(blocks, chain, own)
        done += 1
        if passes is None and told - last <= GAIN * abs(told):
            break
        last = told
    return chain


def score(
    docs: DataFrame, folds: int = 10, states: int = STATES, passes: int | None = None, start_docs: int = START_DOCS,
    folder: str | None = None,
) -> DataFrame:
    """Log10 probability of every whole text of ``docs(doc_id, text, ...)`` under the model.

    Texts outside the held-out fold train it, in ``passes`` Baum-Welch steps over all of them or, by
    default, until a step hardly raises their likelihood. A word's chance is its class's chance in the hidden
    state times its share of the class, (c + 0.1) / (N + 0.1 (V + 1)) over the class's training
    tokens and words; classes of one frequent word give it all. Columns: doc_id, held_out (false
    for a null doc_id), n_tokens (with the end), n_known, train_tokens, base_score (smoothed
    unigrams), score. A null text is empty and has its end only; repeated rows each give a row and
    count as often as they occur. An empty table gives no rows; further columns are ignored.

    Counts of words come back to the blocks by a join, one row per block and distinct word; what
    they tell of a text is summed then (`coded`), and later steps read its classes only.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "hmm")
    blocks = encode(docs, folds, folder)
    words = word_counts(blocks, folder)
    own = class_table(top_words(words, TOP_WORDS))
    total, kinds = class_sizes(words, own)
    n = int(total.sum())
    blocks = coded(blocks, words, own, total, kinds, folder)
    chain = first_chain(docs, own, folds, states, start_docs)
    chain = trained(blocks, chain, own, passes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                chained = likelihood(chain, np.frombuffer(row["codes"], "<u2"), lengths)
                yield pa.record_batch({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
                    "n_tokens": lengths, "n_known": np.array(row["n_known"], np.int64),
                    "train_tokens": np.full(len(lengths), n, np.int64), "base_score": np.array(row["base"]),
                    "score": (chained + np.array(row["within"])) / np.log(10)})

    return blocks.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double")
