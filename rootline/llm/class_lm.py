"""Class-based bigram model of a corpus, with classes found by exchange, and log probabilities of texts (operator 12).

P(w | v) = P(class of w | class of v) * P(w | class of w), after Brown et al.; classes come from exchange clustering: at
first the most frequent words have a class each and all others share one; then, in sweeps, every word moves to the class
that makes its neighbours' classes, left and right, most probable, and the classes are counted again.  All words of a
sweep move at once against the classes of the sweep before, which never lowers the likelihood of the neighbours' classes.
After some sweeps the neighbours' classes are counted anew (``rounds``).  Every word of the training texts is clustered,
and every count covers all of them.

Texts are cut into chunks of about ``CHUNK`` bytes, held as numbers into a chunk's own list of words, in a table bucketed
by chunk; it is written once and no step shuffles it again.  A chunk's words are dealt by hash to buckets, as one row a
chunk and bucket, and a bucket counts, numbers and clusters its words; its size follows ``parts``.  Between chunks and
buckets go packed arrays only: words and counts once, then each round a byte of class for a word and chunk one way and its
neighbours' classes, counted in the chunk, the other way.  A frequent word is one entry a chunk.  To the driver and from
there to all tasks go only tables of class by class.

A word never met in training is one more word, unknown; its probability is the share of training tokens that are words
met once (Good and Turing), after any word.  A text's end is a token and its start is the class before the first one.
Probabilities of the known words and of the unknown one add up to 1 after every class.

Defined results: a null or blank text is its end only; texts without doc_id are scored with it null and held out of
nothing (they train); a doc_id that repeats gives a row each; a text of any length is tokenised in pieces and makes a
chunk of its own; ties between words go to the smaller one, between classes to the first; without training texts (or
rows) every word is unknown, with probability 1; extra columns, whatever their names, are ignored.
"""

import uuid
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Sent, documents, new_path, parts, store, tidy
from .units import cut, lower_table

CLASSES = 63
CHUNK = 8 << 20
END = b"\n"  # stands for the end of a text among the words, which hold no white space
MERGE = 1 << 21
ROWS = 8192
HISTORY = 100.0
BUCKETS = 100_000  # the most that Spark allows


def numbering() -> defaultdict:
    """A dictionary that numbers what it is asked for, in order."""
    d = defaultdict()
    d.default_factory = d.__len__
    return d


def numbers(d: defaultdict, items: list) -> np.ndarray:
    return np.fromiter(map(d.__getitem__, items), np.int32, len(items))


def listed(values, kind) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def packed(*arrays: np.ndarray) -> list[pa.Array]:
    """Binary columns of one row."""
    return [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays]


def unpacked(scalar, kind) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer(), kind)


def chunks(docs: DataFrame, trains, buckets: int) -> DataFrame:
    """(chunk, doc_ids, trains, lengths, tokens, dealt): texts as places in the chunk's list of words, ends included; the
    list goes by bucket, and dealt has each bucket's words and their counts in the training texts."""
    table, limit = lower_table().tobytes(), CHUNK

    def read(batches):
        task, made = TaskContext.get().partitionId(), 0
        start = lambda: (numbering(), [], [], [], [])

        def row():
            words, ids, train, lengths, tokens = state
            flat = np.concatenate(tokens)
            counts = np.bincount(flat[np.repeat(train, lengths)], minlength=len(words))
            bucket = np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words)) % np.uint32(buckets)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            own, at = np.unique(bucket[order], return_index=True)
            text = list(words)
            dealt = [{"b": int(b), "words": b" ".join([text[i] for i in some]), "counts": counts[some].astype(np.uint32).tobytes()} for b, some in zip(own, np.split(order, at[1:]))]
            kind = pa.struct([("b", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
            columns = [pa.array([task << 32 | made], pa.int64()), listed(ids, pa.int64()), listed(train, pa.bool_()), listed(lengths, pa.int32()), *packed(place[flat]), listed(dealt, kind)]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "doc_ids", "trains", "lengths", "tokens", "dealt"])

        state, size = start(), 0
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            for doc_id, text, train in zip(b.column(0).to_pylist(), texts, b.column(2).to_pylist()):
                data = memoryview(text.as_buffer())
                words, ids, trained, lengths, tokens = state
                found = [numbers(words, piece.split()) for piece in cut(data, table)] + [numbers(words, [END])]
                ids.append(doc_id)
                trained.append(train)
                lengths.append(sum(map(len, found)))
                tokens += found
                size += len(data) + 1
                if size >= limit:
                    yield row()
                    state, size, made = start(), 0, made + 1
        if state[1]:
            yield row()

    schema = "chunk long, doc_ids array<long>, trains array<boolean>, lengths array<int>, tokens binary, dealt array<struct<b:int,words:binary,counts:binary>>"
    read_docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(trains, F.lit(True)).alias("trains"))
    spark, name = docs.sparkSession, f"chunks_{uuid.uuid4().hex}"
    written = read_docs.mapInArrow(tidy(read), schema).write.bucketBy(min(parts(docs), BUCKETS), "chunk")
    written.option("compression", "zstd").option("path", new_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)


def vocabulary(read: DataFrame) -> DataFrame:
    """Of each bucket b one row (words, n) with its words and training counts, and one row (chunk, places) for each chunk
    with the places of the chunk's words among them."""

    def count(rows):
        b, words, places = rows.column("b")[0].as_py(), numbering(), []
        for text in rows.column("words"):
            places.append(numbers(words, text.as_py().split(b" ")))
        n = np.zeros(len(words), np.int64)
        for at, counts in zip(places, rows.column("counts")):
            n[at] += unpacked(counts, np.uint32)
        made = [{"b": b, "chunk": chunk, "places": at.tobytes()} for chunk, at in zip(rows.column("chunk").to_pylist(), places)]
        made.append({"b": b, "words": b" ".join(words), "n": n.tobytes()})
        return pa.Table.from_pylist(made, schema=pa.schema([("b", pa.int32()), ("chunk", pa.int64()), ("places", pa.binary()), ("words", pa.binary()), ("n", pa.binary())]))

    dealt = read.select("chunk", F.inline("dealt"))
    return store(dealt.groupBy("b").applyInArrow(count, "b int, chunk long, places binary, words binary, n binary"), "words")


def top_words(vocab: DataFrame, n: int) -> list:
    """(b, at, word, n) of the most frequent words."""

    def best(batches):
        for batch in batches:
            for b, words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts, words = unpacked(counts, np.int64), words.split(b" ")
                least = max(1, np.partition(counts, -n)[-n]) if len(counts) > n else 1
                at = sorted(np.flatnonzero(counts >= least).tolist(), key=lambda i: (-counts[i], words[i]))[:n]
                yield pa.RecordBatch.from_arrays([pa.array([b] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([words[i] for i in at], pa.binary()), pa.array(counts[at], pa.int64())], ["b", "at", "word", "n"])

    return vocab.select("b", "words", "n").mapInArrow(best, "b int, at int, word binary, n long").orderBy(F.desc("n"), "word").limit(n).collect() if n else []


def first_classes(vocab: DataFrame, k: int) -> DataFrame:
    """(b, first, data): the classes to begin with, a byte a word; k for words that training does not have."""
    own = defaultdict(list)
    for i, r in enumerate(top_words(vocab, k - 1)):
        own[r.b].append((r.at, i))

    def begin(batches):
        for batch in batches:
            for b, n in zip(batch.column(0).to_pylist(), batch.column(1)):
                cls = np.where(unpacked(n, np.int64) > 0, k - 1, k).astype(np.uint8)
                for at, i in own.get(b, ()):
                    cls[at] = i
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([0], pa.int32()), *packed(cls)], ["b", "first", "data"])

    return vocab.select("b", "n").mapInArrow(begin, "b int, first int, data binary")


def returned(places: DataFrame, values: DataFrame, kind, column: str) -> DataFrame:
    """(chunk, column): of each chunk, per bucket, what ``values`` (b, first, data) has for its words."""

    def give(have, rows):
        rows = rows.select(["chunk", "b", "places"])
        data = np.concatenate([unpacked(x, kind) for x in have.combine_chunks().sort_by("first").column("data")])
        given = pa.array([data[unpacked(at, np.int32)].tobytes() for at in rows.column("places")], pa.binary())
        return rows.drop_columns(["places"]).append_column("data", given)

    found = values.groupBy("b").cogroup(places.groupBy("b")).applyInArrow(give, "chunk long, b int, data binary")
    return store(found.groupBy("chunk").agg(F.collect_list(F.struct("b", "data")).alias(column)), "returned")


def of_words(row, column: str, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a chunk was given, by word, with the buckets and the number of words of each."""
    given = row(column)
    b = given.field(0).to_numpy(zero_copy_only=False)
    order = np.argsort(b)
    data = [unpacked(given.field(1)[int(i)], kind) for i in order]
    return np.concatenate(data), b[order], np.array([len(x) for x in data])


def rows_of(batch: pa.RecordBatch):
    """Each row as a function that gives the items of a list column."""
    for i in range(batch.num_rows):
        yield lambda name, i=i: batch.column(name)[i].values


def tokens_of(batch: pa.RecordBatch):
    """Of each row: the list columns, tokens, and whether each token is a text's first."""
    for i, row in enumerate(rows_of(batch)):
        tokens = unpacked(batch.column("tokens")[i], np.int32)
        row.chunk = batch.column("chunk")[i].as_py()
        lengths = row("lengths").to_numpy(zero_copy_only=False)
        first = np.zeros(len(tokens), bool)
        first[np.cumsum(lengths) - lengths] = True
        yield row, tokens, first


def training(row, tokens, first):
    keep = np.repeat(row("trains").to_numpy(zero_copy_only=False), row("lengths").to_numpy(zero_copy_only=False))
    return tokens[keep], first[keep]


def before(classes: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """The class before each token, ``start`` at a text's first."""
    out = np.empty_like(classes)
    out[1:] = classes[:-1]
    out[first] = start
    return out


def summed(parts_: DataFrame, shape) -> np.ndarray:
    """Tables of fixed size from all tasks, added up."""
    out = np.zeros(int(np.prod(shape)), np.int64)
    for r in parts_.groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r.at] = r.n
    return out.reshape(shape)


def entries(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64), pa.int64())], ["at", "n"])


def transitions(texts: DataFrame, k: int) -> np.ndarray:
    """Counts of class (column) after class (row); row k is the start of a text."""
    side = k + 1

    def count(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for row, tokens, first in tokens_of(batch):
                tokens, first = training(row, tokens, first)
                cls = of_words(row, "classes", np.uint8)[0][tokens].astype(np.int64)
                total += np.bincount(before(cls, first, k) * side + cls, minlength=side * side)
        yield entries(total)

    return summed(texts.mapInArrow(tidy(count), "at int, n long"), (side, side))


def neighbours(texts: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """(b, first, sizes, near, n): for words of a bucket from ``first`` on, how many entries each has, and these: how
    often classes stand left (near) and right (k + 1 + near) of it in training texts."""
    width = 2 * (k + 1)
    kinds = (("sizes", np.int32), ("near", np.uint8), ("n", np.int64))

    def count(batches):
        for batch in batches:
            for row, tokens, first in tokens_of(batch):
                tokens, first = training(row, tokens, first)
                of_word, buckets, many = of_words(row, "classes", np.uint8)
                cls = of_word[tokens].astype(np.int64)
                left, right = before(cls, first, k), np.full_like(cls, k)
                right[:-1] = np.where(first[1:], k, cls[1:])
                word = tokens.astype(np.int64) * width
                keys = np.concatenate([word + left, word + k + 1 + right])
                keys, n = np.unique(keys, return_counts=True)
                sizes = np.bincount(keys // width, minlength=len(of_word)).astype(np.int32)
                ends = np.cumsum(many)
                cuts = np.concatenate([[0], np.cumsum(sizes)])[ends][:-1]
                split = [np.split(x, at) for x, at in ((sizes, ends[:-1]), ((keys % width).astype(np.uint8), cuts), (n.astype(np.uint32), cuts))]
                chunk = pa.array([row.chunk] * len(buckets), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), chunk, *[pa.array([x.tobytes() for x in s], pa.binary()) for s in split]], ["b", "chunk", "sizes", "near", "n"])

    def merge(counted, rows):
        at = {c: unpacked(p, np.int32) for c, p in zip(rows.column("chunk").to_pylist(), rows.column("places"))}
        words = max(int(x.max()) for x in at.values()) + 1
        held, waiting = [], 0

        def added():
            keys, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            return keys[new], np.add.reduceat(n[order], new)

        for chunk, sizes, near, n in zip(counted.column("chunk").to_pylist(), *[counted.column(c) for c in ("sizes", "near", "n")]):
            keys = np.repeat(at[chunk].astype(np.int64), unpacked(sizes, np.int32)) * width + unpacked(near, np.uint8)
            if len(keys):
                held.append((keys, unpacked(n, np.uint32).astype(np.int64)))
            waiting += len(keys)
            if waiting > MERGE + 2 * len(held[0][0] if held else ()):
                held = [added()]
                waiting = len(held[0][0])
        keys, n = added() if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        made = []
        for lo in range(0, words, ROWS):
            hi = min(lo + ROWS, words)
            a, z = np.searchsorted(keys, (lo * width, hi * width))
            made.append({"b": rows.column("b")[0].as_py(), "first": lo, "sizes": np.bincount(keys[a:z] // width - lo, minlength=hi - lo).astype(np.int32).tobytes(), "near": (keys[a:z] % width).astype(np.uint8).tobytes(), "n": n[a:z].tobytes()})
        return pa.Table.from_pylist(made, schema=pa.schema([("b", pa.int32()), ("first", pa.int32()), *[(c, pa.binary()) for c, _ in kinds]]))

    counted = texts.mapInArrow(tidy(count), "b int, chunk long, sizes binary, near binary, n binary")
    merged = counted.groupBy("b").cogroup(places.groupBy("b")).applyInArrow(merge, "b int, first int, sizes binary, near binary, n binary")
    return store(merged, "neighbours")


def likely(table: np.ndarray) -> np.ndarray:
    """log P(near | class) from counts of class (row) and near; classes that have lost all words are as all words are."""
    sides = table.reshape(len(table), 2, -1)
    plain = sides.sum(axis=0, keepdims=True) + 1e-3
    plain = plain / plain.sum(axis=2, keepdims=True)
    return np.log((sides + plain) / (sides.sum(axis=2, keepdims=True) + 1)).reshape(table.shape)


def moved(log: np.ndarray, batch: pa.RecordBatch):
    """Of each row of neighbours: its place in the batch, entries (word, near, n) and each word's best class."""
    for i in range(batch.num_rows):
        sizes, near, n = (unpacked(batch.column(c)[i], kind) for c, kind in (("sizes", np.int32), ("near", np.uint8), ("n", np.int64)))
        word = np.repeat(np.arange(len(sizes)), sizes)
        counts = np.zeros((len(sizes), log.shape[1]))
        counts[word, near] = n
        yield i, word, near, n, np.where(sizes > 0, np.argmax(counts @ log.T, axis=1), len(log))


def exchange(near: DataFrame, table: np.ndarray, sweeps: int) -> tuple[DataFrame, list[float]]:
    """(b, first, data): classes after ``sweeps`` sweeps from classes with these counts; the likelihood each sweep began with."""
    began = []
    for _ in range(sweeps - 1):
        log = likely(table)
        began.append(float((table * log).sum()))

        def sweep(batches, log=log):
            total = np.zeros(log.size)
            for batch in batches:
                for _, word, at, n, to in moved(log, batch):
                    total += np.bincount(to[word] * log.shape[1] + at, weights=n, minlength=log.size)
            yield entries(total)

        table = summed(near.mapInArrow(tidy(sweep), "at int, n long"), table.shape).astype(float)
    log = likely(table)
    began.append(float((table * log).sum()))

    def place(batches):
        for batch in batches:
            made = [to.astype(np.uint8).tobytes() for *_, to in moved(log, batch)]
            yield pa.RecordBatch.from_arrays([batch.column("b"), batch.column("first"), pa.array(made, pa.binary())], ["b", "first", "data"])

    return near.mapInArrow(tidy(place), "b int, first int, data binary"), began


class Model:
    """Transition and emission figures of a trained model; all of fixed size but for the words' counts, which are joined."""

    def __init__(self, counts: np.ndarray, once: int):
        k = len(counts) - 1
        of_class = counts.sum(axis=0)[:k].astype(float)
        self.tokens = int(of_class.sum())
        plain = of_class / max(self.tokens, 1)
        unknown = (once + 1) / (self.tokens + once + 1)
        # rows: classes, the unknown word, the start; columns: classes, the unknown word
        after = np.vstack([counts[:k, :k], np.zeros(k), counts[k, :k]])
        known = (after + HISTORY * plain) / (after.sum(axis=1, keepdims=True) + HISTORY)
        with np.errstate(divide="ignore"):
            self.after = np.log10(np.hstack([(1 - unknown) * known, np.full((k + 2, 1), unknown)]))
            self.of_class = np.log10(of_class)


def scored(texts: DataFrame, model: Model, distinct: int) -> DataFrame:
    """doc_id, trains, n_tokens, n_known, base_score and score of every text."""
    sent, k = Sent(texts.sparkSession, model), len(model.of_class)
    below = np.log10(model.tokens + distinct + 1)

    def score(batches):
        m = sent.load()
        for batch in batches:
            for row, tokens, first in tokens_of(batch):
                n, cls = of_words(row, "totals", np.int64)[0], of_words(row, "classes", np.uint8)[0].astype(np.int64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    word = np.where(n > 0, np.log10(n) - np.append(m.of_class, 0)[cls], 0.0)
                base, starts, now = np.log10(n + 1.0) - below, np.flatnonzero(first), cls[tokens]
                each = m.after[before(now, first, k + 1), now] + word[tokens]
                columns = [row("doc_ids"), row("trains"), row("lengths").cast(pa.int64())]
                columns += [pa.array(np.add.reduceat(x, starts)) for x in ((n > 0)[tokens].astype(np.int64), base[tokens], each)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "trains", "n_tokens", "n_known", "base_score", "score"])

    return texts.mapInArrow(tidy(score), "doc_id long, trains boolean, n_tokens long, n_known long, base_score double, score double")


def told(vocab: DataFrame, classes: DataFrame) -> DataFrame:
    """(word, n, cls) of the words that training has."""

    def tell(rows, have):
        n, cls = unpacked(rows.column("n")[0], np.int64), np.concatenate([unpacked(x, np.uint8) for x in have.combine_chunks().sort_by("first").column("data")])
        words = pa.array(rows.column("words")[0].as_py().split(b" "), pa.binary())
        return pa.table({"word": words, "n": pa.array(n), "cls": pa.array(cls, pa.int32())}).filter(pa.array(n > 0))

    return vocab.groupBy("b").cogroup(classes.groupBy("b")).applyInArrow(tell, "word binary, n long, cls int")


def language_model(docs: DataFrame, trains, classes: int = CLASSES, rounds: int = 2, sweeps: int = 4) -> tuple[DataFrame, DataFrame, dict]:
    """Scores of all texts by a model of those for which ``trains`` holds; (word, n, cls) of the model; figures.

    classes: at most 127.  rounds: how often neighbours' classes are counted anew; sweeps: exchange sweeps in each.
    """
    if not 1 <= classes <= 127 or rounds < 1 or sweeps < 1:
        raise ValueError("classes must be 1 to 127, rounds and sweeps 1 or more")
    k = classes
    read = chunks(docs, trains, parts(docs))
    words = vocabulary(read)
    vocab, places = words.where("chunk is null").select("b", "words", "n"), words.where("chunk is not null").select("b", "chunk", "places")
    tokens, distinct, once = totals(vocab)
    figures = {"tokens": tokens, "words": distinct, "likelihood": []}
    texts = read.select("chunk", "doc_ids", "trains", "lengths", "tokens")
    cls = first_classes(vocab, k)
    for _ in range(rounds):
        now = texts.join(returned(places, cls, np.uint8, "classes").hint("shuffle_hash"), "chunk")
        after = transitions(now, k)
        near = neighbours(now, places, k)
        last = after.sum(axis=0)[:k] - after[:k].sum(axis=1)[:k]  # tokens of a class that end a text
        cls, began = exchange(near, np.hstack([after[:, :k].T, after[:k, :k], last[:, None]]).astype(float), sweeps)
        cls = store(cls, "classes")
        figures["likelihood"].append(began)
    now = texts.join(returned(places, cls, np.uint8, "classes").hint("shuffle_hash"), "chunk")
    model = Model(transitions(now, k), once)
    counts = returned(places, vocab.select("b", F.lit(0).alias("first"), F.col("n").alias("data")), np.int64, "totals")
    return scored(now.join(counts.hint("shuffle_hash"), "chunk"), model, distinct), told(vocab, cls), figures


def totals(vocab: DataFrame) -> tuple[int, int, int]:
    """Training tokens, distinct ones, and those met once."""

    def add(batches):
        for batch in batches:
            for n in batch.column(0):
                n = unpacked(n, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (n.sum(), (n > 0).sum(), (n == 1).sum())], ["tokens", "words", "once"])

    found = vocab.select("n").mapInArrow(add, "tokens long, words long, once long")
    return tuple(found.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "words", "once")]).first())


def op12_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found, _, figures = language_model(documents(spark, sf_dir), ~held_out)
    return found.select("doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", F.lit(figures["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
