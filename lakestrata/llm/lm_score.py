"""Language-model scores of documents: a byte model by partial matching, beside a
word model with add-one counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, raw_bytes, row_blocks, stored, text_bytes
from .ppm import BITS, AdaptiveModel, Trie, grams, mask

ORDER = 5
WORDS_AT_ONCE = 1 << 18
GRAMS_AT_ONCE = 1 << 20
COUNTED_BYTES = 1 << 20
FREQUENT_WORDS = 1 << 17
# Pairs of a part of the trie, parts at least, bytes of texts whose different grams are
# gathered, blocks of texts that one copy of a part answers.
TRIE_PAIRS = 1 << 18
TRIE_PARTS = 256
TEXT_BLOCK = 32 << 20
BLOCKS_AT_ONCE = 1 << 10
_ZSTD = pa.Codec("zstd")
_ROWS = pa.schema([("lm_row", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())])


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The different keys, sorted; ``np.unique`` without counts would hash them first,
    which takes three times as long."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([c for _, c in parts]), len(keys))
    return [(keys, counts.astype(np.int64))]


def _counts(docs: DataFrame, order: int) -> DataFrame:
    """Counts of each task: gram and n of the byte contexts, or word and n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def word_batch() -> pa.RecordBatch:
            batch = pa.record_batch(
                [
                    pa.nulls(len(words), pa.int64()),
                    pa.array(list(words.keys()), pa.binary()).cast(pa.string()),
                    pa.array(list(words.values()), pa.int64()),
                ],
                names=["gram", "word", "n"],
            )
            words.clear()
            return batch

        def gram_batch(found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            keys, counts = found
            columns = [pa.array(keys.view(np.int64)), pa.nulls(len(keys), pa.string())]
            return pa.record_batch([*columns, pa.array(counts)], names=["gram", "word", "n"])

        for batch in batches:
            data, at = text_bytes(batch.column(0))
            data = LOWER[data]
            for a, b in row_blocks(at, COUNTED_BYTES):
                base, ends = data[at[a] : at[b]], at[a : b + 1] - at[a]
                keys, n = np.unique(grams(base, ends, order)[0], return_counts=True)
                parts.append((keys, n.astype(np.int64)))
                if len(parts) >= 8:
                    parts = _merge(parts)
                    if len(parts[0][0]) > GRAMS_AT_ONCE:
                        yield gram_batch(parts.pop())
                whole = base.tobytes()
                for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    words.update(whole[x:y].split())
                if len(words) > WORDS_AT_ONCE:
                    yield word_batch()
        if words:
            yield word_batch()
        if parts:
            yield gram_batch(_merge(parts)[0])

    return docs.select("text").mapInArrow(count, "gram long, word string, n long")


@dataclass(frozen=True)
class LanguageModel:
    """Tables in the shared folder, and the sums that every document needs.

    ``grams``: gram, n of the full order. ``vocabulary``: word, n. ``documents``,
    ``tokens``, ``types``: of the training texts, the end of a text counted as a
    token and as a type.
    """

    order: int
    grams: DataFrame
    vocabulary: DataFrame
    documents: int
    tokens: int
    types: int

    def trie_parts(self) -> int:
        return max(1, -(-self.grams.count() // TRIE_PAIRS))

    def trie(self, part: int, parts: int) -> Trie:
        """The part of the trie for the contexts whose last two symbols fall into
        it, for use outside Spark: scoring leaves all but ``low`` where it is."""
        high = self.grams.select("gram", "n").filter(_part_of(F.col("gram"), parts) == part)
        return Trie(self.order, self.low(), _arrays(high.toArrow()))

    def low(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of order 1, which all parts hold: at most 257 x 258 pairs."""
        return _arrays(_folded(self.grams, 1).toArrow())

    def frequent(self) -> tuple[int, dict[bytes, float]]:
        """At most ``FREQUENT_WORDS`` words with the log of their count plus one,
        and the count from which on all words are among them."""
        sizes = self.vocabulary.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
        least, words = None, 0
        for row in sizes.orderBy(F.desc("n")).limit(FREQUENT_WORDS).collect():
            words += row.words
            if words > FREQUENT_WORDS:
                break
            least = row.n
        if least is None:
            return 1 << 62, {}
        found = self.vocabulary.filter(F.col("n") >= least).toArrow()
        logs = np.log10(found.column("n").to_numpy() + 1.0)
        names = found.column("word").to_pylist()
        return least, {w.encode(): x for w, x in zip(names, logs.tolist())}


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table.column("gram").to_numpy().astype(np.uint64), table.column("n").to_numpy()


def _folded(grams_: DataFrame, order: int) -> DataFrame:
    """Counts of the last ``order`` symbols before each symbol."""
    short = F.col("gram").bitwiseAND(F.lit(int(mask(order))))
    return grams_.groupBy(short.alias("gram")).agg(F.sum("n").alias("n"))


def _last_two(gram):
    return F.shiftright(gram, BITS).bitwiseAND(F.lit((1 << 2 * BITS) - 1))


def _part_of(gram, parts: int):
    return F.pmod(_last_two(gram) * F.lit(40_503), F.lit(parts))


def _packed(values: np.ndarray) -> bytes:
    """64-bit values, their bytes apart by place, compressed; with their number."""
    columns = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + _ZSTD.compress(columns).to_pybytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    columns = np.frombuffer(_ZSTD.decompress(data[8:], 8 * n), np.uint8).reshape(8, n)
    return np.ascontiguousarray(columns.T).view(np.uint64).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def train_language_model(docs: DataFrame, order: int = ORDER) -> LanguageModel:
    """Count byte contexts and words of every ``text`` of ``docs``.

    A-Z are lower-cased; a word is a run of other than ASCII white space. A NULL
    text is empty and still has an end. An empty table gives an empty model.
    """
    found = stored(_counts(docs, order), "lm-counts")
    counted = found.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n"))
    vocabulary = found.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    counted, vocabulary = stored(counted, "lm-grams"), stored(vocabulary, "lm-words")
    tokens, types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # Every text has one end, which is the symbol of so many grams.
    ends = counted.filter(F.col("gram").bitwiseAND(F.lit(511)) == 256)
    documents = ends.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return LanguageModel(
        order, counted, vocabulary, documents, tokens + documents, types + (documents > 0)
    )


class _Frequent(dict):
    def __missing__(self, word: bytes) -> float:
        return -1.0


@dataclass(frozen=True)
class _Parts:
    """Where the grams of a trie are. A part has the contexts whose last two symbols
    fall into it; two symbols with more than ``TRIE_PAIRS`` grams (``crowded``, at most
    257 x 258, sorted) have a part for each third symbol."""

    n: int
    crowded: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        two = (keys >> np.uint64(BITS) & np.uint64((1 << 2 * BITS) - 1)).astype(np.int64)
        third = (keys >> np.uint64(3 * BITS) & np.uint64(511)).astype(np.int64)
        return np.where(np.isin(two, self.crowded), self.n + two * 512 + third, two * 40_503 % self.n)

    def keyed(self, spark: SparkSession, rows: DataFrame, third=None) -> DataFrame:
        """``rows`` with the ``part`` of their gram; without a ``third`` symbol those of
        crowded symbols once for each."""
        two = _last_two(F.col("gram"))
        listed = spark.createDataFrame([(int(c),) for c in self.crowded], "two long")
        listed = F.broadcast(listed.withColumn("split", F.lit(True)))
        thirds = F.sequence(F.lit(0), F.lit(511)) if third is None else F.array(third)
        own = F.transform(thirds, lambda t: F.lit(self.n) + F.col("two") * F.lit(512) + t)
        part = F.when(F.col("split"), own).otherwise(F.array(_part_of(F.col("gram"), self.n)))
        joined = rows.withColumn("two", two).join(listed, "two", "left")
        return joined.withColumn("part", F.explode(part)).drop("two", "split")


def _parts(model: LanguageModel) -> _Parts:
    sizes = model.grams.groupBy(_last_two(F.col("gram")).alias("two")).agg(
        F.count(F.lit(1)).alias("size")
    )
    crowded = sizes.filter(F.col("size") > TRIE_PAIRS).select("two").toArrow()
    n = max(TRIE_PARTS, model.trie_parts())
    return _Parts(n, np.sort(crowded.column(0).to_numpy().astype(np.int64)))


def _blocks(docs: DataFrame, order: int, parts: _Parts) -> DataFrame:
    """Texts in blocks, and the different grams of each block by parts of the trie.

    One row per run of documents (block, texts: lm_row, doc_id, text as a compressed
    Arrow stream) and one per block and part (block, part, grams); the rest is NULL.
    """

    def stream(rows: list[pa.Array]) -> bytes:
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, _ROWS, options=options) as out:
            out.write(pa.record_batch(rows, schema=_ROWS))
        return sink.getvalue().to_pybytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        names = ["block", "part", "texts", "grams"]
        for batch in batches:
            rows = [batch.column(i).cast(_ROWS.field(i).type) for i in range(3)]
            data, at = text_bytes(rows[2])
            data = LOWER[data]
            for first, last in row_blocks(at, TEXT_BLOCK):
                part, found = at[first : last + 1], []
                for a, b in row_blocks(part, COUNTED_BYTES):
                    base, ends = data[part[a] : part[b]], part[a : b + 1] - part[a]
                    found.append(_distinct(grams(base, ends, order)[0]))
                    texts = stream([c.slice(first + a, b - a) for c in rows])
                    yield pa.record_batch(
                        [
                            pa.array([block]),
                            pa.nulls(1, pa.int64()),
                            pa.array([texts], pa.binary()),
                            pa.nulls(1, pa.binary()),
                        ],
                        names=names,
                    )
                keys = _distinct(np.concatenate(found))
                place = parts.of(keys)
                inner = np.argsort(place, kind="stable")
                used, starts = np.unique(place[inner], return_index=True)
                asked = [_packed_keys(k) for k in np.split(keys[inner], starts[1:])]
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(used), block)),
                        pa.array(used),
                        pa.nulls(len(used), pa.binary()),
                        pa.array(asked, pa.binary()),
                    ],
                    names=names,
                )
                block += 1

    return docs.select("lm_row", "doc_id", "text").mapInArrow(
        cut, "block long, part long, texts binary, grams binary"
    )


def _answers(asked: DataFrame, model: LanguageModel, parts: _Parts, copies: int) -> DataFrame:
    """block, grams, costs: the log probabilities of the grams that a block asks for.

    The trie is built part by part where its grams are, so often that one copy answers
    a bounded number of blocks. Only the counts of order 1 pass through the driver.
    """
    order, low, spark = model.order, model.low(), asked.sparkSession
    third = F.shiftright("gram", 3 * BITS).bitwiseAND(F.lit(511))
    # Counts of order 2 go to every part of their two symbols.
    middle = parts.keyed(spark, _folded(model.grams, 2))
    known = (
        middle.select("part", "gram", "n", F.lit(True).alias("middle"))
        .unionByName(
            parts.keyed(spark, model.grams, third).select(
                "part", "gram", "n", F.lit(False).alias("middle")
            )
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    )

    def answer(key: tuple, pairs: pa.Table, rows: pa.Table) -> pa.Table:
        costs = []
        if rows.num_rows:
            wanted = [_unpacked_keys(g) for g in rows.column("grams").to_pylist()]
            keys, inverse = np.unique(np.concatenate(wanted), return_inverse=True)
            of_order_2 = pairs.column("middle")
            high = _arrays(pairs.filter(pc.invert(of_order_2)))
            values = Trie(order, low, high, _arrays(pairs.filter(of_order_2))).log10(keys)
            ends = np.cumsum([len(w) for w in wanted])
            costs = [_packed(v) for v in np.split(values[inverse], ends[:-1])]
        return pa.table(
            {
                "block": rows.column("block"),
                "grams": rows.column("grams"),
                "costs": pa.array(costs, pa.binary()),
            }
        )

    copy = F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("copy")
    return (
        known.groupBy("part", "copy")
        .cogroup(asked.select("*", copy).groupBy("part", "copy"))
        .applyInArrow(answer, "block long, grams binary, costs binary")
    )


def _scored(blocks: DataFrame, model: LanguageModel, words: dict, parts: _Parts, copies: int) -> DataFrame:
    """lm_row, doc_id, n_tokens, n_known, logs, score, tail: one row per document.

    ``score`` of the byte model; of the word model the sum of logs of counts plus one
    over ``words`` (the frequent ones), and the other words with their number.
    """
    asked = blocks.filter("part IS NOT NULL").select("block", "part", "grams")
    texts = blocks.filter("part IS NULL").select("block", "texts")
    answers = _answers(asked, model, parts, copies)
    frequent, depth = blocks.sparkSession.sparkContext.broadcast(words), model.order

    def score(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        logs = _Frequent(frequent.value)
        keys = np.concatenate([_unpacked_keys(g) for g in known.column("grams").to_pylist()])
        values = np.concatenate([_unpacked(c) for c in known.column("costs").to_pylist()])
        order = np.argsort(keys)
        keys, values = keys[order], values.view(np.float64)[order]
        out = []
        for column in rows.column("texts").chunks:
            for texts in column:
                for batch in pa.ipc.open_stream(texts.as_buffer()):
                    out.append(_scored_rows(batch, depth, keys, values, logs))
        return pa.concat_tables(out)

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score,
        "lm_row long, doc_id long, n_tokens long, n_known long, logs double, score double, "
        "tail array<struct<word: string, times: long>>",
    )


def _scored_rows(
    batch: pa.RecordBatch, depth: int, keys: np.ndarray, values: np.ndarray, logs: dict
) -> pa.Table:
    """Rows of a block, given the costs of all its grams."""
    data, at = text_bytes(batch.column("text"))
    data = LOWER[data]
    scores, n_tokens, n_known, sums, tails, sizes = [], [], [], [], [], []
    for a, b in row_blocks(at, COUNTED_BYTES):
        base, ends = data[at[a] : at[b]], at[a : b + 1] - at[a]
        packed, begins = grams(base, ends, depth)
        # A hash finds the few different grams; only they are sorted and looked up.
        coded = pa.array(packed).dictionary_encode()
        found = np.asarray(coded.dictionary)
        order = np.argsort(found)
        known = np.empty(len(order))
        known[order] = values[np.searchsorted(keys, found[order])]
        costs = known[np.asarray(coded.indices)]
        scores.append(np.add.reduceat(costs, begins[:-1]))
        del packed, coded, found, order, known, costs
        whole = base.tobytes()
        for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
            found = whole[x:y].split()
            value = np.fromiter(map(logs.__getitem__, found), float, len(found))
            rare = np.flatnonzero(value < 0)
            tail = Counter([found[i] for i in rare.tolist()])
            n_tokens.append(len(found) + 1)
            n_known.append(len(found) - len(rare))
            sums.append(float(value.sum()) + len(rare))
            tails += tail.items()
            sizes.append(len(tail))
    kind = pa.struct([("word", pa.string()), ("times", pa.int64())])
    flat = pa.StructArray.from_arrays(
        [
            pa.array([w for w, _ in tails], pa.binary()).cast(pa.string()),
            pa.array([n for _, n in tails], pa.int64()),
        ],
        fields=list(kind),
    )
    cuts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.table(
        {
            "lm_row": batch.column("lm_row"),
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "logs": pa.array(sums, pa.float64()),
            "score": pa.array(np.concatenate(scores)),
            "tail": pa.ListArray.from_arrays(cuts, flat),
        }
    )


def score_documents(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, base_score, score.

    ``docs``: doc_id, text; other columns are not read. ``score``: log10
    probability of the text's bytes and its end by partial matching.
    ``base_score``: sum over words and the end of log10((c + 1) / (N + V + 1)).
    A NULL text is empty; every row is returned, repeated ids and rows too.

    Words up to a fixed number, the frequent ones, are looked up in memory; the
    rest, of which none is crowded, is joined with the vocabulary. Texts are gathered
    in blocks; the different grams of a block go to the parts of the trie, their costs
    come back, and each text is scored in its block.
    """
    least, words = model.frequent()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    copies = 1 + size // (TEXT_BLOCK * BLOCKS_AT_ONCE)
    parts = _parts(model)
    keyed = docs.select(
        F.monotonically_increasing_id().alias("lm_row"), F.col("doc_id").cast("long"), "text"
    )
    blocks = stored(_blocks(keyed, model.order, parts), "lm-blocks")
    rows = stored(_scored(blocks, model, words, parts, copies), "lm-scores")
    rare = (
        rows.select("lm_row", F.explode("tail").alias("t"))
        .select("lm_row", "t.word", "t.times")
        .join(model.vocabulary.filter(F.col("n") < least), "word")
        .groupBy("lm_row")
        .agg(
            F.sum("times").alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"),
        )
    )
    whole = rows.drop("tail").join(rare, "lm_row", "left")
    end = F.log10(F.lit(model.documents + 1.0))
    scale = F.log10(F.lit(float(model.tokens + model.types + 1)))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + end
    return whole.select(
        "doc_id",
        "n_tokens",
        (
            F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(model.documents > 0))
        ).alias("n_known"),
        (logs - F.col("n_tokens") * scale).alias("base_score"),
        "score",
    )


def score_adaptively(docs: DataFrame, order: int = 3) -> DataFrame:
    """doc_id and score: log10 probability of each text by a model that starts
    empty with it and learns it symbol by symbol.

    Texts are independent, so that no training pass is needed; how far repeats
    shorten a text shows how much it repeats itself. A NULL text is empty. This
    goes through every byte in Python: some 5 microseconds a byte and order.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                AdaptiveModel(order).score(raw_bytes(t).lower(), learn=True)
                for t in batch.column(1)
            ]
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
