"""Hidden Markov language model with exact corpus counts.

*Counts.* Documents are read once into chunks of a couple of million tokens. A
chunk numbers its distinct tokens and asks for their corpus counts: one packed
row per chunk and hash bucket, holding the tokens' 64-bit hashes and how often the chunk's
training documents have them. A bucket adds the counts of all chunks and
answers each chunk in the order it asked. So every token is counted over the whole
corpus, a frequent token costs one entry per chunk, however hot, and nothing
that grows with the corpus is broadcast or collected. (Two of a billion distinct tokens
share a hash with a chance of 3 percent; they would share their count.)

*Model.* Hidden states emit tokens. State s emits token t with probability base(t) * r(s, t), where
r = (g(s, t) / share(s) + 0.5) / (c + 0.5), g are the expected counts (their sum over the states is c) and
share(s) is the state's part of all tokens. Every state's emissions add up to one (up to the rounding of packed
shares to 16 bits), and a token never seen has its base probability in each state. Baum-Welch runs over all training documents: a chunk adds up
expected counts per state and distinct token, sends them packed by hash bucket like its questions, and a bucket answers every chunk
with the sums over the corpus, so the number of emissions learned grows with the vocabulary. Only start and
moves (states, states x states) go through the driver. The likelihood of a text is exact, by the
forward recursion scaled at every token. Recursions advance all documents of a
chunk together, one position at a time.

``base_score`` is the smoothed unigram score: the sum over tokens of
log10((c + 0.5) / (N + 0.5 (V + 1))).

Edge cases: a NULL or empty text is its end token alone. Rows with a NULL or
repeated id are scored each. Without training documents N = V = 0 and the model is the
base model. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import LOWER_AZ, map_arrow, scratch_path, written

CHUNK_TOKENS = 2_000_000
#: Places of a chunk whose emissions are looked up at once.
BLOCK = 1 << 15
END = b""  # no word is empty
LN10 = float(np.log(10.0))


class Numbering(dict):
    """Token to its number in order of appearance."""

    def __missing__(self, token: bytes) -> int:
        self[token] = found = len(self)
        return found


# --- counts ---------------------------------------------------------------------


def encoded(docs: DataFrame, training: Column, buckets: int) -> DataFrame:
    """Chunks (``kind = 'text'``) and their questions (``kind = 'count'``) as packed rows.

    text: ids, flags (1: NULL id, 2: training), lengths, token numbers, documents one after the other;
    count: hashes and training counts of the chunk's tokens in one bucket, ascending."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.coalesce(training, F.lit(False)).alias("training"))
    names = ["kind", "chunk", "bucket", "ids", "flags", "lengths", "tokens", "hashes", "counts"]
    types = [pa.string(), pa.int64(), pa.int32(), *[pa.binary()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() * (1 << 24)
        ids, flags, tokens, held, number = [], [], [], 0, Numbering()

        def flush():
            words = list(number)
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
            bucket = (hashes % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((hashes, bucket))
            place = np.empty(len(order), dtype="<u4")
            place[order] = np.arange(len(order), dtype="<u4")
            lengths = np.array([len(t) for t in tokens], dtype="<u4")
            flat = np.concatenate(tokens)
            is_training = np.array(flags) & 2 > 0
            counts = np.bincount(flat[np.repeat(is_training, lengths)], minlength=len(words))
            rows = [("text", chunk, -1, np.array(ids, dtype="<i8").tobytes(), np.array(flags, dtype="u1").tobytes(),
                     lengths.tobytes(), place[flat].tobytes(), None, None)]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                part = order[edges[b]:edges[b + 1]]
                if len(part):
                    rows.append(("count", chunk, b, None, None, None, None, hashes[part].astype("<u8").tobytes(),
                                 counts[part].astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc_id, text, train in zip(*(c.to_pylist() for c in part.columns)):
                    words = text.encode().translate(LOWER_AZ).split() if text else []
                    words.append(END)
                    tokens.append(np.fromiter(map(number.__getitem__, words), dtype=np.uint32, count=len(words)))
                    ids.append(doc_id or 0)
                    flags.append((doc_id is None) + 2 * train)
                    held += len(words)
                    if held >= CHUNK_TOKENS:
                        yield flush()
                        chunk += 1
                        ids, flags, tokens, held, number = [], [], [], 0, Numbering()
        if ids:
            yield flush()

    return map_arrow(source, run, "kind string, chunk long, bucket int, ids binary, flags binary, lengths binary, "
                                  "tokens binary, hashes binary, counts binary")


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Written by chunk in buckets: the passes never move the texts again."""
    spark, name = df.sparkSession, f"llm_hmm_{uuid.uuid4().hex}"
    (df.write.option("compression", "zstd").option("path", scratch_path(spark, "chunks")).bucketBy(buckets, "chunk")
     .saveAsTable(name))
    return spark.table(name)


def scattered(hashes: np.ndarray, states: int) -> np.ndarray:
    """(tokens, states): first shares of a token's count, from its hash alone."""
    odd = np.arange(1, 2 * states, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (hashes[:, None] ^ (hashes[:, None] >> np.uint64(29))) * odd[None, :]
    out = np.exp(2.0 * (mixed >> np.uint64(11)) / float(1 << 53) - 1.0)
    return out / out.sum(axis=1, keepdims=True)


def answered(questions: DataFrame, buckets: int, states: int, sent: DataFrame | None = None) -> DataFrame:
    """``kind = 'answer'``: ``chunk, bucket, counts`` (u32, or u64 if one is larger) and ``shares`` of the states (f16), in the question's order;
    ``kind = 'total'``: per bucket ``n`` (training tokens) and ``d`` (distinct). ``sent``: the chunks' own shares, none at first."""
    asked = questions.select("bucket", "chunk", "hashes", "counts", F.lit(None).cast("binary").alias("shares"))
    if sent is not None:
        none = F.lit(None).cast("binary")
        asked = asked.unionByName(sent.select("bucket", "chunk", none.alias("hashes"), none.alias("counts"), "shares"))
    dealt = asked.withColumn("part", F.col("hashes").isNull()).repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", "chunk", "part").drop("part")
    first = sent is None
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(bucket, rows):
            hashes = [np.frombuffer(h, "<u8") for _, h, _, _ in rows]
            distinct, where = np.unique(np.concatenate(hashes), return_inverse=True)
            own = [np.frombuffer(c, "<u4") for _, _, c, _ in rows]
            total = np.zeros(len(distinct), dtype="<u8")
            np.add.at(total, where, np.concatenate(own).astype("<u8"))
            cuts = np.cumsum([len(h) for h in hashes])[:-1]
            places = np.split(where, cuts)
            if first:
                shares = scattered(distinct, states)
            else:
                shares = np.zeros((len(distinct), states))
                for (_, _, _, q), c, w in zip(rows, own, places):
                    if q is not None:  # a chunk's tokens are distinct
                        shares[w] += c[:, None] * np.frombuffer(q, "<f2").reshape(-1, states).astype(float)
                shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1e-300)
            shares = shares.astype("<f2")
            packed = total if total.max() >> 32 else total.astype("<u4")
            out = [("answer", r[0], bucket, packed[w].tobytes(), shares[w].tobytes(), None, None) for r, w in zip(rows, places)]
            if first:
                out.append(("total", None, bucket, None, None, int(total.sum()), int((total > 0).sum())))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                              names=["kind", "chunk", "bucket", "counts", "shares", "n", "d"])

        now, rows = None, []
        for batch in batches:
            for bucket, chunk, h, c, q in zip(*(x.to_pylist() for x in batch.columns)):
                if bucket != now and rows:
                    yield answer(now, rows)
                    rows = []
                now = bucket
                if h is None:
                    rows[-1][3] = q
                else:
                    rows.append([chunk, h, c, None])
        if rows:
            yield answer(now, rows)

    return map_arrow(dealt, run, "kind string, chunk long, bucket int, counts binary, shares binary, n long, d long")


# --- the model ---------------------------------------------------------------------


class Hmm:
    """start (states), moves (states, states), emit (states, tokens)."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emit: np.ndarray):
        self.start, self.moves, self.emit = start, moves, emit


class Chain:
    """start, moves and each state's part of all tokens: what does not grow with the vocabulary."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, part: np.ndarray):
        self.start, self.moves, self.part = start, moves, part

    @classmethod
    def first(cls, states: int) -> "Chain":
        """Sticky states."""
        even = np.full(states, 1.0 / states)
        moves = np.full((states, states), 0.1 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
        if states > 1:
            np.fill_diagonal(moves, 0.9)
        return cls(even, moves, even)

    @classmethod
    def of_counts(cls, flat: np.ndarray, states: int) -> "Chain":
        start = flat[:states] + 1e-3
        moves = flat[states:-states].reshape(states, states) + 1e-3
        part = flat[-states:] + 1e-3
        return cls(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), part / part.sum())

    def over(self, counts: np.ndarray, shares: np.ndarray, kind: type = float) -> Hmm:
        """The model of a chunk's tokens, emissions relative to their base probability."""
        c = counts.astype(float)[:, None]
        relative = (c * shares.astype(float) / self.part + 0.5) / (c + 0.5)
        return Hmm(self.start.astype(kind), self.moves.astype(kind), relative.astype(kind).T)


def by_position(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents by falling length, classes by position and then document, first place of each position).

    All documents still running at a position stand together, so one step advances them all."""
    order = np.argsort(-lengths.astype(np.int64), kind="stable")
    longest = int(lengths[order[0]])
    running = np.searchsorted(-lengths[order].astype(np.int64), -np.arange(longest), "left")
    first = np.concatenate(([0], np.cumsum(running)))
    ends = np.cumsum(lengths, dtype=np.int64)
    out = np.empty(len(classes), dtype=np.int64)
    for rank, d in enumerate(order):
        n = int(lengths[d])
        out[first[:n] + rank] = classes[ends[d] - n:ends[d]]
    return order, out, first


def blocks(first: np.ndarray) -> list[tuple[int, int]]:
    """Runs of positions of about ``BLOCK`` places: at the far end of long documents a position has few places, and
    what can be done for many positions at once is."""
    out, t = [], 0
    while t < len(first) - 1:
        end = max(t + 1, int(np.searchsorted(first, first[t] + BLOCK, "right")) - 1)
        out.append((t, end))
        t = end
    return out


def forward(model: Hmm, classes: np.ndarray, first: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(natural log likelihood by rank, scaled forward vectors, scales) over ``by_position`` classes."""
    emit = np.ascontiguousarray(model.emit.T)
    moves, ones = model.moves, np.ones(emit.shape[1], dtype=emit.dtype)
    kept = np.empty((len(classes), emit.shape[1]), dtype=emit.dtype) if keep else None
    scales = np.empty(len(classes), dtype=emit.dtype)
    bounds, alpha = first.tolist(), None
    for t0, t1 in blocks(first):
        start, end = bounds[t0], bounds[t1]
        block = np.take(emit, classes[start:end], axis=0)
        for t in range(t0, t1):
            a, b = bounds[t] - start, bounds[t + 1] - start
            now = block[a:b]
            now *= model.start if alpha is None else alpha[:b - a] @ moves
            scale = now @ ones
            now /= scale[:, None]
            scales[a + start:b + start] = scale
            alpha = now
        if keep:
            kept[start:end] = block
    rank = np.arange(len(classes)) - np.repeat(first[:-1], np.diff(first))
    return np.bincount(rank, weights=np.log(scales, dtype=float), minlength=bounds[1]), kept, scales


def expected(model: Hmm, classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, float]:
    """Flat expected counts (start, moves, emissions) of the documents, and their log likelihood."""
    states = len(model.start)
    emit, back = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.moves.T)
    total, alpha, scales = forward(model, classes, first, True)
    moved = np.zeros((states, states))
    bounds, after = first.tolist(), None
    for t0, t1 in reversed(blocks(first)):
        start, end = bounds[t0], bounds[t1]
        block = np.take(emit, classes[start:end], axis=0)
        block /= scales[start:end, None]
        for t in range(t1 - 1, t0 - 1, -1):
            a, b = bounds[t], bounds[t + 1]
            now = block[a - start:b - start]
            if after is not None:  # documents that end here have nothing after
                on = alpha[a:a + len(after)]
                moved += on.T @ after
                beta = after @ back
                now[:len(after)] *= beta
                on *= beta
            after = now
    seen = np.stack([np.bincount(classes, weights=alpha[:, s], minlength=emit.shape[0]) for s in range(states)])
    start = alpha[:bounds[1]].sum(axis=0, dtype=float)
    return np.concatenate((start, (moved * model.moves).ravel(), seen.ravel())), float(total.sum())


def joined(chunks: DataFrame, answers: DataFrame, *columns: str) -> DataFrame:
    """``chunk, found`` (its answers by bucket) and columns of the chunk."""
    found = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts", "shares"))).alias("found"))
    return chunks.select("chunk", *columns).join(found, "chunk").select("chunk", "found", *columns)


def unpacked(found, states: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(counts, shares, (bucket, tokens)) of a chunk's tokens."""
    cells = found.values
    shares = [np.frombuffer(x.as_buffer(), "<f2").reshape(-1, states) for x in cells.field("shares")]
    counts = [np.frombuffer(x.as_buffer(), f"<u{len(x.as_buffer()) // len(q)}") for x, q in zip(cells.field("counts"), shares)]
    return np.concatenate(counts), np.concatenate(shares), list(zip(cells.field("bucket").to_pylist(), map(len, counts)))


def summed(work: DataFrame, chain: Chain, states: int) -> DataFrame:
    """One pass over the training documents. ``kind = 'share'``: a chunk's expected counts per bucket as the states' shares (f16);
    ``kind = 'sum'``: a task's expected start, moves and state counts."""
    start, moves, part = chain.start, chain.moves, chain.part
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head = Chain(start, moves, part), states + states * states
        total = np.zeros(head + states)

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["kind", "chunk", "bucket", "shares", "sums"])

        for batch in batches:
            for i in range(batch.num_rows):
                flags, lengths, flat = (np.frombuffer(batch.column(k)[i].as_buffer(), t) for k, t in ((2, "u1"), (3, "<u4"), (4, "<u4")))
                training = flags & 2 > 0
                if not training.any():
                    continue
                counts, shares, sizes = unpacked(batch.column(1)[i], states)
                flat = flat[np.repeat(training, lengths)]
                _, ordered, first = by_position(flat, lengths[training])
                got = expected(now.over(counts, shares, np.float32), ordered, first)[0]
                seen = got[head:].reshape(states, -1)
                total[:head] += got[:head]
                total[head:] += seen.sum(axis=1)
                own = (seen / np.maximum(seen.sum(axis=0), 1e-300)).T.astype("<f2")
                edges = np.cumsum([0, *(n for _, n in sizes)])
                yield packed([("share", batch.column(0)[i].as_py(), b, own[edges[k]:edges[k + 1]].tobytes(), None)
                              for k, (b, _) in enumerate(sizes)])
        yield packed([("sum", None, None, None, total.tolist())])

    return map_arrow(work, run, "kind string, chunk long, bucket int, shares binary, sums array<double>")


def baum_welch(chunks: DataFrame, questions: DataFrame, answers: DataFrame, buckets: int, *, states: int,
               rounds: int) -> tuple[Chain, DataFrame]:
    """The chain and the last answers, after one pass over the training documents and one exchange a round."""
    spark, chain, before = chunks.sparkSession, Chain.first(states), None
    schema = "chunk long, bucket int, shares binary, sums array<double>, kind string"
    for _ in range(rounds):
        path = scratch_path(spark, "expected")
        summed(joined(chunks, answers, "flags", "lengths", "tokens"), chain, states).write.option(
            "compression", "zstd").partitionBy("kind").parquet(path)
        sent = spark.read.schema(schema).parquet(path)
        sums = sent.where("kind = 'sum'").select(F.posexplode("sums").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"))
        flat = np.zeros(2 * states + states * states)
        for r in sums.collect():  # as many rows as the chain has numbers
            flat[r.k] = r.v
        chain = Chain.of_counts(flat, states)
        answers = answered(questions, buckets, states, sent.where("kind = 'share'")).where("kind = 'answer'")
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = path
        gc.collect()
        spark._jvm.System.gc()  # shuffle files of the round before go when the driver collects its garbage
    return chain, answers


def score(docs: DataFrame, training: Column, *, states: int = 8, rounds: int = 5) -> DataFrame:
    """``doc_id, training, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``training`` says which rows the counts and the model learn from."""
    spark = docs.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = bucketed(encoded(docs, training, buckets), buckets)
    chunks, questions = table.where("kind = 'text'"), table.where("kind = 'count'")
    first = written(answered(questions, buckets, states), "answers", "kind")
    totals = first.where("kind = 'total'").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).first()
    tokens, distinct = totals.n or 0, totals.d or 0
    norm = tokens + 0.5 * (distinct + 1)
    chain, answers = baum_welch(chunks, questions, first.where("kind = 'answer'"), buckets, states=states,
                                rounds=rounds if tokens else 0)
    start, moves, part = chain.start, chain.moves, chain.part
    names = ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Chain(start, moves, part)
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda k, t: np.frombuffer(batch.column(k)[i].as_buffer(), t)
                c, shares, _ = unpacked(batch.column(1)[i], states)
                ids, flags, lengths, numbers = cell(2, "<i8"), cell(3, "u1"), cell(4, "<u4").astype(np.int64), cell(5, "<u4")
                begin = np.cumsum(lengths) - lengths
                log_c = np.log((c + 0.5) / norm)
                base = np.add.reduceat(log_c[numbers], begin)
                known = np.add.reduceat((c > 0).astype(np.int64)[numbers], begin)
                order, ordered, first = by_position(numbers, lengths)
                gain = np.empty(len(ids))
                gain[order] = forward(own.over(c, shares), ordered, first, False)[0]
                full = base + gain
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64(), mask=flags & 1 > 0), pa.array(flags & 2 > 0, pa.bool_()), pa.array(lengths, pa.int64()),
                    pa.array(known, pa.int64()), pa.array(np.full(len(ids), tokens), pa.int64()),
                    pa.array(base / LN10, pa.float64()), pa.array(full / LN10, pa.float64())], names=names)

    return map_arrow(joined(chunks, answers, "ids", "flags", "lengths", "tokens"), run,
                     "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
