"""Language-model scores: a gated recurrent network with a class-factored softmax over an open vocabulary.

After each state the network gives a softmax over classes of tokens, and within the class of the next token a softmax
over groups of its tokens; a token's share of its group comes from counts. Frequent tokens are classes of their own,
others are classed by how they end and grouped by how they begin, which can be known without a list of all tokens.
Classes, the softmaxes' first biases and shares come from counts over the whole training part.

Weights are trained in numpy by truncated backpropagation on all training documents: whole texts, dealt into rounds and
shards; where there are few, each is in several rounds. In each round every shard goes on from the common weights, and these become the mean of
what the shards have learnt, weighted by their tokens.

Texts are cut into blocks where they are read, and no text is shuffled. A block writes its documents as numbers of its
distinct tokens, frequent ones in one byte, and each of these tokens once, with its count, to be summed over all
blocks; it gets back the sums by number. So what is shuffled per token is a 64-bit hash per block, not a row per
document, and no task holds the vocabulary. What is learnt from is shuffled as classes and groups, too.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapelens.llm.gru import Adam, Gru
from shapelens.llm.texts import LOWER_BYTES, WordHashes, part_of, slices, utf8
from shapelens.session import sized

#: Lower-cases A-Z and makes all whitespace a space: everything else belongs to tokens.
TOKEN_BYTES = bytes(32 if b in b"\t\n\x0b\x0c\r " else b for b in LOWER_BYTES)
#: Classes: the most frequent tokens, the most frequent endings of others, and one for the rest.
SINGLES, ENDINGS = 63, 64
CLASSES = SINGLES + ENDINGS + 1
#: Groups of the tokens of a class.
HEADS = 16
SIZE, WINDOW = 16, 32
#: Documents of a shard, on average, and times that the shards' weights are put together.
SHARD_DOCS, ROUNDS = 6000, 4
#: Documents of a round, if there are as many: a document is in so many rounds that this is reached, and in one at least.
LEARN_LEAST = 1500
#: Tokens of a stream and most streams: large shards take wider steps, not more of them.
STREAM_TOKENS, MOST_STREAMS = 7000, 256
RATE = 0.01
#: Rows whose logits fit a core's cache.
CACHED = 1024
#: Bytes of text in a block of documents, with eight for each.
BLOCK_BYTES = 12 << 20
#: Hash of the token that ends every document; no word has it but by a 64-bit chance.
END = np.uint64(0x656E642D6F662D64)


def ending(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for the last three bytes of each token before a closing comma or full stop, and whether there is one."""
    last = raw[ends - 1]
    mark = ((last == 44) | (last == 46)) & (ends - begins > 1)
    e = ends - mark
    out = mark.astype(np.int64)
    for i in range(1, 4):
        out = out << 8 | np.where(e - i >= begins, raw[np.maximum(e - i, 0)], 32)
    return out


def heading(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group of each token by its first two bytes."""
    first, second = raw[begins].astype(np.int64), np.where(ends - begins > 1, raw[np.minimum(begins + 1, len(raw) - 1)], 0)
    return (first * 31 + second * 7) % HEADS


@dataclass
class Tokens:
    """Tokens of some documents: hash, ending and group of each, and where each document's start; the last of each is END."""

    hashes: np.ndarray
    endings: np.ndarray
    heads: np.ndarray
    starts: np.ndarray


class Tokenizer:
    def __init__(self) -> None:
        self.words = WordHashes(TOKEN_BYTES)

    def __call__(self, column: pa.Array) -> Tokens:
        raw, offsets = utf8(column)
        hashes, starts, begins, ends = self.words.spans(raw, offsets)
        low = np.frombuffer(TOKEN_BYTES, np.uint8)[raw]
        found = ending(low, begins, ends) if len(begins) else np.zeros(0, np.int64)
        heads = heading(low, begins, ends) if len(begins) else np.zeros(0, np.int64)
        at = starts[1:]
        return Tokens(np.insert(hashes, at, END), np.insert(found, at, -1), np.insert(heads, at, 0), starts + np.arange(len(starts)))


@dataclass
class Classes:
    """Class of a token: the number of its hash among `singles`, else of its ending among `endings`, else the last one."""

    singles: np.ndarray
    endings: np.ndarray

    def of(self, tokens: Tokens) -> np.ndarray:
        out = _place(self.endings, tokens.endings)
        out = np.where(out >= 0, SINGLES + out, CLASSES - 1)
        single = _place(self.singles, tokens.hashes)
        return np.where(single >= 0, single, out).astype(np.int16)


def choice(classes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """One number for class and group; a frequent token has its class alone."""
    return np.where(classes < SINGLES, classes, SINGLES + (classes.astype(np.int32) - SINGLES) * HEADS + heads)


def choice_parts(choices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and group of `choice`; the group of a frequent token is 0."""
    inner = np.maximum(choices - SINGLES, 0)
    return np.where(choices < SINGLES, choices, SINGLES + inner // HEADS).astype(np.int16), inner % HEADS


def pack(numbers: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary value per document: seven bits of a number in a byte, the last byte of each without the eighth."""
    sizes = 1 + sum((numbers >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    at = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.empty(at[-1], np.uint8)
    for k in range(int(sizes.max(initial=0))):
        has = sizes > k
        raw[at[:-1][has] + k] = numbers[has] >> 7 * k & 127 | (sizes[has] > k + 1) << 7
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(at[starts].astype(np.int32)), pa.py_buffer(raw)])


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all documents, and where each document's start (n + 1 entries)."""
    raw, offsets = utf8(column)
    ends = np.flatnonzero(raw < 128)
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    numbers = np.zeros(len(ends), np.int64)
    for k in range(int((ends - begins).max(initial=-1)) + 1):
        has = ends - begins >= k
        numbers[has] |= (raw[begins[has] + k] & 127).astype(np.int64) << 7 * k
    return numbers, np.searchsorted(begins, offsets)


def _place(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted array, or -1."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


def _levelled(weight: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
    """The bias lowered so that no logit of a state is above 0, and whether logits can still leave the range of exp.

    States lie within -1 and 1, which bounds all logits.
    """
    reach = np.abs(weight).sum(-2)
    high, low = (bias + reach).max(-1, keepdims=True), (bias - reach).min(-1, keepdims=True)
    return bias - high, bool((high - low).max() > 80)


def _odds(logits: np.ndarray, far: bool) -> np.ndarray:
    """exp of the logits in their place, and the sum of each row; `far` ones are moved first."""
    if far:
        logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], np.float32)


def _log_chosen(logits: np.ndarray, targets: np.ndarray, far: bool) -> np.ndarray:
    """Log probability of one target a row; the logits are used up."""
    right = logits[np.arange(len(targets)), targets]
    if far:
        right -= logits.max(1)
    return right - np.log(_odds(logits, far))


def _runs(classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows of classes from SINGLES on, by class, and (class, begin, end) of each class among them: a product for each
    class is far less work than one weight matrix a row."""
    ends = np.cumsum(np.bincount(classes, minlength=CLASSES))
    runs = [(c, int(ends[c - 1] - ends[SINGLES - 1]), int(ends[c] - ends[SINGLES - 1])) for c in range(SINGLES, CLASSES) if ends[c] > ends[c - 1]]
    return np.argsort(classes, kind="stable")[ends[SINGLES - 1]:], runs


def _slopes(logits: np.ndarray, targets: np.ndarray, weight: np.ndarray, far: bool) -> np.ndarray:
    """Gradient of the weighted loss by the logits, in their place."""
    logits *= (weight / _odds(logits, far))[:, None]
    logits[np.arange(len(targets)), targets] -= weight
    return logits


class Model:
    """The network over classes and groups. `shares` has the counts of tokens, and of those seen once, by class and group."""

    def __init__(self, classes: Classes, shares: np.ndarray) -> None:
        random = np.random.default_rng(11)
        self.classes, self.shares, self.gru = classes, shares, Gru(CLASSES + 1, SIZE, random)
        n = shares[:, :, 0]
        self.p = {
            "out": random.normal(0, 0.1, (SIZE, CLASSES)).astype(np.float32), "bias": np.log(n.sum(1) + 0.5).astype(np.float32),
            "inner": np.zeros((CLASSES, SIZE, HEADS), np.float32), "inner_bias": np.log(n + 0.5).astype(np.float32),
        }

    def weights(self) -> np.ndarray:
        """All weights in one array."""
        return np.concatenate([x.ravel() for x in (*self.gru.p.values(), *self.p.values())])

    def with_weights(self, flat: np.ndarray) -> Model:
        other, at = Model(self.classes, self.shares), 0
        for params in (other.gru.p, other.p):
            for k, x in params.items():
                params[k] = flat[at: at + x.size].astype(np.float32).reshape(x.shape)
                at += x.size
        return other

    def log_choices(self, states: np.ndarray, classes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Log probability of each class after each state, and of the group within it; a frequent token has no groups."""
        out, (bias, far) = np.empty(len(classes), np.float32), _levelled(self.p["out"], self.p["bias"])
        for at in range(0, len(classes), CACHED):
            rows = slice(at, at + CACHED)
            logits = states[rows] @ self.p["out"]
            logits += bias
            out[rows] = _log_chosen(logits, classes[rows], far)
        order, runs = _runs(classes)
        bias, far = _levelled(self.p["inner"], self.p["inner_bias"])
        out[order] += _log_chosen(self._inner(states[order], classes[order], runs, bias), heads[order], far)
        return out

    def _inner(self, states: np.ndarray, classes: np.ndarray, runs: list[tuple[int, int, int]], bias: np.ndarray) -> np.ndarray:
        """Logits of the groups within each row's class."""
        logits = np.empty((len(states), HEADS), np.float32)
        for c, s, e in runs:
            np.matmul(states[s:e], self.p["inner"][c], out=logits[s:e])
        logits += bias[classes]
        return logits

    def log_share(self, classes: np.ndarray, heads: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log share of tokens within their groups: of `counts` for known ones, else what a group keeps for unseen ones
        (Good and Turing's estimate; everything where nothing is known). A frequent token is all of its class."""
        n, once = self.shares[classes, heads, 0], self.shares[classes, heads, 1]
        unseen = np.where(n > 0, np.clip((once + 0.5) / (n + 1), 1e-9, 0.5), 1.0)
        known = counts > 0
        share = np.where(known, np.maximum(counts, 1) / np.maximum(n, 1) * (1 - unseen), unseen)
        return np.where((classes < SINGLES) & known, 0.0, np.log(np.where(share > 0, share, 1.0)))

    def score(self, classes: np.ndarray, heads: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log probability of class and group of every token. The state runs through each document, from window to window."""
        sizes = np.diff(starts)
        order = np.argsort(-sizes, kind="stable")
        sizes, begins = sizes[order], starts[:-1][order]
        out = np.zeros(len(classes), np.float32)
        h = np.zeros((len(order), SIZE), np.float32)
        before = np.full(len(order), CLASSES, np.int16)  # the symbol before the first token
        live = len(order)
        places, states, held = [], [], 0

        def flush() -> None:
            at = np.concatenate(places)
            out[at] = self.log_choices(np.concatenate(states), classes[at], heads[at])

        for t in range(int(sizes[0]) if len(sizes) else 0):
            while live and sizes[live - 1] <= t:
                live -= 1
            h = self.gru.step(before[:live], h[:live])
            at = begins[:live] + t
            places.append(at)
            states.append(h)
            before = classes[at]
            held += live
            if held >= 16384:
                flush()
                places, states, held = [], [], 0
        if held:
            flush()
        return out

    def learn(self, documents: list[tuple[np.ndarray, np.ndarray]], turn: int, turns: int, streams: int | None = None) -> None:
        """One pass over (classes, heads) of documents: truncated backpropagation, the state carried between windows.

        `turn` of `turns` such passes sets the rate, which falls from pass to pass and within each.
        """
        adam, adam_gru = Adam(), Adam()
        line = np.concatenate([np.concatenate([[CLASSES], c]) for c, _ in documents]).astype(np.int16)
        groups = np.concatenate([np.concatenate([[0], g]) for _, g in documents])
        streams = min(MOST_STREAMS, max(64, len(line) // STREAM_TOKENS)) if streams is None else streams
        streams = max(1, min(streams, len(line) // 8))
        width = len(line) // streams
        grid, group_grid = (x[: width * streams].reshape(streams, width).T for x in (line, groups))
        h = np.zeros((streams, SIZE), np.float32)
        for t in range(0, width - 1, WINDOW):
            y = grid[t + 1: t + 1 + WINDOW]
            x = grid[t: t + len(y)]
            states, kept = self.gru.forward_all(x, h)
            flat, target, group = states.reshape(-1, SIZE), y.ravel(), group_grid[t + 1: t + 1 + WINDOW].ravel()
            real = target < CLASSES  # the start of a document is given, not predicted
            weight = (real / np.float32(max(1, real.sum()))).astype(np.float32)
            target = np.where(real, target, 0)
            back, grads = np.empty_like(flat), {k: np.zeros_like(v) for k, v in self.p.items()}
            bias, far = _levelled(self.p["out"], self.p["bias"])
            for at in range(0, len(flat), CACHED):
                rows = slice(at, at + CACHED)
                logits = flat[rows] @ self.p["out"]
                logits += bias
                slope = _slopes(logits, target[rows], weight[rows], far)
                np.matmul(slope, self.p["out"].T, out=back[rows])
                grads["out"] += flat[rows].T @ slope
                grads["bias"] += np.ones(len(slope), np.float32) @ slope
            order, runs = _runs(target)
            own, inner_back = flat[order], np.empty((len(order), SIZE), np.float32)
            bias, far = _levelled(self.p["inner"], self.p["inner_bias"])
            slope = _slopes(self._inner(own, target[order], runs, bias), group[order], weight[order], far)
            for c, s, e in runs:
                np.matmul(slope[s:e], self.p["inner"][c].T, out=inner_back[s:e])
                np.matmul(own[s:e].T, slope[s:e], out=grads["inner"][c])
            if runs:
                grads["inner_bias"][[c for c, _, _ in runs]] = np.add.reduceat(slope, [s for _, s, _ in runs], axis=0)
            back[order] += inner_back
            adam.rate = adam_gru.rate = RATE * (1 - 0.9 * (turn + t / width) / turns)
            adam(self.p, grads)
            adam_gru(self.gru.p, self.gru.backward_all(x, kept, back.reshape(states.shape)))
            h = np.where((y[-1] == CLASSES)[:, None], 0, states[-1]).astype(np.float32)


def classes_of(counts: DataFrame) -> Classes:
    """The classes that `(token, ending, c)` of all training tokens gives: bounded by SINGLES and ENDINGS."""
    end = int(END.astype(np.int64))
    singles = [r.token for r in counts.orderBy((F.col("token") == end).desc(), F.col("c").desc(), "token").limit(SINGLES).select("token").collect()]
    others = counts.where(~F.col("token").isin(singles)) if singles else counts
    common = others.groupBy("ending").agg(F.sum("c").alias("n")).orderBy(F.col("n").desc(), "ending").limit(ENDINGS).select("ending").collect()
    return Classes(np.sort(np.array(singles, np.int64).astype(np.uint64)), np.array(sorted(r.ending for r in common), np.int64))


def with_class(tokens: DataFrame, classes: Classes) -> DataFrame:
    """`class` of each `(token, ending)`, as `Classes.of` says."""
    spark = tokens.sparkSession
    single = spark.createDataFrame([(int(v), i) for i, v in enumerate(classes.singles.astype(np.int64))], "token long, single int")
    end = spark.createDataFrame([(int(v), SINGLES + i) for i, v in enumerate(classes.endings)], "ending long, class int")
    named = tokens.join(F.broadcast(single), "token", "left").join(F.broadcast(end), "ending", "left")
    return named.withColumn("class", F.coalesce("single", "class", F.lit(CLASSES - 1))).drop("single")


def group_counts(counts: DataFrame, classes: Classes) -> np.ndarray:
    """Counts of tokens, and of those seen once, by class and group."""
    shares = np.zeros((CLASSES, HEADS, 2))
    for r in with_class(counts, classes).groupBy("class", "head").agg(F.sum("c").alias("n"), F.count_if(F.col("c") == 1).alias("once")).collect():
        shares[r["class"], r["head"]] = r["n"], r["once"]
    return shares


def _coded(classes: Classes) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of batches as their tokens' choices."""
    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for part in slices(batches, "text", 1 << 20):
            tokens = tokenizer(part.column("text"))
            yield part.drop_columns("text").append_column("choices", pack(choice(classes.of(tokens), tokens.heads), tokens.starts))

    return code


def _pass(model: Model, turn: int) -> Callable[[pa.Table], pa.Table]:
    """Gives the weights that a shard has learnt from its documents, times its tokens."""
    def learn(table: pa.Table) -> pa.Table:
        documents = []
        for part in slices(table.sort_by([("order", "ascending")]).combine_chunks().to_batches(), "choices", 1 << 20):
            choices, starts = unpack(part.column("choices"))
            kinds, heads = choice_parts(choices)
            documents += [(kinds[s:e], heads[s:e]) for s, e in zip(starts[:-1], starts[1:])]
        own = model.with_weights(model.weights())
        own.learn(documents, turn, ROUNDS)
        n, flat = sum(len(c) for c, _ in documents), own.weights().astype(np.float64)
        return pa.table({"place": pa.array(np.arange(-1, len(flat)), pa.int32()), "value": pa.array(np.concatenate([[1.0], flat]) * n)})

    return learn


def fit(docs: DataFrame, counts: DataFrame, n_docs: int) -> Model:
    """docs: id, text, learn. Weights learnt from each of the `n_docs` documents to learn from, in one round at least."""
    classes = classes_of(counts)
    model = Model(classes, group_counts(counts, classes))
    if not n_docs:
        return model
    each = max(1, min(ROUNDS, math.ceil(ROUNDS * LEARN_LEAST / n_docs)))
    shards = max(1, math.ceil(n_docs * each / ROUNDS / SHARD_DOCS))
    # rows of equal id and text are spread too: no shard grows with them
    dealt = docs.where("learn").withColumn("order", F.xxhash64("id", "text")).withColumn("place", F.pmod(F.xxhash64("order", F.rand(3)), F.lit(shards * ROUNDS))).select(
        F.floor(F.col("place") / ROUNDS).cast("int").alias("shard"), F.pmod("place", F.lit(ROUNDS)).cast("int").alias("first"), "order", "text")
    dealt = sized(dealt.mapInArrow(_coded(classes), "shard int, first int, order long, choices binary"))
    for turn in range(ROUNDS):
        learnt = dealt.where(F.pmod(F.lit(turn) - F.col("first"), F.lit(ROUNDS)) < each).select("shard", "order", "choices").groupBy("shard").applyInArrow(_pass(model, turn), "place int, value double")
        sums = {r.place: r.value for r in learnt.groupBy("place").agg(F.sum("value").alias("value")).collect()}  # as many as weights
        total = sums.pop(-1, None)
        if total:  # a handful of documents may leave a round empty
            model = model.with_weights(np.array([sums[i] for i in range(len(sums))]) / total)
    return model


def _block(block: int, parts: list[tuple[pa.RecordBatch, tuple[np.ndarray, ...]]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of documents, as numbers of tokens, and of tokens, by how often the block has them."""
    tokens = [p for _, p in parts]
    kinds, at, where = np.unique(np.concatenate([t[0] for t in tokens]), return_index=True, return_inverse=True)
    n_all, learnt, tag = (np.concatenate([t[i] for t in tokens]) for i in (2, 3, 1))
    order = np.argsort(-np.bincount(where, n_all, len(kinds)), kind="stable")
    rank = np.empty(len(kinds), np.int64)
    rank[order] = np.arange(len(kinds))
    own = np.split(rank[where], np.cumsum([len(t[0]) for t in tokens])[:-1])
    for (part, (*_, numbers, starts)), places in zip(parts, own, strict=True):
        yield _rows(schema, part.num_rows, block=block, id=part.column("id"), numbers=pack(places[numbers], starts))
    yield _rows(schema, len(kinds), block=block, number=np.arange(len(kinds)), token=kinds[order].astype(np.int64), tag=tag[at][order],
                n=np.bincount(where, learnt, len(kinds)).astype(np.int64)[order])


def _rows(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    """`size` rows of a block, with nulls for what is not given."""
    columns["block"] = np.full(size, columns["block"])
    return pa.record_batch([pa.array(columns[f.name], f.type) if isinstance(columns.get(f.name), np.ndarray) else columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)


def in_blocks(rows: DataFrame) -> DataFrame:
    """rows: id, text, learn. Blocks of documents, written: a row per document, `numbers` of its tokens, and, without these,
    a row per token of a block: its number, hash, `tag` (ending and group) and count in documents to learn from.

    Blocks are cut as texts are read, so none grows with the rows of one id or text.
    """
    schema = pa.schema([("block", pa.int64()), ("id", _arrow(rows)), ("numbers", pa.binary()), ("number", pa.int64()), ("token", pa.int64()), ("tag", pa.int64()), ("n", pa.int64())])

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, block = Tokenizer(), TaskContext.get().partitionId() << 32
        parts, size = [], 0
        for part in slices(batches, "text", 1 << 20):
            tokens = tokenizer(part.column("text"))
            learnt = np.repeat(part.column("learn").to_numpy(zero_copy_only=False), np.diff(tokens.starts))
            kinds, at, where = np.unique(tokens.hashes, return_index=True, return_inverse=True)
            tag = tokens.endings[at] * HEADS + tokens.heads[at]
            n_all, n = np.bincount(where, minlength=len(kinds)), np.bincount(where, learnt, len(kinds)).astype(np.int64)
            parts.append((part.select(["id"]), (kinds, tag, n_all, n, where.astype(np.int32), tokens.starts)))
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() + 8 * part.num_rows  # empty texts fill blocks too
            if size >= BLOCK_BYTES:
                yield from _block(block, parts, schema)
                parts, size, block = [], 0, block + 1
        if parts:
            yield from _block(block, parts, schema)

    return sized(rows.mapInArrow(tally, f"block long, id {rows.schema['id'].dataType.simpleString()}, numbers binary, number long, token long, tag long, n long"))


def score_texts(docs: DataFrame, learn: F.Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of every document.

    `learn` says which rows are learnt from. Scores are log10 probabilities of the whole text with its end: `base` by
    single tokens with one added to each count, `score` by the network: the class after all tokens before, the group in
    the class, and the token's share of the group, where a group keeps the share for unseen tokens that tokens seen once had.

    Null texts are empty and consist of the end; repeated rows are scored one by one; with nothing to learn from all
    tokens are unknown; an empty table gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    blocks, each = in_blocks(rows), Window.partitionBy("token")
    asked = sized(blocks.where("numbers is null").select("block", "number", "token", "tag", F.sum("n").over(each).alias("c"), (F.min("block").over(each) == F.col("block")).alias("first")))
    asked = asked.select("block", "number", "token", F.floor(F.col("tag") / HEADS).alias("ending"), F.pmod("tag", F.lit(HEADS)).cast("int").alias("head"), "c", "first")
    counts = asked.where("first and c > 0").select("token", "ending", "head", "c")
    n_docs = counts.where(F.col("token") == int(END.astype(np.int64))).select("c").first()
    model = fit(rows, counts, n_docs[0] if n_docs else 0)
    shared = spark.sparkContext.broadcast(model)
    kinds, n_all = counts.count(), int(model.shares[:, :, 0].sum())
    chosen = F.when(F.col("class") < SINGLES, F.col("class")).otherwise(SINGLES + (F.col("class") - SINGLES) * HEADS + F.col("head"))
    answers = with_class(asked, model.classes).select("block", "number", chosen.alias("choice"), "c")

    def score(table: pa.Table, known: pa.Table) -> pa.Table:
        model, order = shared.value, np.argsort(known.column("number").to_numpy())
        count, choices = known.column("c").to_numpy()[order], known.column("choice").to_numpy()[order]
        classes, heads = choice_parts(choices)
        base, inside = np.log10((count + 1) / (n_all + kinds + 1)), model.log_share(classes, heads, count)
        numbers, starts = unpack(table.column("numbers").combine_chunks())
        token_scores = (model.score(classes[numbers], heads[numbers], starts).astype(np.float64) + inside[numbers]) / math.log(10)
        add = lambda x: np.add.reduceat(x, starts[:-1])
        out = [np.diff(starts).astype(np.int64), add((count > 0).astype(np.int64)[numbers]), np.full(len(starts) - 1, n_all, np.int64), add(base[numbers]), add(token_scores)]
        return pa.table({"id": table.column("id"), **{n: pa.array(v) for n, v in zip(names, out, strict=True)}})

    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    documents = blocks.where("numbers is not null").select("block", "id", "numbers")
    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)


def lm_report(docs: DataFrame) -> DataFrame:
    part = part_of(F.col("doc_id"), 7, 2)
    scored = score_texts(docs, part != 2)
    return scored.select(F.col("id").alias("doc_id"), (part_of(F.col("id"), 7, 2) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

