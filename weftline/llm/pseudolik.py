"""Masked pseudo-likelihood by a bidirectional window network in numpy.

Every word is predicted from the WINDOW words on each side: the network adds up their vectors, scaled by
place; a softmax over classes and, within the class, a walk down a binary tree lead to the word's leaf,
where each turn's probability is a logistic function of the hidden units and the inner node. The KNOWN
most frequent words have leaves of their own, the others share REST leaves by hash, and within such a
leaf a word has its share of the leaf's occurrences. So log P(w | both sides) is a proper distribution over all words of the corpus, and
a document's score is the sum over all of its words.

Counts are exact and cover every document; they stay in a table that grows with the corpus. The network
starts at the distribution of single words and is trained on every word of every document in rounds:
shards, by hash, start from the same parameters, and these are averaged by row. A shard receives the
leaves of its documents and forms the windows itself. Shards, their number and the order in
them follow from the documents alone, so scores do not depend on how the input is dealt.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import materialize

from .textkernel import U64, list_array, steps, utf8, words

#: Words with leaves of their own; leaves of all others; hidden units; words on each side; targets of a step.
KNOWN, REST, HIDDEN, WINDOW, BATCH = 65_536, 256, 16, 2, 8192
#: Classes of words: trees of about equal counts.
CLASSES = 32
#: Words of a shard; rows of a parameter chunk.
SHARD, CHUNK = 4_000_000, 4096
#: Every so many words one is a target, in each round others: with 1 every word is, in every round.
STRIDE = 1
RATE, ROUNDS = 0.08, 1


@dataclass
class Vocabulary:
    """keys: sorted hashes of the known words, leaf: their leaves; by leaf its count, class, and way through the inner nodes: first, depth, and node and turn of each step; start: the biases of the inner nodes, then of the classes."""

    keys: np.ndarray
    leaf: np.ndarray
    counts: np.ndarray
    kind: np.ndarray
    first: np.ndarray
    depth: np.ndarray
    node: np.ndarray
    turn: np.ndarray
    start: np.ndarray
    inner: int

    def leaves(self, token: np.ndarray) -> np.ndarray:
        """The leaf of each word: a known word's own, or one of the last REST."""
        out = len(self.keys) + token.view(np.int64) % REST
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, token), len(self.keys) - 1)
            out = np.where(self.keys[at] == token, self.leaf[at], out)
        return out.astype(np.int32)


def vocabulary(keys: np.ndarray, known: np.ndarray, rest: np.ndarray) -> Vocabulary:
    """From the hashes and counts of the known words and the counts of the other leaves. The lightest trees are joined until CLASSES are left; the start is the distribution of single words."""
    order = np.argsort(keys)
    counts = np.concatenate([known, np.maximum(rest, 1)]).astype(np.int64)
    heap = [(int(n), i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    leaves, bias = len(counts), []
    parent, turn = np.full(2 * leaves, -1, np.int64), np.zeros(2 * leaves, np.int8)
    while len(heap) > CLASSES:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[[i, j]], turn[j] = leaves + len(bias), 1
        heapq.heappush(heap, (a + b, leaves + len(bias)))
        bias.append(np.log(b / a))
    # a parent has a larger number than its children: depths and classes go from the roots down
    deep, kind = np.zeros(2 * leaves, np.int64), np.zeros(2 * leaves, np.int64)
    kind[[v for _, v in heap]] = np.arange(len(heap))
    for v in range(leaves + len(bias) - 1, -1, -1):
        if parent[v] >= 0:
            deep[v], kind[v] = deep[parent[v]] + 1, kind[parent[v]]
    depth = deep[:leaves]
    first = np.cumsum(depth) - depth
    node, sign = np.zeros(int(depth.sum()), np.int32), np.zeros(int(depth.sum()), np.float32)
    at, place = np.arange(leaves), first.copy()
    while len(at := at[more := parent[at] >= 0]):
        place = place[more]
        node[place], sign[place] = parent[at] - leaves, turn[at]
        at, place = parent[at], place + 1
    start = np.concatenate([bias, np.log([n for n, _ in heap])]).astype(np.float32)
    return Vocabulary(keys[order], order.astype(np.int32), counts, kind[:leaves].astype(np.int32), first, depth, node, sign, start, len(bias))


@dataclass
class Window:
    """Rows of ``table``: a vector and a bias for each inner node and class, then a vector for each leaf and one for a text's edges, a scale for each place and the hidden bias."""

    vocab: Vocabulary
    table: np.ndarray

    @classmethod
    def fresh(cls, vocab: Vocabulary, seed: int = 2) -> Window:
        g, out, leaves = np.random.default_rng(seed), len(vocab.start), len(vocab.counts)
        table = np.zeros((out + leaves + 1 + 2 * WINDOW + 1, HIDDEN + 1), np.float32)
        table[:out, HIDDEN] = vocab.start
        table[out : out + leaves + 1, :HIDDEN] = g.standard_normal((leaves + 1, HIDDEN)) * 0.3
        table[out + leaves + 1 : -1, :HIDDEN] = 1 + 0.3 * g.standard_normal((2 * WINDOW, HIDDEN))
        return cls(vocab, table)

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        near = [self.table.take(len(self.vocab.start) + a, axis=0)[:, :HIDDEN] for a in around]
        z = near[0] * self.table[-1 - 2 * WINDOW, :HIDDEN]
        for k in range(1, 2 * WINDOW):
            z += near[k] * self.table[-1 - 2 * WINDOW + k, :HIDDEN]
        z += self.table[-1, :HIDDEN]
        return np.tanh(z, out=z), near

    def classes(self, h: np.ndarray) -> np.ndarray:
        """Log-probabilities of the classes."""
        v = self.vocab
        z = h @ self.table[v.inner : len(v.start), :HIDDEN].T + self.table[v.inner : len(v.start), HIDDEN]
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return z

    def ways(self, h: np.ndarray, target: np.ndarray):
        """The turns on the ways to the targets, which go by falling depth, one from each way at a time: the nodes, their vectors, the turns and the logits of these; they are the first targets'."""
        depth, first = self.vocab.depth[target], self.vocab.first[target]
        for step in range(int(depth[0]) if len(depth) else 0):
            at = first[: np.searchsorted(-depth, -step)] + step
            node = self.vocab.node[at]
            vec = self.table.take(node, axis=0)
            yield node, vec[:, :HIDDEN], self.vocab.turn[at], np.einsum("ij,ij->i", h[: len(at)], vec[:, :HIDDEN]) + vec[:, HIDDEN]

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target leaf, given the leaves around it (2 * WINDOW rows)."""
        if not len(target):
            return np.zeros(0)
        deep = np.argsort(-self.vocab.depth[target], kind="stable")
        target = target[deep]
        h, _ = self.hidden(around[:, deep])
        found = self.classes(h)[np.arange(len(target)), self.vocab.kind[target]]
        for _, _, turn, x in self.ways(h, target):
            np.negative(x, out=x, where=turn > 0)
            found[: len(x)] -= np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))
        out = np.empty(len(target))
        out[deep] = found
        return out

    def learn(self, around: np.ndarray, target: np.ndarray, squares: np.ndarray, touched: np.ndarray, rate: float) -> None:
        """One step of Adagrad, by rows: squares and how often a row was touched are added up in place."""
        v, last = self.vocab, len(self.table) - 1
        out, places = len(v.start), last - 2 * WINDOW
        deep = np.argsort(-v.depth[target], kind="stable")
        target = target[deep]
        around = around[:, deep]
        h, near = self.hidden(around)
        dense = h @ self.table[v.inner : out, :HIDDEN].T + self.table[v.inner : out, HIDDEN]
        dense -= dense.max(1, keepdims=True)
        np.exp(dense, out=dense)
        dense /= dense.sum(1, keepdims=True)
        dense[np.arange(len(target)), v.kind[target]] -= 1
        dh = dense @ self.table[v.inner : out, :HIDDEN]
        nodes, fars = [], []
        for node, vec, turn, x in self.ways(h, target):
            far = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - turn
            dh[: len(x)] += far[:, None] * vec
            nodes.append(node)
            fars.append(far)
        dz = dh * (1 - h * h)
        rows, times, step = [], [], []
        if nodes:
            own, far = np.concatenate([np.arange(len(n)) for n in nodes]), np.concatenate(fars)
            row, order, start = _grouped(np.concatenate(nodes))
            far = far[order]
            rows.append(row)
            times.append(np.diff(start, append=len(order)))
            step.append(np.concatenate([np.add.reduceat(h.take(own[order], axis=0) * far[:, None], start), np.add.reduceat(far, start)[:, None]], 1))
        row, order, start = _grouped(np.concatenate(list(around)))
        rows.append(out + row)
        times.append(np.diff(start, append=len(order)))
        moved = np.concatenate([dz * self.table[places + k, :HIDDEN] for k in range(2 * WINDOW)])
        step.append(_wide(np.add.reduceat(moved.take(order, axis=0), start)))
        # all classes, the scales and the hidden bias are in every target
        rows = np.concatenate([*rows, np.arange(v.inner, out), np.arange(places, last + 1)])
        times = np.concatenate([*times, np.full(out - v.inner + 2 * WINDOW + 1, len(target))])
        step.append(np.concatenate([dense.T @ h, dense.sum(0)[:, None]], 1))
        step.append(_wide(np.stack([np.einsum("ij,ij->j", dz, e) for e in near] + [dz.sum(0)])))
        # the mean over its occurrences, so that a frequent row's step is not larger
        step = np.concatenate(step)
        step /= times.astype(np.float32)[:, None]
        total = squares[rows] + np.einsum("ij,ij->i", step, step) / step.shape[1]
        squares[rows] = total
        touched[rows] += times
        step *= (rate / np.sqrt(total + 1e-8)).astype(np.float32)[:, None]
        self.table[rows] -= step


def _grouped(index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct numbers, the places that hold them, in their order, where each number's places start); ``index`` has 32-bit numbers."""
    # number and place in one key
    both = np.sort((index.astype(np.int64) << 32) | np.arange(len(index)))
    index = both >> 32
    start = np.flatnonzero(np.diff(index, prepend=-1))
    return index[start], both & 0xFFFFFFFF, start


def _wide(v: np.ndarray) -> np.ndarray:
    return np.concatenate([v, np.zeros((len(v), 1), v.dtype)], 1)


def windows(leaf: np.ndarray, at: np.ndarray, edge: int) -> np.ndarray:
    """(2 * WINDOW, words): leaves of the neighbours of each word; ``edge`` beyond a text's ends."""
    n = len(leaf)
    first, end = np.repeat(at[:-1], np.diff(at)), np.repeat(at[1:], np.diff(at))
    here = np.arange(n)
    out = np.empty((2 * WINDOW, n), np.int64)
    for k, d in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
        j = here + d
        out[k] = np.where((j >= first) & (j < end), leaf[np.clip(j, 0, max(0, n - 1))], edge)
    return out


def _counted(batches):
    """Per task: hash of a word and its occurrences."""
    keys, total = np.zeros(0, U64), np.zeros(0, np.int64)

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(total)], names=["h", "n"])

    held, size = [], 0
    for batch in batches:
        data, offs = utf8(batch.column(0))
        for a, b in steps(offs):
            token, *_ = words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            held.append(np.unique(token, return_counts=True))
            size += len(held[-1][0])
            if size > 2_000_000:  # bounded memory: a task may send a word more than once
                keys, total = _summed(held)
                held, size = [(keys, total)], len(keys)
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
    if held:
        keys, total = _summed(held)
        yield flush()


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _encoded(vocab: Vocabulary):
    """Rows (doc_id, text) to (doc_id, leaves of its words, hashes of those that are not known)."""

    def run(batches):
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for a, b in steps(offs):
                token, at, _ = words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                leaf = vocab.leaves(token)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(leaf))
                far = leaf >= len(vocab.keys)
                rare = list_array([token[x:y][far[x:y]] for x, y in zip(at[:-1], at[1:], strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, rare], names=["doc_id", "leaves", "rare"])

    return run


def _trained(net: Window, rate: float, turn: int, stride: int):
    """Over rows (shard, hash of the document's words, leaves), sorted: the rows of the table that a shard has touched, in chunks."""
    edge = len(net.vocab.counts)

    def targets(order: np.ndarray, leaf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Columns: the targets of a round, each after the leaves around it."""
        near = np.concatenate([windows(leaf, at, edge), leaf[None]]).astype(np.int32)
        if stride == 1:
            return near
        # a document's first target follows from its words, so that short ones have targets too
        own = np.repeat(np.arange(len(order)), np.diff(at))
        return near[:, (np.arange(len(leaf)) - at[:-1][own]) % stride == ((order + turn) % stride)[own]]

    def run(batches):
        shard, held, size = None, [], 0
        own = squares = touched = None

        def fit(last: bool):
            """Steps of BATCH targets: they follow from the documents, not from the batches they come in."""
            seen = np.concatenate(held, 1)
            whole = seen.shape[1] if last else seen.shape[1] // BATCH * BATCH
            for i in range(0, whole, BATCH):
                own.learn(seen[:-1, i : min(i + BATCH, whole)], seen[-1, i : min(i + BATCH, whole)], squares, touched, rate)
            return [seen[:, whole:]], seen.shape[1] - whole

        def done():
            if size:
                fit(True)
            hit = np.flatnonzero(touched)
            cuts = np.searchsorted(hit, np.arange(0, len(touched) + CHUNK, CHUNK))
            parts = [hit[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([int(p[0]) // CHUNK for p in parts], pa.int32()),
                    pa.array([shard] * len(parts), pa.int64()),
                    pa.array([p.astype(np.int32).tobytes() for p in parts], pa.binary()),
                    pa.array([touched[p].tobytes() for p in parts], pa.binary()),
                    pa.array([own.table[p].tobytes() for p in parts], pa.binary()),
                ],
                names=["chunk", "shard", "rows", "times", "vectors"],
            )

        for batch in batches:
            shards, order, column = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            offs, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)] if len(shards) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if shards[lo] != shard:
                    if shard is not None:
                        yield done()
                    shard, held, size = int(shards[lo]), [], 0
                    own, squares, touched = Window(net.vocab, net.table.copy()), np.zeros(len(net.table)), np.zeros(len(net.table))
                for a, b in steps(offs[lo : hi + 1], 1 << 18):
                    a, b = a + lo, b + lo
                    held.append(targets(order[a:b], flat[offs[a] : offs[b]], offs[a : b + 1] - offs[a]))
                    size += held[-1].shape[1]
                    if size >= BATCH:
                        held, size = fit(False)
        if shard is not None:
            yield done()

    return run


def _averaged(width: int):
    """Over rows of whole chunks, sorted: the mean of each row, by how often it was touched."""

    def run(batches):
        chunk, times, total = None, None, None

        def done():
            hit = np.flatnonzero(times)
            mean = (total[hit] / times[hit, None]).astype(np.float32)
            return pa.RecordBatch.from_arrays([pa.array([(chunk * CHUNK + hit).astype(np.int32).tobytes()], pa.binary()), pa.array([mean.tobytes()], pa.binary())], names=["rows", "vectors"])

        for batch in batches:
            for c, _, rows, n, vec in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c != chunk:
                    if chunk is not None:
                        yield done()
                    chunk, times, total = c, np.zeros(CHUNK), np.zeros((CHUNK, width))
                at, n = np.frombuffer(rows, np.int32) - c * CHUNK, np.frombuffer(n)
                times[at] += n
                total[at] += np.frombuffer(vec, np.float32).reshape(-1, width) * n[:, None]
        if chunk is not None:
            yield done()

    return run


def _scored(net: Window):
    edge = len(net.vocab.counts)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            offs, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
            total = np.zeros(len(column))
            for a, b in steps(offs, 1 << 18):
                leaf, at = flat[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                around = windows(leaf, at, edge)
                value = np.concatenate([net.log_probability(around[:, i : i + BATCH], leaf[i : i + BATCH]) for i in range(0, len(leaf), BATCH)] or [np.zeros(0)])
                total[a:b] = np.bincount(np.repeat(np.arange(b - a), np.diff(at)), value, b - a)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs)), pa.array(total)], names=["row", "n_words", "total"])

    return run


@dataclass
class Model:
    """counts: (h, n) of every word of the corpus; net: the trained network; rows: the corpus, encoded."""

    counts: DataFrame
    net: Window
    rows: DataFrame


def encoded(docs: DataFrame, vocab: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, leaves, rare), written: ``row`` numbers the rows."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(_encoded(vocab), "doc_id long, leaves array<int>, rare array<long>")
    return materialize(out.select(F.monotonically_increasing_id().alias("row"), "*"), "encoded")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE, stride: int = STRIDE, known: int = KNOWN) -> Model:
    """Counts and network from every document; texts that are null or without words add nothing.

    The driver receives the ``known`` most frequent words, REST sums and the averaged parameters: sizes
    that are fixed whatever the corpus. Each round's targets are all words or, where ``stride`` is more
    than 1, every ``stride``-th word of all documents, from another word on; all words are context.
    """
    src = docs.select(F.col(text_col).alias("text"))
    counts = materialize(src.mapInArrow(_counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "counts")
    top = counts.orderBy(F.desc("n"), "h").limit(known)
    got = top.toArrow()
    keys, own = got["h"].to_numpy().view(U64), got["n"].to_numpy()
    # the last of the known words divides the table
    last = (int(own[-1]), int(got["h"][-1].as_py())) if len(own) else (0, 0)
    others = counts.where((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("h") > last[1]))) if len(own) else counts
    part = F.pmod("h", F.lit(REST))
    rest = np.zeros(REST, np.int64)
    for r in others.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect():  # REST rows
        rest[r.part] = r.n
    net = Window.fresh(vocabulary(keys, own, rest))
    total = int(own.sum() + rest.sum())
    corpus = encoded(docs, net.vocab, id_col, text_col)
    if total and rounds:
        shards = -(-total // SHARD)
        rows = corpus.where(F.size("leaves") > 0).select(F.xxhash64("leaves").alias("order"), "leaves")
        for turn in range(rounds):
            some = rows.select(F.pmod("order", F.lit(shards)).alias("shard"), "order", "leaves").repartition(int(shards), "shard")
            some = some.sortWithinPartitions("shard", "order", "leaves")
            found = some.mapInArrow(_trained(net, rate, turn, stride), "chunk int, shard long, rows binary, times binary, vectors binary")
            found = found.repartition("chunk").sortWithinPartitions("chunk", "shard").mapInArrow(_averaged(HIDDEN + 1), "rows binary, vectors binary")
            table = net.table.copy()
            for r in found.collect():  # the parameters: a fixed size
                table[np.frombuffer(r.rows, np.int32)] = np.frombuffer(r.vectors, np.float32).reshape(-1, HIDDEN + 1)
            net = Window(net.vocab, table)
    return Model(counts, net, corpus)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, pseudo_log_likelihood (the sum), mean_log_probability.

    Null and empty texts have no words, a sum of 0 and a null mean. Rows that repeat or have no id are
    scored by themselves. An empty table gives no rows. Words that the model's corpus lacks count as if
    they stood there once. Extra columns, whatever their names, play no part.
    """
    return _of_rows(encoded(docs, model.net.vocab, id_col, text_col), model)


def corpus_scored(model: Model) -> DataFrame:
    """As ``scored``, of the documents that the model was trained on."""
    return _of_rows(model.rows, model)


def _of_rows(rows: DataFrame, model: Model) -> DataFrame:
    net = rows.select("row", "leaves").mapInArrow(_scored(model.net), "row long, n_words long, total double")
    net = materialize(net, "network")
    # words without a leaf of their own: their share of the leaf, from the table of all counts
    rare = rows.where(F.size("rare") > 0).select("row", F.explode("rare").alias("h")).groupBy("row", "h").agg(F.count("*").alias("times"))
    leaf = F.log(F.element_at(F.array(*[F.lit(float(n)) for n in model.net.vocab.counts[-REST:]]), F.pmod("h", F.lit(REST)).cast("int") + 1))
    share = rare.join(model.counts, "h", "left").select("row", (F.col("times") * (F.log(F.coalesce("n", F.lit(1)).cast("double")) - leaf)).alias("part"))
    share = share.groupBy("row").agg(F.sum("part").alias("part"))
    out = rows.select("row", "doc_id").join(net, "row").join(share, "row", "left")
    total = (F.col("total") + F.coalesce("part", F.lit(0.0))).alias("pseudo_log_likelihood")
    out = out.select("doc_id", "n_words", total)
    return out.withColumn("mean_log_probability", F.when(F.col("n_words") > 0, F.col("pseudo_log_likelihood") / F.col("n_words")))
