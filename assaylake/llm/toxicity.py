"""Toxicity with convolutional text classifiers, trained in numpy inside Spark tasks.

A word's vector is the sum of hashed embeddings: of the whole word, and of its first bytes, which lets rare
forms of one stem share what is learned. Filters of several widths run over the words of the whole text, each
keeps its largest value, and a logistic layer turns these into a score. Gradients reach only the
places of those largest values, so training costs little more than the forward pass.

All labelled rows teach. A hash of the id deals them into two folds; each fold trains a network of its own, and
a score is taken from the mean of both logits. Labelled rows are written once, in shards of about
``SHARD_BYTES`` of text, as the features that all epochs read. In each epoch every shard continues from the networks of the epoch before, in one task,
and what the shards of a fold have learned is averaged; a row of the embedding only over the shards that moved it.
Every labelled row also sets the cuts: the network of the other fold scores it. The logits of each network are
shifted so that 0.5 is its best cut over all rows of the other fold, and a threshold for each language is
chosen over all rows, for those who want to use it beside the score. Scores read the text only.

Defined cases: a NULL or empty text has the score of a text without words. Labels of one id are averaged; NULL
labels and evenly divided ones teach nothing. Without labels of both kinds every score is 0 (or 1, if all
labels say so). If a fold lacks one kind, one network is trained and cut on all rows. Repeated rows get one score
each; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from assaylake.llm import arrays
from assaylake.llm.decontamination import WORD_BYTE
from assaylake.llm.names import unused
from assaylake.plans.scratch import new_folder

BUCKETS = 1 << 16
DEPTH = 8
WIDTHS = (1, 3, 8, 24)
FILTERS = 8
STEMS = (4, 5, 6, 8)
BATCH = 32
SHARD_BYTES = 8 << 20

_BLOCK = 8  # words whose windows are multiplied at once
_GAP = max(WIDTHS)
_AT_ONCE = 400  # gaps; a run's outputs stay in the processor's cache
_ALL = FILTERS * len(WIDTHS)
_SHAPES = [*((w, DEPTH, FILTERS) for w in WIDTHS), (_ALL,), (_ALL,), (1,)]
_PIECE = 1 << 19
_SHARDS_PER_TASK = 3
_BLOCKS = 16  # parts in which embeddings travel to be averaged
_BINS = 64
_LOWER, _IN_WORD = arrays.LOWER.tobytes(), WORD_BYTE.tobytes()


@dataclass
class Net:
    embedding: np.ndarray
    dense: np.ndarray  # filters of each width, their biases, the output layer and its bias
    # state of the optimizers, absent when training is over: squares of Adagrad, both moments and the steps of Adam
    squares: np.ndarray | None = None
    mean: np.ndarray | None = None
    square: np.ndarray | None = None
    step: float = 0


@dataclass
class Model:
    nets: list[Net]
    always: float = 0.0  # the logit of all texts where there are no networks
    thresholds: dict[str, float] = field(default_factory=dict)


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of each distinct word (the word and its stems), the distinct word of each word, and
    the number of each text's first word."""
    low = np.frombuffer(buf.tobytes().translate(_LOWER), np.uint8)
    starts, ends, first = arrays.runs(np.frombuffer(low.tobytes().translate(_IN_WORD), bool), offsets)
    found = pa.array(arrays.span_hashes(low, starts, ends)).dictionary_encode()
    whole, words = found.dictionary.to_numpy(), found.indices.to_numpy()
    order = np.argsort(whole)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    whole, words = whole[order], rank.take(words)
    at = np.empty(len(whole), np.int64)
    at[words[::-1]] = np.arange(len(words))[::-1]
    starts, ends = starts[at], ends[at]
    hashes = [whole]
    hashes += [arrays.mix(arrays.span_hashes(low, starts, np.minimum(ends, starts + n)) + np.uint64(n)) for n in STEMS]
    return (np.stack(hashes) % np.uint64(BUCKETS)).astype(np.uint16).T, words, first


def _views(dense: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    out, at = [], 0
    for shape in _SHAPES:
        out.append(dense[at : at + int(np.prod(shape))].reshape(shape))
        at += out[-1].size
    return out[: len(WIDTHS)], *out[len(WIDTHS) :]


def _vectors(embedding: np.ndarray, forms: np.ndarray) -> np.ndarray:
    """Vectors of all forms, and a last one of zeros."""
    out = np.zeros((len(forms) + 1, DEPTH), np.float32)
    for column in forms.T:
        out[:-1] += embedding.take(column, axis=0)
    return out


def _laid(words: np.ndarray, first: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with ``blank`` after each text, where each text starts, and for each text its first block and the end of
    its blocks. Their windows start at a word or see none, and one of them sees none."""
    counts = np.diff(first)
    at = np.concatenate([[0], np.cumsum(counts + _GAP)])
    spots = np.full(-(-(at[-1] + 1) // _GAP) * _GAP + _GAP, blank, np.int32)
    spots[arrays.ragged(at[:-1], counts)] = words
    return spots, at[:-1], np.stack([at[:-1] // _BLOCK, (at[:-1] + counts) // _BLOCK + 1], axis=1)


def _bands(filters: list[np.ndarray]) -> list[np.ndarray]:
    """For each width a matrix that takes the words which windows of one block see to (place in block, filter)."""
    bands = []
    for w, weights in zip(WIDTHS, filters, strict=True):
        band = np.zeros((_BLOCK, FILTERS, _BLOCK + w - 1, DEPTH), np.float32)
        for p in range(_BLOCK):
            band[p, :, p : p + w] = weights.transpose(2, 0, 1)
        bands.append(band.reshape(_BLOCK * FILTERS, -1))
    return bands


def _convolve(x: np.ndarray, filters: list[np.ndarray], at: np.ndarray, most: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Outputs by (place in block, filter, block) for runs of blocks; the least for windows that start before a text and
    see its words. A window's products are added up to the next multiple of its ``turn``, and then beyond it."""
    bands = _bands(filters)
    for a in range(0, len(x) // _GAP - 1, most):
        b = min(a + most, len(x) // _GAP - 1)
        run = slice(a * _GAP // _BLOCK, b * _GAP // _BLOCK)
        outs = np.empty((_BLOCK, _ALL, run.stop - run.start), np.float32)
        for k, (w, band) in enumerate(zip(WIDTHS, bands, strict=True)):
            turn = _GAP if w == _GAP else _BLOCK
            rows = x[a * _GAP : b * _GAP + turn].reshape(-1, turn * DEPTH)
            for c in range(turn // _BLOCK):
                cut = (turn - c * _BLOCK) * DEPTH
                out = band[:, :cut] @ rows[:-1, c * _BLOCK * DEPTH :].T
                if band.shape[1] > cut:
                    out += band[:, cut:] @ rows[1:, : band.shape[1] - cut].T
                outs[:, k * FILTERS : (k + 1) * FILTERS, c :: turn // _BLOCK] = out.reshape(_BLOCK, FILTERS, -1)
            early = (at[1:, None] - np.arange(w - 1, 0, -1)).ravel()
            early = early[slice(*np.searchsorted(early, (a * _GAP, b * _GAP)))] - a * _GAP
            outs[early % _BLOCK, k * FILTERS : (k + 1) * FILTERS, early // _BLOCK] = -np.inf
        yield run, outs


def logits(net: Net, forms: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _logits([net], forms, words, first)[0]


def _logits(nets: list[Net], forms: np.ndarray, words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    if len(first) == 1:
        return [np.zeros(0) for _ in nets]
    spots, at, blocks = _laid(words, first, len(forms))
    found = []
    for net in nets:
        filters, biases, output, bias = _views(net.dense)
        best = np.empty((_ALL, (len(spots) - _GAP) // _BLOCK), np.float32)
        for run, outs in _convolve(_vectors(net.embedding, forms).take(spots, axis=0), filters, at, _AT_ONCE):
            outs.max(axis=0, out=best[:, run])
        top = np.ascontiguousarray(np.maximum.reduceat(best, blocks.ravel(), axis=1)[:, ::2].T) + biases
        found.append((np.maximum(top, 0) @ output + bias[0]).astype(np.float64))
    return found


def _new_net(seed: int) -> Net:
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DEPTH)).astype(np.float32)
    dense = np.zeros(sum(int(np.prod(s)) for s in _SHAPES), np.float32)
    filters, _, output, _ = _views(dense)
    for w, weights in zip(WIDTHS, filters, strict=True):
        weights[:] = rng.normal(0, 0.6 / np.sqrt(w), (1, DEPTH, FILTERS))
    output[:] = rng.normal(0, 0.1, _ALL)
    return Net(embedding, dense, np.full(BUCKETS, 1e-3, np.float32), np.zeros_like(dense), np.zeros_like(dense))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of each key."""
    if not len(keys):
        return keys, values
    if keys.max() < 1 << 16:
        keys = keys.astype(np.uint16)  # sorted by digits
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(values.take(order, axis=0), starts, axis=0)


def _learn(net: Net, forms: np.ndarray, words: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
    """One step of ``net`` on one batch of texts."""
    filters, biases, output, bias = _views(net.dense)
    local = np.zeros(len(forms), np.int32)
    local[words] = 1
    used = np.flatnonzero(local)
    local[used] = np.arange(len(used))
    forms = forms.T.take(used, axis=1).T
    spots, at, blocks = _laid(local.take(words), first, len(used))
    x = _vectors(net.embedding, forms).take(spots, axis=0)
    ((_, outs),) = _convolve(x, filters, at, len(spots))
    # the first of the largest outputs, by its block and its place in it
    best = outs.max(axis=0)
    block = np.stack([a + best[:, a:b].argmax(axis=1) for a, b in blocks])
    place = outs[:, np.arange(_ALL), block].argmax(axis=0)
    where = block * _BLOCK + place
    top = best[np.arange(_ALL), block] + biases
    hidden = np.maximum(top, 0)
    score = 1 / (1 + np.exp(-np.clip(hidden @ output + bias[0], -30, 30)))
    error = ((score - labels) * weight / len(labels)).astype(np.float32)
    back = error[:, None] * output * (top > 0)
    gradient = np.zeros_like(net.dense)
    d_filters, d_biases, d_output, d_bias = _views(gradient)
    d_biases += back.sum(axis=0)
    d_output += hidden.T @ error + 1e-4 * output
    d_bias += error.sum()
    hit, pushes = [], []
    for k, w in enumerate(WIDTHS):
        t, f = np.nonzero(back[:, k * FILTERS : (k + 1) * FILTERS])
        g = back[t, k * FILTERS + f]
        window = where[t, k * FILTERS + f][:, None] + np.arange(w)
        chosen = np.zeros((FILTERS, len(g)), np.float32)
        chosen[f, np.arange(len(g))] = g
        d_filters[k] += (chosen @ x.take(window, axis=0).reshape(len(g), w * DEPTH)).reshape(FILTERS, w, DEPTH).transpose(1, 2, 0)
        hit.append(spots.take(window.ravel()))
        pushes.append((g[:, None] * filters[k].transpose(2, 0, 1).reshape(FILTERS, -1).take(f, axis=0)).reshape(-1, DEPTH))
    hit, pushes = np.concatenate(hit), np.concatenate(pushes)
    hit, pushes = _summed(hit[hit < len(used)], pushes[hit < len(used)])
    # Adam for what all texts share, Adagrad for the words that gradients reached
    net.step += 1
    net.mean += 0.1 * (gradient - net.mean)
    net.square += 0.001 * (gradient * gradient - net.square)
    net.dense -= 0.01 * (net.mean / (1 - 0.9**net.step)) / (np.sqrt(net.square / (1 - 0.999**net.step)) + 1e-8)
    rows, total = _summed(forms.take(hit, axis=0).ravel(), np.repeat(pushes, forms.shape[1], axis=0))
    net.squares[rows] += (total * total).mean(axis=1)
    net.embedding[rows] = net.embedding.take(rows, axis=0) - 0.05 * total / np.sqrt(net.squares[rows])[:, None]


class _Sum:
    """What the shards of one fold have learned in an epoch."""

    def __init__(self) -> None:
        self.rows, self.moved = 0, np.zeros((BUCKETS, DEPTH + 2))
        self.shared = np.zeros(0)

    def add(self, before: Net, after: Net, rows: int) -> None:
        touched = after.squares != before.squares
        self.rows += rows
        self.moved[:, :DEPTH] += after.embedding - before.embedding
        self.moved[:, DEPTH] += after.squares - before.squares
        self.moved[:, DEPTH + 1] += touched
        shared = rows * np.concatenate([after.dense, after.mean, after.square, [after.step]]).astype(np.float64)
        self.shared = self.shared + shared if len(self.shared) else shared

    def parts(self) -> list[bytes]:
        return [*(p.astype(np.float32).tobytes() for p in np.split(self.moved, _BLOCKS)), (np.append(self.shared, self.rows)).astype(np.float32).tobytes()]


_RUN = "fold int, shard int, y binary, langs array<string>, forms binary, words binary, counts binary"
_PART = "fold int, part int, shard int, content binary"


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled rows in order of their shards as runs of texts, none over two shards, with the features in place of the
    texts, so that all epochs share them."""
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        for part in np.split(np.arange(len(shards)), np.flatnonzero(shards[1:] != shards[:-1]) + 1) if len(shards) else []:
            for rows, buf, offsets in arrays.pieces(batch.slice(part[0], len(part)), "text", _PIECE):
                forms, words, first = features(buf, offsets)
                yield pa.RecordBatch.from_pydict({
                    "fold": rows.column("fold").slice(0, 1), "shard": rows.column("shard").slice(0, 1),
                    "y": pa.array([rows.column("y").to_numpy().astype(np.uint8).tobytes()], pa.binary()),
                    "langs": pa.array([rows.column("lang").to_pylist()], pa.list_(pa.string())),
                    "forms": pa.array([forms.T.tobytes()], pa.binary()),
                    "words": pa.array([words.astype(_number(len(forms))).tobytes()], pa.binary()),
                    "counts": pa.array([np.diff(first).tobytes()], pa.binary()),
                })


def _number(below: int) -> type:
    return np.uint16 if below <= 1 << 16 else np.uint32


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, tuple]]:
    """For each run its fold, its row, its labels and its features."""
    for batch in batches:
        for i in range(batch.num_rows):
            read = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: B023, E731
            forms = read("forms", np.uint16).reshape(1 + len(STEMS), -1).T
            first = np.concatenate([[0], np.cumsum(read("counts", np.int64))])
            yield batch.column("fold")[i].as_py(), batch.slice(i, 1), read("y", np.uint8).astype(np.int32), (forms, read("words", _number(len(forms))), first)


def _epoch(shared, weights: list[float], seed: int):
    """Trains on whole shards, each from the shared networks on, and sends one sum for each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nets, sums = shared.value, {}
        now, fold, rows, net, rng, lowest = None, 0, 0, None, None, {}

        def close() -> None:
            if now is not None:
                sums.setdefault(fold, _Sum()).add(nets[fold], net, rows)

        for of_fold, row, y, (forms, words, first) in _runs(batches):
            number = row.column("shard")[0].as_py()
            if number != now:
                close()
                now, fold, rows, rng = number, of_fold, 0, np.random.default_rng([seed, number])
                net = replace(nets[fold], **{k: getattr(nets[fold], k).copy() for k in ("embedding", "dense", "squares", "mean", "square")})
                lowest[fold] = min(now, lowest.get(fold, now))
            order = rng.permutation(len(y))
            for texts in np.split(order, range(BATCH, len(order), BATCH)):
                counts = np.diff(first)[texts]
                of = words[arrays.ragged(first[:-1][texts], counts)]
                _learn(net, forms, of, np.concatenate([[0], np.cumsum(counts)]), y[texts], np.where(y[texts] == 1, weights[fold], 1.0))
            rows += len(y)
        close()
        for fold, total in sums.items():
            for number, content in enumerate(total.parts()):
                yield pa.RecordBatch.from_pydict({"fold": pa.array([fold], pa.int32()), "part": pa.array([number], pa.int32()), "shard": pa.array([lowest[fold]], pa.int32()), "content": pa.array([content], pa.binary())})

    return run


def _added(table: pa.Table) -> pa.Table:
    table = table.sort_by("shard")
    total = sum(np.frombuffer(c.as_py(), np.float32).astype(np.float64) for c in table.column("content"))
    return table.slice(0, 1).set_column(3, "content", pa.array([total.astype(np.float32).tobytes()], pa.binary()))


def _averaged(net: Net, parts: dict[int, bytes]) -> Net:
    read = lambda n: np.frombuffer(parts[n], np.float32)
    moved = np.concatenate([read(n).reshape(-1, DEPTH + 2) for n in range(_BLOCKS)])
    shards = np.maximum(moved[:, DEPTH + 1], 1)
    shared = read(_BLOCKS)
    dense, mean, square = np.split(shared[:-2] / shared[-1], 3)
    return Net(net.embedding + moved[:, :DEPTH] / shards[:, None], dense, net.squares + moved[:, DEPTH] / shards, mean, square, float(shared[-2] / shared[-1]))


def _best_cuts(rows: DataFrame) -> dict:
    """For each scope, the logit at or above which calling a text toxic gives the best F1 over all its rows; between
    neighbours, the middle. Scopes without labels of both kinds are left out. Running counts are taken in bins of
    similar size, so that no task sees all rows of a scope."""
    points = rows.groupBy("scope", "value").agg(F.count("*").alias("n"), F.sum("y").alias("hits"))
    whole = points.groupBy("scope").agg(
        F.percentile_approx("value", [i / _BINS for i in range(1, _BINS)]).alias("edges"), F.sum("hits").alias("all_hits"), F.sum("n").alias("all_n")
    )
    whole = whole.where("all_hits > 0 and all_hits < all_n").drop("all_n")
    binned = points.join(F.broadcast(whole), "scope").withColumn("bin", F.size(F.filter("edges", lambda e: e > F.col("value")))).drop("edges")
    totals = binned.groupBy("scope", "bin").agg(F.sum("n").alias("n_"), F.sum("hits").alias("hits_"))
    earlier = Window.partitionBy("scope").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("scope", "bin", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("n_", "hits_")))
    within = Window.partitionBy("scope", "bin").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    f1 = 2 * (F.col("hits_") + F.sum("hits").over(within)) / (F.col("n_") + F.sum("n").over(within) + F.col("all_hits"))
    running = binned.join(F.broadcast(before), ["scope", "bin"]).select("scope", "value", f1.alias("f1"))
    best = running.groupBy("scope").agg(F.max(F.struct("f1", "value"))["value"].alias("best"))
    best = {r["scope"]: r["best"] for r in best.collect()}
    if not best:
        return {}
    kept = rows.sparkSession.createDataFrame(list(best.items()), rows.select("scope", F.col("value").alias("best")).schema)
    below = points.join(F.broadcast(kept), "scope").where("value < best").groupBy("scope").agg(F.max("value").alias("value"))
    below = {r["scope"]: r["value"] for r in below.collect()}
    return {scope: (value + below[scope]) / 2 if scope in below else value - 1e-6 for scope, value in best.items()}


def _maybe_labelled(docs: DataFrame, votes: DataFrame, total: int) -> DataFrame:
    """``docs`` without most rows that have no label, so that their texts aren't shuffled. Labelled ids set bits, about
    eight for each, of at most 16 MB; a join decides afterwards."""
    bits = min(1 << 27, max(1 << 15, 1 << (8 * total - 1).bit_length()))
    bit = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(bits))
    word, place = (bit / (1 << 15)).cast("int"), F.pmod(bit, F.lit(1 << 15))
    marks = votes.groupBy(word.alias("word")).agg(F.bitmap_construct_agg(place).alias("marks"))
    byte = F.conv(F.hex(F.substring("marks", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1
    return docs.withColumn("word", word).join(F.broadcast(marks), "word").where(is_set).drop("word", "marks")


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
    epochs: int = 8,
    seed: int = 7,
    shard_bytes: int = SHARD_BYTES,
    scratch: str | None = None,
) -> Model:
    """Fit on all labelled rows of ``docs``."""
    spark, scratch = docs.sparkSession, scratch or new_folder(docs.sparkSession, "toxicity")
    votes = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
    votes = votes.agg(F.avg(F.col(label).cast("double")).alias("y")).where("y != 0.5").select("id", (F.col("y") > 0.5).cast("int").alias("y"))
    votes.write.parquet(f"{scratch}/votes")
    votes = spark.read.parquet(f"{scratch}/votes")
    docs = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"))
    fold = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(2)).cast("int")
    sizes = docs.select("id", F.octet_length("text").alias("bytes")).join(votes, "id").groupBy(fold.alias("fold"))
    sizes = {r["fold"]: r for r in sizes.agg(F.count("*").alias("n"), F.sum("y").alias("toxic"), F.sum("bytes").alias("bytes")).collect()}
    n, toxic = sum(r["n"] for r in sizes.values()), sum(r["toxic"] for r in sizes.values())
    if toxic in (0, n):
        return Model([], 30.0 if toxic else -30.0)
    crossed = len(sizes) == 2 and all(0 < r["toxic"] < r["n"] for r in sizes.values())
    if not crossed:
        fold, sizes = F.lit(0), {0: {"n": n, "toxic": toxic, "bytes": sum(r["bytes"] for r in sizes.values())}}
    shards = [max(1, -(-sizes[k]["bytes"] // shard_bytes)) for k in range(len(sizes))]
    of = F.pmod(F.xxhash64("id", "text", F.lit(4)), F.when(fold == 0, F.lit(shards[0])).otherwise(F.lit(shards[-1])))
    shard = (of + F.when(fold == 0, F.lit(0)).otherwise(F.lit(shards[0]))).cast("int")
    if docs.schema["id"].dataType == votes.schema["id"].dataType:  # else equal ids may have different hashes
        docs = _maybe_labelled(docs, votes, votes.count())
    rows = docs.join(votes, "id").select("id", "text", "lang", "y", fold.alias("fold"), shard.alias("shard"))
    dealt = rows.repartitionById(sum(shards), "shard").sortWithinPartitions("shard", F.xxhash64("id", F.lit(5)), "id", "text", "lang")
    dealt.drop("id").mapInArrow(_featured, _RUN).write.parquet(f"{scratch}/labelled")
    rows = spark.read.parquet(f"{scratch}/labelled")
    weights = [float(np.sqrt((sizes[k]["n"] - sizes[k]["toxic"]) / sizes[k]["toxic"])) for k in range(len(sizes))]
    nets = [_new_net(seed) for _ in sizes]
    # a task sends a sum of 2.6 MB however little it has learned from, so where shards are many it takes several
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(shards) // _SHARDS_PER_TASK))
    for number in range(epochs):
        shared = spark.sparkContext.broadcast(nets)
        parts = rows.drop("langs").coalesce(tasks).mapInArrow(_epoch(shared, weights, seed + 1000 * number), _PART)
        parts = parts.groupBy("fold", "part").applyInArrow(_added, _PART).collect()
        nets = [_averaged(net, {r["part"]: bytes(r["content"]) for r in parts if r["fold"] == k}) for k, net in enumerate(nets)]
        shared.unpersist()
    nets = [Net(net.embedding, net.dense) for net in nets]
    # the network of the other fold scores each row
    shared = spark.sparkContext.broadcast(nets)
    scored = rows.mapInArrow(_other_logits(shared), "y int, lang string, net int, value double")
    scored.write.parquet(f"{scratch}/scored")
    scored = spark.read.parquet(f"{scratch}/scored")
    cuts = _best_cuts(scored.withColumnRenamed("net", "scope"))
    for k, net in enumerate(nets):
        net.dense[-1] -= cuts[k]
    cut = F.when(F.col("net") == 0, F.lit(cuts[0])).otherwise(F.lit(cuts[len(nets) - 1]))
    by_lang = _best_cuts(scored.select(F.col("lang").alias("scope"), (F.col("value") - cut).alias("value"), "y"))
    return Model(nets, thresholds={name: float(1 / (1 + np.exp(-by_lang[name]))) for name in sorted(by_lang)})


def _other_logits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nets = shared.value
        for fold, row, y, found in _runs(batches):
            net = (fold + 1) % len(nets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), row.column("langs").flatten(), pa.array([net] * len(y), pa.int32()), pa.array(logits(nets[net], *found))],
                names=["y", "lang", "net", "value"],
            )

    return run


def _score(shared, text: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, buf, offsets in arrays.pieces(batch, text, _PIECE):
                value = np.full(rows.num_rows, model.always)
                if model.nets:
                    value = np.mean(_logits(model.nets, *features(buf, offsets)), axis=0)
                score = 1 / (1 + np.exp(-np.clip(value, -30, 30)))
                kept = [n for n in rows.schema.names if n != text]
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), pa.array(score)], names=[*kept, into])

    return run


def with_scores(docs: DataFrame, model: Model, *, text: str = "text", into: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` with a score from 0 to 1. A column of that name is replaced. The model is of fixed size."""
    spark = docs.sparkSession
    content, name = unused(docs, "_text", "_score")
    out = docs.withColumn(content, F.col(text).cast("string")).drop(into, *([] if keep_text else [text]))
    shape = T.StructType([f for f in out.schema if f.name != content]).add(name, T.DoubleType())
    shared = spark.sparkContext.broadcast(model)
    return out.mapInArrow(_score(shared, content, name), shape).withColumnRenamed(name, into)


def flagged(score, lang, model: Model):
    """Whether a score reaches the threshold of its language."""
    threshold = F.lit(0.5)
    for name, value in model.thresholds.items():
        threshold = F.when(F.coalesce(lang, F.lit("")) == name, F.lit(value)).otherwise(threshold)
    return score >= threshold
