"""Phrase collocation mining with counting quotient filters.

Texts are lower-cased (A-Z), split at ``[.,;:!?]`` and line ends into pieces, and those at spaces and tabs into words. For each
language, phrases of 2 to ``MOST_WORDS`` words that occur at least ``least`` times within pieces are candidates. A
candidate is cut in two at every place; a cut scores floor(2000000 * a / (l + r)) from the counts of the
phrase and of its parts, and the lowest-scoring cut (the first of equals) counts. Candidates are dropped that lie inside
a longer one with at least 80 % of their count.

1. Runs of texts (packs, about ``PACK_BYTES``) become numbers of a local list of words, so texts are split once. Words are
   counted over the lists. Each that is frequent enough in its language gets a number (a phrase can't be more
   frequent than its words); the numbers go back to the packs.
2. Each pack packs the numbers of its n-grams into keys and counts them in quotient filters, split into shards by the
   first bits of the permuted key. Filters of a shard are sorted and merged; keys that reach ``least`` are unpacked again.
   Shards follow the number of words, and keys are spread evenly whatever the words, so no shard grows.
3. What is frequent enough is little: cuts, containment and ranks are joins over it.

Counts are exact: words of a pack are compared byte by byte, keys are whole, and products are decimals.

Defined cases: a NULL or empty text has no words; a NULL language is ``und``. Repeated rows count each time. Equal scores and
counts are ordered by the phrase's UTF-8 bytes. An empty table gives no rows. Other columns are not read. A text longer
than a pack is a pack of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from assaylake.llm import arrays, quotient_filters as Q

MOST_WORDS = 4
PACK_BYTES = 8 << 20
SHARD_WORDS = 1 << 20
# A list of frequent words up to this size is broadcast (about 50 MB); a longer one is joined by a shuffle.
MOST_BROADCAST = 500_000

_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _ENDS_PIECE.copy()
_BETWEEN[[0x20, 0x09]] = True


def _same_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether each span has the bytes of the span with the number in ``other``."""
    load, length = arrays.lanes(buf), ends - starts
    if not np.array_equal(length, length[other]):
        return False
    todo, done = np.flatnonzero(other != np.arange(len(other))), 0
    while len(todo):
        a, b, left = load[starts[todo] + done], load[starts[other[todo]] + done], length[todo] - done
        if np.any((a ^ b) & arrays._MASKS[np.clip(left, 0, 8)]):
            return False
        todo, done = todo[left > 8], done + 8
    return True


def local_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A span for each distinct (group, bytes), the number of the distinct one for each span, and counts. The
    most frequent come first."""
    h = arrays.mix(arrays.span_hashes(buf, starts, ends) + group.astype(np.uint64))
    _, sample, which, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    if not (_same_bytes(buf, starts, ends, sample[which]) and np.array_equal(group, group[sample[which]])):
        seen: dict[tuple, int] = {}  # two words of one hash: by content
        content = ((g, buf[a:b].tobytes()) for g, a, b in zip(group.tolist(), starts, ends, strict=True))
        which = np.array([seen.setdefault(x, len(seen)) for x in content], np.int64)
        _, sample, count = np.unique(which, return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return sample[order], rank[which], count[order]


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each pack with their languages and counts, and all its words in order as numbers of that list, from 1 on;
    a 0 stands between pieces."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for rows, buf, offsets in arrays.pieces(batch, "text", PACK_BYTES):
            low = arrays.LOWER[buf]
            starts, ends, first = arrays.runs(~_BETWEEN[low], offsets)
            langs = rows.column("lang").dictionary_encode()
            group = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(first))
            sample, which, count = local_words(low, starts, ends, group)
            fresh = np.zeros(len(starts), bool)
            edges = np.concatenate([[0], np.cumsum(_ENDS_PIECE[low])])
            fresh[1:] = edges[starts[1:]] > edges[ends[:-1]]
            fresh[first[:-1][first[:-1] < len(fresh)]] = True
            tokens = np.zeros(len(starts) + int(fresh.sum()), "<i4")
            tokens[np.arange(len(starts)) + np.cumsum(fresh)] = which + 1
            size = ends[sample] - starts[sample]
            at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            words = pa.StringArray.from_buffers(len(sample), pa.py_buffer(at), pa.py_buffer(low[arrays.ragged(starts[sample], size)]))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(sample)], pa.int32()), x) for x in (langs.dictionary.take(pa.array(group[sample])), words, pa.array(count))]
            planes = zstandard.ZstdCompressor(level=1).compress(tokens.view(np.uint8).reshape(-1, 4).T.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([number]), *lists, pa.array([planes], pa.binary())], names=["pack", "langs", "words", "counts", "tokens"])
            number += 1


_PACK = "pack long, langs array<string>, words array<string>, counts array<long>, tokens binary"


def _filters(bits: int, shard_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("tokens")[i].as_py()), np.uint8)
                tokens = planes.reshape(4, -1).T.copy().view("<i4").ravel()
                known = batch.column("known")[i].values
                ids = np.full(int(tokens.max(initial=0)) + 1, -1, np.int64)
                ids[known.field("at").to_numpy() + 1] = known.field("id").to_numpy()
                words = ids[tokens]
                for n in range(2, MOST_WORDS + 1):
                    half, count = n * bits // 2, max(0, len(words) - n + 1)
                    whole = np.ones(count, bool)
                    for j in range(n):
                        whole &= words[j : j + count] >= 0
                    high, low = np.zeros(int(whole.sum()), np.uint64), np.zeros(int(whole.sum()), np.uint64)
                    for j in range(n):
                        word = words[j : j + count][whole].astype(np.uint64)
                        high, low = _shifted(high, low, bits, half)
                        low |= word
                    counter = Q.counted(*Q.permute(high, low, half), half)
                    rows = [(s, Q.dump(c, half, _shard_bits(shard_bits, half))) for s, c in Q.split(counter, half, _shard_bits(shard_bits, half))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * len(rows), pa.int32()), pa.array([s for s, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.binary())], names=["n", "shard", "data"]
                    )

    return run


def _shard_bits(wanted: int, half: int) -> int:
    return min(wanted, half)


def _shifted(high: np.ndarray, low: np.ndarray, bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A key of two halves moved up by ``bits``, which may be as many as a half has."""
    if bits == half:
        return low, np.zeros_like(low)
    mask = np.uint64((1 << half) - 1)
    return ((high << np.uint64(bits)) | (low >> np.uint64(half - bits))) & mask, (low << np.uint64(bits)) & mask


def _unpacked(high: np.ndarray, low: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The word numbers of each key, first word first."""
    half, out = n * bits // 2, np.empty((len(high), n), np.int64)
    for j in range(n - 1, -1, -1):
        out[:, j] = (low & np.uint64((1 << bits) - 1)).astype(np.int64)
        if bits == half:
            low, high = high, np.zeros_like(high)
        else:
            low = ((low >> np.uint64(bits)) | (high << np.uint64(half - bits))) & np.uint64((1 << half) - 1)
            high = high >> np.uint64(bits)
    return out


def _merged(bits: int, shard_bits: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        n, shard = table.column("n")[0].as_py(), table.column("shard")[0].as_py()
        half = n * bits // 2
        loaded = [Q.load(x.as_py(), half, _shard_bits(shard_bits, half), shard) for x in table.column("data")]
        merged = Q.merge(loaded, half)
        keep = merged.counts >= least
        ids = _unpacked(*Q.restore(merged.high[keep], merged.low[keep], half), bits, n)
        at = pa.array(np.arange(0, ids.size + 1, n), pa.int32())
        return pa.table({"ids": pa.ListArray.from_arrays(at, pa.array(ids.ravel())), "f": pa.array(merged.counts[keep])})

    return run


def _frequent_phrases(docs: DataFrame, scratch: str, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbers of frequent words (``lang``, ``word``, ``id``), phrases of up to ``MOST_WORDS`` words (``ids``, ``f``), and the words
    of each language (``lang``, ``n``)."""
    spark = docs.sparkSession
    read = lambda name: spark.read.parquet(f"{scratch}/{name}")
    docs.mapInArrow(_packs, _PACK).write.parquet(f"{scratch}/packs")
    packs = read("packs")
    entries = packs.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("e")).select("e.langs", "e.words", "e.counts")
    entries.groupBy(F.col("langs").alias("lang"), F.col("words").alias("word")).agg(F.sum("counts").alias("f")).write.parquet(f"{scratch}/words")
    totals = read("words").groupBy("lang").agg(F.sum("f").cast("long").alias("n"))
    place = F.monotonically_increasing_id()
    part, row = F.shiftright(place, 33), place.bitwiseAND((1 << 33) - 1)
    read("words").where(F.col("f") >= least).select("lang", "word", "f", part.alias("part"), row.alias("row")).write.parquet(f"{scratch}/frequent")
    frequent = read("frequent")
    size = frequent.agg(F.max("part"), F.max("row"), F.count("*"), F.sum("f")).first()
    parts, rows = (size[0] or 0) + 1, (size[1] or 0) + 1
    frequent = frequent.select("lang", "word", "f", (F.col("row") * parts + F.col("part")).alias("id"))
    bits = max(8, (parts * rows - 1).bit_length())
    bits += bits % 2  # all keys have two equal halves
    if bits > 32:
        raise ValueError("more than 2^32 frequent words")
    shard_bits = max(0, (size[3] or 0) // SHARD_WORDS).bit_length()

    numbers = frequent.select(F.col("lang").alias("langs"), F.col("word").alias("words"), "id")
    numbers = F.broadcast(numbers) if size[2] <= MOST_BROADCAST else numbers
    local = packs.select("pack", F.posexplode(F.arrays_zip("langs", "words")).alias("at", "e")).select("pack", "at", "e.langs", "e.words")
    known = local.join(numbers, ["langs", "words"]).groupBy("pack").agg(F.collect_list(F.struct("at", "id")).alias("known"))
    filters = packs.select("pack", "tokens").join(known, "pack").select("tokens", "known").mapInArrow(_filters(bits, shard_bits), "n int, shard long, data binary")
    merged = filters.groupBy("n", "shard").applyInArrow(_merged(bits, shard_bits, least), "ids array<long>, f long")
    merged.write.parquet(f"{scratch}/phrases")
    phrases = read("phrases").union(frequent.select(F.array("id"), "f"))
    return frequent.select("lang", "word", "id"), phrases, totals


def collocations(
    docs: DataFrame, *, scratch: str, text: str = "text", lang: str = "lang", least: int = 30, most: int = 2000, contained_percent: int = 80
) -> DataFrame:
    """The first ``most`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the
    parts of its lowest cut), ``n`` (words of the language) and ``score``. ``scratch`` is a shared folder."""
    if least < 1 or most < 1:
        raise ValueError("least and most must be positive")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    words, phrases, totals = _frequent_phrases(rows, scratch, least)
    candidates = phrases.where(F.size("ids") > 1)
    # the lowest cut
    k = F.col("k")
    cuts = candidates.select("ids", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k")).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), k).alias("left"), F.slice("ids", k + 1, F.size("ids") - k).alias("right")
    )
    part = lambda side, count: phrases.select(F.col("ids").alias(side), F.col("f").alias(count))
    cuts = cuts.join(part("left", "l"), "left").join(part("right", "r"), "right")
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div (CAST(l AS DECIMAL(20, 0)) + r)").cast("long")
    scored = cuts.groupBy("ids").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low"), F.first("a").alias("a"))
    # what a longer candidate holds
    inner = F.expr("flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))")
    held = candidates.where(F.size("ids") > 2).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("held"))
    whole = F.col("held").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * contained_percent
    scored = scored.join(held, "ids", "left").where(~F.coalesce(whole, F.lit(False)))
    scored.select("ids", "a", "low.l", "low.r", "low.score").write.parquet(f"{scratch}/scored")
    scored = spark.read.parquet(f"{scratch}/scored")
    spelled = scored.select("ids", F.posexplode("ids").alias("at", "id")).join(words, "id").groupBy("ids").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    spelled = scored.join(spelled, "ids")
    # ranks within parts of a language, then over the first of each part
    parts = max(1, int((scored.count() / most) ** 0.5))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("ids"), F.lit(parts))
    first = spelled.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.where(F.col("rank") <= most).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= most).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
