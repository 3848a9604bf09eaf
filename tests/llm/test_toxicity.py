"""All labelled rows teach and set the cuts, and scores depend on the text alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from assaylake.llm import toxicity

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, toxic int"


def _tables(spark, rows):
    """``rows``: texts with their languages and labels; ids are their numbers."""
    docs = spark.createDataFrame([(i, text, lang) for i, (text, lang, _) in enumerate(rows)], DOCS)
    return docs, spark.createDataFrame([(i, y) for i, (_, _, y) in enumerate(rows)], LABELS)


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def _texts(n: int, seed: int = 3) -> list[tuple[str, int]]:
    """Invented words; one of twenty bad ones in each third text."""
    random = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = [f"w{k}" for k in random.integers(0, 300, 12)]
        if i % 3 == 0:
            words[random.integers(0, 12)] = f"bad{'abcdefghijklmnopqrst'[random.integers(0, 20)]}"
        out.append((" ".join(words), int(i % 3 == 0)))
    return out


def test_every_labelled_row_sets_a_threshold(spark):
    """More rows than were ever sampled, two for each language: each language has its threshold only if both are used."""
    rows = [(f"{'vile' if y else 'kind'} word{n % 50}", f"l{n}", y) for n in range(4_200) for y in (0, 1)]
    model = toxicity.train(*_tables(spark, rows), epochs=1)
    assert len(model.thresholds) == 4_200


def test_rows_of_all_shards_teach(spark):
    """Many small shards learn as one does, and their sums do not depend on the run."""
    rows = [(text, "en", y) for text, y in _texts(1_500)]
    docs, labels = _tables(spark, rows)
    new, _ = _tables(spark, [(text, "en", y) for text, y in _texts(300, seed=4)])
    y = np.array([y for _, y in _texts(300, seed=4)])
    scores = []
    for size in (1 << 20, 20_000, 20_000):
        model = toxicity.train(docs, labels, shard_bytes=size)
        found = toxicity.with_scores(new, model).select("doc_id", "score").orderBy("doc_id").collect()
        scores.append(np.array([r["score"] for r in found]))
        assert (((scores[-1] >= 0.5) == y).mean()) > 0.9
    assert (scores[1] == scores[2]).all() and not (scores[0] == scores[1]).all()


def test_labelled_texts_become_features_once(spark, tmp_path):
    """Epochs read features, not texts: hashing words again in each was a quarter of their work."""
    made = _texts(1_500)
    toxicity.train(*_tables(spark, [(text, f"l{n % 3}", y) for n, (text, y) in enumerate(made)]), epochs=1, shard_bytes=20_000, scratch=str(tmp_path / "x"))
    runs = spark.read.parquet(str(tmp_path / "x" / "labelled"))
    assert "text" not in runs.columns
    runs = runs.collect()
    assert sum(len(r["y"]) for r in runs) == sum(len(r["langs"]) for r in runs) == 1_500
    assert sum(map(sum, (r["y"] for r in runs))) == sum(y for _, y in made)
    bags = []
    for r in runs:
        forms = np.frombuffer(r["forms"], np.uint16).reshape(1 + len(toxicity.STEMS), -1).T
        words = np.frombuffer(r["words"], np.uint16)
        bags += [forms[w].tobytes() for w in np.split(words, np.cumsum(np.frombuffer(r["counts"], np.int64))[:-1])]
    alone = [toxicity.features(*_bytes([text])) for text, _ in made]
    assert sorted(bags) == sorted(forms[words].tobytes() for forms, words, _ in alone)


def test_runs_keep_their_features_and_labels():
    """Texts without words, more than one shard in a batch, and more than 65,536 distinct words in a run."""
    texts = ["", "a b a", " ".join(f"w{i}" for i in range(70_000)), "c", "..", "a b"]
    rows = pa.RecordBatch.from_pydict({
        "text": texts, "lang": list("abcdef"), "y": pa.array([0, 1, 1, 0, 0, 1], pa.int32()),
        "fold": pa.array([0, 0, 0, 1, 1, 1], pa.int32()), "shard": pa.array([4, 4, 4, 7, 7, 7], pa.int32()),
    })
    found = []
    for fold, row, y, (forms, words, first) in toxicity._runs(toxicity._featured(iter([rows]))):
        for n, lang in enumerate(row.column("langs")[0].as_py()):
            found.append((lang, fold, row.column("shard")[0].as_py(), int(y[n]), forms[words[first[n] : first[n + 1]]].tolist()))
    plain = lambda text: (lambda forms, words, _: forms[words].tolist())(*toxicity.features(*_bytes([text])))
    assert found == [(lang, fold, 4 + 3 * fold, y, plain(text)) for text, lang, y, fold in zip(texts, "abcdef", [0, 1, 1, 0, 0, 1], [0, 0, 0, 1, 1, 1], strict=True)]


def test_a_step_follows_the_slope_of_the_loss():
    """First moments hold a tenth of the gradient after one step; held against differences of the mean loss."""
    texts = ["", "a", "b c d", "bada b " * 9, " ".join(f"w{i}" for i in range(70)), "a " * 24 + "badb"]
    labels, weight = np.array([0, 0, 1, 1, 0, 1]), np.array([1, 1, 3, 3, 1, 3.0])
    forms, words, first = toxicity.features(*_bytes(texts))

    def loss(net):
        z = toxicity.logits(net, forms, words, first)
        return (weight * (np.logaddexp(0, z) - labels * z)).sum() / len(texts) + 0.5e-4 * (toxicity._views(net.dense)[2] ** 2).sum()

    net = toxicity._new_net(2)
    toxicity._views(net.dense)[1][:] = np.random.default_rng(1).normal(0.2, 0.1, toxicity._ALL)
    before = toxicity.Net(net.embedding.copy(), net.dense.copy())
    squares = net.squares.copy()
    toxicity._learn(net, forms, words, first, labels, weight)
    slopes = []
    for i in range(0, len(before.dense), 37):
        ends = []
        for step in (1e-3, -1e-3):
            dense = before.dense.copy()
            dense[i] += step
            ends.append(loss(toxicity.Net(before.embedding, dense)))
        slopes.append((ends[0] - ends[1]) / 2e-3)
    assert np.allclose(10 * net.mean[::37], slopes, atol=2e-3)
    moved = np.flatnonzero(net.squares != squares)
    assert set(moved) <= set(forms.ravel().tolist()) and len(moved)
    for row in moved[:: max(1, len(moved) // 20)]:
        ends = []
        for step in (1e-4, -1e-4):  # small, as another window may become the largest
            embedding = before.embedding.copy()
            embedding[row] += step
            ends.append(loss(toxicity.Net(embedding, before.dense)))
        pushed = (before.embedding[row] - net.embedding[row]) * np.sqrt(net.squares[row]) / 0.05
        assert np.isclose(pushed.sum(), (ends[0] - ends[1]) / 2e-4, atol=4e-3)


def test_few_products_for_each_word():
    """Blocks of words meet matrices of the width of a filter; bands as wide as two blocks took 6,144 products."""
    filters = toxicity._views(toxicity._new_net(1).dense)[0]
    assert sum(band.size for band in toxicity._bands(filters)) / toxicity._BLOCK < 4_500


def test_ids_of_another_type_still_meet_their_labels(spark):
    docs, labels = _tables(spark, [(text, "en", y) for text, y in _texts(300)])
    as_int = docs.withColumn("doc_id", docs["doc_id"].cast("int"))
    assert len(toxicity.train(as_int, labels, epochs=1).nets) == 2


def _plain_cut(points):
    """The best F1 over all cuts, the highest such cut, and the middle to the value below."""
    values = sorted({v for v, _ in points}, reverse=True)
    positive, best = sum(y for _, y in points), None
    for v in values:
        called = [y for w, y in points if w >= v]
        f1 = 2 * sum(called) / (len(called) + positive)
        if best is None or f1 > best[0]:
            best = (f1, v)
    below = [v for v in values if v < best[1]]
    return (best[1] + below[0]) / 2 if below else best[1] - 1e-6


@pytest.mark.parametrize("distinct", [3, 40, 4_000])
def test_cuts_equal_brute_force(spark, distinct):
    random = np.random.default_rng(distinct)
    points = [("ab"[k], float(v) / 8, int(random.random() < (v + 9) / (distinct + 20))) for k, v in zip(random.integers(0, 2, 600), random.integers(0, distinct, 600), strict=True)]
    rows = spark.createDataFrame([*points, ("one kind", 1.0, 1)], "scope string, value double, y int")
    assert toxicity._best_cuts(rows) == {s: _plain_cut([(v, y) for t, v, y in points if t == s]) for s in "ab"}


def test_a_score_does_not_depend_on_the_next_text(spark):
    """Wide filters that start behind the last word of a text must not see the next text."""
    rows = [(text, "en", y) for text, y in _texts(300)]
    model = toxicity.train(*_tables(spark, rows), epochs=2)
    texts = ["", "w1 w2", "bada badb " * 30, "", "w5 " * 40, "badc"]
    together = [r["score"] for r in toxicity.with_scores(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS).coalesce(1), model).orderBy("doc_id").collect()]
    alone = [toxicity.with_scores(spark.createDataFrame([(0, t, "en")], DOCS), model).collect()[0]["score"] for t in texts]
    assert np.allclose(together, alone, rtol=0, atol=1e-5)
    assert together[0] == together[3]


def test_outputs_equal_plain_windows():
    """Band matrices against one product for each word and each place of a filter."""
    random = np.random.default_rng(1)
    net = toxicity._new_net(1)
    filters, biases, output, bias = toxicity._views(net.dense)
    biases[:] = random.normal(0, 0.1, len(biases))
    texts = ["", "a", "b c d", " ".join(f"w{i}" for i in range(70))]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    forms, words, first = toxicity.features(np.frombuffer(b"".join(data), np.uint8), offsets)
    vectors = net.embedding[forms].sum(axis=1)[words]
    expected = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        x = np.concatenate([vectors[a:b], np.zeros((25, toxicity.DEPTH), np.float32)])
        tops = [np.max([np.einsum("jd,jdf->f", x[t : t + w], f) for t in range(b - a + 1)], axis=0) for w, f in zip(toxicity.WIDTHS, filters, strict=True)]
        expected.append(np.maximum(np.concatenate(tops) + biases, 0) @ output + bias[0])
    assert np.allclose(toxicity.logits(net, forms, words, first), expected, atol=1e-4)
