"""Fill-in-middle, hidden Markov scores and the conversation trie: against plain versions, and odd inputs."""

import brute
import numpy as np
import pytest
from conftest import tables_dir
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stackroom.llm import conversation_trie, fim, hidden_markov, hmm_score
from stackroom.llm.running import running

FOLDER = "/root/testdata/sf0.001"
EXTRA = ("row", "n", "form", "output", "low", "word", "classes", "held_out", "depth", "words", "k1", "turns", "run_part", "digest", "marked")
LONG = "wörd " * 40_000
ROWS = [
    (1, "plain words here and there"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "É é 漢字 😀 ß"), (6, "É é 漢字 😀 ß"), (7, "has <S> in it"),
    (8, "ends with <P"), (9, "<"), (10, "S><M"), (None, "no id at all"), (None, None), (11, "A b"), (12, "a B"), (13, "x"), (14, "😀"), (15, "<P <S <M < > P>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({name: F.lit(name) for name in EXTRA})


def order(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


# --- fill-in-middle -------------------------------------------------------------------------------------


def test_rank_index_finds_every_boundary():
    rng = np.random.default_rng(3)
    for _ in range(60):
        text = "".join(rng.choice(list("ab éß漢😀"), int(rng.integers(0, 3000)), p=rng.dirichlet(np.ones(7) * 0.3)))
        offsets = fim.boundaries(np.frombuffer(text.encode(), np.uint8))
        assert offsets.tolist() == [len(text[:i].encode()) for i in range(len(text) + 1)]
        index = fim.RankIndex(offsets, int(rng.integers(1, 40)))
        assert (index.offsets(np.arange(len(offsets))) == offsets).all()


@pytest.mark.parametrize("epsilon", [1, 5, 31, 126])
def test_rank_index_keeps_its_bound(epsilon):
    text = "".join("a" * (i % 50) + "é漢😀"[i % 3] * (i * 7 % 90) for i in range(900))
    offsets = fim.boundaries(np.frombuffer(text.encode(), np.uint8))
    index = fim.RankIndex(offsets, epsilon)
    assert abs(index.residual.astype(int)).max() <= epsilon + 1
    assert len(index.slope) < len(offsets) / 20 or epsilon == 1


def test_straight_text_is_one_segment():
    assert len(fim.RankIndex(fim.boundaries(np.frombuffer(b"plain text " * 50_000, np.uint8))).slope) == 1


def test_rearranged(spark, docs):
    found = fim.rearrange(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r[:-1]) for r in found), key=order) == sorted(((d, *brute.fill_in_middle(d, t)) for d, t in ROWS), key=order)
    assert sorted(r.back for r in found) == sorted(t or "" for _, t in ROWS)
    assert fim.rearrange(docs.limit(0)).count() == 0


def test_every_form_comes_back(spark):
    texts = [(i, ("<" * (i % 3) + "é漢 P>S>" * (i % 5) + "<M<P<S")[: i % 40]) for i in range(400)]
    found = fim.rearrange(spark.createDataFrame(texts, "doc_id long, text string")).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert {r.doc_id: r.back for r in found} == dict(texts)
    assert {(r.doc_id, *r[1:6]) for r in found} == {(d, *brute.fill_in_middle(d, t)) for d, t in texts}


def test_other_seed_and_sentinels(spark):
    spec = fim.FimSpec(seed="epoch 2", plain_from=100, prefix="<.>", suffix="<*>", middle="<|>")
    found = fim.rearrange(spark.createDataFrame([(i, f"text {i} é") for i in range(50)], "doc_id long, text string"), spec)
    back = found.withColumn("back", fim.restored(F.col("output"), F.col("form"), spec)).collect()
    assert all(r.back == f"text {r.doc_id} é" and r.form != "plain" for r in back)
    with pytest.raises(ValueError):
        fim.FimSpec(prefix="<M>")
    with pytest.raises(ValueError):
        fim.FimSpec(epsilon=200)


# --- hidden Markov model --------------------------------------------------------------------------------


def model_of(rng, states, classes):
    return hidden_markov.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states).T)


def test_forward_sums_over_all_paths():
    from itertools import product

    rng = np.random.default_rng(0)
    model, steps = model_of(rng, 3, 5), np.array([1, 4, 0, 2, 2], np.uint16)
    total = 0.0
    for path in product(range(3), repeat=len(steps)):
        p = model.start[path[0]] * model.emit[steps[0], path[0]]
        for a, b, step in zip(path, path[1:], steps[1:]):
            p *= model.move[a, b] * model.emit[step, b]
        total += p
    assert hidden_markov.forward(model, steps, np.array([5]))[0] == pytest.approx(np.log(total))


@pytest.mark.parametrize("states", [1, 3, 6])
def test_counts_are_those_of_single_steps(states):
    """Forward and backward a step at a time, over sequences shorter and longer than chunks, equal and one above."""
    rng = np.random.default_rng(states)
    model = model_of(rng, states, 7)
    sizes = np.array([1, 5, 64, 65, 128, 150, 2, 1])
    steps = rng.integers(0, 7, sizes.sum()).astype(np.uint16)
    counts = hidden_markov.Counts.empty(states, 7)
    hidden_markov.add_counts(counts, model, steps, sizes)
    start, move, emit, log = np.zeros(states), np.zeros((states, states)), np.zeros((7, states)), 0.0
    for x in np.split(steps, np.cumsum(sizes)[:-1]):
        a = [model.start * model.emit[x[0]]]
        for c in x[1:]:
            a.append(a[-1] @ model.move * model.emit[c])
        b = [np.ones(states)]
        for c in x[:0:-1]:
            b.insert(0, model.move @ (model.emit[c] * b[0]))
        p = a[-1].sum()
        log += np.log(p)
        start += a[0] * b[0] / p
        for t, c in enumerate(x):
            emit[c] += a[t] * b[t] / p
            if t:
                move += np.outer(a[t - 1], model.emit[c] * b[t]) * model.move / p
    assert np.allclose(counts.start, start) and np.allclose(counts.move, move) and np.allclose(counts.emit, emit) and counts.log == pytest.approx(log)


def test_long_sequences_do_not_underflow():
    rng = np.random.default_rng(5)
    model = model_of(rng, 4, 3000)
    steps = rng.integers(0, 3000, 50_000).astype(np.uint16)
    got = hidden_markov.forward(model, steps, np.array([50_000]))[0]
    assert got == pytest.approx(brute.forward_log(model.start.tolist(), model.move.tolist(), model.emit.tolist(), steps.tolist()))


def test_scores(spark, docs):
    """Base and counts against plain Python; the score against a recursion by single steps with the same model."""
    spec = hmm_score.HmmSpec(states=3, classes=16, rounds=2, hot_share=20)
    found = sorted((tuple(r) for r in hmm_score.score_documents(docs, spec).collect()), key=order)
    seen, base = brute.unigrams(ROWS)
    assert [r[:5] for r in found] == [x[:5] for x in sorted(((d, *b) for (d, _), b in zip(ROWS, base)), key=order)]
    assert [r[5] for r in found] == pytest.approx([x[5] for x in sorted(((d, *b) for (d, _), b in zip(ROWS, base)), key=order)], rel=1e-9)

    counts = hmm_score.count_words(docs, spec)
    freq = hmm_score.frequencies(counts, spec)
    assert 0 < len(freq.hot_words) < counts.count() == len(seen), "some words are looked up, some joined"
    coded = hmm_score.encode(docs, freq, spec).where("NOT held_out")
    model = hmm_score.train(coded, freq, spec)
    classes = lambda w: 16 if w is None else int(hmm_score.xxhash.xxh3_64_intdigest(w.encode()) % 16)
    inside, words = np.zeros(16), np.zeros(16)
    for w, n in seen.items():
        if w is not None:
            inside[classes(w)] += n
            words[classes(w)] += 1
    assert (freq.class_tokens == inside).all() and (freq.class_words == words).all()
    expected = {}
    for d, t in ROWS:
        tokens = brute.tokens(t)
        paths = brute.forward_log(model.start.tolist(), model.move.tolist(), model.emit.tolist(), [classes(w) for w in tokens]) / np.log(10)
        shares = sum(np.log10((seen[w] + 0.5) / (inside[classes(w)] + 0.5 * (words[classes(w)] + 1))) for w in tokens[:-1])
        expected[(d, len(tokens))] = paths + shares
    assert len(found) == len(ROWS)
    for r in found:
        assert r[6] == pytest.approx(expected[(r[0], r[2])], rel=1e-6)


def test_rounds_raise_the_probability(spark):
    """Two languages: training never lowers the probability (but for the prior), and held-out texts gain on word frequencies."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{int(w)}" for w in rng.integers(0, 40, 60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spec = hmm_score.HmmSpec(states=2, classes=512, prior=1.0)
    freq = hmm_score.frequencies(hmm_score.count_words(docs, spec), spec)
    coded = hmm_score.encode(docs, freq, spec).where("NOT held_out").cache()
    model, logs = hmm_score.first_model(freq, spec), []
    for _ in range(5):
        model, log = hmm_score.improve(model, coded, freq, spec)
        logs.append(log)
        assert model.start.sum() == pytest.approx(1) and np.allclose(model.move.sum(1), 1) and np.allclose(model.emit.sum(0), 1)
    assert all(b > a - 1 for a, b in zip(logs, logs[1:])) and logs[-1] > logs[0]
    held = hmm_score.score_documents(docs, spec).where("held_out").collect()
    assert len(held) > 40 and all(r.score > r.base_score for r in held)


def test_scores_of_odd_tables(spark, docs):
    assert hmm_score.score_documents(docs.limit(0)).count() == 0
    held = next(i for i in range(100) if brute.held_out(i))
    only = hmm_score.score_documents(spark.createDataFrame([(held, "no training text")], "doc_id long, text string")).first()
    assert (only.n_tokens, only.n_known, only.train_tokens, only.base_score) == (4, 0, 0, 0.0) and only.score < 0


def test_scores_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op12_hidden_markov"](spark, FOLDER).collect()}
    _, base = brute.unigrams(rows)
    assert len(found) == len(rows)
    for (d, _), b in zip(rows, base):
        assert found[d][:4] == b[:4] and found[d][4] == pytest.approx(b[4], rel=1e-9)


def test_held_out_texts_gain_on_word_frequencies(spark):
    held = entry.queries()["op12_hidden_markov"](spark, tables_dir()).where("held_out").collect()
    assert len(held) > 150 and sum(r.score > r.base_score for r in held) > 0.85 * len(held)
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)


# --- running totals and the trie ------------------------------------------------------------------------


def test_running_totals_over_cut_groups(spark):
    """One group has most of the rows and spans every range."""
    rows = [(7 if i % 10 else i, i, (i * 37) % 11 - 5, (i * 2654435761) % 2**62) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g long, i long, x long, y long").repartition(16)
    found = running(frame, "g", [F.col("i")], sums=["x"], xors=["y"])
    expected, sums, xors = [], {}, {}
    for g, i, x, y in sorted(rows):
        sums[g], xors[g] = sums.get(g, 0) + x, xors.get(g, 0) ^ y
        expected.append((g, i, x, y, sums[g], xors[g]))
    assert sorted(map(tuple, found.collect())) == expected
    assert running(frame.limit(0), "g", [F.col("i")], sums=["x"]).count() == 0


TALKS = "conv_id long, turn long, role string, text string"


def talk(spark, rows):
    return spark.createDataFrame(rows, TALKS).withColumns({name: F.lit(name) for name in EXTRA})


def nodes(df):
    return sorted(map(tuple, df.collect()), key=order)


@pytest.mark.parametrize("block", [1, 3, 4, 7])
def test_trie(spark, block):
    """Long and short conversations, equal ones, shared openings that end within and at the ends of blocks, null and odd turns."""
    rng = np.random.default_rng(block)
    rows = []
    for c in range(130):
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, t, "user" if t % 2 == 0 else None, None if rng.random() < 0.1 else " ".join("ab"[int(x)] for x in rng.integers(0, 2, int(rng.integers(0, 2)) + 1))))
    rows += [(c, t, "user", f"same {t}") for c in (200, 203, 1007, 123456) for t in range(40)]
    rows += [(300, None, "user", "first"), (300, 2, "user", "second"), (None, 1, "user", "nobody"), (301, 1, "user", ""), (302, 1, "user", "x" * 100_000)]
    rows += [(140, 5, "user", "twice"), (140, 5, "user", "twice")]
    found = conversation_trie.rebuilt_trie(talk(spark, rows), conversation_trie.TrieSpec(block=block, id_bits=2))
    assert nodes(found) == sorted(brute.trie(rows), key=order)


def test_trie_of_one_hot_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 4000, 20) for t in range(3)] + [(4001, t, "user", f"long {t}") for t in range(1500)]
    found = conversation_trie.rebuilt_trie(talk(spark, rows))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    turns = conversation_trie.number_turns(talk(spark, rows))
    assert turns.groupBy("conv_id").agg(F.max("depth").alias("d")).where("d > 3").first().d == 1500
    lost = brute.zlib.crc32(b"4001") % 4  # its giver does not exist
    assert found.where("depth = 0").first().n_convs == 201 and found.count() == 1 + 3 + 1500 - lost


def test_trie_without_turns(spark):
    """A conversation that keeps none of its turns ends in the root."""
    lost = next(c for c in range(1, 20) if brute.zlib.crc32(str(c).encode()) % 4 == 3)
    found = nodes(conversation_trie.rebuilt_trie(talk(spark, [(lost, 0, "user", "a"), (lost, 1, "user", "b")])))
    assert found == [(lost, 0, None, 1, 0, 1, 0, brute.sha256(str(lost)))]
    assert conversation_trie.rebuilt_trie(talk(spark, [(None, 0, "user", "a")])).count() == 0
    assert conversation_trie.rebuilt_trie(talk(spark, []).limit(0)).count() == 0
