"""The perceptron against plain Python, and against the lexicon where neighbours decide."""

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.operators import perceptron, tagging
from textstyle.plans import registry

MASK = (1 << 64) - 1
BITS = 10


def mix(x):
    x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & MASK
    x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 & MASK
    return x ^ x >> 33


def features(words, endings, capitals, i, before, last):
    """The weights' rows of a token, from whole numbers, one feature after the other."""
    def at(values, j):
        return values[j] & MASK if 0 <= j < len(values) else 0

    word, capital = at(words, i), int(capitals[i])
    values = [0, word, at(endings, i), capital + 2 * (i == 0), at(words, i - 1),
              at(words, i + 1), at(endings, i - 1), at(endings, i + 1),
              mix(at(endings, i)) ^ capital,
              last + 1, (last + 1) * (1 << 20) + before + 1, mix(word) ^ (last + 1)]
    return [mix(value ^ mix(kind + 1)) >> 64 - BITS for kind, value in enumerate(values)]


def best(weights, rows, tags):
    scores = [sum(weights.get((row, tag), 0) for row in rows) for tag in range(tags)]
    return scores.index(max(scores))


def plain_learn(sentences, tags, epochs):
    """Weights after each token, added up and averaged."""
    weights, total, steps = {}, {}, 0
    order = np.random.default_rng(1)
    history = []
    for _ in range(epochs):
        for number in order.permutation(len(sentences)):
            words, endings, capitals, gold = sentences[number]
            before = last = tags
            for i, right in enumerate(gold):
                rows = features(words, endings, capitals, i, before, last)
                guess = best(weights, rows, tags)
                steps += 1
                if guess != right:
                    history.append((steps, rows, right, guess))
                    for row in rows:
                        weights[row, right] = weights.get((row, right), 0) + 1
                        weights[row, guess] = weights.get((row, guess), 0) - 1
                before, last = last, guess
    for step, rows, right, guess in history:
        # A move at a step is part of the weights after it and all later ones.
        share = (steps - step) / steps
        for row in rows:
            total[row, right] = total.get((row, right), 0) + share
            total[row, guess] = total.get((row, guess), 0) - share
    return total


def sentences(seed, count, tags=3):
    pick = random.Random(seed)
    made = []
    for _ in range(count):
        n = pick.randrange(1, 12)
        words = [pick.randrange(-(1 << 63), 1 << 63) if pick.random() < 0.3
                 else pick.randrange(5) for _ in range(n)]
        made.append((words, [w % 3 for w in words], [pick.random() < 0.2 for _ in words],
                     [pick.randrange(tags) for _ in words]))
    return made


def as_arrays(made):
    words, endings = (np.array([w for s in made for w in s[k]], dtype=np.int64) for k in (0, 1))
    marks = np.array([perceptron.CAPITAL * c for s in made for c in s[2]], dtype=np.int32)
    starts = np.cumsum([0, *[len(s[0]) for s in made[:-1]]])
    return words, endings, marks, starts


def test_learning_and_decoding_equal_plain_python():
    made = sentences(1, 30)
    words, endings, marks, starts = as_arrays(made)
    fixed = perceptron.fixed_features(words, endings, marks, starts, BITS)
    edges = [*starts.tolist(), len(words)]
    given = [(words[a:b], fixed[a:b], np.array(s[3]))
             for a, b, s in zip(edges, edges[1:], made, strict=False)]
    weights = perceptron.learn(given, ["a", "b", "c"], 3, BITS)
    expected = plain_learn(made, 3, 3)
    for (row, tag), value in expected.items():
        assert weights[row, tag] == pytest.approx(value, abs=1e-5)
    assert np.count_nonzero(weights) <= len(expected)

    tagger = perceptron.Tagger(["a", "b", "c"], weights)
    table = {(r, t): float(weights[r, t]) for r, t in np.argwhere(weights)}
    unseen = sentences(2, 40)
    found = perceptron.decode(tagger, *as_arrays(unseen))
    at = 0
    for words, endings, capitals, _ in unseen:
        before = last = 3
        for i in range(len(words)):
            rows = features(words, endings, capitals, i, before, last)
            scores = [sum(table.get((row, tag), 0) for row in rows) for tag in range(3)]
            assert scores[found[at]] == pytest.approx(max(scores), abs=1e-4)
            before, last = last, int(found[at])
            at += 1


@pytest.fixture
def tagged(spark):
    """The tag of "porte" and "ferme" is told by the word before."""
    pick = random.Random(7)
    rows = []
    for i in range(400):
        tokens, tags = [], []
        for _ in range(pick.randrange(1, 6)):
            noun = pick.random() < 0.5
            tokens += ["la" if noun else "il", pick.choice(["porte", "ferme"]), "."]
            tags += ["D" if noun else "P", "N" if noun else "V", "."]
        rows.append((i, tokens, tags))
    return spark.createDataFrame(rows, "id long, tokens array<string>, tags array<string>")


def test_neighbours_decide(tagged):
    known, unseen = tagged.filter("id % 4 <> 0"), tagged.filter("id % 4 = 0")
    tagger = perceptron.train(known)
    rows = perceptron.tag(unseen, tagger).collect()
    hits = sum(a == b for r in rows for a, b in zip(r.tags, r.pos, strict=True))
    tokens = sum(len(r.tags) for r in rows)
    pairs = F.transform("tokens", lambda t, i: F.struct(
        t.alias("word"), F.get("tags", i).alias("tag")))
    lexicon = tagging.train_lexicon(known.select(F.inline(pairs)))
    by_word = {r.id: r.pos for r in tagging.tag_documents(unseen, *lexicon).collect()}
    lexicon_hits = sum(
        a == b for r in rows for a, b in zip(r.tags, by_word[r.id], strict=True))
    assert hits == tokens and lexicon_hits < 0.9 * tokens


def test_training_does_not_depend_on_partitions(tagged):
    one = perceptron.train(tagged, rows=50, per_row=4, epochs=2)
    many = perceptron.train(tagged.repartition(7), rows=50, per_row=4, epochs=2)
    assert one.tags == many.tags and np.array_equal(one.weights, many.weights)


def test_odd_rows(spark, tagged):
    tagger = perceptron.train(tagged)
    long = ["la", "porte"] * 900
    rows = [(1, None), (2, []), (3, [None, "la"]), (4, ["."]), (5, long), (5, long), (None, ["il"])]
    docs = spark.createDataFrame(rows, "id long, tokens array<string>")
    found = perceptron.tag(docs, tagger).collect()
    assert [None if r.pos is None else len(r.pos) for r in found] == [
        None if t is None else len(t) for _, t in rows]
    assert found[4].pos == found[5].pos and set(found[4].pos) <= {"D", "N"}
    nobody = perceptron.train(tagged.limit(0))
    assert nobody.tags == [] and perceptron.tag(docs, nobody).collect()[3].pos == [None]
    assert perceptron.tag(docs.limit(0), tagger).count() == 0
    # Rows that teach nothing.
    odd = spark.createDataFrame(
        [(["a"], ["X", "Y"]), (["a"], [None]), (None, None), ([], [])],
        "tokens array<string>, tags array<string>")
    assert perceptron.train(odd).tags == []


def test_tagging_is_one_pass(tagged):
    frame = perceptron.tag(tagged, perceptron.train(tagged))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_comparing_taggers_looks_into_no_array_that_is_made(spark, tmp_path):
    """No array is made again for each of its tokens: a long text takes no longer."""
    rows = [(i, f"w{i % 7} " * (30_000 if i < 20 else 30), f"s{i % 3}", "fr" if i % 2 else "de", 1)
            for i in range(60)]
    spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, n_chars long"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    started = time.time()
    found = registry.tagger_accuracy(spark, str(tmp_path)).collect()
    assert found[0].tokens == found[1].tokens > 30_000
    assert time.time() - started < 60


def test_learning_side_by_side_in_one_lane_is_learning_token_by_token(monkeypatch):
    monkeypatch.setattr(perceptron, "LANES", 1)
    made = sentences(3, 60)
    words, endings, marks, starts = as_arrays(made)
    fixed = perceptron.fixed_features(words, endings, marks, starts, BITS)
    gold = np.array([tag for s in made for tag in s[3]])
    weights, moved = np.zeros((1 << BITS, 3)), np.zeros((1 << BITS, 3))
    step = perceptron.learn_side_by_side(
        weights, moved, 0, 7, (words, fixed, gold, starts), BITS, np.random.default_rng(1))
    edges = [*starts.tolist(), len(words)]
    given = [(words[a:b], fixed[a:b], gold[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    assert step == len(words)
    assert np.array_equal((weights / 7 - moved / step).astype(np.float32),
                          perceptron.learn(given, ["a", "b", "c"], 1, BITS))


def test_all_rows_and_tokens_teach(spark):
    """Also those beyond 300 rows, and beyond 200 tokens of a row."""
    rows = [(i, ["la", "porte"] * 110 + ["fin"], ["D", "N"] * 110 + ["Z"]) for i in range(4)]
    rows += [(i, [f"m{i}", "."], [f"T{i % 4}", "."]) for i in range(4, 700)]
    known = spark.createDataFrame(rows, "id long, tokens array<string>, tags array<string>")
    tagger = perceptron.train(known)
    assert tagger.tags == sorted({tag for _, _, tags in rows for tag in tags})
    found = perceptron.tag(known, tagger).collect()
    hits = sum(a == b for r in found for a, b in zip(r.tags, r.pos, strict=True))
    assert hits > 0.95 * sum(len(r.tags) for r in found)


def test_shards_do_not_depend_on_partitions_and_blocks_not_on_batches(tagged, monkeypatch):
    monkeypatch.setattr(perceptron, "SHARD", 700)
    monkeypatch.setattr(perceptron, "BLOCK", 150)
    frame = tagged.withColumn("held_out", F.lit(False))
    one = perceptron.train(frame.coalesce(1), epochs=3)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    tagged.sparkSession.conf.set(batch, "7")
    try:
        many = perceptron.train(frame.repartition(7), epochs=3)
    finally:
        tagged.sparkSession.conf.unset(batch)
    assert one.tags == many.tags and np.array_equal(one.weights, many.weights)
    rows = perceptron.tag(tagged, one).collect()
    assert all(r.tags == r.pos for r in rows)


def test_a_row_of_any_length_is_learned_from_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(perceptron, "BLOCK", 100)
    long = spark.createDataFrame(
        [(["il", "dort", "."] * 500, ["P", "V", "."] * 500)],
        "tokens array<string>, tags array<string>")
    tagger = perceptron.train(long)
    assert perceptron.tag(long, tagger).first().pos == ["P", "V", "."] * 500


def test_tagger_accuracy_learns_from_whole_texts(spark, tmp_path):
    """What tells the languages apart stands behind the first 200 tokens of all texts that are
    learned from."""
    rows = []
    for i in range(300):
        held_out = zlib.crc32(str(i).encode()) % 5 == 0
        text = f"tard{i % 4} " * 20
        rows.append((i, text if held_out else "x " * 210 + text, "s", f"l{i % 4}", 1))
    spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, n_chars long"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.tagger: r for r in registry.tagger_accuracy(spark, str(tmp_path)).collect()}
    assert found["perceptron"].right > 0.9 * found["perceptron"].tokens > 900
