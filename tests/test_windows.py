import random

import pytest

from textstyle.operators.scan import ranges, sums_before
from textstyle.operators.windows import (
    block_windows,
    full_windows,
    readability_windows,
    window_stability,
)

CONFIGS = ((500, 250), (1000, 500))


@pytest.mark.parametrize(
    "tokens, config, sliding, tumbling",
    [
        (1300, (500, 250), [500, 500, 500, 500, 300], [250] * 5),
        (1300, (1000, 500), [1000, 800], [500, 500]),
        (750, (500, 250), [500, 500, 250], [250] * 3),
        (750, (1000, 500), [750], [500]),
        (499, (500, 250), [499], [250]),
        (499, (1000, 500), [], []),
        (0, (500, 250), [], []),
    ],
)
def test_window_lengths(make_corpus, tokens, config, sliding, tumbling):
    corpus = make_corpus(" ".join(["le"] * tokens))
    for mode, expected in (("sliding", sliding), ("tumbling", tumbling)):
        rows = readability_windows(corpus, [config], mode).orderBy("window_index").collect()
        assert [r.word_count for r in rows] == expected
        assert [r.window_index for r in rows] == list(range(len(expected)))


@pytest.mark.parametrize("tokens, expected", [(1300, [500] * 4), (750, [500] * 2), (499, [499]),
                                              (0, [0])])
def test_full_windows(make_corpus, tokens, expected):
    rows = full_windows(make_corpus(" ".join(["le"] * tokens))).orderBy("start").collect()
    assert [len(r.window) for r in rows] == expected


def test_windows_agree_with_plain_python(make_corpus):
    rng = random.Random(3)
    words = [rng.choice(["le", "maison", "peut-être", "idée", ",", "x"]) for _ in range(2300)]
    size = {"le": 1, "maison": 2, "peut-être": 4, "idée": 2, ",": 1, "x": 1}
    corpus = make_corpus(" ".join(words))
    for mode in ("sliding", "tumbling"):
        expected = {}
        for window, step in ((7, 3), (5, 5), (4, 9), (500, 250)):
            length = window if mode == "sliding" else min(window, step)
            for start in range(0, len(words), step):
                part = words[start:start + length]
                if len(part) >= window * 0.5:
                    expected[window, start // step] = (len(part), sum(size[w] for w in part))
        rows = readability_windows(corpus, [(7, 3), (5, 5), (4, 9), (500, 250)], mode).collect()
        found = {(r.window_size, r.window_index): (r.word_count, r.syllable_count) for r in rows}
        assert found == expected
        for r in rows:
            ratio = r.syllable_count / r.word_count
            assert r.flesch == pytest.approx(206.835 - 1.015 * 20 - 84.6 * ratio)
            assert r.km == pytest.approx(207.0 - 1.015 * 20 - 73.6 * ratio)


def test_unknown_mode(make_corpus):
    with pytest.raises(ValueError):
        readability_windows(make_corpus("a"), mode="hopping")


def test_stability(make_corpus):
    corpus = make_corpus(" ".join(["le"] * 250 + ["maison"] * 250), " ".join(["le"] * 10))
    row = window_stability(readability_windows(corpus, [(500, 250)])).first()
    assert row.mean_flesch == pytest.approx(206.835 - 20.3 - 84.6 * 1.5)
    assert row.std_flesch == pytest.approx(84.6 / 2**0.5)
    assert row.cv_flesch == pytest.approx(row.std_flesch / abs(row.mean_flesch))
    single = window_stability(readability_windows(corpus, [(1000, 500)])).first()
    assert single.std_km is None and single.cv_km is None


@pytest.mark.parametrize("step", [1, 10, 7])
def test_running_sums_of_fine_steps(make_corpus, step):
    rng = random.Random(step)
    words = [rng.choice(["le", "maison", "idée", ","]) for _ in range(3001)]
    size = {"le": 1, "maison": 2, "idée": 2, ",": 1}
    before = [0]
    for word in words:
        before.append(before[-1] + size[word])
    rows = readability_windows(make_corpus(" ".join(words), ""), [(100, step)], "sliding").collect()
    expected = {s // step: before[min(s + 100, len(words))] - before[s]
                for s in range(0, len(words) - 49, step)}
    assert {r.window_index: r.syllable_count for r in rows} == expected


def plain_block_windows(blocks, configs):
    """Blocks in order, NULL first, put together and cut into windows."""
    size = {"le": 1, "maison": 2, "idée": 2}
    documents = {}
    for key, turn, text in sorted(
        blocks, key=lambda b: (b[0] or "", b[1] is not None, b[1] or 0)
    ):
        documents.setdefault(key, []).extend((text or "").split())
    found = set()
    for key, words in documents.items():
        for window, step in configs:
            for start in range(0, len(words), step):
                part = words[start : start + min(window, step)]
                if len(part) >= window / 2:
                    found.add((key, window, start // step, len(part), sum(size[w] for w in part)))
    return found


def test_blocks_with_repeated_and_missing_turns(spark):
    rng = random.Random(1)
    blocks = [(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 2, 3, 40]),
               rng.choice([None, "", " ".join(["maison"] * rng.randrange(9))])) for _ in range(60)]
    # A third of all blocks in one document, many with the same number.
    blocks += [("hot", i // 3, "idée") for i in range(40)]
    blocks += [("same", 1, "le le"), ("same", 1, "le le le"), ("same", 1, "le le")]
    table = spark.createDataFrame(blocks, "id string, turn long, text string").selectExpr(
        "id", "'x' AS author", "'g' AS genre", "'t' AS title", "turn", "text"
    )
    configs = [(4, 4), (10, 5), (6, 9)]
    rows = block_windows(table, "turn", configs).collect()
    found = {(r.id, r.window_size, r.window_index, r.word_count, r.syllable_count) for r in rows}
    # Which of two blocks of one number comes first is the table's order, so are the syllables.
    assert len(found) == len(rows) and found == plain_block_windows(blocks, configs)
    assert block_windows(table.limit(0), "turn", configs).count() == 0


def test_a_large_document_fills_many_ranges(spark, tmp_path):
    rows = spark.range(4000).selectExpr("'hot' AS id", "7 AS turn", "id AS _row", "1 AS _size")
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")
    ranged = ranges(rows.repartition(4), "id", "turn", "_row", str(tmp_path))
    spark.conf.unset(coalescing)
    parts = ranged.groupBy("_part").count().collect()
    assert len(parts) > 3 and max(r["count"] for r in parts) < 2000
    places = sums_before(ranged, "id", "turn", "_row", "_size").collect()
    assert sorted((r._row, r._place) for r in places) == [(i, i) for i in range(4000)]
