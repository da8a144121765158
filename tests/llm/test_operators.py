"""The operators against brute force, and their odd rows: NULLs, empty and very long texts,
ties, repeated rows, empty tables, columns that clash in name."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.llm import (
    language_model,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    quality,
    topk,
    toxicity,
    url_filter,
)
from textstyle.llm.components import components

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, lang string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(60_000))


def odd_documents(spark, extra=()):
    """NULLs in every column, empty, blank, one word, a very long text, repeated rows."""
    rows = [
        (1, "one two three four five six seven. Again here!\nSecond line of it", "a", "en", 3),
        (1, "one two three four five six seven. Again here!\nSecond line of it", "a", "en", 3),
        (2, None, None, None, None), (3, "", "b", "en", 0), (4, " \n\t", "b", None, 3),
        (5, "word", None, "fr", 4), (6, LONG, "a", "en", len(LONG)), (None, "no id here", "c", "en", 1),
        (7, "one two three four five six seven. Again here!\nSecond line of it", "b", "en", 3),
        (8, "퟿ été <|endoftext|>  two  spaces x ", "c", "en", 9), *extra,
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def clashing(spark):
    """Columns of the input that carry names the operators use for results and on the way."""
    names = ("size", "target", "rate", "copies", "taken", "score", "predicted", "held_out",
             "row", "rare", "n_tokens", "host", "path", "verdict", "n_kept", "parts")
    return odd_documents(spark).select("*", *[F.lit("mine").alias(n) for n in names])


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 1 mixing -----------------------------------------------------------------------------


def filled(sizes, weights, share=1.5, limit=2.0):
    """Targets by handing the excess on until nobody is above."""
    left, open_, targets = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] > limit * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in over:
            targets[i] = limit * sizes[i]
            left -= targets[i]
        open_ -= over
    return targets


def test_mixing_targets_and_copies(spark):
    sizes = {"a": 50, "b": 3, "c": 400, "é": 7, "z": 90, None: 120}
    rows = [(i, " ".join(["w"] * n), s, None, None) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r.source: r for r in mixing.mix(docs).collect()}
    expected = filled(list(sizes.values()), [3, 1, 2, 3, 1, 2])
    for (source, size), target in zip(sizes.items(), expected, strict=True):
        row = found[source]
        assert row.size == row.source_size == size and math.isclose(row.target, target)
        assert row.taken in (size * math.floor(row.rate), size * math.ceil(row.rate))
    assert sorted(r.taken for r in mixing.mix(docs).collect()) == sorted(
        r.taken for r in found.values()
    )


def test_mixing_comes_near_targets(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"),
    )
    rows = mixing.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"),
        F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.05 and r.most <= 2 for r in rows)


def test_mixing_odd_rows(spark, clashing):
    rows = mixing.mix(clashing).collect()
    assert len(rows) == 10 and all(r.size == len((r.text or "").encode().split()) for r in rows
                                   if r.doc_id not in (8,))
    mixed = mixing.mixed_documents(odd_documents(spark))
    assert mixed.columns == odd_documents(spark).columns
    assert mixing.mix(empty(spark)).count() == 0


# --- 2 and 7 vectors ----------------------------------------------------------------------


def embeddings(spark, n=400, size=16):
    random = np.random.default_rng(5)
    rows = [(i, [float(x) for x in random.normal(size=size)], 1) for i in range(n)]
    rows += [(n, rows[1][1], 1), (n + 1, rows[1][1], 1), (n + 20, None, 1),
             (n + 21, [1.0, None] * (size // 2), 1), (n + 22, [float("nan")] * size, 1),
             (n + 23, [float("inf")] * size, 1), (n + 24, [], 1), (None, rows[2][1], 1),
             (n + 25, [0.0] * size, 1), (n + 26, [1.0, 2.0], 1), (n + 30, rows[3][1], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows


def brute(rows, every, k, measure, zeros):
    usable = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and None not in v
              and np.isfinite(v).all() and (zeros or np.any(v))]
    found = {}
    for q, x in usable:
        if q % every == 0:
            scored = [(-measure(x, y), i) for i, y in usable if i != q and len(y) == len(x)]
            found[q] = sorted(scored)[:k]
    return found


def test_top_k_equals_brute_force(spark):
    table, rows = embeddings(spark)
    whole = lambda x, y: int(np.floor(256 * x) @ np.floor(256 * y))
    expected = brute(rows, 50, 5, whole, True)
    found = {}
    for r in topk.top_k(table, per_shard=64, per_block=4).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert found == {q: v for q, v in expected.items() if v}
    assert topk.top_k(table.limit(0)).count() == 0


def test_threshold_stops_early():
    random = np.random.default_rng(2)
    values = np.floor(random.normal(size=(4000, 3)) * 256)
    lists = np.argsort(-values, axis=0, kind="stable").T
    ids, query = np.arange(4000), values[7]
    found, scores, scored = topk.best_of(values, lists, ids, query, 7, 5, step=8)
    order = [i for i in np.lexsort((ids, -(values @ query))) if i != 7][:5]
    assert found.tolist() == order and scored < 2000


def test_neighbours_with_factor_one_are_exact(spark):
    table, rows = embeddings(spark)
    expected = brute(rows, 20, 20, lambda x, y: float((x * y).sum()), False)
    found = {}
    run = neighbours.nearest(table, factor=1.0, per_shard=150, per_block=8)
    for r in run.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert set(found) == {q for q, v in expected.items() if v}
    for q, best in found.items():
        assert [i for _, i in best] == [i for _, i in expected[q]]
        assert np.allclose([s for s, _ in best], [s for s, _ in expected[q]])
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_neighbours_recall_of_the_production_factor():
    random = np.random.default_rng(3)
    points = random.normal(size=(6000, 64))
    ids = np.arange(6000)
    order, nodes = neighbours.build(neighbours.lifted(points))
    own = ids[ids % 200 == 0]
    search = neighbours.Search(points, ids, order, nodes, points[own], own, 20, neighbours.FACTOR)
    found = {}
    for q, i, _ in search.run():
        found.setdefault(q, set()).add(i)
    scores = points[own] @ points.T
    scores[np.arange(len(own)), own] = -np.inf
    hits = sum(len(found[q] & set(np.argsort(-s)[:20])) for q, s in zip(own, scores, strict=True))
    assert hits / (20 * len(own)) >= 0.9


# --- 3 packing ----------------------------------------------------------------------------


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_encoder_agrees_with_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(packing.TOKENIZER), packing.Encoder()
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    texts += ["", " ", "  ", "a  b", "a   b", " a", "a ", "a \n b", "a\n b", "\n \n", "x\t y",
              "<|endoftext|> a", "a<|endoftext|>", "é  x", "　 y", "it's  don't", "a\0b c",
              "\r\n  z", "  lead", "a   b", "1 2  3"]
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):
        found = encoder.encode(texts)
        assert [np.frombuffer(ids, "<u2").tolist() for ids in found] == expected
    # One by one, and with room for few chunks only.
    encoder, packing.CACHED, before = packing.Encoder(), 20, packing.CACHED
    for text, ids in zip(texts, expected, strict=True):
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == ids
    packing.CACHED = before
    assert encoder.encode([]) == []


def test_packing_covers_every_id_once(spark, clashing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = packing.pack(clashing).collect()
    texts = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    whole = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        whole[doc, np.array(ids, "<u2").tobytes()] += 1
    groups = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32
        assert len(r.ids) == 2 * r.length
        groups.setdefault(r.sequence_id, []).append(r)
    for pieces in groups.values():
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        total = sum(p.length for p in pieces)
        assert total == 1024 or total & (total - 1) == 0
    put = Counter()
    for doc in {d for d, _ in texts}:
        parts, have = [], b""
        for r in sorted((r for r in rows if r.doc_id == doc), key=lambda r: (r.sequence_id, r.offset)):
            assert r.start == len(have) // 2
            have += bytes(r.ids)
            if len(have) == 2 * r.doc_tokens:
                parts.append(have)
                have = b""
        assert not have
        put.update((doc, p) for p in parts)
    assert put == whole
    assert packing.pack(empty(spark)).count() == 0
    joined = packing.sequences(packing.pack(clashing))
    assert joined.agg(F.sum(F.length("ids"))).first()[0] == sum(2 * r.length for r in rows)


# --- 4 and 5 classifiers ------------------------------------------------------------------


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_learns_from_training_rows_alone(spark, module, label):
    folds, held = module.FOLDS, module.HELD_OUT
    rows, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        words = [f"word{(i * 7 + j) % 50}" for j in range(30)]
        if bad:
            words[5] = "vile"
            words = words if module is toxicity else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words[:15]) + ". " + " ".join(words[15:]) + ".", "s", "en", 1))
        labels.append((i, int(bad) if module is toxicity else int(not bad)))
    held_out = {i for i in range(400) if zlib.crc32(str(i).encode()) % folds == held}
    docs = spark.createDataFrame(rows, DOCS)
    # Wrong labels on what is held out change nothing.
    table = spark.createDataFrame(
        [(i, v) for i, v in labels if i not in held_out] + [(i, 1) for i in held_out],
        f"doc_id long, {label} int")
    found = module.score(docs, table).collect()
    truth = dict(labels)
    assert {r.doc_id for r in found if r.held_out} == held_out
    assert np.mean([r.predicted == truth[r.doc_id] for r in found if r.held_out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= module.LIMIT) for r in found)
    if module is toxicity:
        guilty = [r for r in found if r.predicted and truth[r.doc_id]]
        assert guilty and all(any("vile" in s for s in r.offending) for r in guilty)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_odd_rows(spark, clashing, module, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    assert module.score(clashing, none).count() == 10
    some = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (2, None), (None, 1), (6, 0), (3, 1)],
                                 f"doc_id long, {label} int")
    rows = module.score(clashing, some).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.size == "mine" for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[1]) == 1
    assert module.score(empty(spark), some).count() == 0


def test_noisy_or_of_sentences():
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    scorer = toxicity.Scorer(weights, -1.0)
    single = 1 / (1 + math.exp(1))
    for count in (1, 2, 5):
        score, _ = scorer.documents(["some words here. " * count])[0]
        assert math.isclose(score, 1 - (1 - single) ** count, rel_tol=1e-9)


# --- 6 language model ---------------------------------------------------------------------


def test_language_model_scores(spark, clashing):
    extra = [(i, " ".join(f"v{(i + j) % 9}" for j in range(20)) + f" Rare{i}", "s", "en", 1)
             for i in range(20, 120)]
    docs = odd_documents(spark, extra)
    rows = language_model.score(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter()
    for i, text in texts:
        if not held(i):
            counts.update(language_model.tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for i, text in texts:
        found = language_model.tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in found)
        expected[i, held(i), len(found), sum(w in counts for w in found), round(base, 6)] += 1
    assert expected == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6))
                               for r in rows)
    assert all(r.train_tokens == total and r.score < 0 for r in rows)
    assert language_model.score(clashing).count() == 10
    assert language_model.score(empty(spark)).count() == 0


def test_every_training_document_reaches_the_network(spark, monkeypatch):
    settle, learned = language_model.settle, []

    def spy(frame, name):
        written = settle(frame, name)
        if name == "lm-models":
            learned.append(written.agg(F.sum("seen")).first()[0] or 0)
        return written

    monkeypatch.setattr(language_model, "settle", spy)
    rows = [(i, " ".join(f"v{(i + j) % 9}" for j in range(i % 20)), "s", "en", 1) for i in range(200)]
    scored = language_model.score(spark.createDataFrame(rows, DOCS)).first()
    assert sum(learned) == scored.train_tokens


def lexicon_of(words, counts, head):
    known = language_model.Lexicon(words, np.array(counts, float), head, {b"ng": 0, b"ed": 1},
                                   np.array([7.0, 5.0, 4.0]), sum(counts), len(counts))
    return known


def test_probabilities_add_up_to_one():
    known = lexicon_of([b"", b"a", b"b", b"c", b"d"], [9, 8, 5, 3, 2], 5)
    model = language_model.Model(known, units=6)
    random = np.random.default_rng(0)
    model.load(random.normal(0, 0.5, model.flat().shape).astype(np.float32))
    state = random.normal(size=(1, 6)).astype(np.float32)
    every = np.arange(known.symbols)
    found = model.outputs(np.repeat(state, len(every), axis=0), every)
    assert math.isclose(np.exp(found).sum(), 1, rel_tol=1e-5)


def test_slopes_agree_with_differences():
    known = lexicon_of([b"", b"a", b"b", b"c", b"d"], [9, 8, 5, 3, 2], 5)
    model = language_model.Model(known, units=4)
    random = np.random.default_rng(1)
    model.parts = {k: random.normal(0, 0.5, v.shape) for k, v in model.parts.items()}
    symbols, targets = random.integers(0, known.symbols, (2, 6, 3))
    opens = np.zeros((6, 3), bool)
    opens[0] = opens[3, 1] = True
    full = np.ones((6, 3), bool)
    full[5, 2] = False
    captured = {}

    class Spy(language_model.Trainer):
        def _move(self, name, where, grad):
            captured[name] = (where, grad)

    def loss():
        state, total = np.zeros((3, 4)), 0.0
        for t in range(6):
            state, *_ = model.step(state * ~opens[t][:, None], symbols[t])
            total -= model.outputs(state[full[t]], targets[t][full[t]]).sum()
        return total / full.sum()

    Spy(model).window(np.zeros((3, 4)), symbols, targets, opens, full)
    for name, (where, grad) in captured.items():
        part = model.parts[name]
        whole = np.zeros_like(part)
        whole[where] = grad
        for place in list(np.ndindex(part.shape))[:: max(part.size // 7, 1)]:
            before = part[place]
            part[place] = before + 1e-5
            above = loss()
            part[place] = before - 1e-5
            below = loss()
            part[place] = before
            assert abs((above - below) / 2e-5 - whole[place]) < 1e-4, (name, place)


# --- 8 urls -------------------------------------------------------------------------------


def test_url_rules_and_parts(spark):
    urls = ["http://A.Example.ORG/es/1", "http://x.org", "https://org/", "http://example.org/en/1x?q",
            "http://example.org/en/2", "ftp://y.com/de/", "http://y.com/fr/#a", "http://nocom/fr/",
            "no host", None, "", "http://q.net?://x.org/", "//x.org/", "://z.org/#", "http://x.orgs/"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)],
                                  "page_id int, url string, host string")
    found = {r.page_id: r for r in url_filter.judge(pages).collect()}
    rules = [found[i].rule for i in range(len(urls))]
    assert rules == ["example.org/es/", None, "org/", "example.org/en/1", "org/", "com/de/",
                     "com/fr/", None, None, None, None, None, None, "org/", None]
    assert (found[0].host, found[0].path) == ("a.example.org", "/es/1")
    assert (found[9].host, found[9].path) == ("", "") and (found[1].path) == ""
    assert all(r.verdict in ("allow", "block") for r in found.values())
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_models_tell_apart(spark):
    rows = [(i, f"http://good{i % 7}.x.org/news/{i}") for i in range(60)]
    rows += [(i, f"http://pills{i % 7}.y.com/de/buy/{i}") for i in range(60, 120)]
    rows += [(200, "http://good3.z.net/news/7"), (201, "http://pills3.z.net/buy/7")]
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id int, url string"))
    found = {r.page_id: r.verdict for r in judged.collect()}
    assert found[200] == "allow" and found[201] == "block"


def test_url_scores_equal_a_plain_model(spark):
    """The same models counted and smoothed in Python."""
    rows = [(i, f"http://h{i % 5}.a.org/{i % 11}") for i in range(40)]
    rows += [(i, f"http://h{i % 4}.b.com/de/{i % 13}") for i in range(40, 90)] + [(99, "http://h.net/1")]
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id int, url string"))
    found = {r.url: r.score for r in judged.collect()}
    kinds = {u: "allow" if ".org" in u else "block" for _, u in rows if ".net" not in u}
    train = {u: k for u, k in kinds.items() if int(hashlib.md5(u.encode()).hexdigest()[:7], 16) % 5}
    counts, before, letters = Counter(), Counter(), set()
    for u, k in train.items():
        text = "\x02" * 4 + u + "\x03"
        for i in range(4, len(text)):
            letters.add(text[i])
            for n in range(5):
                counts[k, text[i - n : i + 1]] += 1
                before[k, text[i - n : i]] += 1

    def chance(k, gram):
        p = 1 / (len(letters) + 1)
        for n in range(5):
            part = gram[4 - n :]
            p = (counts[k, part] + 2 * p) / (before[k, part[:-1]] + 2)
        return p

    for u, score in found.items():
        text = "\x02" * 4 + u + "\x03"
        grams = [text[i - 4 : i + 1] for i in range(4, len(text))]
        gain = sum(math.log(chance("allow", g)) - math.log(chance("block", g)) for g in grams)
        assert abs(gain / len(grams) - score) < 2e-6


# --- 9 lines ------------------------------------------------------------------------------


def dedup_plainly(rows):
    """Each line against all earlier ones."""
    seen, result = [], {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in text.split("\n"):
            words = {w for w in re.split("[\x20\x09-\x0d]+", line) if w}
            if not words:
                kept.append(line)
                continue
            if not any(9 * len(words & s) >= 4 * (len(words) + len(s)) for s in seen):
                kept.append(line)
            seen.append(words)
        result[doc] = "\n".join(kept)
    return result


def test_lines_equal_brute_force(spark):
    random = np.random.default_rng(4)
    rows = []
    for doc in range(60):
        lines = []
        for _ in range(random.integers(1, 8)):
            size = int(random.choice([1, 2, 3, 4, 5, 9, 20, 60]))
            words = random.zipf(1.3, size) % 40
            lines.append(" ".join(f"t{w}" for w in words))
            if rows and random.random() < 0.6:
                old = str(random.choice(rows[random.integers(len(rows))][1].split("\n"))).split()
                for _ in range(random.integers(0, 3)):
                    if old:
                        old[random.integers(len(old))] = f"n{random.integers(99)}"
                lines.append(" ".join(old))
        lines.append("")
        rows.append((doc, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, frequent=10).collect()}
    assert found == dedup_plainly(rows)


def test_lines_odd_rows(spark, clashing):
    rows = line_dedup.dedup_lines(clashing).collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_kept))
    text = "one two three four five six seven. Again here!\nSecond line of it"
    assert len(rows) == 10 and found[1] == [(text, 2, 2)] * 2 and found[7] == [("", 2, 0)]
    assert found[2] == [(None, 0, 0)] and found[3] == [("", 1, 1)] and found[4] == [(" \n\t", 2, 2)]
    assert found[6] == [(LONG, 1, 1)] and found[None] == [("no id here", 1, 1)]
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_a_large_group_of_near_lines(spark):
    """Copies of a long line with one word changed: all but the first go."""
    base = [f"common{i}" for i in range(40)]
    rows = [(i, " ".join(base[: i % 40] + [f"own{i}"] + base[i % 40 + 1 :])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.dedup_lines(docs)
    assert [r.doc_id for r in found.filter("n_kept > 0").collect()] == [0]


def test_a_large_group_of_lines_that_are_not_near(spark, monkeypatch):
    """Variants of a long line, each too far from the others: few become pairs, all stay."""
    base = [f"common{i}" for i in range(40)]
    rows = []
    for i in range(300):
        own = {(i * 7 + 5 * k) % 40: f"own{i}x{k}" for k in range(8)}
        rows.append((i, " ".join(own.get(at, word) for at, word in enumerate(base))))
    pairs, settle = [], line_dedup.settle

    def counted(frame, name):
        written = settle(frame, name)
        if name == "line-pairs":
            pairs.append(written.count())
        return written

    monkeypatch.setattr(line_dedup, "settle", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).filter("n_kept = 1").count() == 300
    assert sum(pairs) < 10 * len(rows)


def test_similar_lines_meet_once_and_not_at_every_pair(spark, monkeypatch):
    """Lines that move on word by word: each resembles the one before, none the first of its pairs."""
    rows = [(i, " ".join(f"moving{k}" for k in range(3 * i, 3 * i + 40))) for i in range(60)]
    met, verified = [], line_dedup._verified

    def counted(pairs, *others):
        met.append((pairs.count(), pairs.distinct().count()))
        return verified(pairs, *others)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.dedup_lines(docs)
    assert [r.doc_id for r in found.filter("n_kept > 0").collect()] == [0]
    joined, pairs = met[1]
    assert 0 < pairs <= joined < 3 * pairs


# --- 10 near duplicates -------------------------------------------------------------------


def test_signatures_estimate_weighted_jaccard():
    random = np.random.default_rng(6)
    shingles = random.integers(1, 1 << 62, 300).astype(np.uint64)
    a, b = random.integers(1, 20, (2, 300))
    owner = np.repeat([0, 1], 300)
    times = near_dedup.signatures(owner, np.tile(shingles, 2), np.concatenate([a, b]), 2, 4000)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((times[0] == times[1]).mean() - truth) < 0.03


def test_near_classes_equal_brute_force(spark):
    random = np.random.default_rng(7)
    texts = []
    for _ in range(25):
        base = [f"x{w}" for w in random.integers(0, 3000, random.integers(3, 120))]
        for _ in range(random.integers(1, 7)):
            copy = list(base)
            for _ in range(random.integers(0, 3)):
                copy[random.integers(len(copy))] = f"y{random.integers(99)}"
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0], "a b", "a b", "a c", "", "", " "]
    rows = list(enumerate(texts))
    parent = list(range(len(rows)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, x in rows:
        for j in range(i):
            y = rows[j][1]
            if (x == y and x.split()) or near_dedup.similar(x, y):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.classify(docs).collect()}
    assert found == {i: root(i) for i, _ in rows}
    kept = sorted(r.doc_id for r in near_dedup.drop_near(docs).collect())
    assert kept == sorted({root(i) for i, _ in rows})


def test_similarity_counts_repeats():
    assert near_dedup.similar("a b c d e " * 9, "a b c d e " * 9)
    assert not near_dedup.similar("a b c d e " * 9, "a b c d e " * 4)
    assert not near_dedup.similar("", "") and near_dedup.similar("a b", "a b")


def test_near_odd_rows(spark, clashing):
    rows = Counter((r.doc_id, r.class_id) for r in near_dedup.classify(clashing).collect())
    assert rows == {(1, 1): 2, (2, 2): 1, (3, 3): 1, (4, 4): 1, (5, 5): 1, (6, 6): 1,
                    (None, None): 1, (7, 1): 1, (8, 8): 1}
    kept = Counter(r.doc_id for r in near_dedup.drop_near(clashing).collect())
    assert kept == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, None: 1, 8: 1}
    assert near_dedup.classify(empty(spark)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r.id: r.label for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
