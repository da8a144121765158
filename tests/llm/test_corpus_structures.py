"""The prefix trie, the suffix arrays and the phrases against brute force, with NULLs, empty and
very long texts, ties, repeated rows, empty tables and columns that clash in name."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.llm import induced, phrases, suffix_dedup, trie

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string"


@pytest.fixture
def small_batches(spark):
    """Several Arrow batches even of small tables."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "20")
    yield
    spark.conf.set(name, before)


# --- 11 prefix trie -----------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(own)] for conv, own in turns.items()}
    whole = {}
    for conv, own in turns.items():
        taken = zlib.crc32(str(conv).encode()) % 9
        whole[conv] = tuple(turns.get(conv - conv % 5, [])[:taken]) + tuple(own[taken:])
    members, children = defaultdict(list), defaultdict(set)
    for conv in sorted(whole):
        for depth in range(len(whole[conv]) + 1):
            members[whole[conv][:depth]].append(conv)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += path not in children
            saved[path[:depth]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    return Counter(
        (convs[0], len(path), members[path[:-1]][0] if path else None, len(convs),
         len(children[path]) if path in children else 0, leaves[path], saved[path],
         hashlib.sha256(",".join(
             str(c) for c in convs if len(whole[c]) == len(path)).encode()).hexdigest())
        for path, convs in members.items()
    )


def found_trie(rows, shard=trie.SHARD):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens", "ends_sha256")
    return Counter(tuple(r[n] for n in names) for r in trie.prefix_trie(rows, shard).collect())


def test_trie_over_many_shards(spark, small_batches):
    pick = random.Random(3)
    rows = [(pick.randrange(40), pick.choice([None, *range(9)]), pick.choice([None, "u", "a"]),
             pick.choice([None, "é", "x", "yy"])) for _ in range(250)]
    # A conversation of a third of all turns, with repeated rows and equal turns.
    rows += [(7, i, "u", pick.choice("ab")) for i in range(100)] + [(7, 3, "u", "twice")] * 30
    rows += [(10, i, "u", f"t{i % 3}") for i in range(60)] + [(None, 1, "u", "x"), (-7, 1, "u", "x")]
    assert found_trie(spark.createDataFrame(rows, TURNS), shard=40) == brute_trie(rows)


def test_trie_of_equal_conversations(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 200, 5) for t in range(3)]
    rows += [(c, 0, "u", "short") for c in range(1, 60, 5)]
    table = spark.createDataFrame(rows, TURNS)
    assert found_trie(table) == brute_trie(rows)
    # Names that the operator uses on the way are nobody's business.
    clashing = table.select("*", *[F.lit("mine").alias(n) for n in ("conv", "part", "n", "pos")])
    assert found_trie(clashing) == brute_trie(rows)
    assert found_trie(spark.createDataFrame([], TURNS)) == Counter()


def test_node_table_is_minimal_and_verifies():
    random_ = np.random.default_rng(2)
    a, b = (random_.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(2))
    table = trie.NodeTable(a, b)
    slots = table.slots(a, b)
    assert sorted(slots.tolist()) == list(range(5000))
    assert (table.slots(a, b + np.uint64(1)) == -1).all()


# --- 12 suffix arrays ---------------------------------------------------------------------


@pytest.mark.parametrize("letters", [1, 2, 3, 25])
def test_suffix_array_and_prefixes(letters):
    pick = random.Random(letters)
    for trial in range(25):
        size = pick.randrange(1, 300)
        body = [pick.randrange(2, 2 + letters) for _ in range(size)]
        if trial % 3 == 0:
            body = (body[:7] * 60)[:size]
        for at in range(0, size, pick.randrange(5, 90)):
            body[at] = 1
        text = [*body, 0]
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        order = induced.suffix_array(np.array(text, np.int16), 258)
        assert order.tolist() == expected
        prefixes = induced.common_prefixes(np.array(text, np.int16), order, 1)
        for left, right in zip(expected, expected[1:], strict=False):
            shared = 0
            while text[left + shared] == text[right + shared] > 1:
                shared += 1
            assert prefixes[right] == shared


def brute_removed(rows, length=suffix_dedup.LENGTH):
    """doc_id -> (kept bytes, spans), from every window of every text."""
    seen, results = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for start in range(len(data) - length + 1):
            window = data[start : start + length]
            if window in seen:
                gone[start : start + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0])).reshape(-1, 2).tolist()
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        results[doc] = (kept, [tuple(edge) for edge in edges])
    return results


def repeating_documents():
    pick = random.Random(5)
    words = ["the", "sea", "été", "ox", "of", "a", "longer", "word", "日本"]

    def text(n):
        return " ".join(pick.choice(words) for _ in range(n))

    passage, line, base = text(40), "a line that very many documents share, sixty-four bytes", text(90)
    rows = [(i, text(pick.randrange(5, 60))) for i in range(40)]
    rows += [(100 + i, f"{text(20)} {passage} {text(20)}") for i in range(8)]
    rows += [(200 + i, f"{text(12)}\n{line}\n{text(12)}") for i in range(60)]
    rows += [(300 + i, base) for i in range(5)]
    rows += [(400 + i, base.replace("ox", f"ox{i}", 1 + i)) for i in range(5)]
    rows += [(500, "ab" * 300), (501, "x" * 700), (502, "ab" * 200), (503, None), (504, ""),
             (505, passage[:50]), (None, passage), (506, f"{passage} {passage}")]
    return rows


@pytest.mark.parametrize("wide", [1, 32])
def test_repeats_equal_brute_force(spark, monkeypatch, wide):
    # With 1, every anchor with two different pieces is cut into windows.
    monkeypatch.setattr(suffix_dedup, "WIDE", wide + 1)
    rows = repeating_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.without_repeats(docs, shard=4000).collect()
    expected = brute_removed(rows)
    assert len(found) == len(rows)
    for r in found:
        assert (bytes(r.kept), [tuple(s) for s in r.removed]) == expected[r.doc_id], r.doc_id
    assert sum(len(spans) for _, spans in expected.values()) > 20


def test_repeats_over_long_texts(spark, monkeypatch):
    pick = random.Random(9)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    suffix_dedup._powers.cache_clear()
    part = "".join(pick.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, part), (2, "x" + part[3000:] + part[:500]), (3, part[100:220] * 30)]
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = brute_removed(rows)
    assert {r.doc_id: bytes(r.kept) for r in found.collect()} == {
        doc: kept for doc, (kept, _) in expected.items()}
    monkeypatch.undo()
    suffix_dedup._powers.cache_clear()


def test_repeats_odd_rows(spark):
    pick = random.Random(1)
    long = "".join(pick.choice("abcdefgh ") for _ in range(300))
    rows = [(1, long), (1, long), (1, long[50:]), (None, long), (None, long), (2, None), (3, "")]
    # All rows in one task.
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    names = ("doc", "tag", "parts", "cut", "start", "size", "h", "_doc", "KEPT", "removed")
    clashing = docs.select("*", *[F.lit("mine").alias(n) for n in names])
    result = suffix_dedup.without_repeats(clashing)
    assert result.columns == ["doc_id", "text", *names[:-2], "kept", "removed"]
    found = result.collect()
    assert all(r[n] == "mine" for r in found for n in names[:-2])
    kept = Counter((r.doc_id, r.text, bytes(r.kept)) for r in found)
    # NULL comes first; rows equal in id and text share their fate.
    whole = long.encode()
    assert kept == Counter({
        (None, long, whole): 2, (1, long, b""): 2, (1, long[50:], b""): 1, (2, None, b""): 1,
        (3, "", b""): 1})
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


# --- 13 phrases ---------------------------------------------------------------------------


def brute_phrases(rows, longest, least, top):
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    results = []
    for lang, grams in counts.items():
        frequent = {p: a for p, a in grams.items() if len(p) > 1 and a >= least}
        inner = {
            p[i : i + size] for p, a in frequent.items() for size in range(2, len(p))
            for i in range(len(p) - size + 1) if a >= grams[p[i : i + size]]
        }
        ranked = []
        for p, a in frequent.items():
            if p not in inner:
                cuts = [(1000 * a * totals[lang] // (grams[p[:k]] * grams[p[k:]]), k)
                        for k in range(1, len(p))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), grams[p[:k]], grams[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            results.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(results)


def found_phrases(docs, **options):
    return sorted(tuple(r) for r in phrases.phrases(docs, **options).collect())


def test_phrases_equal_brute_force(spark):
    pick = random.Random(4)
    words = ["Ab", "ab", "cd", "é", "ef\x1cg", "\xa0h", "of the sea", "x y z w v u"]

    def text():
        return "".join(pick.choice(words) + pick.choice([" ", " ", "\t ", ", ", "\n"])
                       for _ in range(pick.randrange(0, 60)))

    rows = [(i, text(), pick.choice(["en", "fr", None, "und"])) for i in range(120)]
    rows += [(200, None, "en"), (201, "", "fr"), (202, " ,;\t", "de")] + [(203, text(), "en")] * 3
    rows.append((204, " ".join(pick.choice(words) for _ in range(5000)), "en"))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    for longest, least, top, shard in ((5, 6, 20, 1 << 20), (5, 3, 1000, 700), (2, 10, 50, 2000)):
        assert found_phrases(docs, longest=longest, least=least, top=top, shard=shard) == (
            brute_phrases(rows, longest, least, top)
        )


def test_phrases_odd_rows(spark):
    rows = [(1, "a b " * 30, "en")]
    names = ("rank", "phrase", "a", "l", "r", "n", "score", "shard", "keys")
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("x").alias(n) for n in names])
    assert found_phrases(docs, least=5) == brute_phrases(rows, 5, 5, 2000)
    assert found_phrases(docs.limit(0)) == []


def test_shards_keep_every_word():
    text = b"a b\xffc\xff\xffd a b"
    words, vocabulary, width, bwt = phrases.index_row(text)
    index = phrases.Shard(vocabulary, width, bwt)
    assert words == 6 and width == 2
    assert dict(zip(index.words, index.counts.tolist(), strict=True)) == {
        b"a": 2, b"b": 2, b"c": 1, b"d": 1}
    index.extend()
    pairs = [(index.words[index.first[s] - 1], int(c))
             for s, c in zip(index.starts, index.counts, strict=True)]
    assert sorted(pairs) == [(b"a", 2), (b"d", 1)]
