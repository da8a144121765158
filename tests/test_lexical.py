import random
from collections import Counter

from textstyle.functions.text import STOPWORDS
from textstyle.operators import lexical
from textstyle.operators.corpus import only_documents
from textstyle.operators.lexical import (
    representative_documents,
    representative_words,
    word_frequencies,
    zipf_curve,
    zipf_table,
    zipf_table_of_blocks,
)


def test_stopwords():
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 54


def test_ties_share_a_rank(make_corpus):
    corpus = make_corpus("Chat chat chien Chien oiseau le le le cœur , l'eau")
    rows = {r.word: (r.frequency, r.rank) for r in zipf_table(corpus, 200, ["le"]).collect()}
    assert rows == {"chat": (2, 1), "chien": (2, 1), "oiseau": (1, 3), "cur": (1, 3),
                    "leau": (1, 3)}
    top = {r.word for r in zipf_table(corpus, 2, ["le"]).collect()}
    assert top == {"chat", "chien"}


def test_both_ways_agree_with_plain_python(make_corpus):
    rng = random.Random(5)
    vocabulary = ["mot" + chr(97 + i) for i in range(26)] + ["le", "la", ",", "1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=n)) for n in (0, 1, 50, 400, 3000)]
    corpus = make_corpus(*texts, "le la", None)
    expected = set()
    for i, one in enumerate(texts):
        counts = Counter(w for w in one.split() if w.startswith("mot"))
        for word, n in counts.items():
            rank = 1 + sum(m > n for m in counts.values())
            if rank <= 10:
                expected.add((f"d{i}", word, n, rank))
    for count in (zipf_table, zipf_table_of_blocks):
        rows = count(corpus, 10).collect()
        assert {(r.id, r.word, r.frequency, r.rank) for r in rows} == expected
        assert len(rows) == len(expected)


def test_one_word_repeated_many_times(make_corpus):
    row = word_frequencies(make_corpus("mot " * 60_000)).first()
    assert (row.word, row.frequency) == ("mot", 60_000)


def test_counts_add_up_over_rows_of_one_id(spark):
    rows = [("d", "a", "t", "g", "chat chat chien"), ("d", "a", "t", "g", "chien chien")]
    blocks = spark.createDataFrame(
        rows, "id string, author string, title string, genre string, text string"
    )
    found = {r.word: (r.frequency, r.rank)
             for r in zipf_table_of_blocks(blocks).collect()}
    assert found == {"chien": (3, 1), "chat": (2, 2)}


def test_curve_and_representative_words(spark, make_corpus):
    corpus = make_corpus("chat chat chien", "chien chien chien oiseau", "chat chat chat")
    zipf = zipf_table(corpus)
    chosen = representative_documents(zipf)
    assert [(r.author, r.id) for r in chosen.collect()] == [("a", "d1")]
    words = representative_words(only_documents(zipf, chosen), head=1).collect()
    assert [(r.word, r.frequency) for r in words] == [("chien", 3)]
    curve = {r["rank"]: r.log_freq for r in zipf_curve(zipf, "genre").collect()}
    assert set(curve) == {1, 2} and curve[2] == 0.0


def test_a_stop_list_as_a_table_equals_the_literal_one(spark, make_corpus):
    corpus = make_corpus("Le chat et le chien, le Chat!", "le la les", "", None, "été Été peut-être")
    stoplist = spark.createDataFrame([(w.upper(),) for w in STOPWORDS] * 2, "word string")
    found = lexical.zipf_table_without(corpus, stoplist, 2)
    expected = lexical.zipf_table(corpus, 2)
    assert found.columns == expected.columns
    assert sorted(found.collect()) == sorted(expected.collect())
    long = spark.range(100_000).selectExpr("translate(CAST(id AS STRING), '0123456789', 'abcdefghij') AS word")
    assert lexical.zipf_table_without(corpus, long).count() == lexical.zipf_table(corpus, 200, ()).count()
    assert lexical.zipf_table_without(corpus, stoplist.limit(0)).count() == 9
