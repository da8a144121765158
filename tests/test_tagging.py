from conftest import plan_of
from pyspark.sql import functions as F

from textstyle.operators.tagging import apply_lexicon, tag_documents, train_lexicon


def test_word_then_ending_then_default(spark):
    tagged = spark.createDataFrame(
        [("Chante", "V"), ("chante", "V"), ("chante", "N"), ("le", "D"), ("le", "P"),
         ("plante", "N"), ("plante", "N"), ("plante", "N")],
        "word string, tag string",
    )
    lexicon, endings = train_lexicon(tagged)
    tokens = spark.createDataFrame(
        [("CHANTE",), ("le",), ("tante",), ("zzz",), ("le",)], "word string"
    )
    rows = apply_lexicon(tokens, lexicon, endings, default="?").collect()
    assert sorted((r.word, r.tag) for r in rows) == [
        ("CHANTE", "V"), ("le", "D"), ("le", "D"), ("tante", "N"), ("zzz", "?")
    ]


def test_documents_are_tagged_in_token_order(spark, make_corpus):
    tagged = spark.createDataFrame(
        [("le", "D"), ("chat", "N"), (",", "P"), ("dort", "V")], "word string, tag string"
    )
    lexicon, endings = train_lexicon(tagged)
    corpus = make_corpus("Le chat, le chat dort", "", "xyz , LE", None)
    twice = corpus.union(corpus.filter("id = 'd2'"))
    found = sorted((r.id, r.pos) for r in tag_documents(twice, lexicon, endings, "?").collect())
    assert found == [("d0", ["D", "N", "P", "D", "N", "V"]), ("d2", ["?", "P", "D"]),
                     ("d2", ["?", "P", "D"])]


def test_words_travel_once_per_document(spark, make_corpus):
    lexicon, endings = train_lexicon(spark.createDataFrame([("a", "X")], "word string, tag string"))
    plan = tag_documents(make_corpus("a a a a"), lexicon, endings)
    shuffled = plan._jdf.queryExecution().executedPlan().toString()
    # One exchange for each join side that is not broadcast, and one to gather documents.
    assert shuffled.count("Generate ") == 1 and "posexplode" not in shuffled


def test_places_are_sorted_as_numbers(spark, make_corpus):
    lexicon, endings = train_lexicon(spark.createDataFrame(
        [(f"w{i}", f"T{i % 7}") for i in range(900)], "word string, tag string"))
    corpus = make_corpus(" ".join(f"W{i * 37 % 1000}" for i in range(3000)))
    pos = tag_documents(corpus, lexicon, endings, "?").first().pos
    known = {f"w{i}": f"T{i % 7}" for i in range(900)}
    ending = {r.ending: r.ending_tag for r in endings.collect()}
    expected = [f"w{i * 37 % 1000}" for i in range(3000)]
    assert pos == [known.get(w) or ending.get(w[-3:], "?") for w in expected]
    # Numbers, not structs of words, are what the rows sort.
    plan = plan_of(tag_documents(corpus, lexicon, endings))
    assert "sort_array" in plan and "shiftleft" in plan


def test_document_tags_shuffle_tokens_once_for_the_lexicon(spark, tmp_path):
    from textstyle.plans.registry import QUERIES

    rows = [(i, f"Le chat {i} dort.", "s", "fr" if i % 2 else "en") for i in range(20)]
    spark.createDataFrame(
        [*rows, (None, None, None, None), (3, "Le chat", None, None)],
        "doc_id long, text string, source string, lang string",
    ).write.parquet(f"{tmp_path}/documents.parquet")
    tags = QUERIES["document_tags"](spark, str(tmp_path))
    # Both lexicons are read as written: nothing is left of their training in this plan.
    assert plan_of(tags).count("regexp_extract_all") == 1
    assert tags.count() == 21 and tags.filter(F.length("pos") == 0).count() == 0
