from textstyle.operators.dialogue import (
    add_segmentation,
    add_up_blocks,
    column_means,
    dialogue_counts,
    dialogue_stats,
    flatten_segmentation,
)

SAMPLE = (
    "— Bonjour, dit-il.\nIl marcha.\nElle dit « oui » et partit.\n\n“Hello” he said\n"
    "\xa0« NBSP lead\n- liste\n-\n"
)


def test_segments_of_the_sample(make_corpus):
    seg = add_segmentation(make_corpus(SAMPLE)).first().seg
    assert (seg.dialog_lines, seg.narration_lines, seg.dialog_ratio) == (5, 3, 0.625)
    assert seg.dialog_text.split("\n") == [
        "— Bonjour, dit-il.", "Elle dit « oui » et partit.", "\xa0« NBSP lead", "- liste", "-"
    ]
    assert seg.narration_text.split("\n") == ["Il marcha.", "", "“Hello” he said"]


def test_empty_and_missing_texts(make_corpus):
    rows = add_segmentation(make_corpus("", None, "\n", "\x1f-q")).orderBy("id").collect()
    assert [tuple(r.seg) for r in rows] == [
        (0, 0, 0.0, "", ""), (0, 0, 0.0, "", ""), (0, 1, 0.0, "", ""), (1, 0, 1.0, "\x1f-q", "")
    ]


def test_schema(make_corpus):
    kind = dict(add_segmentation(make_corpus("")).dtypes)["seg"]
    assert kind == (
        "struct<dialog_lines:int,narration_lines:int,dialog_ratio:double,dialog_text:string,"
        "narration_text:string>"
    )


def test_stats_from_struct_and_from_counts_agree(make_corpus):
    corpus = make_corpus(SAMPLE, "rien\nrien", "")
    one = dialogue_stats(add_segmentation(corpus)).first()
    two = dialogue_stats(dialogue_counts(corpus)).first()
    assert one == two
    assert one.nb_texts == 3 and abs(one.avg_dialog_ratio - 0.625 / 3) < 1e-12
    means = column_means(flatten_segmentation(add_segmentation(corpus))).first()
    assert means.dialog_ratio == one.avg_dialog_ratio
    assert set(means.asDict()) == {"author", "genre", "dialog_lines", "dialog_ratio"}


def test_blocks_add_up(spark):
    rows = [("x", "a", "g", "- a\nb"), ("x", "a", "g", "c"), ("y", "a", "g", "")]
    blocks = spark.createDataFrame(rows, "id string, author string, genre string, text string")
    found = {r.id: (r.dialog_lines, r.narration_lines, r.dialog_ratio)
             for r in add_up_blocks(blocks).collect()}
    assert found == {"x": (1, 2, 1 / 3), "y": (0, 0, 0.0)}
