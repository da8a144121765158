import zipfile
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from textstyle.operators.readability import add_up_blocks, document_metrics
from textstyle.operators.windows import block_windows, readability_windows
from textstyle.plans import registry
from textstyle.plans.job import corpus_from_folders
from textstyle.sources import files

RULES = (("sand", ("sand",)), ("zola", ("zola",)))


def write_epub(path, chapters):
    items = "".join(
        f'<item id="c{i}" href="c%20{i}.xhtml" media-type="application/xhtml+xml"{extra}/>'
        for i, (_, extra) in enumerate(chapters)
    )
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "META-INF/container.xml",
            '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles>'
            '<rootfile full-path="OEBPS/content.opf"/></rootfiles></container>',
        )
        book.writestr(
            "OEBPS/content.opf",
            f'<package xmlns="http://www.idpf.org/2007/opf"><manifest>{items}'
            '<item id="s" href="s.css" media-type="text/css"/></manifest></package>',
        )
        for i, (markup, _) in enumerate(chapters):
            book.writestr(f"OEBPS/c {i}.xhtml", markup)


def make_folder(tmp_path):
    (tmp_path / "sand_1.txt").write_bytes("Été\r\nun\rdeux".encode())
    (tmp_path / "sand_2.txt").write_bytes(b"\xff\xfe broken")
    (tmp_path / "sand_3.txt").write_text("third")
    (tmp_path / "hugo.txt").write_text("x" * 50)
    write_epub(
        tmp_path / "zola_1.EPUB",
        [("<html><head><title>no</title></head><body><p>Un&eacute;</p></body></html>", ""),
         ("<html><body>toc</body></html>", ' properties="nav"'),
         ("<html><body><p>Deux</p></body></html>", "")],
    )
    (tmp_path / "zola_2.epub").write_bytes(b"not a zip")
    return str(tmp_path)


def test_whole_folder(spark, tmp_path):
    books = files.load_folder(spark, make_folder(tmp_path), None, 12, RULES)
    found = {r.filename: r for r in books.collect()}
    assert set(found) == {"sand_1.txt", "sand_3.txt", "hugo.txt", "zola_1.EPUB", "zola_2.epub"}
    assert found["sand_1.txt"].text == "Été\nun\ndeux"
    assert found["hugo.txt"].text == "x" * 12 and found["hugo.txt"].author == "unknown"
    assert found["zola_1.EPUB"].text.split() == ["Uné", "toc", "D"]
    assert "\n" in found["zola_1.EPUB"].text and found["zola_1.EPUB"].error is None
    assert found["zola_2.epub"].text == "" and "BadZipFile" in found["zola_2.epub"].error
    known = files.load_folder(spark, str(tmp_path), None, None, RULES, keep_unknown=False)
    assert "hugo.txt" not in {r.filename for r in known.collect()}


def test_cap_counts_unreadable_files(spark, tmp_path):
    folder = make_folder(tmp_path)
    two = files.load_folder(spark, folder, 2, None, RULES).collect()
    assert {r.filename for r in two} == {"sand_1.txt", "hugo.txt", "zola_1.EPUB", "zola_2.epub"}


def test_navigation_is_kept_unless_left_out(spark, tmp_path):
    write_epub(tmp_path / "a.epub", [("<p>one</p>", ""), ("<p>toc</p>", ' properties="nav"')])
    for navigation, words in ((True, ["one", "toc"]), (False, ["one"])):
        read = files.load_folder(spark, str(tmp_path), navigation=navigation).first()
        assert read.text.split() == words


def test_plain_text_needs_no_python(spark, tmp_path):
    stored = spark.read.format("binaryFile").load(make_folder(tmp_path))
    plan = files.plain_text(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_listing_opens_no_file(spark, tmp_path):
    listed = files.list_files(spark, make_folder(tmp_path), "*.txt")
    assert listed.count() == 4
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_corpus_from_folders(spark, tmp_path):
    for genre in ("romantic", "realism"):
        (tmp_path / genre).mkdir()
        make_folder(tmp_path / genre)
    folders = {genre: str(tmp_path / genre) for genre in ("romantic", "realism")}
    rows = corpus_from_folders(spark, folders, 1, 3, RULES).collect()
    assert {r.id for r in rows} == {f"{g}_{i}" for g in folders for i in range(3)}
    assert {r.title for r in rows} == {"sand_1.txt", "hugo.txt", "zola_1.EPUB"}
    assert all(len(r.text) <= 3 and r.id.startswith(r.genre) for r in rows)


def test_names_with_glob_characters(spark, tmp_path):
    names = {"sand [1].txt", "sand {a,b}.txt", "sand é?.txt", "zola*.txt"}
    for name in names:
        (tmp_path / name).write_text(name)
    for cap in (None, 5):
        rows = files.load_folder(spark, str(tmp_path), cap, None, RULES).collect()
        assert {(r.filename, r.text) for r in rows} == {(name, name) for name in names}


def test_stored_books_of_any_language_and_author(spark, tmp_path):
    rows = [(i, text, source, lang, 1) for i, (text, source, lang) in enumerate([
        ("one\nmore", "src25", "it"), ("two", "Src25", "it"), ("three", "a/b", None), ("four", None, "de"),
        *[(f"w{i}", "src1", "de") for i in range(2500)],
    ])]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    lines = registry.folder_lines(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, lines)) == Counter(
        (r[3], r[2], line) for r in rows for line in r[1].split("\n")
    )
    cut = {(r.genre, r.author): r.text for r in registry.folder_scan(spark, str(tmp_path)).collect()}
    assert cut["de", "src1"] == "".join(f"w{i}\n" for i in range(2500))[:5000]
    assert cut["it", "Src25"] == "two\n" and cut[None, "a/b"] == "three\n" and cut["de", None] == "four\n"


def test_the_capped_folder_has_few_files(spark, tmp_path, monkeypatch):
    odd = ["\\n\\\\\n\\\\n\r\nend\\", "a\0b\rc\n", None, "", "\n\n", "\\"]
    rows = [(i, text, f"s{i}", "fr", 1) for i, text in enumerate(odd)]
    rows += [(i, f"later {i}", f"s{i % len(odd)}", "fr", 1) for i in range(len(odd), 1200)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    written = f"{tmp_path}/written"
    monkeypatch.setattr(registry.tables, "work_folder", lambda spark: written)
    got = {r.author: r.text for r in registry.folder_capped(spark, str(tmp_path)).collect()}
    plain = [(text or "").replace("\r\n", "\n").replace("\r", "\n") for text in odd]
    assert got == {f"s{i}": text for i, text in enumerate(plain)}
    assert len(list(Path(written).rglob("*.txt"))) < 100


def test_chapters_equal_whole_books(spark, tmp_path):
    folder = make_folder(tmp_path)
    long = "".join(f"<p>Une peut-être maison {i}.</p>" for i in range(300))
    write_epub(tmp_path / "sand_9.epub", [(f"<body>{long}</body>", "")] * 3 + [("<p>Fin</p>", "")])
    write_epub(tmp_path / "empty.epub", [])
    books = spark.read.format("binaryFile").load(folder).filter(files.is_epub())
    whole = files.epub_text(books)
    chapters = files.epub_chapters(books)
    names = {r.path.rsplit("/", 1)[1]: r for r in files.joined_chapters(chapters).collect()}
    assert {name: (r.text, r.error) for name, r in names.items()} == {
        r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in whole.collect()}
    assert names["zola_2.epub"].error and not names["empty.epub"].error
    longest = chapters.agg(F.max(F.length("text"))).first()[0]
    assert longest < whole.agg(F.max(F.length("text"))).first()[0] / 2

    def corpus(table):
        return table.selectExpr(
            "path AS id", "'a' AS author", "'g' AS genre", "'t' AS title", "*").drop("path", "error")

    configs = [(500, 250), (40, 40)]
    by_chapter = block_windows(corpus(chapters), "number", configs)
    of_whole = readability_windows(corpus(whole), configs)
    columns = sorted(of_whole.columns)
    assert sorted(by_chapter.select(*columns).collect()) == sorted(of_whole.select(*columns).collect())
    assert by_chapter.count() > 20
    counts = ["id", "word_count", "syllable_count"]
    added = add_up_blocks(corpus(chapters)).select(*counts)
    measured = document_metrics(corpus(whole)).selectExpr(
        "id", "CAST(word_count AS BIGINT)", "CAST(syllable_count AS BIGINT)")
    assert sorted(added.collect()) == sorted(measured.collect())
