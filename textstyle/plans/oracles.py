"""DuckDB SQL that states each registered query independently, over the same tables."""

from __future__ import annotations

from textstyle.functions.text import STOPWORDS

# Java's \s holds the vertical tab, RE2's does not.
_TOKEN = (
    r"[\p{L}\p{M}\p{N}]+(?:[''’\-][\p{L}\p{M}\p{N}]+)*|[^\s\x0B\p{L}\p{M}\p{N}]"
)
_SENTENCE_END = r"[.!?…]+(?:[ \n\r\t]+|\z)"
_LINE_END = r"(?:\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}])"
_SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
    r"\x{205F}\x{3000}]"
)
_OPENS = rf'^{_SPACE}*[«"„—–\-]'
_QUOTED = r'[«"][^»"]*[»"]'
_VOWELS = "[aeiouyàâéèêëîïôùûü]+"
_STOPWORDS = ", ".join(f"'{word}'" for word in STOPWORDS)
_URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

_CORPUS = """corpus AS (
  SELECT doc_id AS id, source AS author, 'doc_' || doc_id AS title, lang AS genre, text
  FROM documents)"""

_SPOKEN = r"""corpus AS (
  SELECT doc_id AS id, source AS author, 'doc_' || doc_id AS title, lang AS genre,
    regexp_replace(regexp_replace(text, '([.!?…]) ([AEIOUÉÈÀ])', E'\\1\n— \\2', 'g'),
      '([a-zà-ÿ]{9,}), ', '« \1 », ', 'g') AS text
  FROM documents)"""

_BLOCKS = """corpus AS (
  SELECT conv_id AS id, 'conv_' || (conv_id % 7) AS author, 'conversation' AS title,
    CASE WHEN conv_id % 2 = 0 THEN 'romantic' ELSE 'realism' END AS genre,
    CASE role WHEN 'user' THEN '— ' || text WHEN 'system' THEN '« ' || text || ' »'
      ELSE text END AS text
  FROM conversations)"""


def _tokens(syllables: str = "count") -> str:
    if syllables == "count":
        groups = f"len(string_split(regexp_replace(lower(w), '{_VOWELS}', '-', 'g'), '-')) - 1"
    else:
        groups = f"len(regexp_extract_all(lower(w), '{_VOWELS}'))"
    return f"""annotated AS (
  SELECT *, regexp_extract_all(text, '{_TOKEN}') AS tokens,
    list_filter(regexp_split_to_array(text, '{_SENTENCE_END}'), lambda x: length(trim(x)) > 0)
      AS sentences
  FROM corpus),
counted AS (
  SELECT *, list_transform(tokens, lambda w: greatest({groups}, 1)) AS syllables
  FROM annotated)"""


def _scored(words: str, sentences: str, syllables: str, flesch: str, km: str) -> str:
    def score(constant: float, weight: float) -> str:
        return (
            f"CASE WHEN {words} = 0 OR {sentences} = 0 THEN 0.0 ELSE "
            f"{constant}::DOUBLE - 1.015::DOUBLE * ({words}::DOUBLE / {sentences})"
            f" - {weight}::DOUBLE * ({syllables}::DOUBLE / {words}) END"
        )

    return f"{score(206.835, 84.6)} AS {flesch}, {score(207.0, 73.6)} AS {km}"


def _metrics(syllables: str = "count", corpus: str = _CORPUS) -> str:
    return f"""{corpus},
{_tokens(syllables)},
counts AS (
  SELECT id, author, title, genre, len(tokens)::INTEGER AS word_count,
    len(sentences)::INTEGER AS sentence_count,
    coalesce(list_sum(syllables), 0)::INTEGER AS syllable_count
  FROM counted),
metrics AS (
  SELECT *, {_scored("word_count", "sentence_count", "syllable_count",
                     "flesch_score", "km_score")}
  FROM counts)"""


_DOC = """SELECT id, author, title, genre, word_count, sentence_count, syllable_count,
  round(flesch_score, 6) AS flesch_score, round(km_score, 6) AS km_score FROM metrics"""

_STATS = """SELECT author, genre, avg(flesch_score) AS avg_flesch, avg(km_score) AS avg_km,
  avg(word_count) AS avg_words, avg(sentence_count) AS avg_sentences
  FROM metrics GROUP BY author, genre"""


def _windows(mode: str) -> str:
    """Tumbling from single tokens and a GROUP BY; sliding from list slices."""
    parts = []
    for size, step in ((500, 250), (1000, 500)):
        if mode == "tumbling":
            parts.append(f"""SELECT id, author, genre, title, (pos // {step})::INTEGER AS window_index,
    count(*) AS word_count, sum(syl)::BIGINT AS syllable_count,
    {size} AS window_size, {step} AS step FROM positions
    WHERE pos < (pos // {step}) * {step} + {size}
    GROUP BY ALL HAVING count(*) >= {size} * 0.5""")
        else:
            parts.append(f"""SELECT id, author, genre, title, (s // {step})::INTEGER AS window_index,
    least(len(syllables) - s, {size})::BIGINT AS word_count,
    list_sum(syllables[s + 1 : s + {size}])::BIGINT AS syllable_count,
    {size} AS window_size, {step} AS step
    FROM (SELECT *, unnest(range(0, len(syllables), {step})) AS s FROM counted)
    WHERE len(syllables) - s >= {size} * 0.5""")
    union = "\n  UNION ALL ".join(parts)
    return f"""{_CORPUS},
{_tokens()},
positions AS (
  SELECT id, author, genre, title, unnest(syllables) AS syl,
    unnest(range(len(syllables))) AS pos FROM counted),
sized AS ({union}),
windows AS (
  SELECT id, author, genre, title, window_index, word_count, syllable_count,
    word_count / 20.0::DOUBLE AS sentence_count,
    {_scored("word_count", "(word_count / 20.0::DOUBLE)", "syllable_count", "flesch", "km")},
    window_size, step FROM sized)"""


_WINDOW_ROWS = """SELECT id, author, genre, title, window_index, word_count, syllable_count,
  round(sentence_count, 6) AS sentence_count, round(flesch, 6) AS flesch, round(km, 6) AS km,
  window_size, step FROM windows"""


def _block_windows(corpus: str, order: str, keys: str) -> str:
    """Windows of documents in several rows: their tokens numbered one by one."""
    return f"""WITH {corpus},
{_tokens()},
spoken AS (
  SELECT id, {keys}, {order}, unnest(range(len(syllables))) AS place, unnest(syllables) AS syl
  FROM counted),
placed AS (
  SELECT id, {keys}, syl, row_number() OVER (PARTITION BY id ORDER BY {order}, place) - 1 AS pos
  FROM spoken),
sized AS (
  SELECT id, {keys}, (pos // step)::INTEGER AS window_index, count(*) AS word_count,
    sum(syl)::BIGINT AS syllable_count, size AS window_size, step
  FROM placed, (VALUES (100, 50), (40, 40)) c(size, step)
  WHERE pos % step < size GROUP BY ALL HAVING count(*) >= size * 0.5),
windows AS (
  SELECT *, word_count / 20.0::DOUBLE AS sentence_count,
    {_scored("word_count", "(word_count / 20.0::DOUBLE)", "syllable_count", "flesch", "km")}
  FROM sized)
{_WINDOW_ROWS}"""


def _zipf(top_n: int, corpus: str = _CORPUS) -> str:
    return f"""{corpus},
words AS (
  SELECT id, author, genre, title,
    lower(regexp_replace(w, '[^a-zA-ZÀ-ÿ]', '', 'g')) AS word
  FROM (SELECT *, unnest(regexp_extract_all(text, '{_TOKEN}')) AS w FROM corpus)),
frequencies AS (
  SELECT id, author, genre, title, word, count(*) AS frequency FROM words
  WHERE word <> '' AND word NOT IN ({_STOPWORDS})
  GROUP BY id, author, genre, title, word),
ranked AS (
  SELECT *, (rank() OVER (PARTITION BY id ORDER BY frequency DESC))::INTEGER AS rank
  FROM frequencies),
zipf AS (
  SELECT *, log10(rank::DOUBLE) AS log_rank, log10(frequency::DOUBLE) AS log_freq
  FROM ranked WHERE rank <= {top_n})"""


_ZIPF_ROWS = """SELECT id, author, genre, title, word, frequency, rank,
  round(log_rank, 6) AS log_rank, round(log_freq, 6) AS log_freq FROM zipf"""


def _dialogue(corpus: str) -> str:
    test = f"(regexp_matches(l, '{_OPENS}') OR regexp_matches(l, '{_QUOTED}'))"
    return f"""{corpus},
split AS (
  SELECT *, CASE WHEN text = '' THEN []::VARCHAR[] ELSE
    regexp_split_to_array(regexp_replace(text, '{_LINE_END}\\z', ''), '{_LINE_END}') END AS ls
  FROM corpus),
sorted AS (
  SELECT id, author, genre, title, ls, list_filter(ls, lambda l: {test}) AS d,
    list_filter(ls, lambda l: NOT {test}) AS n FROM split),
segments AS (
  SELECT id, author, genre, title, len(d)::INTEGER AS dialog_lines,
    len(n)::INTEGER AS narration_lines,
    len(d)::DOUBLE / greatest(len(ls), 1) AS dialog_ratio,
    array_to_string(d, E'\\n') AS dialog_text, array_to_string(n, E'\\n') AS narration_text
  FROM sorted)"""


_DIALOGUE_STATS = """SELECT author, genre, round(avg(dialog_ratio), 6) AS avg_dialog_ratio,
  round(avg(dialog_lines), 6) AS avg_dialog_lines,
  round(avg(narration_lines), 6) AS avg_narration_lines, count(*) AS nb_texts
  FROM {table} GROUP BY author, genre"""

_BLOCK_SUMS = f"""{_dialogue(_BLOCKS)},
summed AS (
  SELECT id, author, genre, sum(dialog_lines)::BIGINT AS dialog_lines,
    sum(narration_lines)::BIGINT AS narration_lines FROM segments GROUP BY ALL),
conversations_counted AS (
  SELECT *, dialog_lines::DOUBLE / greatest(dialog_lines + narration_lines, 1) AS dialog_ratio
  FROM summed)"""


def _plain(markup: str) -> str:
    """Markup to text, white space kept; the four references the pages use."""
    text = f"regexp_replace({markup}, '(?is)<(script|style)\\b.*?</(script|style)>', ' ', 'g')"
    text = f"regexp_replace({text}, '(?s)<!--.*?-->', ' ', 'g')"
    text = f"regexp_replace({text}, '(?s)<[^>]+>', ' ', 'g')"
    for name, mark in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{mark}')"
    return text


_STOPPED = r"[\p{L}\p{M}\p{N}]+(?:[.''’\-]+[\p{L}\p{M}\p{N}]+)*"
_ABBREVIATIONS = rf"""found AS (
  SELECT unnest(list_transform(regexp_extract_all(text, '{_STOPPED}\.*'), lambda w: lower(w))) AS f
  FROM documents),
split AS (
  SELECT regexp_replace(f, '\.+$', '') AS word, length(f) - length(word) = 1 AS stopped, count(*) AS n
  FROM found GROUP BY ALL),
counts AS (
  SELECT word, coalesce(sum(n) FILTER (stopped), 0)::DOUBLE AS w,
    coalesce(sum(n) FILTER (NOT stopped), 0)::DOUBLE AS o
  FROM split WHERE regexp_matches(word, '\p{{L}}') GROUP BY word),
totals AS (SELECT sum(w) / sum(w + o) AS p FROM counts),
scored AS (
  SELECT word, w, o, length(replace(word, '.', '')) + 1 AS letters,
    -2 * (w * ln(p) + CASE WHEN o = 0 THEN 0 ELSE o * ln(1 - p) END
      - w * ln(0.99::DOUBLE) - CASE WHEN o = 0 THEN 0 ELSE o * ln(1 - 0.99::DOUBLE) END)
      * exp(-letters) * (length(word) + 2 - letters) * pow(letters, -o) AS score
  FROM counts, totals WHERE w > 0)"""

_LINKED = """linked AS (
  SELECT page_id, url, regexp_replace(html, 'href="/([^"]*)"', 'href="' || CASE page_id % 4
    WHEN 0 THEN '/blob/\\1.TXT' WHEN 1 THEN '../\\1.txt'
    WHEN 2 THEN './d/../\\1.epub#f' ELSE '?p=\\1.htm' END || '"', 'g') AS html
  FROM pages),
listed AS (
  SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS targets FROM linked),
found AS (
  SELECT page_id, url, (i - 1)::INTEGER AS position, replace(targets[i], '&amp;', '&') AS href
  FROM (SELECT page_id, url, list_append(targets, 'a/bé.txt') AS targets,
    unnest(range(1, len(targets) + 2)) AS i FROM listed)),"""

# The four link forms of the derived pages, resolved one by one.
_RESOLVED = f"""{_LINKED}
parts AS (
  SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root,
    regexp_extract(url, '{_URI}', 3) AS path FROM found),
folders AS (
  SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^.*/') END AS folder
  FROM parts),
resolved AS (
  SELECT page_id, url, position, href, CASE
    WHEN href = 'a/bé.txt' THEN root || folder || href
    WHEN page_id % 4 = 0 THEN root || href
    WHEN page_id % 4 = 1 THEN root || CASE WHEN folder = '/' THEN '/'
      ELSE regexp_replace(folder, '[^/]+/$', '') END || substr(href, 4)
    WHEN page_id % 4 = 2 THEN root || folder || substr(href, 8)
    ELSE root || path || href END AS resolved
  FROM folders)"""

_HOST_AUTHOR = """CASE WHEN lower({0}) LIKE '%://blog.%' THEN 'blog'
  WHEN lower({0}) LIKE '%://m.%' THEN 'mobile'
  WHEN lower({0}) LIKE '%.example.org%' THEN 'organisation'
  WHEN lower({0}) LIKE '%.example.net%' THEN 'network' ELSE 'unknown' END"""

_ATTRIBUTED = f"attributed AS (SELECT url, {_HOST_AUTHOR.format('url')} AS author FROM pages)"

_TEXT_LINK = "(lower(href) LIKE '%.epub%' OR lower(href) LIKE '%.txt%')"


def _tagged(train: str, apply: str) -> str:
    """Most frequent tag per word and per ending, ties to the first tag."""
    return f"""train AS ({train}),
apply AS ({apply}),
pairs AS (SELECT lower(word) AS word, tag, count(*) AS n FROM train GROUP BY ALL),
lexicon AS (
  SELECT word, tag AS word_tag FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, tag) = 1),
ending_pairs AS (
  SELECT right(word, 3) AS ending, tag, sum(n) AS n FROM pairs GROUP BY ALL),
endings AS (
  SELECT ending, tag AS ending_tag FROM ending_pairs
  QUALIFY row_number() OVER (PARTITION BY ending ORDER BY n DESC, tag) = 1),
tagged AS (
  SELECT a.*, coalesce(l.word_tag, e.ending_tag, 'X') AS tag FROM apply a
  LEFT JOIN lexicon l ON l.word = lower(a.word)
  LEFT JOIN endings e ON e.ending = right(lower(a.word), 3))"""


_ALL_TOKENS = (
    f"SELECT genre, unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM corpus"
)
_PAGE_TEXT = f"trim(regexp_replace({_plain('html')}, '[ \\n\\r\\t\\x{{A0}}]+', ' ', 'g'))"

# The body element, which some pages never close.
_BODY = "regexp_extract(html, '(?is)<body\\b[^>]*>(.*?)(?:</body\\s*>|\\z)', 1)"
_CHAPTERS = f"""bodies AS (SELECT *, {_plain(_BODY)} AS body FROM pages),
corpus AS (
  SELECT url || '/book.EPUB' AS id, 'someone' AS author, 'web' AS genre, 'book' AS title,
    unnest([0, 1, 2]) AS number,
    unnest([body, 'contents', ' ' || replace(url, '&amp;', '&') || ' ']) AS text FROM bodies)"""

_NUMBERED = f"""{_CORPUS}
SELECT genre || '_' || (row_number() OVER (PARTITION BY genre
    ORDER BY substr(md5(title), 1, 3), title) - 1) AS id, author, title, genre, text
FROM corpus"""

_FIRST = "(SELECT author, min(id) AS id FROM windows WHERE window_size = 500 GROUP BY author)"

_RAW_ROWS = "SELECT id, author, title, genre, text FROM corpus"

ORACLES: dict[str, str] = {
    "doc_readability": f"WITH {_metrics()} {_DOC}",
    "doc_readability_pure": f"WITH {_metrics('ignore')} {_DOC}",
    "readability_band_counts": f"""WITH {_metrics()}
SELECT genre, CASE WHEN flesch_score > 70 THEN 'easy' WHEN flesch_score < 30 THEN 'hard'
  ELSE 'medium' END AS band, count(*) AS documents FROM metrics GROUP BY ALL""",
    "book_projection": f"""WITH {_metrics()}
SELECT id, title, author, genre, word_count, sentence_count,
  round(flesch_score, 6) AS flesch_score, round(km_score, 6) AS km_score,
  round(word_count::DOUBLE / greatest(sentence_count, 1), 6) AS avg_sent_len FROM metrics""",
    "author_stats": f"""WITH {_metrics()}, stats AS ({_STATS})
SELECT author, genre, round(avg_flesch, 6) AS avg_flesch, round(avg_km, 6) AS avg_km,
  round(avg_words, 6) AS avg_words, round(avg_sentences, 6) AS avg_sentences FROM stats""",
    "author_summary_rounded": f"""WITH {_metrics()}, stats AS ({_STATS})
SELECT author AS "Auteur", genre AS "Genre", round_even(avg_flesch * 100, 0) / 100 AS "Flesch moy.",
  round_even(avg_km * 100, 0) / 100 AS "KM moy.", round_even(avg_words * 100, 0) / 100 AS "Mots moy.",
  round_even(avg_sentences * 100, 0) / 100 AS "Phrases moy." FROM stats""",
    "complexity_by_author": f"""WITH {_metrics()}, stats AS ({_STATS})
SELECT author, genre, round(avg_sentences, 6) AS avg_sentences,
  round(avg_words, 6) AS avg_words FROM stats
WHERE author <> 'src1'""",
    "flesch_bars": f"""WITH {_metrics()}, stats AS ({_STATS})
SELECT author, genre, round(avg_flesch, 6) AS avg_flesch, CASE WHEN avg_flesch > 70 THEN 'easy'
  WHEN avg_flesch < 30 THEN 'hard' ELSE 'medium' END AS band FROM stats""",
    "kandel_moles_bars": f"""WITH {_metrics()}, stats AS ({_STATS})
SELECT author, genre, round(avg_km, 6) AS avg_km FROM stats""",
    "sentence_table": f"""WITH {_CORPUS}, {_tokens()}
SELECT id, unnest(range(len(sentences)))::INTEGER AS pos, unnest(sentences) AS sentence
FROM counted""",
    "token_table": f"""WITH {_CORPUS}, {_tokens()}
SELECT id, author, genre, title, unnest(range(len(tokens)))::INTEGER AS pos,
  unnest(tokens) AS word, unnest(syllables)::INTEGER AS syllables FROM counted""",
    "corpus_with_ids": f"WITH {_NUMBERED}",
    "tumbling_readability": f"WITH {_windows('tumbling')} {_WINDOW_ROWS}",
    "sliding_readability": f"WITH {_windows('sliding')} {_WINDOW_ROWS}",
    "full_windows": f"""WITH {_CORPUS}, {_tokens()},
starts AS (
  SELECT *, unnest(range(0, greatest(len(tokens) - 500 + 1, 1), 250)) AS s FROM counted)
SELECT id, author, genre, title, (s // 250)::INTEGER AS window_index, s::INTEGER AS start,
  array_to_string(tokens[s + 1 : s + 500], ' ') AS "window" FROM starts""",
    "window_stability": f"""WITH {_windows('tumbling')},
spread AS (
  SELECT author, genre, window_size, avg(flesch) AS mean_flesch,
    stddev_samp(flesch) AS std_flesch, avg(km) AS mean_km, stddev_samp(km) AS std_km
  FROM windows GROUP BY ALL)
SELECT author, genre, window_size, round(mean_flesch, 6) AS mean_flesch,
  round(std_flesch, 6) AS std_flesch, round(mean_km, 6) AS mean_km, round(std_km, 6) AS std_km,
  round(std_flesch / greatest(abs(mean_flesch), 1e-9), 6) AS cv_flesch,
  round(std_km / greatest(abs(mean_km), 1e-9), 6) AS cv_km FROM spread""",
    "sliding_curve_sample": f"""WITH {_windows('tumbling')}
{_WINDOW_ROWS} JOIN {_FIRST} f USING (author, id) WHERE window_size = 500""",
    "word_frequencies": f"""WITH {_zipf(200)}
SELECT id, author, genre, title, word, frequency FROM frequencies""",
    "zipf_top": f"WITH {_zipf(200)} {_ZIPF_ROWS}",
    "zipf_by_genre": f"""WITH {_zipf(200)}
SELECT genre, rank, round(avg(log_freq), 6) AS log_freq FROM zipf GROUP BY ALL""",
    "zipf_by_author": f"""WITH {_zipf(200)}
SELECT author, rank, round(avg(log_freq), 6) AS log_freq FROM zipf GROUP BY ALL""",
    "zipf_across_blocks": f"WITH {_zipf(20, _BLOCKS)} {_ZIPF_ROWS}",
    "zipf_representative_words": f"""WITH {_zipf(200)},
chosen AS (
  SELECT author, id FROM zipf
  QUALIFY row_number() OVER (PARTITION BY author ORDER BY frequency DESC, id, word) = 1),
heads AS (
  SELECT z.* FROM zipf z JOIN chosen USING (author, id)
  QUALIFY row_number() OVER (PARTITION BY author ORDER BY frequency DESC, word) <= 50)
SELECT id, author, genre, title, word, frequency, rank,
  round(log_rank, 6) AS log_rank, round(log_freq, 6) AS log_freq FROM heads""",
    "dialogue_segments": f"""WITH {_dialogue(_SPOKEN)}
SELECT id, author, genre, title, dialog_lines, narration_lines,
  round(dialog_ratio, 6) AS dialog_ratio, dialog_text, narration_text FROM segments""",
    "dialogue_stats": f"""WITH {_dialogue(_SPOKEN)}
{_DIALOGUE_STATS.format(table='segments')}""",
    "dialogue_bars": f"""WITH {_dialogue(_SPOKEN)}
SELECT author, genre, round(avg(dialog_ratio), 6) AS avg_dialog_ratio
FROM segments GROUP BY ALL""",
    "dialogue_column_means": f"""WITH {_dialogue(_SPOKEN)}
SELECT author, genre, round(avg(dialog_lines), 6) AS dialog_lines,
  round(avg(dialog_ratio), 6) AS dialog_ratio FROM segments GROUP BY ALL""",
    "conversation_dialogue": f"""WITH {_BLOCK_SUMS}
SELECT id, author, genre, dialog_lines, narration_lines,
  round(dialog_ratio, 6) AS dialog_ratio FROM conversations_counted""",
    "conversation_dialogue_stats": f"""WITH {_BLOCK_SUMS}
{_DIALOGUE_STATS.format(table='conversations_counted')}""",
    "html_text": f"""SELECT page_id, url, trim('l''homme ≂̸ a < b é & c &bogus; € '
  || {_PAGE_TEXT}) AS text FROM pages""",
    "page_links": f"""WITH {_RESOLVED}
SELECT DISTINCT url AS page_url, resolved AS url FROM resolved WHERE {_TEXT_LINK}""",
    "distinct_page_links": f"""WITH {_RESOLVED}
SELECT DISTINCT resolved AS url FROM resolved WHERE {_TEXT_LINK}""",
    "resolved_links": f"""WITH {_RESOLVED}
SELECT page_id, position, href, resolved FROM resolved""",
    "raw_file_links": f"""WITH {_RESOLVED}
SELECT url AS page_url, 'https://raw.example.org' || replace(href, '/blob', '') AS url
FROM resolved WHERE href LIKE '%.TXT'""",
    "catalogue_two_hop": """WITH offered AS (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages),
entries AS (SELECT DISTINCT page_id FROM offered)
SELECT 'https://books.example.org/ebooks/' || page_id AS book_url,
  'https://books.example.org' || replace(href, '&amp;', '&') AS url
FROM offered JOIN entries USING (page_id)""",
    "attribute_author": f"""WITH {_ATTRIBUTED}
SELECT url, author, author || '_' || string_split(url, '/')[-1] AS filename FROM attributed""",
    "known_authors": f"WITH {_ATTRIBUTED} SELECT url, author FROM attributed WHERE author <> 'unknown'",
    "cap_per_author": f"""WITH {_ATTRIBUTED}
SELECT url, author FROM attributed
QUALIFY row_number() OVER (PARTITION BY author ORDER BY url) <= 10""",
    "incremental_split": f"""WITH {_RESOLVED},
links AS (
  SELECT DISTINCT resolved AS link, url LIKE 'https:%' AS secure FROM resolved
  WHERE {_TEXT_LINK}),
named AS (
  SELECT link, secure, {_HOST_AUTHOR.format('link')} || '_' || string_split(link, '/')[-1]
    AS filename FROM links)
SELECT DISTINCT link AS url, filename,
  filename IN (SELECT filename FROM named WHERE secure) AS already_stored FROM named""",
    "books_to_fetch": f"""WITH {_RESOLVED},
links AS (
  SELECT DISTINCT resolved AS url, {_HOST_AUTHOR.format('resolved')} AS author FROM resolved
  WHERE {_TEXT_LINK}),
capped AS (
  SELECT url, author, author || '_' || string_split(url, '/')[-1] AS filename FROM links
  QUALIFY row_number() OVER (PARTITION BY author ORDER BY url) <= 25),
stored AS (
  SELECT DISTINCT author || '_' || string_split(resolved, '/')[-1] AS filename FROM (
    SELECT resolved, {_HOST_AUTHOR.format('resolved')} AS author FROM resolved
    WHERE {_TEXT_LINK} AND url LIKE 'https:%'))
SELECT url, author, filename, filename IN (FROM stored) AS already_stored FROM capped
WHERE author <> 'unknown'""",
    "truncate_union": f"""WITH {_CORPUS}
SELECT id, author, title, substr(text, 1, 1000) AS text,
  CASE WHEN genre IN ('fr', 'es') THEN 'romantic' ELSE 'realism' END AS genre FROM corpus""",
    "authors_sorted": "SELECT DISTINCT source AS author FROM documents ORDER BY author",
    "document_counts": "SELECT lang AS genre, count(*) AS count FROM documents GROUP BY lang",
    "lexicon_tags": f"""WITH {_CORPUS},
{_tagged(f"SELECT word, genre AS tag FROM ({_ALL_TOKENS})", _ALL_TOKENS)}
SELECT genre, tag, count(*) AS tokens FROM tagged GROUP BY ALL""",
    "unseen_word_tags": f"""WITH {_CORPUS},
texts AS (
  SELECT {_PAGE_TEXT} AS text, regexp_extract(url, '/([a-z]{{2}})/', 1) AS tag FROM pages),
{_tagged(f"SELECT unnest(regexp_extract_all(text, '{_TOKEN}')) AS word, tag FROM texts",
         f"SELECT DISTINCT word FROM ({_ALL_TOKENS})")}
SELECT word, tag FROM tagged""",
    "file_text": f"""WITH {_CORPUS}
SELECT title || '.txt' AS path, regexp_replace(text, '\\r\\n?', E'\\n', 'g') AS text,
  NULL::VARCHAR AS error FROM corpus""",
    "epub_text": f"""SELECT url || '/book.EPUB' AS path,
  {_plain(_BODY)} || E'\\ncontents\\n' || ' ' || replace(url, '&amp;', '&') || ' ' AS text,
  NULL::VARCHAR AS error FROM pages""",
    "folder_scan": """SELECT lang AS genre, source AS author, lang || '_' AS id,
  substr(string_agg(regexp_replace(text, '\\r\\n?', E'\\n', 'g') || E'\\n', '' ORDER BY doc_id), 1, 5000)
    AS text
FROM documents GROUP BY lang, source""",
    "folder_lines": """SELECT lang AS genre, source AS author,
  unnest(string_split(regexp_replace(text, '\\r\\n?', E'\\n', 'g'), E'\\n')) AS line FROM documents""",
    "folder_capped": """SELECT lang AS genre, source AS author,
  regexp_replace(arg_min(text, doc_id), '\\r\\n?', E'\\n', 'g') AS text
FROM documents GROUP BY lang, source""",
    "stored_sizes": """WITH texts AS (SELECT sum(strlen(text))::BIGINT AS n FROM documents)
SELECT "table", stored, CASE WHEN "table" = 'parquet/raw_corpus' THEN n ELSE 0 END AS text_bytes,
  "table" = 'parquet/raw_corpus' AND n > 0 AS plausible
FROM texts, (VALUES ('parquet/raw_corpus', true),
  ('parquet/annotated_corpus', false), ('parquet/sliding_readability', false),
  ('orc/stylometry', true), ('zipf.csv', false), ('segmentation.csv', false)) t("table", stored)""",
    "document_tags": f"""WITH {_CORPUS},
{_tagged(f"SELECT word, genre AS tag FROM ({_ALL_TOKENS})", f"""SELECT id, unnest(ts) AS word,
    unnest(range(len(ts))) AS place FROM (
      SELECT id, regexp_extract_all(text, '{_TOKEN}') AS ts FROM corpus)""")}
SELECT id, string_agg(tag, ' ' ORDER BY place) AS pos FROM tagged GROUP BY id""",
    "conversation_readability": f"""WITH {_metrics("count", _BLOCKS).replace("FROM counts", "FROM summed").replace("metrics AS (", """summed AS (
  SELECT id, author, genre, sum(word_count)::BIGINT AS word_count,
    sum(sentence_count)::BIGINT AS sentence_count, sum(syllable_count)::BIGINT AS syllable_count
  FROM counts GROUP BY ALL),
metrics AS (""")}
SELECT id, author, genre, word_count, sentence_count, syllable_count,
  round(flesch_score, 6) AS flesch_score, round(km_score, 6) AS km_score FROM metrics""",
    "abbreviation_scores": f"""WITH {_ABBREVIATIONS}
SELECT word, w::BIGINT AS with_stop, o::BIGINT AS without_stop,
  round(score, 6) + 0.0::DOUBLE AS score FROM scored""",
    "abbreviation_sentences": f"""WITH {_ABBREVIATIONS},
learned AS (
  SELECT list(word) AS words FROM (
    SELECT word FROM scored WHERE score >= 0.3)),
parts AS (
  SELECT doc_id AS id, unnest(string_split(
    regexp_replace(text, '{_SENTENCE_END}', '\\0' || chr(1), 'g'), chr(1))) AS part,
    generate_subscripts(string_split(
    regexp_replace(text, '{_SENTENCE_END}', '\\0' || chr(1), 'g'), chr(1)), 1) AS place
  FROM documents),
closed AS (
  SELECT id, place, CASE WHEN list_contains(words,
      lower(regexp_extract(part, '({_STOPPED})\\.[ \\n\\r\\t]*$', 1))) THEN part
    ELSE regexp_replace(part, '[.!?…]+[ \\n\\r\\t]*$', chr(1)) END AS part
  FROM parts, learned),
joined AS (
  SELECT id, list_filter(string_split(string_agg(part, '' ORDER BY place), chr(1)),
    lambda x: length(trim(x)) > 0) AS found FROM closed GROUP BY id)
SELECT id, (unnest(range(len(found))))::INTEGER AS number,
  length(unnest(found))::INTEGER AS length, md5(unnest(found)) AS sentence_md5
FROM joined""",
    "chapter_readability": f"""WITH {_metrics("count", _CHAPTERS).replace("FROM counts", "FROM summed").replace("metrics AS (", """summed AS (
  SELECT id, author, genre, sum(word_count)::BIGINT AS word_count,
    sum(sentence_count)::BIGINT AS sentence_count, sum(syllable_count)::BIGINT AS syllable_count
  FROM counts GROUP BY ALL),
metrics AS (""")}
SELECT id, author, genre, word_count, sentence_count, syllable_count,
  round(flesch_score, 6) AS flesch_score, round(km_score, 6) AS km_score FROM metrics""",
    "chapter_windows": _block_windows(_CHAPTERS, "number", "author, genre, title"),
    "conversation_windows": _block_windows("""corpus AS (
  SELECT conv_id AS id, 'someone' AS author, 'talk' AS genre, 'conversation' AS title, turn, text
  FROM conversations)""", "turn", "author, genre, title"),
    "zipf_without_benchmark": "WITH unwanted AS (SELECT lower(regexp_replace(w, '[^a-zA-ZÀ-ÿ]', "
    f"'', 'g')) AS word FROM (SELECT unnest(regexp_extract_all(text, '{_TOKEN}')) AS w "
    "FROM benchmark)), "
    + _zipf(200).replace(f"NOT IN ({_STOPWORDS})", "NOT IN (SELECT word FROM unwanted)")
    + _ZIPF_ROWS,
    "attribute_author_by_table": """WITH names AS (
  SELECT source AS author, row_number() OVER (ORDER BY length(source) DESC, source) AS place
  FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
links AS (
  SELECT doc_id AS id, 'https://EXAMPLE.org/' || upper(coalesce(source, 'none')) || '/doc_' || doc_id
    || '.txt' AS url FROM documents)
SELECT id, url, coalesce((SELECT arg_min(author, place) FROM names
  WHERE contains(lower(url), lower(author))), 'unknown') AS author FROM links""",
    "stored_raw_corpus": f"WITH {_CORPUS} {_RAW_ROWS}",
    "stored_annotated_corpus": f"""WITH {_metrics()},
{_dialogue(_CORPUS).removeprefix(_CORPUS + ',')}
SELECT m.id, m.author, m.title, m.genre, word_count, sentence_count, syllable_count,
  round(flesch_score, 6) AS flesch_score, round(km_score, 6) AS km_score, dialog_lines,
  narration_lines, round(dialog_ratio, 6) AS dialog_ratio
FROM metrics m JOIN segments USING (id) WHERE m.genre = 'fr'""",
    "stored_windows": f"WITH {_windows('tumbling')} {_WINDOW_ROWS} WHERE window_size = 500",
    "stored_author_stats": f"""WITH {_metrics()}, stats AS ({_STATS})
SELECT author, genre, round(avg_flesch, 6) AS avg_flesch, round(avg_km, 6) AS avg_km,
  round(avg_words, 6) AS avg_words, round(avg_sentences, 6) AS avg_sentences FROM stats""",
    "stored_zipf": f"WITH {_zipf(200)} {_ZIPF_ROWS}",
    "stored_dialogue_stats": f"""WITH {_dialogue(_SPOKEN)}
{_DIALOGUE_STATS.format(table='segments')}""",
    "analysis_tables": f"""WITH {_zipf(200, _SPOKEN)},
{_metrics("count", _SPOKEN).removeprefix(_SPOKEN + ",")},
stats AS ({_STATS}),
{_dialogue(_SPOKEN).removeprefix(_SPOKEN + ",")},
positions AS (
{_windows("tumbling").split("positions AS (", 1)[1]}
SELECT 'raw_corpus' AS "table", count(*) AS rows, sum(id)::DOUBLE AS total FROM corpus
UNION ALL SELECT 'annotated_corpus', count(*), round(sum(m.id + word_count + sentence_count
  + syllable_count + flesch_score + km_score + dialog_lines + narration_lines + dialog_ratio), 2)
  FROM metrics m JOIN segments s ON s.id = m.id
UNION ALL SELECT 'stylometry', count(*), round(sum(avg_flesch + avg_km + avg_words + avg_sentences), 2)
  FROM stats
UNION ALL SELECT 'segmentation', count(*), round(sum(r + d + n + k), 2) FROM (
  SELECT avg(dialog_ratio) AS r, avg(dialog_lines) AS d, avg(narration_lines) AS n, count(*) AS k
  FROM segments GROUP BY author, genre)
UNION ALL SELECT 'sliding_readability', count(*), round(sum(id + window_index + word_count
  + syllable_count + sentence_count + flesch + km + window_size + step), 2) FROM windows
UNION ALL SELECT 'zipf', count(*), round(sum(id + frequency + rank + log_rank + log_freq), 2)
  FROM zipf""",
}

ORACLES["stored_sliding_curves"] = ORACLES["sliding_curve_sample"]
ORACLES["stored_characteristic_words"] = ORACLES["zipf_representative_words"]
# Tables that books are added to are those of one run over all books.
for _updated, _whole in (
    ("stored_dialogue_means", "dialogue_column_means"),
    ("updated_author_stats", "stored_author_stats"),
    ("updated_dialogue_stats", "stored_dialogue_stats"),
    ("updated_stability", "window_stability"),
):
    ORACLES[_updated] = ORACLES[_whole]
