"""HTML, link and URL expressions."""

from __future__ import annotations

import html.entities
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textstyle.functions.text import _col

# A tag opens with a letter, a slash or a mark of declaration; quoted values may hold ">".
# Each pattern is possessive or runs to the end of the page where its end is missing, so that
# a damaged page is read once.
TAG_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>"""
TAG = r"(?s)<[A-Za-z/!?]" + TAG_REST
ANCHOR = r"(?is)<a(?=[\s/])" + TAG_REST
ATTRIBUTE = r"""(?s)[^\s=>/"']++\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""
TABLE_TAG = r"(?is)</?+(tr|table)(?=[\s/>])" + TAG_REST
UNSEEN = (r"(?is)<(script|style)\b.*?(?:</\1\s*+>|\z)", r"(?s)<!--.*?(?:-->|\z)")

# Closed rows of a page that are kept in one list.
KEPT_TOGETHER = 100
# Stands between pieces of a page while it is taken apart; a page's own read as spaces.
MARK = "\x01"

# Generic URI splitting pattern published in RFC 3986, appendix B.
URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

# First rule with a keyword contained in the lower-cased URL wins.
AUTHOR_RULES = (
    ("balzac", ("balzac", "gutenberg")),
    ("dumas", ("dumas",)),
    ("sand", ("sand",)),
    ("maupassant", ("maupassant",)),
    ("zola", ("zola",)),
    ("dickens", ("dickens",)),
)
UNKNOWN_AUTHOR = "unknown"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_code(code: Column) -> Column:
    """Character of a code point; the ones that HTML replaces are replaced."""
    # Numbers from 128 to 159 name characters of code page 1252, as browsers read them.
    western = F.create_map(*[
        F.lit(part) for byte in range(0x80, 0xA0)
        for part in (byte, bytes([byte]).decode("cp1252", "ignore") or chr(byte))
    ])
    is_character = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.between(0x80, 0x9F), F.try_element_at(western, code))
        .when(is_character, plain)
        .otherwise("\ufffd")
    )


def unescape_entities(text: Column | str) -> Column:
    """Decode numeric and HTML 5 named character references.

    The string is cut at references; each distinct one is decoded once and the pieces look
    it up among those. Texts without ``&`` skip the work. Names of the older standard need no
    semicolon. Unknown references stay as they are.
    """
    text = _col(text)
    known = {name[:-1]: found for name, found in html.entities.html5.items() if name[-1] == ";"}
    old = sorted((n for n in html.entities.html5 if n[-1] != ";"), key=lambda n: (-len(n), n))
    # One literal that is split while planning, instead of thousands.
    listed = "\x01".join(f"{name}\x02{found}" for name, found in known.items())
    names = F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))
    pieces = F.regexp_extract_all(text, F.lit(r"&#?+\w++;?+|&|[^&]++"), F.lit(0))

    def decode(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#0*+([0-9]++);?$", 1)
        hexadecimal = F.regexp_extract(piece, r"^&#[xX]0*+([0-9a-fA-F]++);?$", 1)
        number = F.when(F.length(digits).between(1, 7), digits.try_cast("int")).when(
            F.length(hexadecimal).between(1, 6), F.conv(hexadecimal, 16, 10).try_cast("int")
        )
        is_number = piece.rlike(r"^&#(?:[0-9]++|[xX][0-9a-fA-F]++);?$")
        zeros = piece.rlike(r"^&#[xX]?0++;?$")
        by_number = _by_code(F.when(zeros, 0).otherwise(F.coalesce(number, F.lit(-1))))
        by_name = F.try_element_at(names, F.regexp_extract(piece, r"^&(\w++);$", 1))
        # The longest old name that the reference begins with; what follows it is text.
        older = F.regexp_extract(piece, f"^&({'|'.join(old)})", 1)
        by_older = F.concat(
            F.try_element_at(names, F.when(older != "", older)),
            F.substring(piece, F.length(older) + 2, F.length(piece)),
        )
        return F.when(is_number, by_number).otherwise(F.coalesce(by_name, by_older, piece))

    def replaced(parts: Column) -> Column:
        references = F.array_distinct(F.filter(parts, lambda p: p.startswith("&")))
        return _let(references, lambda found: _let(
            F.map_from_arrays(found, F.transform(found, decode)),
            lambda decoded: F.array_join(F.transform(
                parts, lambda p: F.when(p.startswith("&"), decoded[p]).otherwise(p)
            ), ""),
        ))

    return F.when(text.contains("&"), _let(pieces, replaced)).otherwise(text)


def without_unseen(markup: Column | str) -> Column:
    """Markup without scripts, styles and comments."""
    text = _col(markup)
    for pattern in UNSEEN:
        text = F.regexp_replace(text, pattern, " ")
    return text


def html_to_text(markup: Column | str, collapse: bool = True) -> Column:
    """Visible text of HTML; every tag reads as one space.

    ``collapse=False`` keeps the white space of the source, which matters when
    line structure is analysed afterwards.
    """
    text = unescape_entities(F.regexp_replace(without_unseen(markup), TAG, " "))
    if not collapse:
        return text
    return F.trim(F.regexp_replace(text, "[ \n\r\t\xa0]++", " "))


def row_text(markup: Column | str) -> Column:
    """Lower-cased text of a table row: trimmed text nodes joined by one space."""
    nodes = F.transform(F.split(_col(markup), TAG), lambda node: F.regexp_replace(node, r"^\s++|(?<!\s)\s++\z", ""))
    return F.lower(F.trim(unescape_entities(F.array_join(F.filter(nodes, lambda node: node != ""), " "))))


def table_rows(
    markup: Column | str, of: Callable[[Column], Column] = lambda row: row
) -> Column:
    """Array of what ``of`` makes of the markup of each table row, in the order in which rows
    open; the rows themselves by default.

    The tags of rows and tables are folded over the stack of those that are open. An end tag
    closes the element of its name that was opened last and all that were opened in it; one
    that closes nothing is skipped. So a row holds the rows of tables inside it, a row without
    an end tag goes on to the end of its table or of the page, and tables left open end with
    the page. Other elements are taken to end in the row they begin in. Closed rows are kept
    in lists of bounded length, since a list is copied when it grows.
    """
    text = without_unseen(F.translate(_col(markup), MARK, " "))
    # All tags are matched, so that none inside a quoted value is taken for one.
    marked = F.regexp_replace(text, f"({TABLE_TAG})|({TAG})", f"{MARK}$1{MARK}$3")
    none = F.array().cast("array<struct<name:string,at:int>>")
    no_rows = F.array().cast("array<struct<at:int,stop:int>>")
    no_lists = F.array().cast("array<array<struct<at:int,stop:int>>>")

    def tag(piece: Column, at: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, "^" + TABLE_TAG, 1))
        return F.when(name != "", F.struct(
            name.alias("name"), piece.startswith("</").alias("closes"), at.alias("at")))

    def ended(popped: Column, stop: Column) -> Column:
        return F.transform(
            F.filter(popped, lambda one: one["name"] == "tr"),
            lambda one: F.struct(one["at"].alias("at"), stop.cast("int").alias("stop")),
        )

    def step(state: Column, tag: Column) -> Column:
        open_ = state["open"]
        size = F.size(open_)
        names = F.transform(open_, lambda one: one["name"])
        # Mostly the element that was opened last.
        inner = F.when(F.get(open_, size - 1)["name"] == tag["name"], 1).otherwise(
            F.array_position(F.reverse(names), tag["name"]).cast("int"))
        rows = F.concat(state["rows"], ended(F.slice(open_, size - inner + 1, inner), tag["at"]))
        full = F.size(state["rows"]) >= KEPT_TOGETHER
        return (
            F.when(~tag["closes"], F.struct(
                F.concat(open_, F.array(F.struct(tag["name"], tag["at"]))).alias("open"),
                state["rows"].alias("rows"), state["lists"].alias("lists"),
            ))
            .when(inner > 0, F.struct(
                F.slice(open_, F.lit(1), size - inner).alias("open"),
                F.when(full, no_rows).otherwise(rows).alias("rows"),
                F.when(full, F.concat(state["lists"], F.array(rows)))
                .otherwise(state["lists"]).alias("lists"),
            ))
            .otherwise(state)
        )

    def cut(parts: Column) -> Column:
        tags = F.filter(F.transform(parts, tag), lambda one: one.isNotNull())
        found = F.aggregate(
            tags, F.struct(none.alias("open"), no_rows.alias("rows"), no_lists.alias("lists")),
            step,
            lambda state: F.array_sort(F.concat(
                F.flatten(state["lists"]), state["rows"], ended(state["open"], F.size(parts))
            )),
        )
        return F.transform(found, lambda row: of(F.array_join(
            F.slice(parts, row["at"] + 1, row["stop"] - row["at"]), ""
        )))

    return F.when(_col(markup).rlike("(?i)<tr"), _let(F.split(marked, MARK), cut))


def hrefs(markup: Column | str) -> Column:
    """``array<string>``: link targets of all anchors seen on the page, in its order."""
    anchors = F.regexp_extract_all(without_unseen(markup), F.lit(ANCHOR), F.lit(0))
    return F.filter(F.transform(anchors, anchor_href), lambda href: href != "")


def anchor_href(anchor: Column | str) -> Column:
    """Link target of one anchor tag, ``''`` without one.

    Attributes are read one after the other, so that neither another attribute's name nor
    its quoted value is taken for the target.
    """
    attributes = F.regexp_extract_all(_col(anchor), F.lit(ATTRIBUTE), F.lit(0))
    targets = F.filter(attributes, lambda one: one.rlike(r"(?i)^href\s*+="))
    value = F.regexp_extract(
        F.coalesce(F.get(targets, F.lit(0)), F.lit("")), r"(?is)^href\s*+=\s*+(.*)$", 1
    )
    quoted = value.rlike(r"""(?s)^(?:"[^"]*+"|'[^']*+')$""")
    return unescape_entities(
        F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    )


def first_href(markup: Column | str) -> Column:
    """Link target of the first anchor, ``''`` when there is none."""
    return anchor_href(F.regexp_extract(without_unseen(markup), ANCHOR, 0))


def _fold_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path."""
    segments = F.split(F.substring(path, 2, 1 << 30), "/")
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, segment: F.when(segment == ".", kept)
        .when(segment == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .otherwise(F.concat(kept, F.array(segment))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.concat(
        F.lit("/"),
        F.array_join(folded, "/"),
        F.when(ends_in_dots & (F.size(folded) > 0), "/").otherwise(""),
    )


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of ``href`` found on page ``base``."""
    base, href = _col(base), _col(href)

    def part(url: Column, number: int) -> Column:
        return F.regexp_extract(url, URI, number)

    scheme, host, path = part(base, 1), part(base, 2), part(base, 3)
    root = F.concat(scheme, F.lit("://"), host)
    page = F.concat(root, path)
    href_path = part(href, 3)
    after_path = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, _fold_dots(href_path), after_path))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, "^[^#]*", 0), href))
        .otherwise(
            F.concat(
                root,
                _fold_dots(F.regexp_replace(F.concat(folder, href_path), "/{2,}", "/")),
                after_path,
            )
        )
    )


def author_of(
    url: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = AUTHOR_RULES
) -> Column:
    """Author whose rule matches the URL first, else ``unknown``."""
    lowered = F.lower(_col(url))
    # One flat expression: rules inside one another make plans that take minutes to optimise.
    result = F
    for author, keywords in rules:
        matched = reduce(lambda a, b: a | b, [lowered.contains(word) for word in keywords])
        result = result.when(matched, author)
    return F.lit(UNKNOWN_AUTHOR) if result is F else result.otherwise(UNKNOWN_AUTHOR)


def stored_name(author: Column | str, url: Column | str) -> Column:
    """File name under which a link is kept: author, underscore, last URL segment."""
    return F.concat(_col(author), F.lit("_"), F.element_at(F.split(_col(url), "/"), -1))
