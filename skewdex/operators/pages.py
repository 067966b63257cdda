"""Links and typed anchors of stored web pages, and the catalog built from them."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

# Addresses and links of the book catalog.
BASE_URL = "https://www.gutenberg.org"
INDEX_URLS = (
    BASE_URL + "/wiki/Category:Bookshelf",
    BASE_URL + "/w/index.php?title=Category:Bookshelf&pagefrom=The+Girls+Own+Paper+%28Bookshelf%29#mw-pages",
)
GROUP_HREF = r"/wiki/.+\(Bookshelf\)"
DENIED_HREFS = (
    "/wiki/Category:DE_B%C3%BCcherregal",
    "/wiki/Category:FR_Genre",
    "/wiki/Category:IT_Biblioteca",
    "/wiki/Category:PT_Prateleira",
    "/wiki/Category:Categories",
    "/wiki/Category:Bookshelf",
    "/wiki/Special:Categories",
    "/wiki/Special:Search",
    "/wiki/Main_Page",
)
FILE_ROOT = "http://www.gutenberg.lib.md.us"
FILE_SUFFIXES = (".txt", "-8.txt", "-0.txt")

_UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_ATTRIBUTES = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)"""
_OPENED = rf"(?is)<a\s{_ATTRIBUTES}>"
# An anchor's text ends at its end tag, at the next anchor, or with the page.
_CLOSED = rf"(?is)<a\s{_ATTRIBUTES}>(.*?)(?=</a\s*>|<a\s|\z)"
# One attribute: its name, and a value in double or single quotes or none, if it has one.
_PAIR = r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+|["'][^"']*+["']?+"""
_VALUE = r"""(?s)^[^\s=>"'/]++\s*+=\s*+["']?(.*?)["']?$"""
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name in the inside of a tag; "" if bare, null if there is none.

    The attributes are taken apart in order, so a name inside another's value is not one.
    """
    pairs = F.regexp_extract_all(tag, F.lit(_PAIR), F.lit(0))
    own = F.get(F.filter(pairs, lambda p: F.lower(p).rlike(rf"^{name}(?:\s*=|$)")), 0)
    return F.when(own.contains("="), F.regexp_extract(own, _VALUE, 1)).otherwise(own.substr(1, 0))


def _unescape(text: Column) -> Column:
    """Character references replaced: numeric ones, and the named ones that stand for one character.

    What is no reference, or an unknown one, stays as it is.
    """
    named = F.create_map(*[F.lit(x) for name, code in sorted((name2codepoint | {"apos": 39}).items()) for x in (name, code)])
    rest, found = F.split(text, _ENTITY, -1), F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))

    def decoded(ref: Column) -> Column:
        body = F.substr(ref, F.lit(2), F.length(ref) - 2)
        code = (
            F.when(body.rlike("^#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10).cast("int"))
            .when(body.startswith("#"), F.substr(body, F.lit(2)).cast("int"))
            .otherwise(F.try_element_at(named, body))
        )
        whole = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(whole, _character(code)).otherwise(ref)

    joined = F.concat(
        F.array_join(F.transform(found, lambda ref, i: F.concat(F.get(rest, i), decoded(ref))), ""), F.element_at(rest, -1)
    )
    return F.when(text.contains("&"), joined).otherwise(text)


def _character(code: Column) -> Column:
    """The character of a code point, by its bytes in UTF-8."""

    def byte(lead: int, shift: int, mask: int) -> Column:
        return F.lpad(F.hex(F.shiftright(code, shift).bitwiseAND(mask).bitwiseOR(lead)), 2, "0")

    tail = [byte(0x80, shift, 0x3F) for shift in (12, 6, 0)]
    bytes_ = (
        F.when(code < 0x80, byte(0, 0, 0x7F))
        .when(code < 0x800, F.concat(byte(0xC0, 6, 0x1F), tail[2]))
        .when(code < 0x10000, F.concat(byte(0xE0, 12, 0x0F), *tail[1:]))
        .otherwise(F.concat(byte(0xF0, 18, 0x07), *tail))
    )
    return F.decode(F.unhex(bytes_), "UTF-8")


def links(pages: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """``key``, ``pos`` and ``href`` of every anchor with an href, in order, repeats kept."""
    seen = F.regexp_replace(html, _UNSEEN, "")
    return (
        pages.select(*key, F.posexplode_outer(F.regexp_extract_all(seen, F.lit(_OPENED), 1)).alias("pos", "_tag"))
        .select(*key, "pos", _unescape(_attribute(F.col("_tag"), "href")).alias("href"))
        .where(F.col("href").isNotNull())
    )


def typed_anchors(
    pages: DataFrame,
    key: list[str],
    html: str = "html",
    kind: str = "ebook",
    min_digits: int = 2,
) -> DataFrame:
    """``key``, ``pos``, ``ebook_id`` and ``ebook_title`` of anchors titled ``kind:number``.

    The title of the document is the text of the anchor. Numbers of fewer than
    ``min_digits`` digits are left out.
    """
    seen = F.regexp_replace(html, _UNSEEN, "")
    anchors = F.transform(
        F.regexp_extract_all(seen, F.lit(_CLOSED), 0),
        lambda a: F.struct(
            F.regexp_extract(a, _CLOSED, 1).alias("tag"), F.regexp_extract(a, _CLOSED, 2).alias("text")
        ),
    )
    number = F.regexp_extract(
        _attribute(F.col("_a.tag"), "title"), rf"^{kind}:([0-9]{{{min_digits},}})$", 1
    )
    inner = F.regexp_replace("_a.text", r"<[^>]*>", "")
    return (
        pages.select(*key, F.posexplode_outer(anchors).alias("pos", "_a"))
        .select(
            *key, "pos",
            number.try_cast("long").alias("ebook_id"),
            F.trim(F.regexp_replace(_unescape(inner), r"\s+", " ")).alias("ebook_title"),
        )
        .where(F.col("ebook_id").isNotNull())
    )


def group_links(
    hrefs: DataFrame,
    href: str = "href",
    pattern: str = GROUP_HREF,
    denied: tuple[str, ...] = DENIED_HREFS,
) -> DataFrame:
    """Rows whose link is present, is none of the denied ones and matches the pattern in full."""
    link = F.col(href)
    return hrefs.where(link.isNotNull() & ~link.isin(*denied) & link.rlike(rf"^(?:{pattern})\z"))


def absolute(href: Column | str, base: str = BASE_URL) -> Column:
    """``href`` put behind the base address."""
    return F.concat(F.lit(base), F.col(href) if isinstance(href, str) else href)


def catalog(
    index_pages: DataFrame,
    pages: DataFrame,
    base: str = BASE_URL,
    pattern: str = GROUP_HREF,
    denied: tuple[str, ...] = DENIED_HREFS,
) -> DataFrame:
    """The listing: ``shelf_pos``, ``bookshelf_url``, ``ebook_pos``, ``ebook_id``, ``ebook_title``.

    ``index_pages``: page_no, html; ``pages``: url, html. Groups are the matching links of
    the index pages in order; each group's documents are the typed anchors of its own page.
    A group linked twice stays twice, and one without a page or without documents is a row
    of nulls after its url. ``shelf_pos`` orders the groups and has gaps.
    """
    shelves = group_links(links(index_pages, ["page_no"]), "href", pattern, denied).select(
        (F.col("page_no").cast("long") * F.lit(1 << 32) + F.col("pos")).alias("shelf_pos"),
        absolute("href", base).alias("bookshelf_url"),
    )
    # Staged, so that Catalyst knows its size and sends it around only if it is small;
    # otherwise the pages would be shuffled before that is known.
    shelves = stage(shelves, "shelves")
    opened = pages.withColumnRenamed("url", "bookshelf_url").join(shelves, "bookshelf_url")
    found = typed_anchors(opened, ["shelf_pos"]).select(
        "shelf_pos", F.col("pos").alias("ebook_pos"), "ebook_id", "ebook_title"
    )
    return shelves.join(found, "shelf_pos", "left").select(
        "shelf_pos", "bookshelf_url", "ebook_pos", "ebook_id", "ebook_title"
    )


def build_catalog(pages: DataFrame, index_urls: tuple[str, ...] | DataFrame = INDEX_URLS, **options) -> DataFrame:
    """The listing of stored pages (url, html), groups linked from the first index page first.

    ``index_urls`` has the addresses of the index pages in order, or is a table of them (url, page_no).
    """
    if isinstance(index_urls, DataFrame):
        index_pages = pages.join(index_urls.select("url", "page_no"), "url").select("page_no", "html")
    else:
        page_no = F.array_position(F.lit(list(index_urls)), F.col("url"))
        index_pages = pages.where(F.col("url").isin(*index_urls)).select(page_no.alias("page_no"), "html")
    return catalog(index_pages, pages.select("url", "html"), **options)


def candidate_urls(
    listing: DataFrame,
    doc: str = "ebook_id",
    root: str = FILE_ROOT,
    suffixes: tuple[str, ...] = FILE_SUFFIXES,
) -> DataFrame:
    """``listing`` once per file suffix, with ``priority`` (from 0) and ``url``.

    The path of a number is its digits but the last: 611 is at 6/1/611/611.txt.
    """
    digits = F.col(doc).cast("string")
    path = F.array_join(F.split(F.left(digits, F.length(digits) - 1), ""), "/")
    stem = F.concat_ws("/", F.lit(root), path, digits, digits)
    return listing.withColumn("_stem", stem).select(
        *listing.columns, "_stem",
        F.posexplode(F.array(*[F.lit(s) for s in suffixes])).alias("priority", "_suffix"),
    ).withColumn("url", F.concat("_stem", "_suffix")).drop("_stem", "_suffix")


def first_available(candidates: DataFrame, lengths: DataFrame, doc: str = "ebook_id") -> DataFrame:
    """``doc``, ``url`` and ``length`` of its first candidate with a known length.

    ``candidates`` has one set of rows per document (see ``candidate_urls``); a document
    without any available candidate is dropped.
    """
    return (
        candidates.select(doc, "priority", "url")
        .join(lengths.where(F.col("length").isNotNull()).select("url", "length"), "url")
        .groupBy(doc)
        .agg(F.min_by(F.struct("url", "length"), "priority").alias("_found"))
        .select(doc, "_found.url", "_found.length")
    )


def resolve_urls(
    listing: DataFrame, lengths: DataFrame, doc: str = "ebook_id", root: str = FILE_ROOT,
    suffixes: tuple[str, ...] = FILE_SUFFIXES,
) -> DataFrame:
    """``listing`` with the ``url`` and ``length`` of each document; unavailable ones go.

    Every document is looked up once, however often it is listed.
    """
    found = first_available(candidate_urls(listing.select(doc).distinct(), doc, root, suffixes), lengths, doc)
    return listing.join(found, doc)


def group_sizes(resolved: DataFrame, group: list[str], size: str = "length") -> DataFrame:
    """Documents and total size per group; a document listed twice counts twice."""
    return resolved.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(size).cast("long")).alias("total_size")
    )
