"""E-books and HTML as text."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from dialoom.functions import text as T

# Elements before and after which a line ends, and those whose content is no text.
BREAK_BEFORE = frozenset("p div br h1 h2 h3 h4 h5 h6 li tr".split())
BREAK_AFTER = frozenset("p div h1 h2 h3 h4 h5 h6".split())
SILENT = frozenset(("script", "style"))
CHAPTER_BREAK = "\n\n---\n\n"


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        self.silent += tag in SILENT
        if tag in BREAK_BEFORE:
            self.parts.append("\n")

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in BREAK_BEFORE:
            self.parts.append("\n")
        if tag in BREAK_AFTER:  # an empty element both begins and ends
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        if tag in BREAK_AFTER:
            self.parts.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)


def text_of_html(html: str | None) -> str | None:
    """The text of a page: a line per block, lines stripped, two blank lines in a row at most. What an unfinished tag or
    entity at the very end holds back is lost."""
    if html is None:
        return None
    reader = _Reader()
    reader.feed(html)
    out: list[str] = []
    blank = 0
    for line in (x.strip() for x in "".join(reader.parts).splitlines()):
        blank = 0 if line else blank + 1
        if blank <= 2:
            out.append(line)
    return "\n".join(out).strip()


def html_to_text(html: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(text_of_html), StringType())(html)


#: Entities that `html_to_text_sql` knows, the sign of entities itself last.
_ENTITIES = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0"), ("amp", "&"))
#: What ends a line besides a line feed, and white space that does not.
LINE_END = r"\r\n|[\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
INLINE_SPACE = r"[\x{9}\x{1f}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"


def html_to_text_sql(html: Column) -> Column:
    """The same for well-formed pages with the common named entities, as regular expressions that stay in the JVM."""
    quiet = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    empty = F.regexp_replace(quiet, r"(?i)<(?:p|div|h[1-6])\b[^<>]*/>", "\n\n")
    broken = F.regexp_replace(F.regexp_replace(empty, r"(?i)<(?:p|div|br|h[1-6]|li|tr)\b[^<>]*>", "\n"), r"(?i)</(?:p|div|h[1-6])\s*>", "\n")
    plain = F.regexp_replace(broken, r"<[^<>]*>", "")
    for name, sign in _ENTITIES:
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(sign))
    lines = F.regexp_replace(F.regexp_replace(plain, LINE_END, "\n"), f"{INLINE_SPACE}*\n{INLINE_SPACE}*", "\n")
    return T.strip(F.regexp_replace(lines, r"\n{4,}", "\n\n\n"))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def opf_path(book: zipfile.ZipFile) -> str | None:
    """The package file that the container names, else the first one there is."""
    try:
        for element in ElementTree.fromstring(book.read("META-INF/container.xml")).iter():
            if _local(element.tag) == "rootfile" and element.get("full-path"):
                return element.get("full-path")
    except (KeyError, ElementTree.ParseError):
        pass
    return next((n for n in book.namelist() if n.endswith(".opf")), None)


def read_package(xml: bytes) -> tuple[dict[str, str], list[str]]:
    """The manifest (id -> href of items of HTML or XML) and the ids of the spine in order."""
    manifest, spine = {}, []
    for element in ElementTree.fromstring(xml).iter():
        kind = _local(element.tag)
        if kind == "item" and re.search("html|xml", element.get("media-type") or "") and element.get("id"):
            manifest[element.get("id")] = element.get("href") or ""
        elif kind == "itemref" and element.get("idref"):
            spine.append(element.get("idref"))
    return manifest, spine


def chapters_of(content: bytes) -> list[tuple[int, str, str]]:
    """(place in the spine, href, text) of the chapters of a book; those that are missing or blank are left out.

    Raises ValueError if the content is no book.
    """
    if not zipfile.is_zipfile(io.BytesIO(content)):
        raise ValueError("not an e-book")
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        path = opf_path(book)
        if path is None:
            raise ValueError("no package file in the e-book")
        manifest, spine = read_package(book.read(path))
        names, folder, out = set(book.namelist()), posixpath.dirname(path), []
        for place, item in enumerate(spine):
            href = manifest.get(item)
            name = next((n for n in (posixpath.join(folder, href or ""), href) if n in names), None) if href else None
            if name is None:
                continue
            try:
                text = text_of_html(book.read(name).decode("utf-8"))
            except (UnicodeDecodeError, zipfile.BadZipFile):
                continue
            if text:
                out.append((place, href, text))
        return out


def read_chapters(spark: SparkSession, path: str, pattern: str = "*.epub") -> DataFrame:
    """(path, place, href, text, error): the chapters of all books under a path; a book that cannot be read gives one row with its error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return chapters(files)


def chapters(files: DataFrame) -> DataFrame:
    """`read_chapters` of files (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"]):
                try:
                    rows = [(where, *c, None) for c in chapters_of(bytes(content))]
                except (ValueError, KeyError, ElementTree.ParseError) as error:
                    rows = [(where, None, None, None, str(error))]
                out = pd.DataFrame(rows, columns=["path", "place", "href", "text", "error"])
                yield out.astype({"place": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, place int, href string, text string, error string")


def join_chapters(chapters: DataFrame, key: str = "path", place: str = "place", text: str = "text") -> DataFrame:
    """(key, text): the chapters of each book in the order of their place."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), F.col(text).alias("t"))))
    return chapters.filter(F.col(text).isNotNull()).groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), CHAPTER_BREAK).alias("text"))


def spine_order(spine: DataFrame, manifest: DataFrame) -> DataFrame:
    """(book, place, href): spine items with a manifest entry; repeated ones stay."""
    return spine.join(manifest, ["book", "item"]).select("book", "place", "href")
