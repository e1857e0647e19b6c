"""Company fields out of landed web pages: column expressions for flat elements, and a walk through
the tags for nested ones."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.functions.text import strip_words

# Month abbreviations and phrases removed from scraped texts.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
PEOPLE = ("people",)
PLACE_PHRASES = ("Basque Country", "View more")
RANKING_PHRASES = ("Dealroom.co signal",)

# field -> (pattern with one group, words to strip)
PROFILE_RULES: dict[str, tuple[str, Sequence[str]]] = {
    "name": (r"(?s)<h1[^>]*>(.*?)</h1>", ()),
    "launch_year": (r"(?s)<time[^>]*>(.*?)</time>", MONTHS),
    "employees": (r'(?s)<div class="field employees">.*?<a[^>]*>(.*?)</a>', PEOPLE),
    "ownership": (r'(?s)<a class="field-value-link"[^>]*>(.*?)</a>', ()),
    "location": (r'(?s)<span class="highlight">(.*?)</span>', PLACE_PHRASES),
    "ranking": (r'(?s)<div class="ranking-section-container">(.*?)</div>', RANKING_PHRASES),
}


def field(html: Column, pattern: str, words: Sequence[str] = ()) -> Column:
    """First match of ``pattern`` without inner tags and the listed words; NULL when the element is
    missing."""
    found = F.when(F.regexp_like(html, F.lit(pattern)), F.regexp_replace(F.regexp_extract(html, pattern, 1), "<[^>]*>", ""))
    return F.nullif(strip_words(found, words), F.lit(""))


def extract_page_fields(
    pages: DataFrame, rules: Mapping[str, tuple[str, Sequence[str]]] = PROFILE_RULES, html: str = "html"
) -> DataFrame:
    """Every page with one column per rule; the page text itself is not carried on."""
    fields = [field(F.col(html), pattern, words).alias(name) for name, (pattern, words) in rules.items()]
    return pages.select(*(c for c in pages.columns if c != html), *fields)


# ---- nested elements -----------------------------------------------------------------------------

#: An element by its tag and classes, and those it must lie in, outermost first.
Path = Sequence[tuple[str, str | None]]

# Where the profile fields stand. field -> (path, words to strip)
NESTED_RULES: dict[str, tuple[Path, Sequence[str]]] = {
    "name": ((("h1", None),), ()),
    "launch_year": ((("div", "description"), ("time", None)), MONTHS),
    "employees": ((("div", "field employees"), ("a", None)), PEOPLE),
    "ownership": ((("a", "field-value-link"),), ()),
    "location": ((("span", "highlight"),), PLACE_PHRASES),
    "ranking": ((("div", "ranking-section-container"),), RANKING_PHRASES),
}

# Elements that have no content, and those whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))


class ElementTexts(HTMLParser):
    """The text of the first element of each path, in one walk with a stack of open tags.

    Attributes may stand in any order; a class is there if all its words are. An end tag closes
    what was left open inside its element and is ignored if no such element is open; what the page
    leaves open ends with it.
    """

    def __init__(self, paths: Mapping[str, Path]):
        super().__init__(convert_charrefs=True)
        self.paths = {name: [(tag, frozenset((words or "").split())) for tag, words in path] for name, path in paths.items()}
        self.stack: list[tuple[str, frozenset]] = []
        self.open: dict[str, tuple[int, list[str]]] = {}
        self.found: dict[str, str] = {}

    def handle_starttag(self, tag: str, attrs) -> None:
        words = frozenset(w for key, value in attrs if key == "class" for w in (value or "").split())
        self.stack.append((tag, words))
        for name, path in self.paths.items():
            if name not in self.found and name not in self.open and self._at_end(path):
                self.open[name] = (len(self.stack), [])
        if tag in VOID:
            self._close(len(self.stack) - 1)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._close(at)
                break

    def handle_data(self, data: str) -> None:
        if self.open and not any(tag in SILENT for tag, _ in self.stack):
            for _, parts in self.open.values():
                parts.append(data)

    def close(self) -> None:
        super().close()
        self._close(0)

    def _at_end(self, path) -> bool:
        """Whether the innermost open element ends the path, the others around it in order."""
        left = list(path)
        tag, words = left.pop()
        if self.stack[-1][0] != tag or not words <= self.stack[-1][1]:
            return False
        for outer_tag, outer_words in reversed(self.stack[:-1]):
            if left and outer_tag == left[-1][0] and left[-1][1] <= outer_words:
                left.pop()
        return not left

    def _close(self, depth: int) -> None:
        """Elements from ``depth`` on end."""
        del self.stack[depth:]
        for name in [n for n, (at, _) in self.open.items() if at > depth]:
            self.found[name] = "".join(self.open.pop(name)[1])


def element_texts(html: str | None, paths: Mapping[str, Path]) -> dict[str, str]:
    walk = ElementTexts(paths)
    walk.feed(html or "")
    walk.close()
    return walk.found


def extract_nested_fields(
    pages: DataFrame, rules: Mapping[str, tuple[Path, Sequence[str]]] = NESTED_RULES, html: str = "html"
) -> DataFrame:
    """Every page with one column per rule; NULL where a page has no such element or it is empty.

    Each page is walked once for all rules. The page text is not carried on; repeated pages stay, an
    empty table gives no rows.
    """
    kept = [c for c in pages.columns if c != html]
    paths = {name: path for name, (path, _) in rules.items()}
    schema = pages.select(*kept).schema
    fields = {name: f"__{i}" for i, name in enumerate(rules)}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [element_texts(t, paths) for t in batch.column(html).to_pylist()]
            columns = [batch.column(c) for c in kept] + [pa.array([t.get(n) for t in texts], pa.string()) for n in rules]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *fields.values()])

    for column in fields.values():
        schema = schema.add(column, "string")
    found = pages.select(*kept, html).mapInArrow(walk, schema)
    cleaned = [F.nullif(strip_words(F.col(fields[n]), words), F.lit("")).alias(n) for n, (_, words) in rules.items()]
    return found.select(*kept, *cleaned)
