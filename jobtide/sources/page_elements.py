"""The one Python function of the library: the elements of a stored page, as an Arrow function."""

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Executors get this module's functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ATTRIBUTES = ["id", "class", "href", "department_id", "office_id"]
ELEMENTS = T.ArrayType(
    T.StructType(
        [T.StructField(name, T.IntegerType()) for name in ["start", "end", "parent"]]
        + [T.StructField(name, T.StringType()) for name in ["tag", "text", *ATTRIBUTES]]
    )
)

_VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW_TEXT_END = {tag: re.compile(f"</{tag}", re.I) for tag in ("script", "style")}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NO_ATTRIBUTES = [None] * len(ATTRIBUTES)
_START, _END, _PARENT, _TAG, _TEXT = range(5)


def _attributes(text: str) -> list[str | None]:
    """The attributes of interest; of one given twice the first counts."""
    if not text:
        return _NO_ATTRIBUTES
    given = {}
    for name, *quoted in _ATTRIBUTE.findall(text):
        given.setdefault(name.lower(), unescape("".join(quoted)))
    return [given.get(name) for name in ATTRIBUTES]


def read_elements(html: str) -> list[list]:
    """Elements of a page as in ``ELEMENTS``: place, last place beneath, parent, tag, first own
    text, attributes. Missing end tags are made up for by the end of an outer element."""
    found, open_elements, position = [], [], 0

    def close(depth):
        for element in open_elements[depth:]:
            element[_END] = len(found) - 1
        del open_elements[depth:]

    def add_text(begin, until):
        if begin < until and open_elements and not open_elements[-1][_TEXT]:
            open_elements[-1][_TEXT] = unescape(html[begin:until])

    def start(tag, rest):
        if tag == "p" and open_elements and open_elements[-1][_TAG] == "p":
            close(len(open_elements) - 1)
        parent = open_elements[-1][_START] if open_elements else None
        element = [len(found), len(found), parent, tag, None, *_attributes(rest)]
        found.append(element)
        if tag not in _VOID_TAGS and not rest.endswith("/"):
            open_elements.append(element)

    def end(tag):
        for depth in range(len(open_elements) - 1, -1, -1):
            if open_elements[depth][_TAG] == tag:
                return close(depth)

    opening = html.find("<")
    while opening >= 0:
        token = _TOKEN.match(html, opening)
        if token is None:
            opening = html.find("<", opening + 1)
            continue
        add_text(position, opening)
        position = token.end()
        closing, tag, rest = token.groups()
        if closing:
            end(tag.lower())
        elif tag:
            tag = tag.lower()
            start(tag, rest)
            if tag in _RAW_TEXT_END:
                ending = _RAW_TEXT_END[tag].search(html, position)
                opening = ending.start() if ending else -1
                continue
        opening = html.find("<", position)
    add_text(position, len(html))
    close(0)
    return found


#: Characters of markup that are Python objects at once, where an element counts for so many more.
_SLICE, _ELEMENT = 1 << 21, 50


def _as_arrow(rows: list[list], ends: list[int]) -> pa.Array:
    element = to_arrow_type(ELEMENTS).value_type
    columns = zip(*rows, strict=True) if rows else [[]] * len(element)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, element, strict=True)]
    flat = pa.StructArray.from_arrays(arrays, fields=list(element))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


@F.arrow_udf(ELEMENTS)
def page_elements(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """All elements of each page, in document order; none for a NULL page.

    A batch may hold 10,000 pages or 64 MB, and its elements take many times that as Python objects.
    So they leave in slices, and a task's memory depends on its longest page only.
    """
    for pages in batches:
        rows, ends, size = [], [0], 0
        for page in pages:
            html = page.as_py() or ""
            rows += read_elements(html)
            size += len(html) + _ELEMENT * (len(rows) - ends[-1])
            ends.append(len(rows))
            if size >= _SLICE:
                yield _as_arrow(rows, ends)
                rows, ends, size = [], [0], 0
        if len(ends) > 1:
            yield _as_arrow(rows, ends)
