"""Text and fields of detail pages, from a small tree built with the standard library's parser.

Only parsing runs in Python, a batch of pages at a time; what it returns are structs, and a page that can't be parsed returns its error instead
of raising, so that one bad page never stops a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .text import JOINT_CITED, JOINT_FORMATS, SECTION_TITLES

# Elements without an end, elements whose text isn't shown, and elements that end an open one of their kind.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
# Elements that make a paragraph of text.
PARAGRAPHS = ("p", "li", "h2", "h3", "h4", "td")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Labels of the dialects' fields.
LIST_LABELS = {
    "question id": "qa_id", "legal act": "legal_act_raw", "article": "article", "topic": "topic", "status": "status", "question": "question",
    "background on the question": "background", "answer": "answer", "final answer": "answer",
}
BOLD_LABELS = {"question id": "qa_id", "regulation reference": "legal_act_raw", "article": "article", "topic": "topic", "status": "status"}
# Parts of labels that name a person or a firm; their fields are dropped.
PRIVATE = ("submitter", "name of institution", "country of incorporation")
_TITLE = re.compile(rf"^(?:{'|'.join(SECTION_TITLES)})\b[\s:]*", re.I)

RECORD = (
    "authority string, qa_id string, joint_id string, legal_act_raw string, article string, topic string, status string, dates map<string,string>, "
    "extra map<string,string>, source_url string, question string, background string, answer string, error string"
)


class Element:
    __slots__ = ("attributes", "children", "name", "parent")

    def __init__(self, name: str, attributes: dict[str, str], parent: Element | None):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Element)]
        while todo:
            e = todo.pop()
            yield e
            todo.extend(c for c in reversed(e.children) if isinstance(c, Element))

    def all(self, *names: str) -> list[Element]:
        return [e for e in self.walk() if e.name in names]

    def first(self, *names: str) -> Element | None:
        return next((e for e in self.walk() if e.name in names), None)

    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def strings(self) -> Iterator[str]:
        todo: list[Element | str] = [self]
        while todo:
            e = todo.pop()
            if isinstance(e, str):
                yield e
            elif e.name not in SILENT or e is self:
                todo.extend(reversed(e.children))

    def text(self) -> str:
        """Its strings, each stripped, with single spaces between."""
        return " ".join(s for s in (" ".join(x.split()) for x in self.strings()) if s)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def _leave(self, names: tuple[str, ...] | frozenset[str], stop: frozenset[str]) -> None:
        e = self.at
        while e.parent is not None and e.name not in stop:
            if e.name in names:
                self.at = e.parent
                return
            e = e.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES:
            self._leave(CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "div", "article", "section", "details")) - frozenset(CLOSES[tag]))
        elif tag in ENDS_P:
            self._leave(("p",), ENDS_P)
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag == "br":
            e.children.append("\n")
        elif tag not in VOID:
            self.at = e

    def handle_endtag(self, tag: str) -> None:
        e: Element | None = self.at
        while e is not None and e.parent is not None:
            if e.name == tag:
                self.at = e.parent
                return
            e = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def to_text(e: Element | None) -> str:
    """Paragraphs of the top-most paragraph elements, list items with a dash; the whole text where there is none. Text beside paragraphs is dropped."""
    if e is None:
        return ""
    out, found = [], False

    def visit(node: Element) -> None:
        nonlocal found
        for c in node.children:
            if not isinstance(c, Element) or c.name in SILENT:
                continue
            if c.name in PARAGRAPHS:
                found = True
                if t := c.text():
                    out.append(f"- {t}" if c.name == "li" else t)
            else:
                visit(c)

    if e.name in PARAGRAPHS:
        return f"- {e.text()}" if e.name == "li" and e.text() else e.text()
    visit(e)
    return "\n\n".join(out) if found else e.text()


def field_name(label: str) -> str:
    """As text.label_key, for one string: its letters and digits, other runs as one _."""
    return "_".join(re.findall(r"[a-z0-9]+", label.lower()))


def _blank(authority: str, url: str) -> dict:
    return {"authority": authority, "qa_id": "", "joint_id": "", "legal_act_raw": "", "article": "", "topic": "", "status": "", "dates": {}, "extra": {}, "source_url": url, "question": "", "background": "", "answer": "", "error": ""}


def _tail(url: str) -> str:
    return url.rstrip("/").rsplit("/", 1)[-1]


def from_list(root: Element, url: str, formats: dict[str, str] = JOINT_FORMATS) -> dict:  # noqa: ARG001
    """Fields of a definition list: known labels, dates, and all others but private ones."""
    r = _blank("eba", url)
    table = next((e for e in root.all("dl") if "metadata" in e.classes()), None)
    if table is None:
        r["extra"]["parse_warning"] = "no field list on the page"
    else:
        for dt in table.all("dt"):
            beside = [c for c in dt.parent.children if isinstance(c, Element)]
            dd = next((c for c in beside[beside.index(dt) + 1 :][:1] if c.name == "dd"), None)
            label = dt.text().lower().rstrip(":").strip()
            if dd is None or any(p in label for p in PRIVATE):
                continue
            value = to_text(dd)
            if label in LIST_LABELS:
                r[LIST_LABELS[label]] = value
            elif "date" in label:
                r["dates"][field_name(label)] = value
            else:
                r["extra"][field_name(label)] = value
    r["qa_id"] = r["qa_id"] or _tail(url)
    return r


def from_headings(root: Element, url: str, formats: dict[str, str] = JOINT_FORMATS) -> dict:
    """Fields set in bold, and sections below headings; the joint id is that of the address, by its token's format."""
    r = _blank("eiopa", url)
    page = root.first("article") or root
    for p in page.all("p"):
        bold = p.first("b")
        if bold is None:
            continue
        label, value = p.text().split(":")[0].strip().lower(), bold.text()
        if label in BOLD_LABELS:
            r[BOLD_LABELS[label]] = value
        elif "date" in label:
            r["dates"][field_name(label)] = value
    for h in page.all(*HEADINGS):
        title = h.text()
        part = next((k for k in ("background", "answer", "question") if k in title.lower()), None)
        if part is None:
            continue
        texts = []
        for c in h.parent.children[h.parent.children.index(h) + 1 :]:
            if isinstance(c, Element):
                if c.name in HEADINGS:
                    break
                texts.append(to_text(c))
        body = "\n\n".join(t for t in texts if t)
        if not body:
            body = to_text(h.parent)
            body = body[len(title) :].strip() if body.startswith(title) else body
        body = _TITLE.sub("", body)
        r[part] = r[part] or body
    r["qa_id"] = r["qa_id"] or _tail(url).removesuffix("_en")
    m = re.search(JOINT_CITED, r["qa_id"])
    if m:
        r["joint_id"] = formats.get(m[1].upper(), "%s%d") % (m[1].upper(), int(m[2]))
    return r


def _field(root: Element, name: str) -> str:
    e = next((x for x in root.walk() if f"field--name-{name}" in x.classes()), None)
    if e is None:
        return ""
    return (next((x for x in e.walk() if "field__item" in x.classes()), e)).text()


def from_fields(root: Element, url: str, formats: dict[str, str] = JOINT_FORMATS) -> dict:  # noqa: ARG001
    """Fields in named boxes, and folded blocks: the first is the question, the others the answer."""
    r = _blank("esma", url)
    r["qa_id"] = _tail(url)
    r["topic"] = _field(root, "field-qa-subject-matter")
    r["legal_act_raw"] = next(filter(None, (_field(root, n) for n in ("field-qa-level1", "field-qa-legal-act", "field-legal-act"))), "")
    r["article"] = next(filter(None, (_field(root, n) for n in ("field-qa-article", "field-article"))), "")
    info = next((e for e in root.all("div") if "additionalinfo" in e.classes()), None)
    for div in info.children if info else ():
        if isinstance(div, Element) and div.name == "div":
            label, colon, value = div.text().partition(":")
            if label.lower().startswith("status"):
                r["status"] = value.strip() if colon else label.strip()
            elif "date" in div.text().lower() and colon:
                r["dates"][field_name(label)] = value.strip()
    texts = [t for t in map(to_text, root.all("details")) if t]
    if texts:
        r["question"], r["answer"] = texts[0], "\n\n---\n\n".join(texts[1:])
    else:
        body = next((e for e in root.walk() if any("question__content" in c for c in e.classes())), None) or root.first("article")
        r["question"] = to_text(body)
        r["extra"]["parse_warning"] = "no folded blocks; the page's body is the question"
    return r


DIALECTS = {"eba": from_list, "eiopa": from_headings, "esma": from_fields}


def parse_page(authority: str, url: str, html: str | None, formats: dict[str, str] = JOINT_FORMATS) -> dict:
    try:
        return DIALECTS[authority](parse(html), url or "", formats)
    except Exception as e:  # noqa: BLE001  one bad page is one row's error
        return _blank(authority or "", url or "") | {"error": f"{type(e).__name__}: {e}"}


def parse_pages(pages: DataFrame, formats: dict[str, str] = JOINT_FORMATS) -> DataFrame:
    """pages: authority, url, html. A record per page, with error set where it couldn't be parsed. formats: how a joint id is written, by its token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        for b in batches:
            yield pd.DataFrame([parse_page(*row, formats) for row in zip(b["authority"], b["url"], b["html"], strict=True)], columns=names)

    return pages.select("authority", "url", "html").mapInPandas(run, RECORD)


@F.pandas_udf(StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(lambda x: to_text(parse(x)))


@F.udtf(returnType=StructType([StructField("pos", IntegerType()), StructField("tag", StringType()), StructField("text", StringType())]))
class HtmlBlocks:
    """html_blocks(html): the paragraphs of a page by position."""

    def eval(self, html: str):  # noqa: ANN201
        pos = 0
        todo = [parse(html)]
        while todo:
            e = todo.pop()
            if e.name in PARAGRAPHS:
                if t := e.text():
                    yield pos, e.name, t
                    pos += 1
            else:
                todo.extend(reversed([c for c in e.children if isinstance(c, Element) and c.name not in SILENT]))
