"""Scalar functions on columns: ids, references, dates, labels, hashes. All are built-in expressions, so they stay in generated code.

A missing value is the empty string in this data model, and null means the same wherever it comes in; ``nz`` makes one of both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the search page and the parsers see it (Unicode), for Java and RE2 alike.
SPACES = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# How a legal act is cited.
ACT_CITED = r"\((?:EU|EG|EC)\)\s*(?:No\.?\s*)?\d{1,4}/\d{1,4}|\d{4}/\d{1,4}(?=/(?:EU|EG|EC)\b)"
# Date formats by precedence (one digit suffices).
DATE_FORMATS = ("d/M/yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyy-M-d", "d.M.yyyy")
# Tokens of a joint id whose number has three digits at least; acts beside them can be configured.
JOINT_FORMATS = {"DORA": "%s%03d"}
# Titles that lead a section's text.
SECTION_TITLES = ("eiopa answer", "answer", "background of the question", "background", "question")
# A token and a number that make a joint id.
JOINT_CITED = r"([A-Za-z]{3,10})[\s_-]*0*(\d{1,4})"
# An article that isn't one.
NO_ARTICLE = ("n/a", "na", "none", "-")


def nz(col: Column) -> Column:
    """'' for null."""
    return F.coalesce(col, F.lit(""))


def first_of(*cols: Column) -> Column:
    """The first that isn't missing, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def squash(col: Column) -> Column:
    """Runs of white space as one space."""
    return F.regexp_replace(col, f"{SPACES}+", " ")


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{SPACES}+|{SPACES}+$", "")


def slug_of(col: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(nz(col), "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))


def record_slug(qa_id: Column, url: Column) -> Column:
    return first_of(slug_of(qa_id), F.substring(F.sha1(F.encode(nz(url), "utf-8")), 1, 12))


def url_slug(url: Column) -> Column:
    last = F.element_at(F.split(F.regexp_replace(nz(url), "/+$", ""), "/"), -1)
    return slug_of(F.regexp_replace(last, "_en$", ""))


def act_family(label: Column) -> Column:
    base = F.lower(strip(F.split_part(nz(label), F.lit("-"), F.lit(1))))
    return first_of(F.regexp_replace(F.regexp_replace(base, "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit("unsorted"))


def act_ref(raw: Column) -> Column:
    """The number of the first act cited, or ''."""
    return F.regexp_extract(F.regexp_extract(nz(raw), ACT_CITED, 0), r"\d{1,4}/\d{1,4}", 0)


def final_ref(raw: Column, default: Column | str = "") -> Column:
    """Nothing given: the default. Something given that names no act: '' (never the default)."""
    default = F.lit(default) if isinstance(default, str) else default
    return F.when(nz(raw) == "", default).otherwise(act_ref(raw))


def iso_date(col: Column) -> Column:
    value = strip(squash(nz(col)))
    return nz(F.date_format(F.coalesce(*[F.try_to_date(value, f) for f in DATE_FORMATS]), "yyyy-MM-dd"))


def format_joint_id(token: Column, number: Column, formats: dict[str, str] = JOINT_FORMATS) -> Column:
    token = F.upper(token)
    out = F.format_string("%s%d", token, number)
    for t, f in formats.items():
        out = F.when(token == t, F.format_string(f, token, number)).otherwise(out)
    return out


def joint_id_of(native_id: Column, formats: dict[str, str] = JOINT_FORMATS) -> Column:
    """From an id such as 'ABC 12 - 345'; one of digits only has none."""
    token, number = (F.regexp_extract(nz(native_id), JOINT_CITED, g) for g in (1, 2))
    return F.when(token == "", "").otherwise(format_joint_id(token, number.try_cast("int"), formats))


def epoch_ms_date(ms: Column) -> Column:
    return nz(F.date_format(F.date_from_unix_date(F.floor(ms / 86_400_000).cast("int")), "yyyy-MM-dd"))


def facet_date(day: Column) -> Column:
    return F.url_encode(F.date_format(F.to_date(day), "dd/MM/yyyy"))


def act_query(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: F.concat(F.lit("qa_legal_act%5B%5D="), i.cast("string"))), "&")


def cache_bust(url: Column, epoch: int) -> Column:
    return F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit(f"cachebust={epoch}"))


def strip_section_title(col: Column) -> Column:
    return F.regexp_replace(strip(nz(col)), rf"^(?i)(?:{'|'.join(SECTION_TITLES)})\b[\s:]*", "")


def label_key(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(nz(col)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def before_colon(col: Column) -> Column:
    return strip(F.split_part(nz(col), F.lit(":"), F.lit(1)))


def after_colon(col: Column) -> Column:
    return strip(F.when(F.contains(nz(col), F.lit(":")), F.regexp_replace(col, "^[^:]*:", "")).otherwise(""))


def yaml_quoted(col: Column) -> Column:
    """A one-line double-quoted scalar; the backslash goes first."""
    out = F.replace(F.replace(nz(col), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for line_end in ("\r\n", "\r", "\n"):
        out = F.replace(out, F.lit(line_end), F.lit("\\n"))
    return F.concat(F.lit('"'), out, F.lit('"'))


def yaml_value(col: Column) -> Column:
    """What a scalar of a record's head says: quoted ones by the rules of JSON strings, bare ones as they stand."""
    text = strip(nz(col))
    quoted = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string", {"allowUnquotedControlChars": "true"})["v"]
    return F.when(F.startswith(text, F.lit('"')), nz(quoted)).otherwise(text)


def clean_article(col: Column) -> Column:
    out = strip(F.regexp_replace(nz(col), r"^(?i)\s*art(?:icle|\.)?\s+", ""))
    return F.when(F.lower(out).isin(*NO_ARTICLE), "").otherwise(out)


def first_integer(col: Column) -> Column:
    return F.regexp_extract(nz(col), r"\d+", 0)


def html_escaped(col: Column) -> Column:
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, nz(col))


def haystack(*cols: Column) -> Column:
    """What a search looks through: lower case, white space collapsed; missing parts keep their separators."""
    return F.lower(squash(F.concat_ws(" ", *[nz(c) for c in cols])))


def ceil_div(n: Column, size: int) -> Column:
    return F.ceil(n / size).cast("long")


def days_before(now: str, days: int) -> Column:
    """The ISO date so many days before now (an ISO timestamp, given so that results don't depend on the clock)."""
    return F.date_format(F.date_sub(F.to_date(F.lit(now[:10])), days), "yyyy-MM-dd")


def delisted_hash(col: Column) -> Column:
    return F.when(F.startswith(col, F.lit("delisted:")), col).otherwise(F.concat(F.lit("delisted:"), col))


# Where the authorities show single questions.
QUESTION_PAGES = {
    "eba": "https://www.eba.europa.eu/single-rule-book-qa/qna/view/publicId/",
    "eiopa": "https://www.eiopa.europa.eu/qa-regulation/questions-and-answers-database/",
    "esma": "https://www.esma.europa.eu/publications-data/questions-answers/",
}


def candidate_links(authority: Column, native_id: Column, link: Column, joint_id: Column) -> Column:
    """Addresses to try for a row whose link isn't one, best first.

    eba: the id ``YYYY_n`` in the link cell, else in the native id. esma: a numeric native id, else the first number of three digits or more
    in the cell. eiopa: the id's slug if it holds the joint id, else id and joint id in both orders. Others: none.
    """
    native, cell, joint = slug_of(native_id), nz(link), F.lower(strip(nz(joint_id)))
    year_id = first_of(F.regexp_extract(cell, r"\b(\d{4}_\d+)\b", 1), F.regexp_extract(nz(native_id), r"\b(\d{4}_\d+)\b", 1))
    number = F.when(F.rlike(nz(native_id), F.lit(r"^\d+$")), nz(native_id)).otherwise(F.regexp_extract(cell, r"\b\d{3,}\b", 0))
    none = F.array().cast("array<string>")
    one = lambda base, part: F.when(part == "", none).otherwise(F.array(F.concat(F.lit(base), part)))
    page = lambda *parts: F.concat(F.lit(QUESTION_PAGES["eiopa"]), *parts, F.lit("_en"))
    both = F.array(page(native, F.lit("-"), joint), page(joint, F.lit("-"), native))
    pair = F.when((joint != "") & F.contains(native, joint), F.array(page(native))).when((native == "") | (joint == ""), none).otherwise(both)
    return F.when(authority == "eba", one(QUESTION_PAGES["eba"], year_id)).when(authority == "esma", one(QUESTION_PAGES["esma"], number)).when(authority == "eiopa", pair).otherwise(none)


# Names of acts by reference.
ACT_LABELS = {
    "2022/2554": "DORA",
    "2022/2556": "DORA-Amending-Directive",
    "2024/1772": "DORA-RTS-Incident-Classification",
    "2024/1773": "DORA-RTS-TPPol",
    "2024/1774": "DORA-RTS-RMF",
    "2024/2956": "DORA-ITS-Register-of-Information",
    "2025/301": "DORA-RTS-Incident-Reporting",
    "2025/302": "DORA-ITS-Incident-Reporting",
    "2025/532": "DORA-RTS-Subcontracting",
    "2025/1190": "DORA-RTS-TLPT",
    "2013/36": "CRD",
    "575/2013": "CRR",
    "2015/2366": "PSD2",
}
# The authorities' notices on reuse.
LEGAL_NOTICES = {
    "eba": "https://www.eba.europa.eu/legal-notice",
    "eiopa": "https://www.eiopa.europa.eu/legal-notice_en",
    "esma": "https://www.esma.europa.eu/legal-notice",
}


def lookup(key: Column, table: dict[str, str], default: Column | str = "") -> Column:
    """A small constant table as an expression: no join, no shuffle."""
    default = F.lit(default) if isinstance(default, str) else default
    if not table:
        return default
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(pairs[key], default)


def finalised(raw: Column, label: Column, default: str = "", labels: dict[str, str] | None = None) -> Column:
    """struct(ref, legal_act_ref, legal_act) of what a record says about its act."""
    ref = final_ref(raw, default)
    shown = F.when(ref == "", "").otherwise(F.concat(F.lit("(EU) "), ref))
    return F.struct(ref.alias("ref"), shown.alias("legal_act_ref"), lookup(ref, labels or ACT_LABELS, nz(label)).alias("legal_act"))
