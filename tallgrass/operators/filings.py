"""Filings of contracts: rows of section, label and value out of their tables, typed fields, and corrections."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallgrass.functions import text
from tallgrass.operators.html import tables_of

# The head of a table of corrections, the section its rows get, and the labels of a contract's fields.
CORRECTION_HEAD, CORRECTION = ("정정항목", "정정전", "정정후"), "정정사항"
BODY, NOTES, RELATED = "판매공급계약", "기타투자판단", "※관련공시"
LABELS = {
    "판매공급계약구분": "contract_type", "판매공급계약내용": "contract_type", "체결계약명": "contract_name", "계약금액(원)": "contract_amount", "계약금액총액(원)": "contract_amount",
    "확정계약금액": "fixed_amount", "조건부계약금액": "conditional_amount", "조건부계약여부": "is_conditional", "최근매출액(원)": "recent_sales", "매출액대비(%)": "sales_ratio",
    "대규모법인여부": "is_large_corp", "계약상대": "counterparty", "계약상대방": "counterparty", "회사와의관계": "counterparty_relation", "주요사업": "counterparty_business",
    "회사와최근3년간동종계약이행여부": "counterparty_prior_contract", "판매공급지역": "region", "시작일": "start_date", "종료일": "end_date", "계약(수주)일자": "order_date", "수주일자": "order_date",
}
MAPS = {"주요계약조건": "conditions", "판매공급방식": "supply_method", "공시유보관련내용": "reservation"}
COUNTERPARTY = "계약상대"
TARGETS = {"정정관련공시서류": "correction_target_report", "정정관련공시서류제출일": "correction_target_date", "정정사유": "correction_reason"}
# Titles of the section that tells of the business, best first, the keywords that stand in for them, and how much of it counts.
SECTION_TITLES, SECTION_WORDS, SECTION_LENGTH = ("사업의 개요", "회사의 개요"), ("주요 사업의 내용", "사업의 개요", "회사의 개요"), 4000
AMOUNTS = ("contract_amount", "fixed_amount", "conditional_amount", "recent_sales", "counterparty_recent_sales")
DAYS = ("start_date", "end_date", "order_date")
_BLANK = ("", "-", "–")
_NUMBER, _DASH = r"^\s*\d+\s*\.\s*", r"^\s*[-ㆍ·]\s*"


def entries(tables: list[list[list[str]]]) -> Iterator[tuple[str, str, str, str | None]]:
    """(section, label, value, before) of grids of cells, in order; before is the text before a correction.

    A row over the whole width is a section's head, where it is numbered or marked, or else text that belongs to the head before it.
    """
    heads = lambda t: bool(re.match(_NUMBER, t)) or t.startswith("※")
    section, text = "", None  # text: the head that waits for its text
    for table in tables:
        correcting = False
        for row in table:
            cells = [" ".join(c.split()) for c in row]
            correcting = correcting and len(cells) >= 3
            if all(c in _BLANK for c in cells):
                continue
            if correcting:
                yield CORRECTION, cells[0], cells[-1], cells[1]
                continue
            whole = len(cells) >= 3 and cells[0] == cells[1] == cells[-1]
            if not whole and len(cells) >= 2 and tuple(cells[:3]) != CORRECTION_HEAD:
                if text is not None:
                    yield text[0], text[1], " ".join(text[2]), None
                    text = None
                pair = len(cells) == 2 or cells[1] == cells[-1] or cells[0] == cells[1]
                above, label = (section, cells[0]) if pair else (cells[0], cells[1])
                section = label if heads(label) else above if re.match(_NUMBER, above) else section
                yield section, label, cells[-1], None
            elif whole and heads(cells[0]):
                if text is not None:
                    yield text[0], text[1], " ".join(text[2]), None
                section, text = cells[0], (cells[0], cells[0], [])
            elif whole and text is not None:
                text[2].append(cells[0])
            elif tuple(cells[:3]) == CORRECTION_HEAD:
                if text is not None:
                    yield text[0], text[1], " ".join(text[2]), None
                correcting, text = True, None
    if text is not None:
        yield text[0], text[1], " ".join(text[2]), None


def _bare(label: str) -> str:
    return re.sub(r"[\sㆍ·]+", "", re.sub(_DASH, "", re.sub(_NUMBER, "", label)))


def scopes(tables: list[list[list[str]]]) -> tuple[list, list]:
    """The tables before the first that begins with the contract, which are those of a correction, and the others."""
    for i, table in enumerate(tables):
        if _bare(" ".join(c for row in table for c in row)).startswith(BODY):
            return tables[:i], tables[i:]
    return [], tables


def filing_entries(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, scope, place, section, label, value, before) of each page; scope is correction or body."""
    names = ["scope", "place", "section", "label", "value", "before"]
    schema = f"{key} {pages.schema[key].dataType.simpleString()}, scope string, place int, section string, label string, value string, before string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, x in zip(b[key], b[html]):
                for scope, tables in zip(("correction", "body"), scopes(tables_of(x))):
                    out += [(k, scope, i, *e) for i, e in enumerate(entries(tables))]
            yield pd.DataFrame(out, columns=[key, *names], dtype=object)

    return pages.select(key, html).mapInPandas(run, schema)


def bare_label(label: Column) -> Column:
    """A label without number, dash, white space and middle dots."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(label, _NUMBER, ""), _DASH, ""), r"[\sㆍ·]+", "")


def _day(value: Column) -> Column:
    p = r"^(\d{4})[-./](\d{1,2})[-./](\d{1,2})$"
    made = F.concat_ws("-", F.regexp_extract(value, p, 1), F.lpad(F.regexp_extract(value, p, 2), 2, "0"), F.lpad(F.regexp_extract(value, p, 3), 2, "0"))
    return F.when(value.rlike(p), F.date_format(made.try_cast("date"), "yyyy-MM-dd"))


def _typed(name: str, value: Column) -> Column:
    """A field's text as what it is: a whole amount, a ratio, a day, or text."""
    if name in AMOUNTS:
        bare = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(bare.rlike(r"^-?[\d,]+$"), F.replace(bare, F.lit(","), F.lit("")).try_cast("long"))
    if name == "sales_ratio":
        return F.regexp_replace(value, "[,%]", "").try_cast("double")
    if name in DAYS:
        return F.coalesce(_day(value), value)
    return _day(value) if name == "correction_target_date" else value


_NUMBER_A, _DASH_A, _GAPS_A = (re.compile(x, re.ASCII) for x in (_NUMBER, _DASH, r"[\sㆍ·]+"))
_FIELDS = (*dict.fromkeys(LABELS.values()), "counterparty_recent_sales")
_WIDE = ", ".join([*(f"{n} string" for n in _FIELDS), *(f"{n} map<string,string>" for n in MAPS.values()), "note string, related_disclosures string", "corrected array<struct<item:string,before:string,after:string>>", *(f"{n} string" for n in TARGETS.values()), "is_correction boolean"])


@functools.lru_cache(4096)
def _bare_label(label: str) -> str:
    """bare_label() of one label."""
    return _GAPS_A.sub("", _DASH_A.sub("", _NUMBER_A.sub("", label)))


def _fields_of(found: list[tuple]) -> dict:
    """What contract_fields() gives for the entries (scope, section, label, value, before) of one page, in order, as text."""
    out = {n: {} for n in MAPS.values()} | {"corrected": [], "is_correction": False}
    notes: dict = {}
    for scope, section, label, value, before in found:
        at, above, full = _bare_label(label), _bare_label(section), value not in _BLANK
        if scope == "correction":
            out["is_correction"] = True
            if section == CORRECTION:
                out["corrected"].append({"item": label, "before": before, "after": value})
            elif full and at in TARGETS:
                out[TARGETS[at]] = value
            continue
        held = MAPS.get(above) if at != above else None
        if held:
            out[held].pop(label, None)
            out[held][label] = value
        elif above.startswith(NOTES):
            if full:
                notes[value] = None
        elif at.startswith(RELATED):
            out["related_disclosures"] = value if full else None
        elif full and at in LABELS:
            n = LABELS[at]
            out["counterparty_recent_sales" if n == "recent_sales" and above.startswith(COUNTERPARTY) else n] = value
    if notes:
        out["note"] = " ".join(notes)
    return out


def contracts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """contract_fields() of filing_entries(): a page's entries stay in its task, so that only keys are compared for repetition; those that repeat go the longer way."""
    if not pages.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return contract_fields(filing_entries(pages, key, html), key)
    kind = next(iter(pages.select(key).schema)).dataType
    schema = T.StructType([T.StructField(key, kind), *T._parse_datatype_string(_WIDE).fields])
    types = [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                kept, rows = [], []
                for j, x in enumerate(part.column(1).to_pylist()):
                    found = [(scope, *e) for scope, tables in zip(("correction", "body"), scopes(tables_of(x))) for e in entries(tables)]
                    if found:
                        kept.append(j)
                        rows.append(_fields_of(found))
                values = ([list(v.items()) if isinstance(v, dict) else v for v in (r.get(f.name) for r in rows)] for f in schema.fields[1:])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(kept, pa.int64())), *(pa.array(v, t) for v, t in zip(values, types))], schema.names)

    return pages.select(key, html).mapInArrow(run, schema).select(key, *(_typed(n, F.col(n)).alias(n) for n in schema.names[1:]))


def contract_fields(found: DataFrame, key: str) -> DataFrame:
    """One row for each key of filing_entries(): a column for each field, maps of conditions, the note, related disclosures, and the correction.

    Of a field's rows the last that isn't blank counts. Amounts are whole numbers, the ratio a double, days ISO, or the text where they can't be
    read. Sales below the counterparty are the counterparty's.
    """
    in_map, name = F.create_map(*(F.lit(x) for p in MAPS.items() for x in p)), F.create_map(*(F.lit(x) for p in LABELS.items() for x in p))
    target = F.create_map(*(F.lit(x) for p in TARGETS.items() for x in p))
    x = found.withColumns({"l": bare_label(F.col("label")), "s": bare_label(F.col("section")), "full": ~F.col("value").isin(*_BLANK)})
    body = F.col("scope") == "body"
    x = x.withColumn("map", F.when(body & (F.col("l") != F.col("s")), in_map[F.col("s")]))
    x = x.withColumn("noted", body & F.col("map").isNull() & F.col("s").startswith(NOTES))
    x = x.withColumn("related", body & F.col("map").isNull() & ~F.col("noted") & F.col("l").startswith(RELATED))
    plain = body & F.col("map").isNull() & ~F.col("noted") & ~F.col("related") & F.col("full")
    field = F.when(plain, name[F.col("l")])
    x = x.withColumn("field", F.when((field == "recent_sales") & F.col("s").startswith(COUNTERPARTY), "counterparty_recent_sales").otherwise(field))
    fixed = (F.col("scope") == "correction") & (F.col("section") != CORRECTION) & F.col("full")
    x = x.withColumn("target", F.when(fixed, target[F.col("l")]))

    last = lambda kind, n: F.max_by(F.when(F.col(kind) == n, F.col("value")), F.when(F.col(kind) == n, F.col("place")))
    out = []
    for n in (*dict.fromkeys(LABELS.values()), "counterparty_recent_sales"):
        value = _typed(n, last("field", n))
        out.append(value.alias(n))
    rows = lambda cond, *c: F.array_sort(F.collect_list(F.when(cond, F.struct("place", *c))))
    for n in MAPS.values():
        pairs = rows(F.col("map") == n, "label", "value")
        out.append(F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["label"]), F.create_map(p["label"], p["value"]))).alias(n))
    notes = F.array_distinct(F.transform(rows(F.col("noted") & F.col("full"), "value"), lambda p: p["value"]))
    out.append(F.when(F.size(notes) > 0, F.array_join(notes, " ")).alias("note"))
    out.append(F.max_by(F.when(F.col("related") & F.col("full"), F.col("value")), F.when(F.col("related"), F.col("place"))).alias("related_disclosures"))
    items = rows((F.col("scope") == "correction") & (F.col("section") == CORRECTION), "label", "before", "value")
    out.append(F.transform(items, lambda p: F.struct(p["label"].alias("item"), p["before"].alias("before"), p["value"].alias("after"))).alias("corrected"))
    out += [_typed(n, last("target", n)).alias(n) for n in TARGETS.values()]
    return x.groupBy(key).agg(*out, F.max((F.col("scope") == "correction")).alias("is_correction"))


def business_section(report: Column) -> Column:
    """What a report says of the business, empty where it says nothing: the first section that has the best title and text besides tables, else what follows a keyword.

    A section that isn't closed ends where the next begins.
    """
    bare = lambda x: F.regexp_replace(x, "<[^>]+>", "")
    without = lambda x, tag: F.regexp_replace(x, rf"(?s)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    pieces = F.transform(F.split(F.coalesce(report, F.lit("")), r"<SECTION-2\b[^>]*>"), lambda x: F.split(x, r"</SECTION-[12]\s*>")[0])
    sections = F.transform(F.filter(pieces, lambda _, i: i > 0), lambda x: F.struct(
        text.collapsed(bare(F.regexp_extract(x, r"(?s)<TITLE\b[^>]*>(.*?)</TITLE\s*>", 1))).alias("title"), text.collapsed(bare(text.entities(bare(without(without(x, "TITLE"), "TABLE"))))).alias("text")))
    having = lambda title: F.filter(sections, lambda x: x["title"].contains(title) & (x["text"] != ""))
    titled = [F.get(having(t), F.lit(0))["text"] for t in SECTION_TITLES]
    plain = text.collapsed(F.regexp_replace(F.coalesce(report, F.lit("")), "<[^>]+>", " "))
    behind = [F.when(plain.contains(w), F.substring(plain, F.instr(plain, w) + len(w), F.lit(SECTION_LENGTH))) for w in SECTION_WORDS]
    return text.collapsed(F.coalesce(*(F.substring(x, 1, SECTION_LENGTH) for x in titled), *behind, F.lit("")))
