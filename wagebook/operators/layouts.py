"""Layouts given wholly as data: rules in JSON, which become conditions, values and aggregates over text rows.

A layout is a JSON object with name, version, found (a condition on rows of page 1), every (more of them) and any of the blocks
header, period, lines, tax, tfr, leave and totals. What a block or field leaves out is null. Unknown keys are refused.

Conditions are objects, all of whose parts must hold (null counts as false):
  page: n; above, below: top is less than, at least n; text, compact: a pattern found in the row's text, or in it without spaces;
  label: labels the row contains; starts, is: a label that it starts with, or is; norm: parts of its normalised text; says: parts
  of its text in lower case; word: [i, pattern] of its i-th word; upper: [i, text] that this word is in upper case; amounts: at
  least n amounts; amounts_below: the same in the next row, split amounts joined; any: conditions, one of which holds; not: one
  that does not.
Values are objects with one of
  const; word: i; run: {from: i, fits: pattern}, words from the i-th on as long as they fit; match: [pattern, group] or find:
  pattern (null where nothing is found), in text, compact or another value; amount: i (negative from the end), from: words that
  are left out before; amount_below: i of the next row, split amounts joined; below: n, the first amount of any of the next n
  rows, without sign; after: a label, the first amount after it; iban: word (one that looks like one) or words (put together,
  in this row or else the one before); and of other values join, trim, abs, int, month.
CF_PATTERN and MONTHS in patterns stand for a fiscal code and for a group of the names of months.

Blocks header, tax, tfr and totals have fields: {name: {when, value, take: first (or last), given: true where a row without
value does not count, else: what stands for null}}, boxes: [{when, fields: [[key, name], ...], within}], amounts of the row
below the first row that fits, each for the nearest word that contains a key, and rows, a condition for all of them. A document
without any such row has no row in the block's table. period is a list of {when, mese, anno, tipo, label}: of the first choice
that any row fits, the first such row counts. lines and leave: see Lines and Leave.

All fields of a document come from one aggregate. Rows that lie in buckets by document are not exchanged.
"""

from __future__ import annotations

import json
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagebook.functions import columns as C
from wagebook.functions import ids as I
from wagebook.functions import text as X
from wagebook.functions.spans import Span
from wagebook.operators import documents as D
from wagebook.sources.files import stored

BLOCKS = ["header", "tax", "tfr", "totals"]
KEYS = {
    "layout": {"about", "name", "version", "found", "every", "period", "lines", "leave", *BLOCKS},
    "block": {"rows", "fields", "boxes"},
    "field": {"when", "value", "take", "given", "else"},
    "box": {"when", "fields", "within"},
    "choice": {"when", "mese", "anno", "tipo", "label"},
    "lines": {"begins", "ends", "code", "values_from", "figurative", "zones", "base", "quantity", "amount", "earnings_from", "category", "more", "mapped"},
    "more": {"when", "fields"},
    "leave": {"begins", "within", "rows", "items"},
    "item": {"tipo", "maturato", "goduto", "residuo", "residuo_ap", "beside"},
}


def _known(rule: dict, kind: str, least: tuple[str, ...] = ()) -> dict:
    if not isinstance(rule, dict):
        raise ValueError(f"{kind}: {rule!r} is no object")
    if odd := sorted(set(rule) - KEYS[kind]):
        raise ValueError(f"{kind}: unknown {', '.join(odd)}")
    if lacks := [k for k in least if k not in rule]:
        raise ValueError(f"{kind}: {', '.join(lacks)} is missing")
    return rule


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _many(x) -> list:
    return x if isinstance(x, list) else [x]


def _pattern(p: str) -> str:
    return p.replace("CF_PATTERN", I.CF_PATTERN).replace("MONTHS", D.MONTHS_RE)


def _word(i: int) -> Column:
    return F.try_element_at("words", F.lit(i + 1 if i >= 0 else i))["text"]


def _next() -> Column:
    plain = F.transform("next", lambda w: F.struct(*[w[k].alias(k) for k in ("text", "x0", "x1", "top", "bottom")]))
    return X.amounts(X.enriched(C.repair_split_amounts(plain)))


CONDITIONS = {
    "page": lambda v: F.col("page") == v,
    "above": lambda v: F.col("top") < v,
    "below": lambda v: F.col("top") >= v,
    "text": lambda v: F.col("text").rlike(_pattern(v)),
    "compact": lambda v: F.col("compact").rlike(_pattern(v)),
    "label": lambda v: _all(D.has(t) for t in _many(v)),
    "starts": lambda v: F.col("norm").startswith(X.label(v)),
    "is": lambda v: F.col("norm") == X.label(v),
    "norm": lambda v: _all(F.col("norm").contains(t) for t in _many(v)),
    "says": lambda v: _all(F.lower("text").contains(t) for t in _many(v)),
    "word": lambda v: _word(v[0]).rlike(_pattern(v[1])),
    "upper": lambda v: F.upper(_word(v[0])) == v[1],
    "amounts": lambda v: F.size(X.amounts(F.col("words"))) >= v,
    "amounts_below": lambda v: F.size(_next()) >= v,
    "any": lambda v: reduce(lambda a, b: a | b, [condition(x) for x in v], F.lit(False)),
    "not": lambda v: ~condition(v),
}


def condition(rule: dict) -> Column:
    """The condition that a rule tells; never null. Later parts are not worked out where an earlier one fails."""
    if odd := sorted(set(rule) - set(CONDITIONS)):
        raise ValueError(f"condition: unknown {', '.join(odd)}")
    return _all(F.coalesce(CONDITIONS[k](v), F.lit(False)) for k, v in rule.items())


def _source(rule: dict) -> Column:
    at = rule.get("in", "text")
    if isinstance(at, dict):
        return value(at)
    if at not in ("text", "compact"):
        raise ValueError(f"value: nothing is in {at}")
    return F.col(at)


def _run(start: int, fits: str) -> Column:
    rest = F.slice("words", F.lit(start + 1), F.greatest(F.size("words"), F.lit(1)))
    stop = F.array_position(F.transform(rest, lambda w: w["text"].rlike(_pattern(fits))), False).cast("int")
    return X.text_of(F.when(stop > 0, F.slice(rest, F.lit(1), stop - 1)).otherwise(rest))


def _amount(words: Column, i: int) -> Column:
    return F.try_element_at(words, F.lit(i + 1 if i >= 0 else i))["amt"]


def _iban(kind: str) -> Column:
    if kind == "word":
        return F.get(F.filter("words", lambda w: I.iban_format(w["text"])), F.lit(0))["text"]
    here = F.when(F.col("text").rlike(r"\d{12}"), C.find_iban(F.col("words")))  # only a word of twelve digits can end one
    return F.coalesce(here, F.lag(here).over(D.in_doc()))


VALUES = {
    "const": lambda r: F.lit(r["const"]),
    "word": lambda r: _word(r["word"]),
    "run": lambda r: _run(r["run"]["from"], r["run"]["fits"]),
    "match": lambda r: F.regexp_extract(_source(r), _pattern(r["match"][0]), r["match"][1]),
    "find": lambda r: F.get(F.regexp_extract_all(_source(r), F.lit(_pattern(r["find"])), 0), F.lit(0)),
    "amount": lambda r: _amount(X.amounts(F.slice("words", F.lit(r.get("from", 0) + 1), F.greatest(F.size("words"), F.lit(1)))), r["amount"]),
    "amount_below": lambda r: _amount(_next(), r["amount_below"]),
    "below": lambda r: F.coalesce(*[F.lead(X.first_amount(F.col("words")), k).over(D.in_doc()) for k in range(1, r["below"] + 1)]),
    "after": lambda r: X.amount_after_label(F.col("words"), X.label(r["after"])),
    "iban": lambda r: _iban(r["iban"]),
    "join": lambda r: F.concat(*[value(x) for x in r["join"]]),
    "trim": lambda r: F.trim(value(r["trim"])),
    "abs": lambda r: F.abs(value(r["abs"])),
    "int": lambda r: value(r["int"]).try_cast("int"),
    "month": lambda r: X.month_number(value(r["month"])),
}


def value(rule: dict) -> Column:
    kinds = [k for k in rule if k in VALUES]
    odd = sorted(set(rule) - set(VALUES) - ({"in"} if kinds in (["match"], ["find"]) else {"from"} if kinds == ["amount"] else set()))
    if len(kinds) != 1 or odd:
        raise ValueError(f"value: {rule} is none")
    return VALUES[kinds[0]](rule)


def fields(layout: dict, rows: DataFrame) -> DataFrame:
    """One row for each document: a struct for each block that is told, null where the block has no row, and period.

    What a field needs of its row is worked out first, so that windows are shared; one aggregate then picks the rows.
    """
    per_row, picks, out = {}, [], {}

    def pick(key: str, when: Column, what: Column, given: bool = False, last: bool = False) -> None:
        # The value is worked out on rows that fit alone; windows in it see all rows.
        per_row[f"c_{key}"], per_row[f"v_{key}"] = when, what
        fits = F.col(f"c_{key}") & F.col(f"v_{key}").isNotNull() if given else F.col(f"c_{key}")
        by = F.max_by if last else F.min_by
        picks.append(by(F.when(fits, F.col(f"v_{key}")), F.when(fits, F.col("doc_row"))).alias(f"p_{key}"))

    for block in (b for b in BLOCKS if layout.get(b)):
        rule, within = layout[block], condition(layout[block].get("rows", {}))
        per_row[f"c_{block}"], names = within, {}
        picks.append(F.bool_or(f"c_{block}").alias(f"p_{block}"))
        for name, f in rule.get("fields", {}).items():
            when, what = condition(f["when"]), value(f["value"])
            pick(f"{block}_{name}", within & when, F.when(within & when, what), f.get("given", False), f.get("take") == "last")
            got = F.col(f"p_{block}_{name}")
            names[name] = F.coalesce(got, F.lit(f["else"])) if "else" in f else got
        for i, box in enumerate(rule.get("boxes", [])):
            when = within & condition(box["when"]) & F.col("next").isNotNull()
            near = C.nearest_column(C.markers_where(F.col("words"), [tuple(x) for x in box["fields"]]), F.col("next"), box["within"])
            pick(f"{block}_{i}", when, F.when(when, near))
            for _, name in box["fields"]:
                names[name] = F.try_element_at(f"p_{block}_{i}", F.lit(name))
        out[block] = F.when(F.col(f"p_{block}"), F.struct(*[c.alias(n) for n, c in names.items()]))
    none = F.struct(F.lit(0).alias("mese"), F.lit(0).alias("anno"), F.lit(D.ORDINARY).alias("tipo"), F.lit("").alias("label"))
    choices = layout.get("period", [])
    for i, choice in enumerate(choices):
        part = lambda k, empty: F.coalesce(value(choice[k]), F.lit(empty)) if k in choice else F.lit(empty)  # noqa: B023, E731
        when = condition(choice["when"])
        pick(f"period_{i}", when, F.when(when, F.struct(part("mese", 0).alias("mese"), part("anno", 0).alias("anno"), F.lit(choice.get("tipo", D.ORDINARY)).alias("tipo"), part("label", "").alias("label"))))
    if choices:
        out["period"] = F.coalesce(*[F.col(f"p_period_{i}") for i in range(len(choices))], none)
    r = rows.withColumn("next", F.lead("words").over(D.in_doc()))
    r = r.select("doc_id", "doc_row", *[c.alias(k) for k, c in per_row.items()])
    return r.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows"), *picks).select("doc_id", *[c.alias(k) for k, c in out.items()])


def _kind(rule: dict) -> list[list[str]] | None:
    """A condition of labels alone as a kind of rows (see spans); None for any other."""
    if set(rule) == {"label"}:
        return [_many(rule["label"])] if not any(t[:1] in ("", "^", "!") for t in _many(rule["label"])) else None
    if set(rule) == {"any"}:
        kinds = [_kind(x) for x in rule["any"]]
        return [labels for k in kinds for labels in k] if kinds and None not in kinds else None
    return None


def span(rule: dict) -> Span | None:
    """What lies near the rows of `lines`, where its begins and ends are of labels alone."""
    begins, ends = _kind(rule["begins"]), _kind(rule["ends"])
    return Span(begins, ends) if begins and ends else None


def lines(rule: dict, rows: DataFrame) -> DataFrame:
    """Rows between begins and ends with is_line, a line's fields, and mapped.

    A line's first word fits code; the words up to values_from describe it and those from there are values, each in the zone
    [least x0 (null: left of all others), name] that it lies in, of which base, quantity and amount are read. An amount from
    earnings_from on is an earning. A last word that is figurative makes the value so. category: that of all lines, else by
    description. mapped: conditions of rows that are no lines and yet are not unmapped.
    """
    r = D._described(D._between(rows, condition(rule["begins"]), condition(rule["ends"])), rule["code"], rule["values_from"])
    mark = rule.get("figurative")
    fig = F.coalesce(F.try_element_at("v", F.lit(-1))["text"] == mark, F.lit(False)) if mark else F.lit(False)
    r = r.withColumn("fig", fig).withColumn("v", F.when(F.col("fig"), F.slice("v", F.lit(1), F.size("v") - 1)).otherwise(F.col("v")))
    zones, rest = [tuple(z) for z in rule["zones"] if z[0] is not None], next((n for x, n in rule["zones"] if x is None), None)
    zone = lambda k: F.filter("v", lambda w: C.placed(w["x0"], zones, rest) == rule[k]) if k in rule else F.slice("v", 1, 0)
    q, u, a = D._quantity(zone("quantity"))
    split = C.split_amount_zone(zone("amount"), rule["earnings_from"])
    category = F.lit(rule["category"]) if "category" in rule else C.classify(F.col("descrizione"))
    told = {"codice": F.col("c0"), "categoria": category, "importo_base": X.first_amount(zone("base")), "quantita": q, "unita": u, "aliquota": a, "trattenuta": split["trattenuta"], "competenza": split["competenza"], "raw_text": F.col("text"), "note": F.when(F.col("fig"), D.FIGURATIVE)}
    known = reduce(lambda x, y: x | y, [condition(m) for m in rule.get("mapped", [])], F.lit(False))
    return r.withColumns(told).withColumn("mapped", known).drop("d", "v", "c0", "fig")


def pay_lines(rule: dict, parsed: DataFrame) -> DataFrame:
    """The lines among rows of `lines`, and those of more: a line by its fields for each row that fits."""
    out = parsed.where("is_line").select(*D.LINE)
    types = dict(out.dtypes)
    for m in rule.get("more", []):
        at = {"doc_id": F.col("doc_id"), "page": F.col("page"), "doc_row": F.col("doc_row"), "raw_text": F.col("text")} | {k: value(v) for k, v in m["fields"].items()}
        out = out.unionByName(parsed.where(condition(m["when"])).select(*[at.get(c, F.lit(None)).cast(types[c]).alias(c) for c in D.LINE]))
    return out


def leave(rule: dict, rows: DataFrame) -> DataFrame:
    """Leave of documents: of the first row that fits begins and has any of the named rows among the next `within`, the values of
    the first row of each name, by [name, place]. An item with none of its values is left out; one beside another is there
    only if that one is and its residue is not zero. Without the first of the named rows there is none."""
    r = D.tails(rows, condition(rule["begins"]), rule["rows"], rule["within"])
    r = r.groupBy("doc_id").agg(F.min_by("tail", "doc_row").alias("x"))
    of = lambda k: F.get(F.filter("x", lambda y: y["k"] == k), F.lit(0))["v"]
    r = r.select("doc_id", *[of(k).alias(f"row_{i}") for i, k in enumerate(rule["rows"])]).where("row_0 is not null")
    names, there, out = ["maturato", "goduto", "residuo", "residuo_ap"], {}, []
    for item in rule["items"]:
        cells = {n: F.get(f"row_{rule['rows'].index(item[n][0])}", F.lit(item[n][1])) for n in names if n in item}
        if "beside" in item:
            some = there[item["beside"]] & (cells["residuo"] != 0)
        else:
            some = F.coalesce(*cells.values()).isNotNull()
        there[item["tipo"]] = some
        out.append(F.when(some, F.struct(F.lit(item["tipo"]).alias("tipo"), *[cells.get(n, F.lit(None)).cast(X.DEC).alias(n) for n in names])))
    return r.select("doc_id", F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("b")).select("doc_id", "b.*")


def tables(layout: dict, rows: DataFrame) -> dict[str, DataFrame]:
    """The tables that the layout tells of its documents' rows, as a TemplateProfile's mapping gives them."""
    out = {}
    told = [b for b in [*BLOCKS, "period"] if layout.get(b)]
    if told:
        found = stored(fields(layout, rows), key="doc_id")
        for b in told:
            out[b] = found.where(F.col(b).isNotNull()).select("doc_id", f"{b}.*")
    if "lines" in layout:
        near = [f"near_{t}" for t, s in D.SECTIONS.items() if s == span(layout["lines"]) and f"near_{t}" in rows.columns]
        parsed = stored(lines(layout["lines"], rows.where(near[0]) if near else rows), key="doc_id")
        out["lines"] = pay_lines(layout["lines"], parsed)
        out["unmapped"] = parsed.where("not is_line and not mapped").select("doc_id", "doc_row", "text")
        out["failed"] = D.out_of_range(parsed, rows)
    if "leave" in layout:
        out["leave"] = leave(layout["leave"], rows)
    return out


def check(layout: dict) -> None:
    """Raises ValueError where the layout has a rule that is none, before any data is read."""
    _known(layout, "layout", ("name", "version", "found"))
    rules = [layout["found"], *layout.get("every", [])]
    for block in (layout[b] for b in BLOCKS if b in layout):
        rules.append(_known(block, "block").get("rows", {}))
        for f in block.get("fields", {}).values():
            rules.append(_known(f, "field", ("when", "value"))["when"])
            value(f["value"])
            if f.get("take", "first") not in ("first", "last"):
                raise ValueError("field: first or last is taken")
        rules += [_known(box, "box", ("when", "fields", "within"))["when"] for box in block.get("boxes", [])]
    for choice in layout.get("period", []):
        rules.append(_known(choice, "choice", ("when",))["when"])
        for k in ("mese", "anno", "label"):
            if k in choice:
                value(choice[k])
    if "lines" in layout:
        rule = _known(layout["lines"], "lines", ("begins", "ends", "code", "values_from", "zones", "amount", "earnings_from"))
        rules += [rule["begins"], rule["ends"], *rule.get("mapped", [])]
        for m in rule.get("more", []):
            rules.append(_known(m, "more", ("when", "fields"))["when"])
            if odd := sorted(set(m["fields"]) - set(D.LINE)):
                raise ValueError(f"more: unknown {', '.join(odd)}")
            for v in m["fields"].values():
                value(v)
    if "leave" in layout:
        rules.append(_known(layout["leave"], "leave", ("begins", "within", "rows", "items"))["begins"])
        for item in layout["leave"]["items"]:
            _known(item, "item", ("tipo",))
    for r in rules:
        condition(r)


def profile(layout: dict) -> D.TemplateProfile:
    """The layout as a profile for find_template, parse_words and register_template."""
    check(layout)
    return D.TemplateProfile(layout["name"], layout["version"], condition(layout["found"]), [condition(e) for e in layout.get("every", [])], lambda rows: tables(layout, rows))


def beside_known(own: list[D.TemplateProfile]) -> list[D.TemplateProfile]:
    """The registry with own layouts: one with the name of a known or registered layout is in its place, others come last."""
    by_name = {p.name: p for p in own}
    known = D.default_registry() + D.REGISTRY
    return [by_name.pop(p.name, p) for p in known] + list(by_name.values())


def shipped(name: str) -> dict:
    """A layout that comes with the package."""
    return json.loads((resources.files("wagebook") / "layouts" / f"{name}.json").read_text("utf-8"))


def read(spark: SparkSession, path: str) -> list[D.TemplateProfile]:
    """Profiles of the JSON files under path, on any file system, in the order of their paths. Two of one name are refused."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value").orderBy("path").collect()
    out = [profile(json.loads(f["value"])) for f in files]
    if len({p.name for p in out}) < len(out):
        raise ValueError("two layouts have one name")
    return out
