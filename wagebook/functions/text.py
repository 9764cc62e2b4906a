"""Column functions over single words, numbers, labels and dates as Italian payslips print them.

Extracted text is never trusted to parse: what is not a number or a date becomes null. Digits are ASCII digits.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Context, Decimal, InvalidOperation

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

DEC = "decimal(14,5)"
#: Fixed values.
AMOUNT_TOKEN = r"-?\d{1,3}(?:\.\d{3})*,\d+|-?\d+,\d+|-?\d+"
UNITS = ["GG", "ORE", "%"]
PARENS = ["(", ")", "{", "}"]
MONTHS = ["gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre"]


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def normalize_label(text: Column) -> Column:
    """Letters and digits only, lower case, without any s: some fonts print a space as s."""
    return F.translate(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]", "")), "s", "")


def label(text: str) -> str:
    """normalize_label of a constant."""
    return "".join(c for c in text if c.isascii() and c.isalnum()).lower().replace("s", "")


def parse_amount(token: Column) -> Column:
    """'1.234,56', '(128,00)', '{5' -> decimal. An opening or a closing mark each make the value negative by itself."""
    core = F.replace(F.replace(F.regexp_replace(token, r"^\s*[({]?\s*|\s*\)?\s*$", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    value = F.when(core.rlike(NUMBER), core.try_cast(DEC))
    return F.when(token.rlike(r"^\s*[({]|\)\s*$"), -value).otherwise(value)


def _odd_amount(core: str) -> Decimal | None:
    """A number with an exponent or many digits, as a cast to DEC gives it."""
    try:
        value = Decimal(core).quantize(Decimal("0.00001"), ROUND_HALF_UP, Context(prec=60))
    except InvalidOperation:
        return None
    return value if abs(value) < 10**9 else None


def amounts_of(tokens: pa.Array) -> pa.Array:
    """parse_amount of many tokens at once, inside a task."""
    space = "[ \\t\\n\\x0b\\f\\r]"
    kind = pa.decimal128(14, 5)
    some = pc.fill_null(pc.match_substring_regex(tokens, "[0-9]"), False)
    at, token = pc.indices_nonzero(some), tokens.filter(some)
    core = pc.replace_substring_regex(token, f"^{space}*[({{]?{space}*|{space}*\\)?{space}*$", "")
    core = pc.replace_substring(pc.replace_substring(core, ".", ""), ",", ".")
    plain = pc.match_substring_regex(core, r"^-?[0-9]{1,9}(\.[0-9]{1,5})?$")
    value = pc.cast(pc.if_else(plain, core, pa.scalar(None, core.type)), kind)
    if not pc.all(plain).as_py():
        odd = pc.and_(pc.invert(plain), pc.match_substring_regex(core, NUMBER))
        if pc.any(odd).as_py():
            value = pc.replace_with_mask(value, odd, pa.array([_odd_amount(x) for x in core.filter(odd).to_pylist()], kind))
    minus = pc.match_substring_regex(token, f"^{space}*[({{]|\\){space}*$")
    value = pc.if_else(minus, pc.cast(pc.negate(value), kind), value)
    return pa.nulls(len(tokens), kind) if not len(at) else pc.replace_with_mask(pa.nulls(len(tokens), kind), some, value)


def out_of_range(token: Column) -> Column:
    """Whether token is a number that no amount column can hold. Such a number fails its document."""
    core = F.replace(F.replace(F.regexp_replace(token, r"^\s*[({]?\s*|\s*\)?\s*$", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.coalesce((F.length(core) > 9) & core.rlike(NUMBER) & core.try_cast(DEC).isNull(), F.lit(False)) | F.coalesce(core.rlike("[0-9][eE]") & core.rlike(NUMBER) & core.try_cast(DEC).isNull(), F.lit(False))


def find_amounts(text: Column) -> Column:
    """All number tokens of a text, in order."""
    return F.regexp_extract_all(text, F.lit(f"({AMOUNT_TOKEN})"), 1)


def month_number(name: Column) -> Column:
    """1 to 12, or null."""
    at = F.array_position(F.lit(MONTHS), F.lower(name)).cast("int")
    return F.when(at > 0, at)


def parse_italian_month_year(text: Column) -> Column:
    """struct(mese, anno) of the first letters-space-year group; null where the letters name no month."""
    pattern = r"([A-Za-zàèéìòù]+)\s+(\d{4})"
    month = month_number(F.regexp_extract(text, pattern, 1))
    return F.when(month.isNotNull(), F.struct(month.alias("mese"), F.regexp_extract(text, pattern, 2).try_cast("int").alias("anno")))


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")


def parse_date(text: Column, sep: str = "-") -> Column:
    """With '-': the first dd-mm-yyyy found in text. With '/': text as a whole is d/m/yyyy. Impossible dates are null."""
    p = r"(\d{2})-(\d{2})-(\d{4})" if sep == "-" else r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    y, m, d = (F.regexp_extract(text, p, k) for k in (3, 2, 1))
    return F.when(text.rlike(p) & (y != "0000"), _date(y, m, d))


def looks_like_data(token: Column) -> Column:
    return F.coalesce(token.isin(UNITS + PARENS) | parse_amount(token).isNotNull(), F.lit(False))


def has_amount(text: Column) -> Column:
    """Whether any word of a row's text is a number."""
    return F.coalesce(F.exists(F.split(F.trim(text), r"\s+"), lambda t: parse_amount(t).isNotNull()), F.lit(False))


def enriched(words: Column) -> Column:
    """Words with amt, the amount that each one's text is, and data, whether it is a unit, a mark or an amount.

    Later operators read these instead of parsing again.
    """
    return F.transform(
        words,
        lambda w: F.struct(w["text"].alias("text"), w["x0"].alias("x0"), w["x1"].alias("x1"), w["top"].alias("top"), w["bottom"].alias("bottom"), parse_amount(w["text"]).alias("amt")),
    )


def is_data(w: Column) -> Column:
    """looks_like_data of an enriched word."""
    return w["amt"].isNotNull() | w["text"].isin(UNITS + PARENS)


def amounts(words: Column) -> Column:
    """Enriched words that are amounts; marks standing alone are not."""
    return F.filter(words, lambda w: w["amt"].isNotNull())


def first_amount(words: Column) -> Column:
    """Absolute value of the first amount among enriched words."""
    return F.abs(F.get(amounts(words), F.lit(0))["amt"])


def amount_after_label(words: Column, wanted: str) -> Column:
    """First amount after the word that completes the label; where no word completes it, the first amount of all.

    Normalising goes letter by letter, so the row's label is looked for once, and one pass over the lengths of the words says
    which word its end lies in.
    """
    norm = F.transform(words, lambda w: normalize_label(w["text"]))
    start = F.instr(F.array_join(norm, ""), F.lit(wanted))
    end = F.when(start > 0, start + (len(wanted) - 1))

    def step(state: Column, n: Column) -> Column:
        upto = state["upto"] + F.coalesce(F.length(n), F.lit(0))
        ends = (state["at"] == 0) & (upto >= state["end"])
        return F.struct(state["end"].alias("end"), upto.alias("upto"), (state["k"] + 1).alias("k"), F.when(ends, state["k"] + 1).otherwise(state["at"]).alias("at"))

    begin = F.struct(end.cast("int").alias("end"), F.lit(0).alias("upto"), F.lit(0).alias("k"), F.lit(0).alias("at"))
    at = F.aggregate(norm, begin, step, lambda s: s["at"])
    return first_amount(F.slice(words, at + 1, F.greatest(F.size(words), F.lit(1))))


def text_of(words: Column, sep: str = " ") -> Column:
    return F.array_join(F.transform(words, lambda w: w["text"]), sep)
