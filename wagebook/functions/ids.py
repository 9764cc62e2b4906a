"""Column functions over identifiers: fiscal codes, IBANs, pay codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Check values of the fiscal code at odd places, for 0-9 then A-Z; at even places a digit or letter counts
#: as its own number.
CF_ODD = [1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 2, 4, 18, 20, 11, 3, 6, 8, 12, 14, 16, 10, 22, 25, 24, 23]
#: Symbols in the order of their values, patterns, and digits with the letters that they are taken for.
SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CF_PATTERN = "[A-Z]{6}[0-9]{2}[A-Z][0-9]{2}[A-Z][0-9]{3}[A-Z]"
IBAN_PATTERN = "IT[0-9]{2}[A-Z][0-9]{22}"
CONFUSED = {"0": "O", "1": "I", "2": "Z", "5": "S", "6": "G", "8": "B"}
CODE_Z = "^[A-Z]{0,2}[0-9]{4,6}$"


def cf_format(cf: Column) -> Column:
    return cf.rlike(f"^{CF_PATTERN}$")


def cf_check_letter(first15: Column) -> Column:
    """Check letter for the first fifteen characters, or null where one is neither a digit nor A-Z."""
    # Each character becomes the letter of its value, A for 0; all 36 have one at odd and at even places.
    odd = F.translate(first15, SYMBOLS, "".join(chr(65 + v) for v in CF_ODD))
    even = F.translate(first15, SYMBOLS, "".join(chr(65 + (i if i < 10 else i - 10)) for i in range(36)))
    total = F.lit(-15 * 65)
    for i in range(1, 16):
        total = total + F.ascii(F.substring(odd if i % 2 else even, i, 1))
    return F.when(first15.rlike("^[0-9A-Z]{15}$"), F.substring(F.lit(SYMBOLS), 11 + total % 26, F.lit(1)))


def cf_checksum_valid(cf: Column) -> Column:
    return F.coalesce((F.length(cf) == 16) & (cf_check_letter(F.substring(cf, 1, 15)) == F.substring(cf, 16, 1)), F.lit(False))


def iban_format(iban: Column) -> Column:
    return iban.rlike(f"^{IBAN_PATTERN}$")


def iban_mod97_valid(iban: Column) -> Column:
    """ISO 7064 mod 97-10, letters as two-digit numbers. Lower case counts as upper; other characters make it invalid."""
    turned = F.upper(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4)))
    digits = turned
    for i, c in enumerate(SYMBOLS[10:]):
        digits = F.replace(digits, F.lit(c), F.lit(str(10 + i)))
    # Up to 72 digits are four numbers of 18, which built-in arithmetic takes in one go; longer texts are folded.
    padded, short = F.lpad(digits, 72, "0"), F.lit(0).cast("long")
    for k in range(4):
        short = (short * (10**18 % 97) + F.substring(padded, 18 * k + 1, 18).try_cast("long") % 97) % 97

    def step(a: Column, i: Column) -> Column:
        at = F.instr(F.lit(SYMBOLS), F.substring(turned, i, F.lit(1))) - 1
        return F.when(at >= 10, (a * 100 + at) % 97).otherwise((a * 10 + at) % 97)

    rest = F.when(F.length(turned) <= 36, short).otherwise(F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step))
    return F.coalesce(F.when(turned.rlike("^[0-9A-Z]+$"), rest == 1), F.lit(False))


def recover_iban(raw: Column) -> Column:
    """struct(iban, repaired). The fifth character must be a letter; a digit there becomes the letter it is taken for,
    if the whole then passes the checksum."""
    fifth = F.substring(raw, 5, 1)
    letter = F.translate(fifth, "".join(CONFUSED), "".join(CONFUSED.values()))
    fixed = F.concat(F.substring(raw, 1, 4), letter, F.substring(raw, F.lit(6), F.length(raw)))
    good = F.coalesce((F.length(raw) == 27) & raw.startswith("IT") & fifth.isin(list(CONFUSED)) & iban_mod97_valid(fixed), F.lit(False))
    return F.struct(F.when(good, fixed).otherwise(raw).alias("iban"), good.alias("repaired"))


def recover_code(raw: Column) -> Column:
    """struct(code, reason): '2' before a letter was a Z; one odd character before a good code is dropped."""
    cut = F.substring(raw, F.lit(2), F.length(raw))
    as_z = F.concat(F.lit("Z"), cut)
    kind = F.when(raw.rlike(CODE_Z), None).when(raw.rlike("^2[A-Za-z]") & as_z.rlike(CODE_Z), "font_digit_lettera").when(raw.rlike("^[^A-Z0-9]") & cut.rlike(CODE_Z), "prefisso_spurio")
    code = F.when(kind == "font_digit_lettera", as_z).when(kind == "prefisso_spurio", cut).otherwise(raw)
    return F.struct(code.alias("code"), kind.alias("reason"))


def is_code(raw: Column) -> Column:
    return F.coalesce(raw.rlike(CODE_Z) | recover_code(raw)["reason"].isNotNull(), F.lit(False))


def suspect_code(code: Column, z_was_two_in_document: Column) -> Column:
    """A digits-only code that starts with 2, in a document where a Z was read as 2 elsewhere."""
    return F.coalesce(z_was_two_in_document & code.rlike("^2[0-9]{3,5}$"), F.lit(False))


def leading_code_index(words: Column) -> Column:
    """Place (from 0) of the pay code among the first three words, or null."""
    at = F.array_position(F.transform(F.slice(words, 1, 3), lambda w: is_code(w["text"])), True).cast("int")
    return F.when(at > 0, at - 1)
