"""Column functions over the words of a row: zones by x, amounts by zone, nearest column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagebook.functions.text import PARENS

#: Keywords of pay-line descriptions, first match wins.
CATEGORIES = [
    ("contributo", ["f.do sostegno", "contributo ivs", "contributo previp", "ctr.prev"]),
    ("assenza", ["ferie godute", "perm.", "permesso"]),
    ("benefit", ["ticket elettronico", "polizza rsmo", "vendita azioni", "stock options", "cassa inf"]),
    ("rimborso", ["spese carta di credito"]),
    ("retribuzione", ["retribuzione ordinaria", "anticipo retribuzione", "anticipo festivit", "mensilita", "malattia", "assenza assunti", "premio", "arrotond"]),
]
#: Fixed values: (least x0, zone), from the right.
ZONES = {
    "z": [(445.0, "importo"), (345.0, "riferimento"), (200.0, "importo_base")],
    "c": [(420.0, "importo"), (345.0, "dato_base")],
    "s1": [(520.0, "competenza"), (455.0, "trattenuta"), (365.0, "importi_figurati"), (280.0, "importo_base"), (230.0, "ore_giorni")],
    "s2": [(520.0, "competenza"), (455.0, "trattenuta"), (385.0, "aliquota"), (300.0, "importo_base")],
    "s_tax": [(478.0, "imposta_pagata_annua"), (374.0, "imposta_dovuta_annua"), (259.0, "imposta_lorda_annua"), (121.0, "imponibile_fiscale_annuo"), (0.0, "retribuzione_utile_tfr_annua")],
    "s_inps": [(236.0, "cong_debito_annuo"), (182.0, "cong_credito_annuo"), (121.0, "ctr_dip_inps_progr_annuo"), (57.0, "ctr_inps_progr_annuo"), (0.0, "imp_inps_progr_annuo")],
}
#: The zone left of all others, and where the earnings column begins.
REST = {"z": "descrizione", "c": "ore_gg"}
EARNINGS_FROM = {"z": 513.0, "c": 503.0, "s": 520.0}


def classify(description: Column) -> Column:
    low = F.lower(description)
    out = F.lit("altro")
    for name, keys in reversed(CATEGORIES):
        hit = F.lit(False)
        for k in keys:
            hit = hit | low.contains(k)
        out = F.when(hit, name).otherwise(out)
    return out


def placed(x0: Column, zones: list[tuple[float, str]], rest: str | None = None) -> Column:
    """Name of the first of zones (least x0, name; from the right) that x0 lies in; left of all zones rest."""
    out = F.lit(rest).cast("string")
    for least, name in reversed(zones):
        out = F.when(x0 >= least, name).otherwise(out)
    return out


def column_of(x0: Column, zones: str) -> Column:
    """Zone name of x0; left of all zones the layout's rest, or null."""
    return placed(x0, ZONES[zones], REST.get(zones))


def in_zone(words: Column, zones: str, name: str) -> Column:
    return F.filter(words, lambda w: column_of(w["x0"], zones) == name)


def split_amount_zone(words: Column, earnings_from: float) -> Column:
    """struct(trattenuta, competenza) of the first amount: a mark anywhere, a minus, or a place left of the earnings
    column make it a deduction, given without sign."""
    first = F.get(F.filter(words, lambda w: w["amt"].isNotNull()), F.lit(0))
    minus = F.exists(words, lambda w: w["text"].isin(PARENS)) | (first["amt"] < 0) | (first["x0"] < earnings_from)
    return F.struct(F.when(minus, F.abs(first["amt"])).alias("trattenuta"), F.when(~minus, first["amt"]).alias("competenza"))


def repair_split_amounts(words: Column) -> Column:
    """Words (text, x0, x1, top, bottom) in which '2.911,2' followed by '3' is one word again. From left to right: a word
    that ended an amount begins none."""
    cut, tail = r"^\d{1,3}(\.\d{3})*,\d$", r"^\d{1,2}$"
    # A tail never looks like a cut amount, so pairs cannot overlap.
    def one(w: Column, i: Column) -> Column:
        nxt, prev = F.get(words, i + 1), F.get(words, i - 1)
        joins = F.coalesce(w["text"].rlike(cut) & nxt["text"].rlike(tail), F.lit(False))
        eaten = F.coalesce((i > 0) & prev["text"].rlike(cut) & w["text"].rlike(tail), F.lit(False))
        return F.struct(
            F.when(joins, F.concat(w["text"], nxt["text"])).otherwise(w["text"]).alias("text"), w["x0"].alias("x0"), F.when(joins, nxt["x1"]).otherwise(w["x1"]).alias("x1"),
            w["top"].alias("top"), F.when(joins, nxt["bottom"]).otherwise(w["bottom"]).alias("bottom"), eaten.alias("eaten"),
        )

    kept = F.filter(F.transform(words, one), lambda w: ~w["eaten"])
    return F.transform(kept, lambda w: F.struct(w["text"].alias("text"), w["x0"].alias("x0"), w["x1"].alias("x1"), w["top"].alias("top"), w["bottom"].alias("bottom")))


#: The words of an IBAN in their order.
IBAN_WORDS = [r"^\d{2}$", r"^[A-Z]$", r"^\d{5}$", r"^\d{5}$", r"^\d{12}$"]


def find_iban(words: Column) -> Column:
    """IBAN put together from five words found from left to right, with anything between: 2 digits, a letter, twice 5
    digits, 12 digits.

    One fold over the words keeps how many of the five it has: whatever can follow a later word can follow the first that
    fits, so nothing is tried twice.
    """
    line = F.array_join(F.transform(words, lambda w: w["text"]), " ")

    def step(state: Column, word: Column) -> Column:
        out = state
        for k, pattern in enumerate(IBAN_WORDS):
            fits = (state["found"] == k) & word.rlike(pattern)
            out = F.when(fits, F.struct(F.lit(k + 1).alias("found"), F.concat(state["iban"], word).alias("iban"))).otherwise(out)
        return out

    start = F.struct(F.lit(0).alias("found"), F.lit("IT").alias("iban"))
    # Only a row with a word of twelve digits can fit; the others are not folded.
    words_of = F.when(line.rlike(r"(^| )\d{12}( |$)"), F.split(line, " "))
    return F.aggregate(words_of, start, step, lambda s: F.when(s["found"] == len(IBAN_WORDS), s["iban"]))


def nearest_column(markers: Column, words: Column, tolerance: float) -> Column:
    """map field -> amount. Each amount among words goes to the marker (x0, field) with the nearest x0, the first of equal
    ones, if that is within tolerance; of several amounts of a field the last stays. Null where nothing is matched."""
    def one(w: Column) -> Column:
        near = F.array_min(F.transform(markers, lambda m, i: F.struct(F.abs(m["x0"] - w["x0"]).alias("d"), i.alias("i"), m["field"].alias("field"))))
        return F.struct(F.when(near["d"] <= tolerance, near["field"]).alias("field"), w["amt"].alias("amt"))

    got = F.filter(F.transform(F.filter(words, lambda w: w["amt"].isNotNull()), one), lambda x: x["field"].isNotNull())
    # Each lambda gives its array a name, so that it is worked out once and not for each of its elements.
    last = F.transform(F.array(got), lambda g: F.filter(g, lambda x, i: ~F.exists(F.slice(g, i + 2, F.size(g) + 1), lambda y: y["field"] == x["field"])))
    return F.get(F.transform(last, lambda x: F.when(F.size(x) > 0, F.map_from_entries(x))), F.lit(0))


def markers_where(words: Column, fields: list[tuple[str, str]]) -> Column:
    """(x0, field) of words whose lower text contains a key, in word order."""
    def one(w: Column) -> Column:
        return F.filter(F.array(*[F.struct(w["x0"].alias("x0"), F.when(F.lower(w["text"]).contains(k), f).alias("field")) for k, f in fields]), lambda m: m["field"].isNotNull())

    return F.flatten(F.transform(words, one))
