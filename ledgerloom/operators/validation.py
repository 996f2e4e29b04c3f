"""Cross-checks of figures, and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE = 2


def adds_up(total: Column, *parts: Column, tolerance: float = TOLERANCE) -> Column:
    """Whether the parts add up; null if any figure is."""
    s = parts[0]
    for p in parts[1:]:
        s = s + p
    return F.abs(total - s) < tolerance


def cross_check(wide: DataFrame) -> DataFrame:
    """Result and balance identities of wide line items."""
    return wide.withColumns({
        "pnl": adds_up(F.col("driftsresultat"), F.col("sum_driftsinntekter"), -F.col("sum_driftskostnader")),
        "bs": adds_up(F.col("sum_eiendeler"), F.col("sum_egenkapital"), F.col("sum_gjeld")),
    })


def continuity(yearly: DataFrame, key: str, year: str, opening: str, closing: str, tolerance: float = TOLERANCE) -> DataFrame:
    """``prior_closing`` of the year before, and whether ``opening`` agrees with it (null without that year)."""
    w = Window.partitionBy(key).orderBy(year)
    prior = F.when(F.lag(year).over(w) == F.col(year) - 1, F.lag(closing).over(w))
    return yearly.withColumn("prior_closing", prior).withColumn("continuous", F.abs(F.col(opening) - F.col("prior_closing")) < tolerance)


def near(a: str, b: str) -> Column:
    return F.abs(F.col(a) - F.col(b)) < TOLERANCE




def signals(figures: DataFrame, keys: list[str]) -> DataFrame:
    """The seventeen checks in long form (keys, signal, passed); a check whose figures are not columns is left out."""
    c = F.col
    rules = {
        "payroll_headcount": (["aarsverk", "lonnskostnad"], lambda: F.when(c("aarsverk") == 0, F.abs(c("lonnskostnad")) < 1000).otherwise(True)),
        "equity_opening": (["egenkapital_inn", "egenkapital_ut_forrige"], lambda: near("egenkapital_inn", "egenkapital_ut_forrige")),
        "equity_movement": (["aarsresultat_note", "aarsresultat"], lambda: near("aarsresultat_note", "aarsresultat")),
        "tax_payable": (["betalbar_skatt_note", "betalbar_skatt"], lambda: near("betalbar_skatt_note", "betalbar_skatt")),
        "fixed_assets": (["bokfort_verdi_note", "varige_driftsmidler"], lambda: near("bokfort_verdi_note", "varige_driftsmidler")),
        "pledged_assets": (["pantstillelse", "sum_eiendeler"], lambda: c("pantstillelse") <= c("sum_eiendeler")),
        "inventory": (["varelager_note", "varelager"], lambda: near("varelager_note", "varelager")),
        "restricted_funds": (["bundne_midler", "bankinnskudd"], lambda: c("bundne_midler") <= c("bankinnskudd")),
        "restricted_covers_tax": (["bundne_midler", "skyldig_skattetrekk"], lambda: c("bundne_midler") >= c("skyldig_skattetrekk")),
        "pledged_deposits": (["pantsatt_bankinnskudd", "bankinnskudd"], lambda: c("pantsatt_bankinnskudd") <= c("bankinnskudd")),
        "intercompany_net": (["fordring_konsern", "gjeld_konsern", "netto_konsern"], lambda: F.abs(c("fordring_konsern") - c("gjeld_konsern") - c("netto_konsern")) < TOLERANCE),
        "pension_declared": (["antall_ansatte", "otp_erklart"], lambda: (c("antall_ansatte") <= 0) | c("otp_erklart")),
        "holiday_pay": (["skyldige_feriepenger", "lonnskostnad"], lambda: c("skyldige_feriepenger").between(0.06 * c("lonnskostnad"), 0.18 * c("lonnskostnad"))),
        "personnel_chain": (["aarsverk", "leder_ansatt_annet"], lambda: (c("aarsverk") > 0) | c("leder_ansatt_annet")),
        "related_receivable_sign": (["fordring_naerstaende"], lambda: c("fordring_naerstaende") >= 0),
        "intercompany_symmetry": (["salg_konsern", "kjop_motpart"], lambda: near("salg_konsern", "kjop_motpart")),
        "shareholder_loan_interest": (["gjeld_aksjonaer", "renter_beregnet"], lambda: (c("gjeld_aksjonaer") <= 0) | c("renter_beregnet")),
    }
    rows = []
    for name, (needs, rule) in rules.items():
        if set(needs) <= set(figures.columns):
            known = F.lit(True)
            for n in needs:
                known = known & c(n).isNotNull()
            rows.append(F.struct(F.lit(name).alias("signal"), F.when(known, rule()).alias("passed")))
    if not rows:
        return figures.select(*keys, F.lit(None).cast("string").alias("signal"), F.lit(None).cast("boolean").alias("passed")).where("false")
    return figures.select(*keys, F.inline(F.array(*rows)))


def token_cost(tokens_in: Column, tokens_out: Column) -> Column:
    """Dollars at 0.15 and 0.60 a million tokens."""
    return tokens_in / 1e6 * 0.15 + tokens_out / 1e6 * 0.60


def shared_cost(notes: DataFrame, doc: str, cost: str) -> DataFrame:
    """Each note's equal share of its document's cost."""
    return notes.withColumn("note_cost", F.col(cost) / F.count("*").over(Window.partitionBy(doc)))


def note_counts(docs: DataFrame, doc: str) -> DataFrame:
    """Notes of a document, and those with amounts (``notes``: array of structs with a map ``amounts``)."""
    with_amounts = F.filter("notes", lambda n: F.size(n["amounts"]) > 0)
    return docs.select(doc, F.greatest(F.size("notes"), F.lit(0)).alias("n_notes"), F.greatest(F.size(with_amounts), F.lit(0)).alias("n_with_amounts"))


def explode_notes(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each note, with its fields and the document's; documents without notes have none."""
    d = docs.select(*keep, F.explode("notes").alias("_n")).select(*keep, "_n.*")
    return d.withColumnsRenamed({"nr": "note_nr", "type": "note_type"})
